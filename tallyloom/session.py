"""The session that tests, benchmarks and local runs use."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Defaults that hold at any size; a cluster's own settings take precedence.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "6g", **more: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session it gives."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tallyloom").config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**DEFAULTS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor see.

    It is the cluster's ``spark.checkpoint.dir``; only where that is unset and Spark runs
    on this machine alone (tests) a temporary folder stands in. A cluster without it is
    an error, as its executors would not see each other's files.
    """
    context = spark.sparkContext
    where = context.getConf().get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if where is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = where or f"file://{tempfile.mkdtemp(prefix='checkpoint-')}"
        context.setCheckpointDir(where)
        current = context._jsc.sc().getCheckpointDir()
    return where or os.path.dirname(current.get())


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, where lost executors do not matter."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate files, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
