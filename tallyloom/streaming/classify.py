"""Labelling as a stream: files come in, each distinct text is labelled once, a restart goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def classify_stream(spark: SparkSession, source: str, schema: str, label: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 4) -> DataFrame:
    """Labels the texts of all Parquet files in ``source`` and returns the labels so far.

    Which texts came before is keyed state (RocksDB, on ``text_key``): a micro-batch of up
    to ``files_per_batch`` files costs what it brings, however much was labelled earlier,
    and no earlier output is read. Labels go into a folder of the batch's number. A batch
    that runs again after a failure starts from the state of the batch before it, so it
    brings the same texts and replaces its own output. The query ends when the source is
    read; another call goes on from its checkpoint, whose number of state partitions stays
    as at the start. A null ``text_key`` is a key. Without any file there are no labels.
    """
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

        def write(batch: DataFrame, number: int) -> None:
            label(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

        fresh = stream.dropDuplicates(["text_key"])
        query = fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(STORE, before)
    labelled = label(spark.createDataFrame([], schema))
    return spark.read.schema(labelled.withColumn("batch", F.lit(0)).schema).option("basePath", out).parquet(out) if exists(spark, out) else labelled.withColumn("batch", F.lit(0))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
