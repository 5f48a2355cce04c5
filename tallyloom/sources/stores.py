"""Files that tasks open themselves, where no reader of Spark's fits."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Stores that a task can stream from, by scheme, and pyarrow's name of each.
STREAMED = {"file": "file", "hdfs": "hdfs", "s3a": "s3", "s3": "s3", "gs": "gs"}


def scheme_of(spark: SparkSession, path: str) -> str:
    """The scheme of a path, the session's own where it names none."""
    return urlparse(path).scheme or urlparse(spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).scheme


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and authority, as ``opened`` wants it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a full URI and the path in it."""
    scheme, _, rest = uri.partition(":")
    if scheme not in STREAMED:
        raise ValueError(f"no task can stream from {uri}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{STREAMED[scheme]}:{rest}")


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by hash over all shuffle partitions.

    Such rows name files, so they are few bytes and much work: partitions without a number
    would be merged by their bytes, and one task would do all.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


@contextmanager
def listing_by_cores(spark: SparkSession) -> Iterator[None]:
    """Within it Spark lists folders with a task a core; otherwise it starts a task a folder, up to 10,000."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(2, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)
