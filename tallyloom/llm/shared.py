"""Helpers that several operators use: lineage cuts and gapless positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.session import shared_dir


#: Spark's setting by which the shuffle files of a run are deleted when it ends.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def swept(df: DataFrame) -> DataFrame:
    """``df`` to be run once: its shuffle files go when that run ends. Otherwise they stay until the
    driver happens to collect its garbage, and an iteration's many small ones fill the disks."""
    conf = df.sparkSession.conf
    before = conf.get(SWEEP, "false")
    conf.set(SWEEP, "true")
    try:
        return df.select("*")  # the setting is read where a frame is made
    finally:
        conf.set(SWEEP, before)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that what follows
    neither repeats the work nor depends on the executors that did it; its shuffle files go."""
    shared_dir(df.sparkSession)
    return swept(df).checkpoint(eager=True)


def hash_bucket(columns: list[str | Column], buckets: int = 256) -> Column:
    """A bucket from 0 that depends on the columns' values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def running_start(df: DataFrame, groups: list[str], order: list[str | Column], value: Column, out: str, bucket: Column) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group that come
    before, in order of (``bucket``, ``order``); with ``value`` 1 a gapless position.

    No group is ever gathered in one task: rows are dealt by (group, bucket), each
    bucket gets its offset from the per-bucket totals (a row a bucket and group), and
    only the rows of one bucket are sorted together. ``groups`` must hold no nulls.
    Rows equal in ``order`` and ``bucket`` are numbered in any order.
    """
    dealt = df.withColumn("__b", bucket)
    before = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*groups, "__b").agg(F.sum(value).alias("__t"))
    offsets = totals.select(*groups, "__b", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy(*groups, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.join(offsets, [*groups, "__b"])
    return joined.withColumn(out, (F.col("__o") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long")).drop("__b", "__o")


def words(text: Column) -> Column:
    """Maximal runs of non-space characters of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
