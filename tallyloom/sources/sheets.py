"""Strict CSV of any size: a file is read in splits, and counts of quotes tell where its records begin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.session import settled

PARSE = {"quote": '"', "escape": '"', "multiLine": "true", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Lines that are numbered together, as a power of two.
CHUNK = 10


def _count(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``line`` (from 1, the record's first) and ``value`` of the records of CSV files; a quoted cell may hold line feeds.

    A line starts within a quoted cell if the quotes before it in its file are odd: each
    chunk of a split (``CHUNK`` lines at most) counts its quotes and lines, and where records
    begin last in it for either start; running values over the chunks of a file, a row each,
    tell every chunk how it starts and which record is open there. So a file is read by as
    many tasks as it has splits, what a task sorts is chunks and not splits, however large
    these are, and a task groups whole records. A quote that is never closed makes a record
    of all that follows.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select("value", meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), _count(F.col("value"), '"').alias("q")).withColumn("chunk", F.shiftright("at", CHUNK))
    here = ["path", "block", "chunk"]  # ids rise within a split, so chunks do
    in_chunk = Window.partitionBy(*here).orderBy("at")
    quotes = F.coalesce(F.sum("q").over(in_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = lines.select(*here, "q", (quotes % 2).alias("odd"), F.row_number().over(in_chunk).alias("k"))
    begins = [F.max(F.when(F.col("odd") == odd, F.col("k"))) for odd in (0, 1)]
    chunks = counted.groupBy(*here).agg(F.sum("q").alias("q"), F.count("*").alias("n"), F.array(*begins).alias("begins"))
    before = Window.partitionBy("path").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    summed = chunks.select(*here, "begins", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("q", "n")))
    last = F.col("n_before") + F.get("begins", (F.col("q_before") % 2).cast("int"))
    starts = summed.withColumn("last", last).select(*here, "q_before", "n_before", F.last("last", ignorenulls=True).over(before).alias("open"))
    placed = lines.join(starts, here).select(*here, "at", "value", "open", (F.col("n_before") + F.row_number().over(in_chunk)).alias("line"), ((F.col("q_before") + quotes) % 2 == 0).alias("begins"))
    first = F.coalesce(F.max(F.when(F.col("begins"), F.col("line"))).over(in_chunk), F.col("open"))
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"])
    every = placed.select("path", first.alias("first"), "line", "value").groupBy("path", F.col("first").alias("line")).agg(F.array_join(pieces, "\n").alias("value"))
    plain = F.when(F.col("line") == 1, F.ltrim("value", F.lit("﻿"))).otherwise(F.col("value"))
    ended = F.when(F.endswith(plain, F.lit("\r")), F.substring(plain, F.lit(1), F.char_length(plain) - 1)).otherwise(plain)
    return every.select("path", "line", ended.alias("value")).filter("value <> ''")  # a regex would mend bytes that are not UTF-8


def csv_fault(value: Column, cells: int) -> Column:
    """What is wrong with a record of so many cells, or null: ``not_utf8``, ``open_quote``, ``stray_quote``
    (within a cell that is not quoted, or text after a closing one), ``bare_return`` or ``cells``."""
    parts = F.split(value, '"', -1)
    last = F.size(parts) - 1
    outside = F.filter(parts, lambda x, i: i % 2 == 0)
    ends = F.size(outside) - 1
    ill = lambda x, i: (x != "") & (((i > 0) & ~x.startswith(",")) | ((i < ends) & ~x.endswith(",")))
    commas = F.aggregate(outside, F.lit(0), lambda n, x: n + _count(x, ","))
    return (
        F.when(~F.is_valid_utf8(value), "not_utf8")
        .when(last % 2 == 1, "open_quote")
        .when(F.size(F.filter(outside, ill)) > 0, "stray_quote")
        .when(F.exists(outside, lambda x: F.contains(x, F.lit("\r"))), "bare_return")
        .when(commas + 1 != cells, "cells")
    )


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The names in the header of the first file."""
    head = spark.read.options(**PARSE).csv(path).limit(1).collect()
    return [(x or "").lstrip("﻿") for x in head[0]] if head else []


def csv_rows(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``file``, ``line``, ``fault`` and ``cells`` (an array of texts, null with a fault) of each record below the headers.

    A header that is not ``names`` is a row with the fault ``header``.
    """
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    read = csv_records(spark, path).withColumn("fault", csv_fault(F.col("value"), len(names)))
    row = F.from_csv("value", F.lit(schema), PARSE)
    cells = F.when(F.col("fault").isNull(), F.array(*(F.coalesce(row[f"c{i}"], F.lit("")) for i in range(len(names)))))
    met = read.withColumn("cells", cells)
    right = F.coalesce(F.col("cells") == F.array(*map(F.lit, names)), F.lit(False))
    kept = met.filter((F.col("line") > 1) | ~right).withColumn("fault", F.when(F.col("line") == 1, "header").otherwise(F.col("fault")))
    return kept.select(F.element_at(F.split("path", "/"), -1).alias("file"), "line", "fault", "cells")


def scan_csv(spark: SparkSession, path: str, fields: Sequence[str], key: str | None = None) -> DataFrame:
    """CSV files of exact strings: quoted line feeds, doubled quotes, a byte-order mark allowed; a file may have any number of splits.

    Refuses a header that repeats or lacks a field and, if ``key`` is given, repeated
    keys. Columns beyond ``fields`` are dropped; empty cells are empty strings, empty lines
    no rows. Records with too few or too many cells, stray or open quotes or bytes that are
    not UTF-8, and headers that differ between files, fail when rows are read and are named
    by file and line.
    """
    names = header_of(spark, path)
    if not names:
        raise ValueError("the file has no rows")
    if len(set(names)) < len(names):
        raise ValueError("the header repeats a column")
    if lacking := [f for f in fields if f not in names]:
        raise ValueError(f"the header lacks {', '.join(lacking)}")
    read = csv_rows(spark, path, names)
    refused = F.raise_error(F.concat_ws(" ", F.lit("malformed CSV record:"), "fault", F.lit("in"), "file", F.lit("line"), F.col("line").cast("string")))
    good = read.filter(F.when(F.col("fault").isNull(), F.lit(True)).otherwise(refused.cast("boolean")))
    rows = good.select(*(F.col("cells")[names.index(f)].alias(f) for f in fields))
    if key is not None:
        rows = settled(rows)  # so that the check of keys does not read the files a second time
        if not rows.groupBy(key).count().filter("count > 1").isEmpty():
            raise ValueError(f"{key} is repeated")
    return rows


def bad_rows(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``file``, ``line`` and ``fault`` of the records that ``scan_csv`` refuses."""
    return csv_rows(spark, path, names).filter("fault IS NOT NULL").select("file", "line", "fault")
