"""Strict readers and plain writers. Paths are Spark's, on any store that it reads."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyloom.functions.json import json_fault
from tallyloom.operators.corpus import tree_digest
from tallyloom.operators.trace import last_wins
from tallyloom.session import drop_folder
from tallyloom.sources import stores


def scan_csv(spark: SparkSession, path: str, fields: Sequence[str], key: str | None = None) -> DataFrame:
    """A CSV file of exact strings: quoted line feeds, doubled quotes, a byte-order mark allowed.

    Refuses a header that repeats or lacks a field and, if ``key`` is given, repeated
    keys. Columns beyond ``fields`` are dropped; empty cells are empty strings. Rows
    with too few or too many cells fail when they are read, as all columns are parsed.
    Rows come in file order from one task a file; ``sheets.scan_csv`` reads a file of any
    size by its splits, in no order, and is stricter.
    """
    options = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "FAILFAST", "inferSchema": "false", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "columnPruning": "false"}
    head = spark.read.options(**options | {"header": "false"}).csv(path).limit(1).collect()
    names = [x.lstrip("﻿") if x else "" for x in head[0]] if head else []
    if not names:
        raise ValueError("the file has no rows")
    if len(set(names)) < len(names):
        raise ValueError("the header repeats a column")
    if lacking := [f for f in fields if f not in names]:
        raise ValueError(f"the header lacks {', '.join(lacking)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.options(**options).schema(schema).csv(path).select(*(F.coalesce(F.col(f"`{f}`"), F.lit("")).alias(f) for f in fields))
    if key is not None and not rows.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{key} is repeated")
    return rows


def bad_cells(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """How many cells of each column do not have its type: ``column`` and ``n``, never the values."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), (F.col(c).isNotNull() & (F.col(c) != "") & F.col(c).try_cast(t).isNull()).alias("bad")) for c, t in types.items()))
    return rows.select(F.explode(cells).alias("c")).select("c.*").filter("bad").groupBy("column").agg(F.count("*").alias("n"))


def scan_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or compressed; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def strict_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Lines with their ``fault`` (null for one strict object that fits the schema) and ``row``."""
    parsed = F.from_json(F.make_valid_utf8("value"), schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"})
    read = lines.filter(F.trim("value") != "").withColumn("row", parsed).withColumn("fault", json_fault(F.col("value")))
    return read.withColumn("fault", F.coalesce("fault", F.when(F.col("row._corrupt").isNotNull(), "not_typed")))


def scan_jsonl_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with ``line_ok``: a line must be UTF-8 and one object that fits, at any depth, without
    repeated keys or NaN; bad lines stay, marked, and name their ``fault``."""
    read = strict_lines(spark.read.text(path), schema).withColumn("line_ok", F.col("fault").isNull())
    return read.select("line_ok", "fault", "row.*").drop("_corrupt")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file`` (name), ``line`` (from 1) and ``value`` of the lines of text files of any size.

    A split's lines are numbered where they are read; how many lines the splits of a file
    before it hold comes from a count a split. No file is read by one task, nothing is sorted.
    """
    read = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = read.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    met = read.join(starts, ["path", "block"])
    return met.select(F.element_at(F.split("path", "/"), -1).alias("file"), (F.col("start") + F.col("at") - F.col("first") + 1).alias("line"), "value")


def bad_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``file``, ``line`` (from 1) and ``fault`` of lines that ``scan_jsonl_strict`` marks."""
    return strict_lines(numbered_lines(spark, path), schema).filter("fault IS NOT NULL").select("file", "line", "fault")


def scan_layouts(spark: SparkSession, paths: Sequence[str], key: str, fields: Sequence[str]) -> DataFrame:
    """Answers from JSON lines of two layouts, flat (``key`` and fields) or nested (``request`` and ``answer``),
    told by the first row of each path; a later path's answer replaces an earlier one's."""
    tables = []
    text = ", ".join(f"{c} string" for c in (key, *fields))
    for path in paths:
        first = spark.read.text(path).limit(1).collect()
        nested = bool(first) and '"request"' in first[0][0]
        rows = spark.read.schema(f"request struct<{key}: string>, answer struct<{', '.join(f'{f}: string' for f in fields)}>" if nested else text).json(path)
        tables.append(rows.select(f"request.{key}", "answer.*") if nested else rows)
    return last_wins(tables, key, *fields)


def scan_needle(spark: SparkSession, path: str, needle: str, schema: str) -> DataFrame:
    """JSON lines that hold a text: it is looked for before a line is parsed."""
    return spark.read.text(path).filter(F.contains("value", F.lit(needle))).select(F.from_json("value", schema).alias("r")).select("r.*")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``place`` (from 0, over files by name and then lines) and ``value`` of the lines of text files of any size."""
    lines = numbered_lines(spark, path)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    sizes = lines.groupBy("file").agg(F.count("*").alias("n"))
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(starts, "file").select((F.col("start") + F.col("line") - 1).alias("place"), "value")


def lines_digest(spark: SparkSession, path: str) -> DataFrame:
    """``records`` and ``digest`` of all lines of text files in file order."""
    return tree_digest(placed_lines(spark, path).withColumn("d", F.sha2("value", 256)), "place", "d")


def file_hashes(spark: SparkSession, path: str, within: str | None = None, block: int = 1 << 20) -> DataFrame:
    """``file``, ``sha256`` and ``length`` of each file under ``path``, read in blocks of a megabyte, so of any size.

    Spark lists the files; each is streamed by one task (SHA-256 has no other order) that
    holds one block. Files are named by their path below ``within``, or by their last part.
    Spark's listing leaves out empty files, and so does this.
    """
    with stores.listing_by_cores(spark):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1) if within is None else F.regexp_replace("path", "^.*?" + re.escape(urlparse(within).path.strip("/")) + "/", "")
    if stores.scheme_of(spark, path) not in stores.STREAMED:  # read whole: up to Spark's 2 GB a value
        return listed.select(name.alias("file"), F.sha2("content", 256).alias("sha256"), "length")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for uri in batch.column("path").to_pylist():
                store, inner = stores.opened(uri)
                digest = hashlib.sha256()
                with store.open_input_stream(inner, compression=None) as stream:
                    while piece := stream.read(block):
                        digest.update(piece)
                out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(out, pa.string())], ["path", "length", "sha256"])

    return stores.spread(listed.select("path", "length"), "path").mapInArrow(hashed, "path string, length long, sha256 string").select(name.alias("file"), "sha256", "length")


def write_manifest(spark: SparkSession, folder: str, to: str) -> None:
    """Writes the hashes of all files of a folder, as JSON lines in the order of their names, to a folder beside it.

    Marks that writers leave (names that start with ``_`` or ``.``) are no part of it.
    """
    write_jsonl(file_hashes(spark, folder, folder).orderBy("file"), to)


def manifest_faults(spark: SparkSession, folder: str, manifest: str, name: Column | None = None) -> DataFrame:
    """``file`` and ``fault`` where a folder is not what its manifest says: ``missing``, ``unlisted`` or ``changed``.

    ``name`` makes the manifest's name of ``file``; without it they are the same.
    """
    said = scan_jsonl(spark, manifest, "file string, sha256 string, length long").select("file", F.struct("sha256", "length").alias("said"))
    found = file_hashes(spark, folder, folder).select((F.col("file") if name is None else name).alias("file"), F.struct("sha256", "length").alias("found"))
    fault = F.when(F.col("found").isNull(), "missing").when(F.col("said").isNull(), "unlisted").when(F.col("said") != F.col("found"), "changed")
    return said.join(found, "file", "full").select("file", fault.alias("fault")).filter("fault IS NOT NULL")


def write_jsonl(df: DataFrame, path: str, compressed: bool = False) -> None:
    """JSON lines without null fields."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").option("compression", "gzip" if compressed else "none").json(path)


def write_csv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """CSV with a header and a fixed order of columns."""
    df.select(*fields).write.mode("overwrite").options(header="true", quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """One JSON document with sorted keys at every level from a table of one row; nulls are written, not a number is null."""
    row = df.select(F.to_json(_sorted(df.schema, lambda name: F.col(name)), {"ignoreNullFields": "false"}).alias("value"))
    row.coalesce(1).write.mode("overwrite").text(path)


def _sorted(fields: T.StructType, get: Callable[[str], Column]) -> Column:
    """A struct of the fields in order of name."""
    out = []
    for field in sorted(fields, key=lambda f: f.name):
        value = get(field.name)
        if isinstance(field.dataType, T.StructType):
            value = _sorted(field.dataType, value.getField)
        elif isinstance(field.dataType, T.FloatType | T.DoubleType):
            value = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
        out.append(value.alias(field.name))
    return F.struct(*out)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a folder's files."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def write_sized(spark: SparkSession, df: DataFrame, folder: str, name: str, gzip_over: int) -> str:
    """JSON lines, plain up to a size, else compressed with the plain form removed; returns the name. Compressed parts
    hold no time, so equal parts are equal bytes."""
    write_jsonl(df, f"{folder}/{name}")
    if size_of(spark, f"{folder}/{name}") <= gzip_over:
        return name
    spark.read.text(f"{folder}/{name}").write.mode("overwrite").option("compression", "gzip").text(f"{folder}/{name}.gz")
    drop_folder(spark, f"{folder}/{name}")
    return f"{name}.gz"
