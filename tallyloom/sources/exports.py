"""Reads a whole export folder, whatever state it is in: what a file lacks becomes a row, and the rest goes on."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.ranking import METRICS
from tallyloom.session import settled
from tallyloom.sources import files

ID = "review_id string"
RECORD = f"{ID}, source_sha256 string, text_key string, status string, reason string, topic string, intent string, sentiment string, severity string, evidence_quote string, label_config string, cache_source_id string"
CALL = "request_id string, role string, review_ids array<string>, phase string, outcome string, label_config string, input_tokens string, output_tokens string"
#: Files of JSON lines with their schemas, and sheets with their columns.
LINES = {"records.jsonl": RECORD, "calls.jsonl": CALL, "checkpoint_before.json": ID, "checkpoint_after.json": ID}
SHEETS = {"membership.csv": ("issue_id", "review_id"), "ranking.csv": ("rank", "issue_id", *METRICS), "claims.csv": ("claim_id", "issue_id", "metric", "value")}


@dataclass(frozen=True)
class Export:
    """The ``tables`` of a folder by name (without their endings) and its ``faults`` (``code``, ``detail``)."""

    tables: dict[str, DataFrame]
    faults: DataFrame

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.tables[name]
        except KeyError:
            raise AttributeError(name) from None


def names_of(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files of a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return {s.getPath().getName() for s in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)}


def _lines(spark: SparkSession, path: str, name: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good lines of a file, once, and its bad ones by number. A field of another kind than a text keeps its own form as text."""
    read = settled(files.strict_lines(files.numbered_lines(spark, path), schema))
    bad = read.filter("fault IS NOT NULL").select(F.lit("malformed_jsonl").alias("code"), F.concat_ws(":", F.lit(name), F.col("line").cast("string")).alias("detail"))
    return read.filter("fault IS NULL").select("row.*").drop("_corrupt"), bad


def _sheet(spark: SparkSession, path: str, name: str, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV file whose header and cells fit; a file with any row that does not, or that is not UTF-8, counts as unreadable."""
    options = {"multiLine": "true", "quote": '"', "escape": '"', "emptyValue": "", "columnPruning": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    head = spark.read.options(**options).csv(path).limit(1).collect()
    names = [(x or "").lstrip("﻿") for x in head[0]] if head else []
    if len(set(names)) < len(names) or set(fields) - set(names):
        return empty(spark, fields), unreadable(spark, name)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_corrupt")])
    read = settled(spark.read.options(**options, header="true").schema(schema).csv(path))
    broken = F.col("_corrupt").isNotNull() | ~reduce(lambda a, b: a & b, (F.coalesce(F.is_valid_utf8(F.col(f"`{f}`")), F.lit(True)) for f in fields))
    bad = read.filter(broken).select(F.lit("unreadable_file").alias("code"), F.lit(name).alias("detail")).distinct()
    return read.filter(~broken).select(*(F.coalesce(F.col(f"`{f}`"), F.lit("")).alias(f) for f in fields)), bad


def empty(spark: SparkSession, fields: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{f} string" for f in fields))


def unreadable(spark: SparkSession, name: str, code: str = "unreadable_file") -> DataFrame:
    return spark.createDataFrame([(code, name)], "code string, detail string")


def read_export(spark: SparkSession, folder: str) -> Export:
    """All tables of an export folder. A file that is missing or cannot be read as a whole is
    an empty table and a fault; of one that is there plain and compressed the plain form
    is read and the fault is ``ambiguous_file``; bad lines are left out, each with a fault.
    Tables are parsed once and kept in the shared folder."""
    there = names_of(spark, folder)
    tables, faults = {}, [spark.createDataFrame([], "code string, detail string")]
    for name in (*LINES, *SHEETS):
        forms = [n for n in (name, f"{name}.gz") if n in there]
        if len(forms) == 2:
            faults.append(unreadable(spark, name, "ambiguous_file"))
        if not forms:
            rows, bad = spark.createDataFrame([], LINES[name]) if name in LINES else empty(spark, SHEETS[name]), unreadable(spark, name)
        elif name in LINES:
            rows, bad = _lines(spark, f"{folder}/{forms[0]}", name, LINES[name])
        else:
            rows, bad = _sheet(spark, f"{folder}/{forms[0]}", name, SHEETS[name])
        tables[name.split(".")[0]] = rows
        faults.append(bad)
    return Export(tables, reduce(DataFrame.unionByName, faults))
