"""A query's rows beside those of its SQL, in a form that both engines share."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def plain(value: object) -> object:
    """Numbers as rounded floats or integers, times as text, so that engines agree on types."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, list | tuple):
        return [plain(x) for x in value]
    return value


def rows_of(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], list[str]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(sql: str, folder: str) -> tuple[list[str], list[str]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    return sorted(columns), rows_of(columns, found.fetchall())
