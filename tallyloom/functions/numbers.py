"""Exact numbers and simple intervals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micro_mean(total: str, n: str) -> Column:
    """A mean of whole numbers in millionths, half up, without fractions; null for none."""
    return F.expr(f"CASE WHEN {n} > 0 THEN CAST((2 * CAST({total} AS DECIMAL(38,0)) * 1000000 + {n}) DIV (2 * {n}) AS BIGINT) END")


def six_places(micros: Column) -> Column:
    """Millionths from 0 up as a text with six decimal places."""
    return F.concat(F.floor(micros / 1_000_000).cast("string"), F.lit("."), F.lpad((micros % 1_000_000).cast("string"), 6, "0"))


def fraction(a: Column, b: Column) -> Column:
    """A ratio to six places, null over zero."""
    return F.round(a / F.nullif(b, F.lit(0)), 6)


def wilson(hits: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """The ends of Wilson's interval of a share."""
    p, zz = hits / n, z * z
    middle, spread = p + zz / (2 * n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    return (middle - spread) / (1 + zz / n), (middle + spread) / (1 + zz / n)


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """A share as text in percent, half up, without fractions on the way; null over zero."""
    scale = 10**places
    units = F.floor((2 * part.cast("decimal(28,0)") * 100 * scale + whole) / F.nullif(2 * whole, F.lit(0))).cast("long")
    return F.concat(F.floor(units / scale).cast("string"), F.lit("."), F.lpad((units % scale).cast("string"), places, "0"), F.lit("%"))


def wald(hits: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """The ends of Wald's interval of a share."""
    p = hits / n
    reach = z * F.sqrt(p * (1 - p) / n)
    return p - reach, p + reach
