"""What a paired comparison of a given size can show: the power of McNemar's exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.exact import binomial_cdf, binomial_pmf, critical_count


def discordant(p_a: Column, p_b: Column, phi: Column) -> tuple[Column, Column]:
    """The shares of pairs that only the first and only the second gets right, from both shares
    of right answers and the correlation of errors; null where no such pairs can be."""
    both_wrong = (1 - p_a) * (1 - p_b) + phi * F.sqrt(p_a * (1 - p_a) * p_b * (1 - p_b))
    fits = (both_wrong <= F.least(1 - p_a, 1 - p_b) + 1e-12) & (both_wrong >= F.greatest(F.lit(0.0), 1 - p_a - p_b) - 1e-12)
    return tuple(F.when(fits, F.greatest(F.lit(0.0), 1 - p - both_wrong)) for p in (p_b, p_a))


def largest_phi(p_a: Column, p_b: Column) -> Column:
    """The largest correlation of errors that two shares of right answers allow."""
    return (F.least(1 - p_a, 1 - p_b) - (1 - p_a) * (1 - p_b)) / F.sqrt(p_a * (1 - p_a) * p_b * (1 - p_b))


def mcnemar_power(designs: DataFrame, *, alpha: float = 0.05, only_a: str = "only_a", only_b: str = "only_b", n: str = "n") -> DataFrame:
    """``designs`` with ``power``, ``power_a`` (rejected because the first is better), ``win``, ``tie`` and ``lose``.

    The number of discordant pairs is binomial, and so is its split. A design is spread
    over a row for each such number; those with a chance under 1e-18 are left out, which
    takes less than n * 1e-18 away. Where the exact test rejects depends on the number
    alone and is found once for all designs. A design without discordant pairs always
    ties; null shares give nulls; rows repeated in full come back once.
    """
    given = designs.columns
    some = F.col(only_a) + F.col(only_b)
    counts = F.explode(F.sequence(F.lit(0), F.col(n).cast("int"))).alias("d")
    spread = designs.select(F.struct(*given).alias("design"), some.alias("some"), (F.col(only_a) / F.nullif(some, F.lit(0.0))).alias("share"), F.col(n).alias("pairs"), counts)
    weighed = spread.withColumn("weight", binomial_pmf(F.col("d"), F.col("pairs"), F.col("some"))).filter("weight IS NULL OR weight >= 1e-18")
    bounds = weighed.select("d").distinct().withColumn("most", critical_count(F.col("d"), alpha))
    share, d = F.coalesce("share", F.lit(0.5)), F.col("d")
    below = binomial_cdf(F.col("most"), d, share)
    above = 1 - binomial_cdf(d - F.col("most") - 1, d, share)
    tied = F.when(d % 2 == 0, binomial_pmf(d / 2, d, share)).otherwise(0.0)
    lost = binomial_cdf(F.ceil(d / 2) - 1, d, share)
    each = weighed.join(bounds, "d").select("design", "weight", (below + above).alias("power"), above.alias("power_a"), (1 - lost - tied).alias("win"), tied.alias("tie"), lost.alias("lose"))
    sums = (F.sum(F.col("weight") * F.col(c)).alias(c) for c in ("power", "power_a", "win", "tie", "lose"))
    return each.groupBy("design").agg(*sums).select("design.*", "power", "power_a", "win", "tie", "lose")


def pairs_needed(powers: DataFrame, *, target: float = 0.8, by: str = "design", n: str = "n", power: str = "power_a") -> DataFrame:
    """``first`` size that reaches the power and ``stable``, from which on all sizes reach it, as
    exact power goes up and down with n; null where none does (a partial maximum and two minima, no sort)."""
    least = F.max(F.when(F.col(power) < target, F.col(n))).alias("short")
    last = powers.groupBy(by).agg(least, F.min(F.when(F.col(power) >= target, F.col(n))).alias("first"))
    after = powers.join(last, by).groupBy(by, "first").agg(F.min(F.when(F.col("short").isNull() | (F.col(n) > F.col("short")), F.col(n))).alias("stable"))
    return after.select(by, "first", "stable")
