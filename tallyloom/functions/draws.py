"""Random draws as column expressions: seeds in, so a lost task draws the same again."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.exact import _deviance, let, stirling_error

#: Chance that all attempts at a draw fail: below 0.35 ** 48, or 1e-21.
ATTEMPTS = 48


def uniform(*seeds: Column | str) -> Column:
    """A number inside (0, 1) that the seeds decide, of 52 bits."""
    return (F.pmod(F.xxhash64(*seeds), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _by_inversion(mean: Column, u: Column) -> Column:
    """How many cumulative chances ``u`` passes; what is left after mean + 9 sqrt(mean) + 12 terms is below what ``u`` resolves."""

    def step(acc: Column, i: Column) -> Column:
        term = acc["t"] * mean / i
        return F.struct(term.alias("t"), (acc["c"] + term).alias("c"), (acc["n"] + (u > acc["c"]).cast("double")).alias("n"))

    first = F.exp(-mean)
    terms = F.sequence(F.lit(1), F.ceil(mean + 9 * F.sqrt(mean) + 12).cast("int"))
    return F.aggregate(terms, F.struct(first.alias("t"), first.alias("c"), F.lit(0.0).alias("n")), step, lambda acc: acc["n"])


def _log_chance(k: Column, mean: Column) -> Column:
    """Log of the Poisson chance of ``k``, without cancelling at large means."""
    return F.when(k == 0, -mean).otherwise(-0.5 * F.log(2 * math.pi * k) - stirling_error(k) - _deviance(k, mean))


def _by_rejection(mean: Column, *seeds: Column | str) -> Column:
    """Transformed rejection with squeeze (Hörmann 1993, PTRS), for means of 10 and more."""
    b = 0.931 + 2.53 * F.sqrt(mean)
    a = -0.059 + 0.02483 * b
    inverse = 1.1239 + 1.1328 / (b - 3.4)
    inside = 0.9277 - 3.6224 / (b - 2)

    def attempt(i: Column) -> Column:
        u, v = uniform(*seeds, i, F.lit("u")) - 0.5, uniform(*seeds, i, F.lit("v"))
        edge = 0.5 - F.abs(u)
        k = F.floor((2 * a / edge + b) * u + mean + 0.43).cast("double")
        return F.struct(edge.alias("e"), v.alias("v"), k.alias("k"))

    def accepted(t: Column) -> Column:
        squeezed = (t["e"] >= 0.07) & (t["v"] <= inside)
        refused = (t["k"] < 0) | ((t["e"] < 0.013) & (t["v"] > t["e"]))
        exact = F.log(t["v"] * inverse / (a / (t["e"] * t["e"]) + b)) <= _log_chance(t["k"], mean)
        return F.when(squeezed, True).when(refused, False).otherwise(exact)

    def step(acc: Column, i: Column) -> Column:
        return F.when(acc.isNotNull(), acc).otherwise(let(attempt(i), lambda t: F.when(accepted(t), t["k"])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ATTEMPTS)), F.lit(None).cast("double"), step)


def poisson(mean: Column, *seeds: Column | str) -> Column:
    """A Poisson number of any mean, as a double: the same law at every size, 0 for a mean of 0, null for null or below 0."""
    m = mean.cast("double")
    return F.when(m == 0, 0.0).when((m > 0) & (m < 10), _by_inversion(m, uniform(*seeds, F.lit("i")))).when(m >= 10, _by_rejection(m, *seeds))
