"""Exact tests and intervals at any count: log-gamma and the incomplete beta function as column expressions.

Arguments are columns or numbers. Probabilities come out with an absolute error of about 1e-12.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = Column | float | int


def _col(x: Number) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _series(z: Column) -> Column:
    """What Stirling's formula for log z! leaves over, z from 16."""
    y = 1 / (z * z)
    return (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y / 1188)))) / z


def _rising(x: Column) -> Column:
    """The logarithm of (x + 1) ... (x + 16)."""
    out = x + 1
    for i in range(2, 17):
        out = out * (x + i)
    return F.log(out)


def stirling_error(x: Number) -> Column:
    """log x! less Stirling's formula, x above 0: small numbers by way of x + 16."""
    x = _col(x)
    z = x + 16
    near = (z + 0.5) * F.log(z) - z + _series(z) - _rising(x) - (x + 0.5) * F.log(x) + x
    return F.when(x < 16, near).otherwise(_series(x))


def log_gamma(x: Number) -> Column:
    """The logarithm of the gamma function of x above 0."""
    z = _col(x) + 15
    whole = (z + 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + _series(z)
    return whole - _rising(_col(x) - 1)


def _deviance(x: Column, mean: Column) -> Column:
    """x log(x / mean) + mean - x, without cancelling where x is near the mean."""
    return let((x - mean) / mean, lambda e: mean * ((1 + e) * F.log1p(e) - e))


def _binomial_raw(x: Number, n: Number, p: Number, q: Number) -> Column:
    """x hits of n with chances p and q = 1 - p, for real x and n too, by Loader's saddle-point form (2000)."""
    x, n, p, q = (_col(v) for v in (x, n, p, q))
    inner = F.exp(stirling_error(n) - stirling_error(x) - stirling_error(n - x) - _deviance(x, n * p) - _deviance(n - x, n * q)) * F.sqrt(n / (2 * math.pi * x * (n - x)))
    edge = F.when((x < 0) | (x > n), 0.0).when(p <= 0, (x == 0).cast("double")).when(q <= 0, (x == n).cast("double"))
    return edge.when(x == 0, F.exp(n * F.log(q))).when(x == n, F.exp(n * F.log(p))).otherwise(inner)


def binomial_pmf(k: Number, n: Number, p: Number) -> Column:
    """The chance of k hits in n draws."""
    return _binomial_raw(k, n, p, 1 - _col(p))


def incomplete_beta(x: Number, a: Number, b: Number) -> Column:
    """The regularised incomplete beta function of a and b above 0, 0 up to x = 0 and 1 from x = 1 on.

    Its continued fraction is unrolled by Lentz's method on the side where it converges, in
    a number of steps that grows with the root of the larger parameter.
    """

    def fraction(v: Column) -> Column:
        def step(at: Column, j: Column) -> Column:
            m = F.floor(j / 2).cast("double")
            odd = -(v["a"] + m) * (v["a"] + v["b"] + m) / ((v["a"] + 2 * m) * (v["a"] + 2 * m + 1))
            even = m * (v["b"] - m) / ((v["a"] + 2 * m - 1) * (v["a"] + 2 * m))
            fresh = lambda c: F.struct((1 / (1 + c * at["d"])).alias("d"), (1 + c / at["c"]).alias("c"))
            return let(let(F.when(j % 2 == 1, odd).otherwise(even) * v["x"], fresh), lambda s: F.struct(s["c"].alias("c"), s["d"].alias("d"), (at["f"] * s["c"] * s["d"]).alias("f")))

        steps = F.sequence(F.lit(1), F.ceil(80 + 6 * F.sqrt(F.greatest(v["a"], v["b"]))).cast("int"))
        start = F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(1.0).alias("f"))
        part = _binomial_raw(v["a"], v["a"] + v["b"], v["x"], 1 - v["x"]) * v["b"] / (v["a"] + v["b"]) / F.aggregate(steps, start, step, lambda at: at["f"])
        return F.when(v["flip"], 1 - part).otherwise(part)

    x, a, b = _col(x), _col(a), _col(b)
    flip = x > (a + 1) / (a + b + 2)
    sides = F.struct(flip.alias("flip"), F.when(flip, 1 - x).otherwise(x).alias("x"), F.when(flip, b).otherwise(a).alias("a"), F.when(flip, a).otherwise(b).alias("b"))
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(let(sides, fraction))


def binomial_cdf(k: Number, n: Number, p: Number) -> Column:
    """The chance of at most k hits in n draws."""
    k, n, p = _col(k), _col(n), _col(p)
    return F.when(k < 0, 0.0).when(k >= n, 1.0).otherwise(incomplete_beta(1 - p, n - k, k + 1))


def sign_test(wins: Column, losses: Column) -> Column:
    """The two-sided exact sign test (McNemar's exact test of a pair's discordant counts)."""
    return F.least(F.lit(1.0), 2 * binomial_cdf(F.least(wins, losses), wins + losses, 0.5))


def mid_p(wins: Column, losses: Column) -> Column:
    """McNemar's mid-p test: the exact test with half the chance of what was seen taken off."""
    n, least = wins + losses, F.least(wins, losses)
    seen = binomial_pmf(least, n, 0.5)
    return F.when(wins == losses, 1 - seen / 2).otherwise(F.greatest(F.lit(0.0), 2 * binomial_cdf(least, n, 0.5) - seen))


def _halved(below: Callable[[Column], Column], low: Number, high: Number, halvings: int) -> Column:
    """Where ``below``, true up to some place, stops being so."""
    start = F.struct(_col(low).alias("low"), _col(high).alias("high"))

    def step(at: Column, _: Column) -> Column:
        move = lambda m: F.when(below(m), F.struct(m.alias("low"), at["high"].alias("high"))).otherwise(F.struct(at["low"].alias("low"), m.alias("high")))
        return let((at["low"] + at["high"]) / 2, move)

    return F.aggregate(F.sequence(F.lit(1), F.lit(halvings)), start, step, lambda at: (at["low"] + at["high"]) / 2)


def clopper_pearson(hits: Column, n: Column, alpha: float = 0.05, halvings: int = 50) -> tuple[Column, Column]:
    """The ends of the exact interval of a share, where the tails of the binomial distribution hold alpha / 2."""
    low = F.when(hits == 0, 0.0).otherwise(_halved(lambda p: incomplete_beta(p, hits, n - hits + 1) < alpha / 2, 0, 1, halvings))
    high = F.when(hits == n, 1.0).otherwise(_halved(lambda p: incomplete_beta(p, hits + 1, n - hits) < 1 - alpha / 2, 0, 1, halvings))
    return low, high


def t_two_sided(t: Number, df: Number) -> Column:
    """The chance that Student's t is at least as far from 0."""
    t, df = _col(t), _col(df)
    return incomplete_beta(df / (df + t * t), df / 2, 0.5)


def t_critical(df: Number, alpha: float = 0.05, halvings: int = 60) -> Column:
    """Where the two-sided chance of Student's t is alpha."""
    df = _col(df)
    share = _halved(lambda x: incomplete_beta(x, df / 2, 0.5) < alpha, 0, 1, halvings)
    return let(share, lambda x: F.sqrt(df * (1 - x) / x))


def hypergeometric_pmf(k: Number, drawn: Number, marked: Number, total: Number) -> Column:
    """The chance that ``drawn`` of ``total`` rows, of which some are marked, hold k marked ones."""
    k, drawn, marked, total = (_col(v) for v in (k, drawn, marked, total))
    p = drawn / total
    parts = _binomial_raw(k, marked, p, 1 - p) * _binomial_raw(drawn - k, total - marked, p, 1 - p)
    return F.when((drawn == 0) | (drawn == total), (k == F.when(drawn == 0, 0).otherwise(marked)).cast("double")).otherwise(parts / _binomial_raw(drawn, total, p, 1 - p))


def critical_count(d: Number, alpha: float = 0.05) -> Column:
    """The largest number of losses among d discordant pairs at which the sign test still rejects; -1 if none does."""
    d = _col(d)
    rejects = lambda k: 2 * binomial_cdf(k, d, 0.5) <= alpha
    found = _halved(lambda k: rejects(F.floor(k)), -1, F.floor(d / 2) + 1, 40)
    return let(F.round(found), lambda k: F.when(rejects(k), k).otherwise(k - 1)).cast("long")
