"""Exact tests against sums of whole numbers, at small and large counts."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import exact
from tallyloom.operators import significance


def tail(k: int, n: int) -> float:
    """At most k of n at even chances, by whole numbers."""
    total, term = 0, 1
    for i in range(k + 1):
        total += term
        term = term * (n - i) // (i + 1)
    return float(Fraction(total, 1 << n))


def tail_at(k: int, n: int, p: float) -> float:
    """At most k of n, terms from the largest down in extended precision."""
    i = np.arange(1, n + 1, dtype=np.longdouble)
    logs = np.concatenate([[np.longdouble(0)], np.cumsum(np.log(n - i + 1) - np.log(i))])
    j = np.arange(n + 1, dtype=np.longdouble)
    terms = np.exp(logs + j * np.log(np.longdouble(p)) + (n - j) * np.log1p(-np.longdouble(p)))
    return float(terms[: k + 1].sum() / terms.sum())


def test_tests_at_any_count(spark):
    cases = [(0, 0), (5, 1), (30, 10), (1409, 1375), (595, 547), (5, 5), (1500, 1500), (0, 3000), (500_800, 499_200), (498_000, 502_000), (500_000, 500_000)]
    rows = spark.createDataFrame(cases, "w long, l long")
    for r in rows.select("w", "l", exact.sign_test(F.col("w"), F.col("l")).alias("p"), exact.mid_p(F.col("w"), F.col("l")).alias("mid")).collect():
        w, lost = r["w"], r["l"]
        n, least = w + lost, min(w, lost)
        assert 0 <= r["p"] <= 1 and 0 <= r["mid"] <= 1
        low = tail(least, n) if n <= 3000 else tail_at(least, n, 0.5)
        own = low - (tail(least - 1, n) if n <= 3000 else tail_at(least - 1, n, 0.5)) if least else low
        assert abs(r["p"] - min(1.0, 2 * low)) < 1e-9
        assert abs(r["mid"] - (1 - own / 2 if w == lost else 2 * low - own)) < 1e-9


@pytest.mark.parametrize(("n", "p"), [(10, 0.3), (3000, 0.02), (3000, 0.5), (1_000_000, 0.37), (1_000_000, 1e-6)])
def test_binomial(spark, n, p):
    at = sorted({0, 1, n, n - 1, *(max(0, min(n, int(n * p + z * math.sqrt(n * p * (1 - p))))) for z in (-8, -3, -1, 0, 0.5, 2, 6))})
    rows = spark.createDataFrame([(k,) for k in (-1, *at, n + 1)], "k long")
    for r in rows.select("k", exact.binomial_cdf(F.col("k"), n, p).alias("cdf"), exact.binomial_pmf(F.col("k"), n, p).alias("pmf")).collect():
        k = r["k"]
        want = 0.0 if k < 0 else 1.0 if k >= n else tail_at(k, n, p)
        assert abs(r["cdf"] - want) < 1e-9
        own = 0.0 if k < 0 or k > n else want - (tail_at(k - 1, n, p) if k else 0.0)
        assert abs(r["pmf"] - own) < 1e-9


def test_gamma_and_beta(spark):
    xs = [0.1, 0.5, 1.0, 1.5, 2.0, 3.7, 15.9, 16.0, 100.0, 1e6]
    rows = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in rows.select("x", exact.log_gamma(F.col("x")).alias("g"), exact.incomplete_beta(0.3, F.col("x"), 1.0).alias("power"), exact.incomplete_beta(0.3, F.col("x"), F.col("x")).alias("one"), exact.incomplete_beta(0.7, F.col("x"), F.col("x")).alias("other")).collect():
        assert abs(r["g"] - math.lgamma(r["x"])) <= 1e-13 * max(1, abs(r["g"]))
        assert abs(r["power"] - 0.3 ** r["x"]) < 1e-12 and abs(r["one"] + r["other"] - 1) < 1e-12


def test_interval_ends_hold_their_tails(spark):
    cases = [(0, 10), (10, 10), (1, 1), (3, 10), (1500, 3000), (2, 3000), (370_000, 1_000_000)]
    low, high = exact.clopper_pearson(F.col("k"), F.col("n"))
    for r in spark.createDataFrame(cases, "k long, n long").select("k", "n", low.alias("low"), high.alias("high")).collect():
        k, n = r["k"], r["n"]
        assert r["low"] <= k / n <= r["high"]
        assert r["low"] == 0 if k == 0 else abs(1 - tail_at(k - 1, n, r["low"]) - 0.025) < 1e-9
        assert r["high"] == 1 if k == n else abs(tail_at(k, n, r["high"]) - 0.025) < 1e-9


def test_students_t_and_hypergeometric(spark):
    rows = spark.createDataFrame([(1, 12.706204736432095), (2, 4.302652729911275), (5, 2.5705818366147395), (30, 2.0422724563012373), (1000, 1.9623390808264078)], "df long, t double")
    for r in rows.select("t", exact.t_critical(F.col("df")).alias("at"), exact.t_two_sided(F.col("t"), F.col("df")).alias("p")).collect():
        assert abs(r["at"] - r["t"]) < 1e-8 and abs(r["p"] - 0.05) < 1e-9
    draws = [(k, d, m, t) for t, m in ((9, 4), (5000, 1200)) for d in (0, 3, t // 2, t) for k in range(0, min(d, m) + 1, max(1, min(d, m) // 7))]
    for r in spark.createDataFrame(draws, "k long, d long, m long, t long").select("*", exact.hypergeometric_pmf(F.col("k"), F.col("d"), F.col("m"), F.col("t")).alias("p")).collect():
        k, d, m, t = r["k"], r["d"], r["m"], r["t"]
        want = float(Fraction(math.comb(m, k) * math.comb(t - m, d - k) if d - k <= t - m else 0, math.comb(t, d)))
        assert abs(r["p"] - want) < 1e-11


def test_critical_counts(spark):
    for r in spark.range(0, 400, 7).select("id", exact.critical_count(F.col("id")).alias("k")).collect():
        d = r["id"]
        assert r["k"] == max((k for k in range(d // 2 + 1) if min(1.0, 2 * tail(k, d)) <= 0.05), default=-1)


def test_power_against_all_splits(spark):
    designs = [("a", 0.2, 0.1, 60), ("b", 0.05, 0.05, 40), ("c", 0.0, 0.3, 25), ("d", 0.0, 0.0, 10), ("e", 0.2, 0.1, 3)]
    got = {r["design"]: r for r in significance.mcnemar_power(spark.createDataFrame(designs, "design string, only_a double, only_b double, n long")).collect()}
    for name, a, b, n in designs:
        sums = dict.fromkeys(("power", "power_a", "win", "tie", "lose"), 0.0)
        for d in range(n + 1):
            for k in range(d + 1):
                w = math.comb(n, d) * math.comb(d, k) * a**k * b ** (d - k) * (1 - a - b) ** (n - d)
                rejected = 2 * tail(min(k, d - k), d) <= 0.05 and 2 * k != d
                for what, holds in (("power", rejected), ("power_a", rejected and 2 * k > d), ("win", 2 * k > d), ("tie", 2 * k == d), ("lose", 2 * k < d)):
                    sums[what] += w * holds
        assert all(abs(got[name][c] - v) < 1e-10 for c, v in sums.items()), name
    sizes = spark.createDataFrame([("x", 0.25, 0.08, n) for n in range(30, 140, 2)], "design string, only_a double, only_b double, n long")
    powers = significance.mcnemar_power(sizes)
    by_n = {r["n"]: r["power_a"] for r in powers.collect()}
    row = significance.pairs_needed(powers).first()
    assert row["first"] == min(n for n, p in by_n.items() if p >= 0.8)
    assert row["stable"] == min(n for n in by_n if all(p >= 0.8 for m, p in by_n.items() if m >= n)) and row["first"] <= row["stable"]


def test_discordant_shares(spark):
    a, b = significance.discordant(F.col("x"), F.col("y"), F.col("phi"))
    rows = spark.createDataFrame([(0.8, 0.7, 0.0), (0.8, 0.7, 0.4), (0.9, 0.6, 0.99), (0.5, 0.5, 1.0)], "x double, y double, phi double")
    got = [tuple(r) for r in rows.select(a.alias("a"), b.alias("b"), significance.largest_phi(F.col("x"), F.col("y")).alias("m")).collect()]
    assert got[2][:2] == (None, None) and all(abs(v - w) < 1e-12 for v, w in zip(got[0][:2], (0.24, 0.14), strict=True))
    assert abs(got[1][0] - got[1][1] - 0.1) < 1e-12 and got[3][:2] == (0.0, 0.0) and got[3][2] == 1.0
