"""Poisson draws at any mean against their law, and draws without replacement against a plain sort."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.draws import poisson
from tallyloom.operators.order import repeated_draws

N = 40_000


@pytest.mark.parametrize("mean", [0.3, 1, 9.99, 10, 60, 1e6, 3e10])
def test_mean_variance_and_skew(spark, mean):
    drawn = spark.range(N).select(poisson(F.lit(mean), "id").alias("w"))
    z = (F.col("w") - mean) / math.sqrt(mean)
    r = drawn.agg(F.avg(z), F.avg(z * z), F.avg(z * z * z), F.count("w"), F.min("w"), F.count_if(F.col("w") != F.floor("w"))).first()
    assert r[3] == N and r[4] >= 0 and r[5] == 0
    assert abs(r[0]) < 5 / math.sqrt(N)
    assert abs(r[1] - 1) < 5 * math.sqrt((2 + 1 / mean) / N)
    assert abs(r[2] - 1 / math.sqrt(mean)) < 5 * math.sqrt((15 + 25 / mean + 1 / mean**2) / N)


@pytest.mark.parametrize("mean", [2, 12, 60])
def test_chances_of_each_number(spark, mean):
    counts = dict(spark.range(N).select(poisson(F.lit(mean), "id").alias("w")).groupBy("w").count().collect())
    chance = [math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(4 * mean + 20)]
    cells = [k for k, p in enumerate(chance) if p * N >= 10]
    chi = sum((counts.get(float(k), 0) - N * chance[k]) ** 2 / (N * chance[k]) for k in cells)
    assert chi < len(cells) + 5 * math.sqrt(2 * len(cells))


def test_odd_means(spark):
    rows = spark.createDataFrame([(0.0,), (None,), (-1.0,)], "m double")
    assert [r[0] for r in rows.select(poisson(F.col("m"), "m")).collect()] == [0.0, None, None]


@pytest.mark.parametrize(("rows", "n"), [(0, 3), (5, 8), (3000, 40)])
def test_draws_without_replacement(spark, rows, n):
    table = spark.createDataFrame([(str(i), i) for i in range(rows)] + [(None, -1)], "review_id string, round_ long")
    got = {}
    for r in repeated_draws(table, "s", n, 6).collect():
        got.setdefault(r["round"], set()).add(r["review_id"])
    key = lambda i, k: (hashlib.sha256(f"s:{k}:{i}".encode()).hexdigest(), str(i))
    assert got == {k: {str(i) for i in sorted(range(rows), key=lambda i: key(i, k))[:n]} for k in range(1, 7) if rows}
