"""Whitening against direct computation: the eigen-solve, merged states, exact sums, odd rows."""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pytest

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.whitening import Moments, Whitener, moments, symmetric_qr, whiten

SCHEMA = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("kind", ["random", "equal values", "rank one", "diagonal", "zero", "tiny", "graded"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_symmetric_qr(kind, n):
    draw = np.random.default_rng(n)
    half = draw.normal(size=(n, n))
    basis = np.linalg.qr(half)[0]
    a = {"random": half @ half.T, "equal values": basis @ np.diag(np.repeat([3.0, 1.0], [n // 2, n - n // 2])) @ basis.T, "rank one": np.outer(half[0], half[0]), "diagonal": np.diag(draw.normal(size=n)), "zero": np.zeros((n, n)), "tiny": half @ half.T * 1e-280, "graded": basis @ np.diag(10.0 ** -np.arange(n)) @ basis.T}[kind]
    a = (a + a.T) / 2
    values, vectors = symmetric_qr(a)
    size = max(np.abs(a).max() * n, 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * size and (np.diff(values) <= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() <= 1e-13 and np.abs(a @ vectors - vectors * values).max() <= 1e-13 * size


def test_states_merge_to_the_covariance():
    draw = np.random.default_rng(1)
    x = draw.integers(-50, 50, (3000, 12)) + 10**6
    parts = [p for p in np.array_split(x, [1, 2, 900, 901, 2500])]
    whole = reduce(Moments.merge, (Moments.empty(p[0].astype(float)).add(p.astype(float), p.sum(axis=0).tolist()) for p in parts))
    assert whole.n == 3000 and whole.total == x.sum(axis=0).tolist()
    direct = np.cov((x - 10**6).T.astype(float), bias=True)
    assert np.abs(whole.square / 3000 - direct).max() <= 1e-12 * np.abs(direct).max()


def test_moments_over_more_partitions_than_a_task_merges(spark):
    draw = np.random.default_rng(2)
    rows = [(int(d), draw.integers(0, 100, d).tolist()) for d in (3, 5) for _ in range(200)]
    for whole in (True, False):
        held = spark.createDataFrame(rows, f"dim int, x array<{'long' if whole else 'double'}>") if whole else spark.createDataFrame([(d, [float(v) for v in x]) for d, x in rows], "dim int, x array<double>")
        for r in moments(held.repartition(40), "x", whole=whole, fan=3).collect():
            x = np.array([v for d, v in rows if d == r["dim"]], float)
            assert r["n"] == 200 and np.allclose(np.array(r["square"]).reshape(r["dim"], -1) / 200, np.cov(x.T, bias=True), rtol=1e-12)
            assert not whole or [int(t) for t in r["total"]] == x.sum(axis=0).tolist()


def expected(x: np.ndarray, k: int = 16) -> tuple:
    """Whole numbers, their distinct rows, eigenvalues and eigenvectors, directly."""
    whole = np.floor(64 * x).astype(np.int64) + 1_000_000
    fit = np.unique(whole, axis=0)
    values, vectors = np.linalg.eigh(np.cov((fit - 1_000_000).T.astype(float), bias=True))
    return whole, fit, values[::-1], vectors[:, ::-1]


def test_whitened_rows_equal_direct_computation(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(700, 20)) @ np.diag(np.linspace(1, 9, 20))
    x = np.concatenate([x, np.repeat(x[:1], 500, axis=0)])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA).repartition(9)
    got = sorted(whiten(table).collect(), key=lambda r: (r["vec_id"], r["component"]))
    whole, fit, values, vectors = expected(x)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    assert len(got) == 1200 * 16 and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    seen = np.array([r["whitened"] for r in got]).reshape(1200, 16)
    direct = (whole - np.array(sums) / n) @ vectors[:, :16] / np.sqrt(values[:16])
    assert np.abs(seen * np.sign((seen * direct).sum(axis=0)) - direct).max() < 1e-8
    for r in got[:: 16 * 50]:
        assert r["deviation"] == sum((n * int(c) - s) ** 2 for c, s in zip(whole[r["vec_id"]], sums, strict=True))
    assert np.allclose([r["explained"] for r in got[:16]], values[:16] / values.sum(), rtol=1e-10)


def test_odd_rows(spark):
    draw = np.random.default_rng(4)
    good = draw.normal(size=(40, 6)).tolist()
    rows = [(i, v, "clash") for i, v in enumerate(good)] + [(7, good[7], "clash"), (None, good[3], "clash"), (100, None, ""), (101, [], ""), (102, [None, *good[0][1:]], ""), (103, [math.nan, *good[0][1:]], ""), (104, [math.inf, *good[0][1:]], ""), (105, [0.0] * 6, "")]
    rows += [(200, [1.0, 2.0], ""), (201, [1.0, 2.0], ""), (300, [5.0], ""), (301, [7.0], ""), (302, [1e300], "")]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string"), chunk=200).collect()
    assert Counter(r["vec_id"] for r in got) == Counter({**{i: 6 for i in range(40)}, 7: 12, None: 6, 105: 6, 200: 2, 201: 2, 300: 1, 301: 1, 302: 1})
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert by[0, 1]["n"] == 41 and by[200, 1]["n"] == 1 and by[200, 1]["whitened"] is None and by[200, 1]["explained"] == 0.0 and by[200, 1]["identity_error"] is None
    assert by[300, 1]["n"] == 3 and by[302, 1]["deviation"] is None and by[0, 1]["identity_error"] < 1e-9
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_numbers_beyond_64_bits_stay_exact():
    one = Whitener(1 << 30, [(1 << 70) + 3], np.ones(1), np.ones((1, 1)), [1.0])
    apart = one.apart(np.array([[1 << 40]]))
    assert apart[0, 0] == (1 << 70) - (1 << 70) - 3 and one.deviations(apart) == [9]


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.01"
    table = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    got = sorted(QUERIES["op13_whiten_embeddings"](spark, folder).collect(), key=lambda r: (r["vec_id"], r["component"]))
    ids = sorted(i for i, v in table.items() if v is not None and all(c is not None and math.isfinite(c) for c in v))
    whole, fit, values, vectors = expected(np.array([table[i] for i in ids], float))
    seen = np.array([r["whitened"] for r in got]).reshape(len(ids), 16)
    direct = (whole - fit.mean(axis=0)) @ vectors[:, :16] / np.sqrt(values[:16])
    assert [r["vec_id"] for r in got[::16]] == ids and np.abs(seen * np.sign((seen * direct).sum(axis=0)) - direct).max() < 1e-6
