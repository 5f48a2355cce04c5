"""Vector search: ties, lengths and large values against brute force, and recall where vectors have no clusters."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallyloom.llm.ann import Index, nearest
from tallyloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def lists(df) -> dict[int, list[tuple[int, float]]]:
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    return got


def exact(ids: np.ndarray, x: np.ndarray, query: int, k: int = 10) -> list[int]:
    far = np.sqrt(((x - x[ids == query][0]) ** 2).sum(1))
    order = np.lexsort((ids, far))
    return [int(i) for i in ids[order] if i != query][:k]


def recall(spark, x: np.ndarray, **options) -> float:
    ids = np.arange(len(x))
    got = lists(nearest(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], SCHEMA), "id % 100 = 0", **options))
    assert len(got) == len(ids[ids % 100 == 0])
    return float(np.mean([len({v for v, _ in found} & set(exact(ids, x, q))) / 10 for q, found in got.items()]))


def test_equal_vectors_come_in_order_of_id(spark):
    draw = np.random.default_rng(1)
    x = np.concatenate([np.ones((1000, 8)), draw.normal(size=(500, 8)), np.repeat(draw.normal(size=(30, 8)), 7, axis=0)])
    ids = np.arange(len(x))
    got = lists(nearest(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], SCHEMA), "id % 100 = 0", rerank=20))
    assert [v for v, _ in got[500]] == list(range(10)) and [v for v, _ in got[0]] == list(range(1, 11))
    for query, found in got.items():
        if query < 1000:
            assert [v for v, _ in found] == exact(ids, x, query)


def test_large_and_tiny_values(spark):
    draw = np.random.default_rng(2)
    for size in (1e20, 1e-30, 1e100):
        x = draw.normal(size=(400, 8)) * size
        assert recall(spark, x) == 1.0


def test_recall_of_rows_far_from_zero_and_beside_a_huge_one(spark):
    base = np.random.default_rng(5).normal(size=(3000, 32))
    assert recall(spark, base * 0.01 + 300) >= 0.95
    assert recall(spark, np.vstack([base[:-1], np.full((1, 32), 1e25)])) >= 0.95
    assert recall(spark, base * np.exp(4 * np.random.default_rng(6).normal(size=(3000, 1)))) >= 0.9


def test_lengths_are_searched_apart(spark):
    rows = [(i, [float(i)] * (2 if i % 3 else 3)) for i in range(1, 40)]
    got = lists(nearest(spark.createDataFrame(rows, SCHEMA), "id % 10 = 0", k=3))
    assert {q: [v for v, _ in found] for q, found in got.items()} == {10: [11, 8, 7], 20: [19, 22, 17], 30: [27, 33, 24]}


@pytest.mark.parametrize(("n", "options"), [(12_000, {"list_rows": 1000})])
def test_recall_without_clusters(spark, n, options):
    assert recall(spark, np.random.default_rng(3).normal(size=(n, 64)), **options) >= 0.9


def test_probes_grow_where_neighbours_are_spread():
    draw = np.random.default_rng(4)
    loose = draw.normal(size=(6000, 32)).astype(np.float32)
    tight = (draw.normal(size=(20, 32))[draw.integers(0, 20, 6000)] + 0.05 * draw.normal(size=(6000, 32))).astype(np.float32)
    assert Index.fit(tight, 32, 2, 16).probes(tight, 10, 0.98) < Index.fit(loose, 32, 2, 16).probes(loose, 10, 0.98)


def test_query_reaches_the_true_neighbours(spark):
    folder = "/root/testdata/sf0.1"
    table = pq.read_table(f"{folder}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()
    fine = [r for r in table if r["embedding"] and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])]
    ids, x = np.array([r["vec_id"] for r in fine]), np.array([r["embedding"] for r in fine], float)
    got = lists(QUERIES["op5_nearest_vectors"](spark, folder))
    asked = [int(i) for i in ids if i % 100 == 0]
    assert sorted(got) == asked
    assert np.mean([len({v for v, _ in got[q]} & set(exact(ids, x, q))) / 10 for q in asked]) >= 0.95
    for query in asked[:5]:
        for vec, score in got[query]:
            assert abs(score - np.sqrt(((x[ids == vec][0] - x[ids == query][0]) ** 2).sum())) < 1e-12
