"""The pipeline's stages, one after the other, against what each promises."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int = 120) -> str:
    draw = np.random.default_rng(seed)
    return " ".join(f"word{x}" for x in draw.integers(0, 3000, n))


def test_each_stage_takes_effect(spark):
    rows = [(i, prose(i), "en", "ab"[i % 2], 0) for i in range(60)]
    rows += [(100 + i, prose(i), "en", "a", 0) for i in range(10)]  # exact copies
    rows += [(200, "too short", "en", "a", 0), (201, None, None, None, None), (202, prose(500) + " password = hunter2hunter2 end", "en", "b", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "unused").cache()
        assert docs.columns == corpus_pipeline.COLUMNS, name
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, single, clean, mixed = kept
    assert quality.keys() == {r[0] for r in rows} - {200, 201}
    assert single.keys() == quality.keys() - set(range(100, 110))
    assert clean.keys() == single.keys() and "[SECRET]" in clean[202] and "hunter2" not in clean[202]
    times = Counter(r["doc_id"] for r in docs.collect())
    assert mixed.keys() <= clean.keys() and len(mixed) > 30 and max(times.values()) <= 3
    packed = corpus_pipeline.packing(spark, docs, "unused").collect()
    whole = Counter()
    for r in packed:
        whole[r["doc_id"]] += r["length"]
    assert whole == {d: n * next(r["doc_tokens"] for r in packed if r["doc_id"] == d) for d, n in times.items()}


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused")
        assert docs.count() == 0


def shingles(text: str) -> set:
    found = text.lower().split()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def test_near_copies_are_dropped(spark):
    texts, near, far = [prose(i, 400) for i in range(40)], [], []
    for i, text in enumerate(texts):
        for edits in (1, 3, 6, 8, 14, 30):
            words = text.split()
            for at in np.random.default_rng(i).choice(np.arange(5, 395, 10), edits, replace=False):
                words[at] = f"other{at}"
            copy = " ".join(words)
            alike = len(shingles(text) & shingles(copy)) / len(shingles(text) | shingles(copy))
            (near if alike >= 0.8 else far).append((1000 * (i + 1) + edits, copy, alike))
    assert len(near) >= 150 and min(x for *_, x in near) < 0.84 and max(x for *_, x in far) < 0.8
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(i, t, "en", "a", 0) for i, t, _ in near]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "unused")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(i, t, "en", "a", 0) for i, t, x in far if i % 1000 == 30]
    assert corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "unused").count() == len(rows) >= 80
