"""License scans: phrases against brute force, notices with changed words, odd rows, and the query beside its SQL."""

from __future__ import annotations

import re

import numpy as np

from tallyloom.llm.licenses import NOTICES, PHRASES, Template, license_words, rolled, scan_licenses, word_hashes
from tallyloom.llm.queries import ORACLES, QUERIES
from tests.oracle import duck_rows, spark_rows

MIT = next(t for t in NOTICES if t.label == "mit" and len(t.words) > 100)


def filler(seed: int, n: int) -> str:
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 300, n))


def scanned(spark, texts: list, **options) -> list[dict]:
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, labels string, template string"), **options)
    return [r.asDict() for r in sorted(found.collect(), key=lambda r: r["doc_id"])]


def places(text: str, phrase: Template) -> list[int]:
    words, wanted = license_words(text.encode()), phrase.words
    return [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]


def test_phrases_equal_brute_force(spark):
    draw = np.random.default_rng(5)
    parts = ["gnu", "General", "PUBLIC", "license", "apache", "cc", "by", "mit", "LICENSE,", "cc-by", "Kit", "mıt", "mit lıcense", "é", "4.0", "K"]
    texts = [" ".join(draw.choice(parts, draw.integers(1, 60))) for _ in range(120)] + ["gnu general public license " * 50, "cc by cc by", "CC BY", "mitlicense mit/license"]
    for text, row in zip(texts, scanned(spark, texts), strict=True):
        small = "".join(c.lower() if c.isascii() else c for c in text)
        assert row["n_words"] == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small))
        at = {p.label: places(text, p) for p in PHRASES}
        every = sorted(i for found in at.values() for i in found)
        assert (row["n_base"], row["first_word"], row["last_word"]) == (len(every), every[0] if every else None, every[-1] if every else None)
        assert row["base_labels"] == ",".join(sorted(label for label, found in at.items() if found))


def test_notices_with_words_more_less_and_changed(spark):
    words = MIT.text.split()
    changed, dropped, added = list(words), list(words), list(words)
    changed[30] = changed[80] = changed[120] = "other"
    del dropped[60:64]
    added[50:50] = ["with", "some", "words", "more"]
    half = words[: len(words) // 2]
    texts = [f"{filler(i, 200)} {' '.join(x)} {filler(i + 9, 300)}" for i, x in enumerate((words, changed, dropped, added, half))] + [" ".join(np.random.default_rng(1).permutation(words)), filler(3, 5000)]
    got = scanned(spark, texts)
    assert [r["labels"] for r in got] == ["mit"] * 4 + [""] * 3
    assert got[0]["score"] == 1.0 and [(s["start"], s["end"], s["label"]) for s in got[0]["spans"]] == [(200, 200 + len(MIT.words), "mit")]
    assert all(0.95 <= r["score"] <= 1 for r in got[1:4]) and 0.4 < got[4]["score"] < 0.6 and got[6]["score"] == 0.0
    for row in got[1:4]:
        assert row["spans"][0]["start"] == 200 and abs(row["spans"][0]["end"] - 200 - len(MIT.words)) <= 4


def test_two_places_of_a_notice_are_two_spans(spark):
    text = f"{MIT.text} {filler(1, 40)} {MIT.text}"
    (row,) = scanned(spark, [text])
    assert [s["start"] for s in row["spans"]] == [0, len(MIT.words) + 40]


def test_equal_hashes_are_not_enough(spark, monkeypatch):
    """Spans are verified by the words themselves: where all words hash alike, no wrong label is left."""
    monkeypatch.setattr("tallyloom.llm.licenses.xxhash.xxh64_intdigest", lambda word: 7)
    (row,) = scanned(spark, [filler(1, 60)])
    assert row["labels"] == "" or row["n_base"] == 0


def test_rolling_hashes():
    raw = ("Word " * 7 + "é 1 ").encode() * 50
    whole = word_hashes(raw)
    assert (whole == word_hashes(raw, piece=10)).all() and len(whole) == 9 * 50
    assert (rolled(whole, 4)[:9] == rolled(whole, 4)[9:18]).all() and len(rolled(whole[:0], 2)) == 0


def test_odd_rows(spark):
    notice = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, " ,.\n"), (4, notice), (4, notice), (4, "another " + notice), (None, notice), (5, filler(1, 200_000) + " " + notice), (6, "the mit license " * 30_000)]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shown = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_base"], r["labels"], r["score"]) for r in got)
    assert shown == [(-1, 5, 1, "mit", 1.0), (1, 0, 0, "", 0.0), (2, 0, 0, "", 0.0), (3, 0, 0, "", 0.0), (4, 5, 1, "mit", 1.0), (4, 5, 1, "mit", 1.0), (4, 6, 1, "mit", 1.0), (5, 200_005, 1, "mit", 1.0), (6, 90_000, 30_000, "mit", shown[-1][4])]
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_template_sets_are_joined(spark):
    many = tuple(Template(f"t{i}", filler(100 + i, 30)) for i in range(200))
    (row,) = scanned(spark, [filler(0, 50) + " " + many[77].text], notices=many)
    assert row["labels"] == "t77" and row["score"] == 1.0


def test_query_equals_sql(spark):
    name, folder = "op12_scan_licenses", "/root/testdata/sf0.001"
    assert spark_rows(QUERIES[name](spark, folder)) == duck_rows(ORACLES[name], folder)
