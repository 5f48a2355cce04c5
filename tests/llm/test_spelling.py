"""Spelling variants against brute force: the automaton, parted blocks, chains, odd rows, and the query beside its SQL."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm.queries import ORACLES, QUERIES
from tallyloom.llm.spelling import Automaton, backward, corpus_words, matrix, spelling_variants
from tests.oracle import duck_rows, spark_rows


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def drawn(seed: int, n: int, letters: str, least: int, most: int) -> list[str]:
    draw = np.random.default_rng(seed)
    return sorted({"".join(draw.choice(list(letters), draw.integers(least, most + 1))) for _ in range(n)})


def forms(counts: dict[str, int], ratio: int = 10) -> dict[str, tuple]:
    out = {}
    for w, n in counts.items():
        around = sorted((x for x in counts if near(w, x)), key=lambda x: (-counts[x], x))
        form = around[0] if around and counts[around[0]] >= ratio * n else None
        out[w] = (form, n, len(around), counts[form] if form else None)
    for w in counts:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (out[w][0], root, *out[w][1:4])
    return out


def test_automaton_is_minimal_and_numbers_its_words():
    words = drawn(1, 900, "abc", 1, 8)
    rows, size = matrix(np.array([w.encode() for w in words]))
    held = Automaton.of(rows)
    for place, word in enumerate(words):
        state, number = held.start, 0
        for code in word.encode():
            goes, edge = held.step(np.array([state]), np.array([code]))
            assert goes[0]
            state, number = held.to[edge[0]], number + held.skip[edge[0]]
        assert held.final[state] and number == place
    tails = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(held.final) == len(tails)  # a state for each different set of endings
    who, number = held.near(rows, size, size // 2)
    assert {(words[a], words[b]) for a, b in zip(who, number, strict=True)} == {(a, b) for a in words for b in words if near(a, b) and b[: len(a) // 2] == a[: len(a) // 2]}
    assert [bytes(r[r > 0]).decode() for r in backward(rows, size)] == [w[::-1] for w in words]


@pytest.mark.parametrize(("letters", "least", "most", "points"), [("ab", 1, 9, 200), ("abcdé", 3, 6, 1_000_000), ("abcde", 7, 9, 2000)])
def test_variants_equal_brute_force_with_whole_and_parted_blocks(spark, letters, least, most, points):
    words = drawn(2, 500, letters, least, most)
    words += ["abcabc" + w for w in drawn(3, 150, letters, 4, 5)]  # one half common to many
    draw = np.random.default_rng(4)
    counts = {w: int(10 ** draw.integers(0, 5)) for w in words}
    table = spark.createDataFrame([(w, n, "clash", 0) for w, n in counts.items()], "word string, n long, form string, block int")
    got = {r["word"]: tuple(r)[1:] for r in spelling_variants(table, points=points).collect()}
    assert got == forms(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "zzzzzzz": 1, "zzzzzzy": 50, "zzzzzzx": 50}
    got = {r["word"]: (r["form"], r["root"]) for r in spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["aaaaaaa"] == ("aaaaaab", "aaaabbb") and got["zzzzzzz"] == ("zzzzzzx", "zzzzzzx") and got["aaaabbb"] == (None, "aaaabbb")


def test_odd_rows(spark):
    long = "q" * 20_000
    texts = [(1, None), (2, ""), (3, " \n"), (4, "Überall Überall überall ÄRGERLICH Ärgerlich"), (None, "Missing missing"), (None, "Missing missing"), (5, long), (6, long + " " + long[:-1]), (7, long[:-1]), *[(i, "wonderful wonderfull wonderful-wonderful×times WONDERFUL") for i in range(100, 200)]]
    docs = spark.createDataFrame([(*t, "clash", 1) for t in texts], "doc_id long, text string, word string, n long")
    seen = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}
    words = corpus_words(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == counts
    assert {r["word"]: tuple(r)[1:] for r in spelling_variants(words).collect()} == forms(counts)
    assert spelling_variants(corpus_words(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(words, ratio=1)


def test_query_equals_sql(spark):
    name, folder = "op11_spelling_variants", "/root/testdata/sf0.001"
    assert spark_rows(QUERIES[name](spark, folder)) == duck_rows(ORACLES[name], folder)
