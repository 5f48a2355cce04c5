"""Near copies against brute force where a family holds many texts just under the similarity, and the parities that spare comparisons."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tallyloom.llm import shared, shingles
from tallyloom.llm.components import components
from tallyloom.llm.shingles import near_copies, parities


@given(st.lists(st.integers(0, 2**64 - 1), max_size=300), st.lists(st.integers(0, 2**64 - 1), max_size=300), st.lists(st.integers(0, 2**64 - 1), max_size=300))
def test_parities_never_exceed_the_difference(both, one, other):
    a, b = set(both) | set(one), set(both) | set(other)
    bits = [parities(np.array(sorted(x), dtype=np.uint64)) for x in (a, b)]
    assert len(bits[0]) == shingles.PARITY_WORDS
    assert sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64)) <= len(a ^ b)


def sets(text: str) -> set:
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def family(seed: int, copies: int, words: int, edits: tuple[int, int]) -> list[str]:
    """Copies of one text, some words of each replaced."""
    draw = np.random.default_rng(seed)
    text, out = [f"w{x}" for x in draw.integers(0, 5000, words)], []
    for copy in range(copies):
        mine = list(text)
        for at in draw.choice(words, draw.integers(*edits), replace=False):
            mine[at] = f"x{copy}_{at}"
        out.append(" ".join(mine))
    return out


def brute(texts: list[str]) -> list[int]:
    root, held = list(range(len(texts))), [sets(t) for t in texts]
    for a, b in combinations(range(len(texts)), 2):
        common = len(held[a] & held[b])
        if held[a] and 100 * common >= 80 * (len(held[a]) + len(held[b]) - common):
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
    return root


def test_strays_of_a_family_are_linked_as_by_brute_force(spark, monkeypatch):
    """Strays link to a few others only, so no pivot joins them and all pairs of a band are looked at."""
    compared, check = [], shingles.verified

    def counted(pairs, docs, **options):
        compared.append(pairs.count())
        return check(pairs, docs, **options)

    monkeypatch.setattr(shingles, "verified", counted)
    strays = family(1, 120, 200, (3, 12))
    twins = [t.replace(" ", " y ", 1) for t in strays[::9]]  # a word more: near their stray
    texts = strays + twins + family(2, 20, 2500, (10, 80)) + ["", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_copies(docs, turns=1).collect()}
    want = brute(texts)
    assert found == dict(enumerate(want))
    assert 30 < len(set(want)) < len(texts) - 10
    assert len(compared) == 3 and compared[-1] < 400  # of 7000 pairs


def test_strays_are_linked_in_few_rounds_however_texts_are_dealt(spark, monkeypatch):
    """Each turn costs a search of components, whose shuffles filled the disk; texts beyond the number that is broadcast are dealt by hash."""
    rounds, search = [], shingles.components
    monkeypatch.setattr(shingles, "components", lambda links: rounds.append(1) or search(links))
    monkeypatch.setattr(shingles, "MOST_SENT", 0, raising=False)
    texts = family(1, 120, 200, (3, 12)) + family(4, 30, 100, (0, 9))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_copies(docs).collect()}
    assert found == dict(enumerate(brute(texts)))
    assert len(rounds) <= 3


def test_a_text_given_twice_and_nulls(spark):
    text = family(3, 1, 60, (0, 1))[0]
    docs = spark.createDataFrame([(5, text, 1), (5, text, 1), (3, text, 2), (9, None, 3), (8, "", 4), (7, " ", 5)], "doc_id long, text string, parity int")
    found = sorted((r["doc_id"], r["component_id"]) for r in near_copies(docs).collect())
    assert found == [(3, 3), (5, 3), (5, 3), (7, 7), (8, 8), (9, 8)]


def shuffle_files(spark) -> set:
    held, names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator(), set()
    while held.hasNext():
        names.add(held.next().getName())
    return {x for x in names if x.startswith("shuffle_")}


def test_rounds_leave_no_shuffle_files(spark):
    """Each round's files stayed until the driver collected its garbage; with many partitions they filled the disk."""
    path = [(i, i + 1) for i in range(300)]
    before = shuffle_files(spark)
    found = components(spark.createDataFrame(path, "a long, b long"))
    left = shuffle_files(spark) - before
    assert found.count() == 301 and {r["root"] for r in found.collect()} == {0}
    assert not left
    conf = spark.conf.get(shared.SWEEP)
    texts = family(1, 40, 200, (3, 12))
    before = shuffle_files(spark)
    near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert len({x.split("_")[1] for x in shuffle_files(spark) - before}) <= 8  # of counts; dozens before
    assert spark.conf.get(shared.SWEEP) == conf == "false"
