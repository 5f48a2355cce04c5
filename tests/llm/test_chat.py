"""Reply trees against a walk in plain Python, and the template's round trip."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import functions as F

from tallyloom.llm.chat import format_trees, masked_text, parsed_turns, threads

SCHEMA = "tree string, node long, parent long, role string, text string, score double, extra string"


def read_back(df):
    turns, loss = parsed_turns(F.col("formatted")), masked_text(F.col("formatted"), F.col("loss_spans"))
    return df.select("tree", "leaf", "rank", "score", turns.alias("turns"), loss.alias("loss")).collect()


def test_paths_ranks_and_texts_of_trees(spark):
    odd = ["", None, "a\nb", "\\", "<|end|>\n", "<|turn|>user\n", "<\\|", "\\<|", "x\\", "é😀", " ", "\r\n"]
    rows = []
    for tree in ("t1", "t2"):
        for node in range(1, 60):
            parent = None if node == 1 else (node * 7) % (node - 1) + 1 if node > 2 else 1
            rows.append((tree, node, parent, "user\n<|x" if node % 2 else "assistant", odd[node % len(odd)], float(node % 5) if node % 9 else None, "x"))
    rows += [("deep", n, n - 1 if n > 1 else None, "assistant", str(n), 1.0, "x") for n in range(1, 120)]
    rows += [("circle", 1, 2, "user", "a", 0.0, "x"), ("circle", 2, 1, "user", "b", 0.0, "x"), ("circle", 3, 2, "user", "hangs on it", 0.0, "x")]
    rows += [("orphan", 5, 99, "assistant", "its parent is missing", 0.0, "x")]
    got = {(r["tree"], r["leaf"]): r for r in read_back(format_trees(spark.createDataFrame(rows, SCHEMA)))}
    by = {(t, n): (p, role or "", text or "", s or 0.0) for t, n, p, role, text, s, _ in rows if t != "circle"}
    parents = {(t, p) for (t, _), (p, *_) in by.items() if p}
    want = {}
    for tree, node in by:
        if (tree, node) not in parents:
            path, at = [], node
            while at is not None and (tree, at) in by:
                path.append(at)
                at = by[tree, at][0]
            want[tree, node] = path[::-1]
    assert got.keys() == want.keys()
    for (tree, leaf), path in want.items():
        r = got[tree, leaf]
        assert [(x["role"], x["text"]) for x in r["turns"]] == [by[tree, n][1:3] for n in path]
        assert r["loss"] == "".join(by[tree, n][2] for n in path if by[tree, n][1] == "assistant")
        assert r["score"] == sum(by[tree, n][3] for n in path)
    for tree in ("t1", "t2"):
        mine = sorted((r for (t, _), r in got.items() if t == tree), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert all((-a["score"], a["leaf"]) < (-b["score"], b["leaf"]) for a, b in pairwise(mine))


def test_branches_keeps_the_best(spark):
    rows = [("t", 1, None, "user", "q", 0.0, ""), ("t", 2, 1, "assistant", "a", 1.0, ""), ("t", 3, 1, "assistant", "b", 2.0, ""), ("t", 4, 1, "assistant", "c", 2.0, "")]
    got = read_back(format_trees(spark.createDataFrame(rows, SCHEMA), branches=2))
    assert sorted((r["rank"], r["leaf"]) for r in got) == [(1, 3), (2, 4)]


def test_threads_keep_repeated_turns_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", "x"), (None, 2, "user", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["tree"]: [(x["role"], x["text"]) for x in r["turns"]] for r in read_back(format_trees(threads(table)))}
    assert got == {"c1": [("", ""), ("user", "a"), ("user", "a")], "n": [("assistant", "x"), ("user", "y")]}


def test_empty_table(spark):
    assert format_trees(spark.createDataFrame([], SCHEMA)).count() == 0
