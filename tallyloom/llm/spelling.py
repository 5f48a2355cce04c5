"""Spelling variants by forward and backward automata: half of a word matches exactly, one error completes it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import cut

CODES = 256
CHUNK = 20_000  # words that ask together
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Automaton:
    """The minimal acyclic automaton of distinct words, with a perfect hash.

    Transitions are kept in order of (state, code): ``keys`` is state * 256 + code, ``to``
    the next state, ``skip`` the number of words of the state that come before those
    behind the transition. The sum of ``skip`` along a word is its place among the sorted
    words. ``first`` has where a state's transitions begin.
    """

    keys: np.ndarray
    to: np.ndarray
    skip: np.ndarray
    first: np.ndarray
    final: np.ndarray
    start: int

    @staticmethod
    def of(words: np.ndarray) -> Automaton:
        """The automaton of ``words``: a row a word, distinct and sorted, codes from 1, zeros after the end."""
        n, width = words.shape
        held = words != 0
        size = held.sum(axis=1)
        apart = np.ones((n, width), bool)
        apart[1:] = np.logical_or.accumulate(words[1:] != words[:-1], axis=1)
        fresh = apart & held  # a new node of the trie; its nodes are numbered row by row, the root is 0
        ids = np.zeros((n, width), np.int64)
        ids[fresh] = np.arange(1, fresh.sum() + 1)
        nodes = np.maximum.accumulate(ids, axis=0)
        above = np.concatenate([np.zeros((n, 1), np.int64), nodes[:, :-1]], axis=1)
        parent, label = above[fresh], words[fresh].astype(np.int64)
        total = len(parent) + 1
        below = np.bincount(nodes[held], minlength=total)
        below[0] = n
        height = np.zeros(total, np.int64)
        row, depth = np.nonzero(held)
        np.maximum.at(height, nodes[held], size[row] - depth - 1)
        height[0] = width
        final = np.zeros(total, bool)
        final[nodes[np.arange(n), size - 1]] = True
        edges = np.argsort(parent, kind="stable")  # children by parent, then by label
        fan = np.bincount(parent, minlength=total)
        begin = np.concatenate([[0], np.cumsum(fan)])
        state, shown, made = np.zeros(total, np.int64), [], 0
        by_height = np.argsort(height, kind="stable")
        for level in np.split(by_height, np.flatnonzero(np.diff(height[by_height])) + 1):  # states that are equal are equally high
            for f in np.unique(fan[level]):
                some = level[fan[level] == f]
                kids = edges[begin[some][:, None] + np.arange(f)]
                if f == 1:
                    mark = (state[kids[:, 0] + 1] * CODES + label[kids[:, 0]]) * 2 + final[some]
                    _, pick, same = np.unique(mark, return_index=True, return_inverse=True)
                else:
                    mark = np.concatenate([final[some][:, None], label[kids], state[kids + 1]], axis=1)
                    _, pick, same = np.unique(mark, axis=0, return_index=True, return_inverse=True)
                state[some] = made + same.reshape(-1)
                shown.append(some[pick])
                made += len(pick)
        node = np.concatenate(shown)  # one node of the trie a state
        first = np.concatenate([[0], np.cumsum(fan[node])])
        kids = edges[np.repeat(begin[node] - first[:-1], fan[node]) + np.arange(first[-1])]
        counts = below[kids + 1]
        before = np.cumsum(counts) - counts
        own = np.repeat(np.arange(made), fan[node])
        skip = before - before[first[own]] + final[node][own] if len(kids) else before
        return Automaton(own * CODES + label[kids], state[kids + 1], skip, first, final[node], int(state[0]))

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states go on with these codes, and by which transition."""
        key = state * CODES + code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key, at

    def near(self, asked: np.ndarray, size: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among ``asked``, number of the word) of all words that begin with the first
        ``half`` codes of what is asked and differ by one code inserted, deleted or replaced
        after them. ``asked`` has zeros after the end.

        All that is asked moves on in step: the exact paths, and those with their one error.
        """
        found: list[np.ndarray] = []
        who = np.arange(len(asked))
        state, number = np.full(len(asked), self.start), np.zeros(len(asked), np.int64)
        once = np.zeros((3, 0), np.int64)  # who, state, number, with the error behind them
        for i in range(int(size.max(initial=0)) + 1):
            open_ = half[who] <= i
            by, at, so_far = who[open_], state[open_], number[open_]
            fan = self.first[at + 1] - self.first[at]
            each = np.repeat(np.arange(len(by)), fan)
            out = np.arange(len(each)) + np.repeat(self.first[at] - (np.cumsum(fan) - fan), fan)
            beyond = np.stack([by[each], self.to[out], so_far[each] + self.skip[out]])
            once = np.concatenate([once, beyond], axis=1)  # one inserted here
            if once.shape[1] > 4 * len(asked):
                once = np.unique(once, axis=1)
            ended = size[once[0]] == i
            done = once[:, ended]
            found.append(done[:, self.final[done[1]]][[0, 2]])
            once = once[:, ~ended]
            more = size[by] > i
            replaced = (size[by[each]] > i) & (self.keys[out] % CODES != asked[by[each], min(i, asked.shape[1] - 1)])
            deleted = np.stack([by[more], at[more], so_far[more]])
            if once.shape[1]:
                goes, edge = self.step(once[1], asked[once[0], i])
                once = np.stack([once[0][goes], self.to[edge[goes]], once[2][goes] + self.skip[edge[goes]]])
            once = np.concatenate([once, beyond[:, replaced], deleted], axis=1)
            going = size[who] > i
            who, state, number = who[going], state[going], number[going]
            if len(who):
                goes, edge = self.step(state, asked[who, i])
                who, state, number = who[goes], self.to[edge[goes]], number[goes] + self.skip[edge[goes]]
            if not len(who) and not once.shape[1]:
                break
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]


def matrix(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of single-byte codes as rows of codes with zeros after the end, and their lengths."""
    rows = words.view(np.uint8).reshape(len(words), -1)
    return rows, (rows != 0).sum(axis=1)


def backward(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same words from their ends."""
    at = size[:, None] - 1 - np.arange(rows.shape[1])
    return np.where(at >= 0, np.take_along_axis(rows, np.maximum(at, 0), axis=1), 0).astype(np.uint8)


NEAR = "word string, n_near long, form_n long, form string"


def block_variants(rows: pa.Table) -> pa.Table:
    """For each word of a block that ``asks``: how many of those it ``holds`` are near it by
    the block's direction, and the most frequent of them (``NEAR``).

    What both directions find is left to the forward one: words that share their first
    half can have their error behind it.
    """
    words = np.array(rows["word"].to_pylist(), object)
    raw = np.array([w.encode("latin-1") for w in words])
    back = rows["back"][0].as_py()
    ahead, size = matrix(raw)
    codes = backward(ahead, size) if back else ahead
    held, asks = (np.flatnonzero(rows[c].to_numpy()) for c in ("holds", "asks"))
    held = held[np.lexsort(codes[held].T[::-1])]
    n, place = rows["n"].to_numpy(), np.empty(len(raw), np.int64)
    place[np.argsort(raw, kind="stable")] = np.arange(len(raw))
    shape = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
    out = [shape.empty_table()]
    known = Automaton.of(codes[held]) if len(held) else None
    for at in range(0, len(asks) if known else 0, CHUNK):
        some = asks[at : at + CHUNK]
        who, number = known.near(codes[some], size[some], size[some] // 2)
        word, other = some[who], held[number]
        if back:
            half = (size[word] // 2)[:, None]
            fresh = ((ahead[word] != ahead[other]) & (np.arange(ahead.shape[1]) < half)).any(axis=1)
            word, other = word[fresh], other[fresh]
        order = np.lexsort((place[other], -n[other], word))
        word, other = word[order], other[order]
        which, first, many = np.unique(word, return_index=True, return_counts=True)
        out.append(pa.table([pa.array(words[which], pa.string()), many, n[other[first]], pa.array(words[other[first]], pa.string())], schema=shape))
    return pa.concat_tables(out).combine_chunks()


def _length_class(size: Column) -> Column:
    """Words of about one length, from a bounded number of classes, so that a block's words fill their rows."""
    return F.when(size < 64, size).otherwise(64 + F.floor(8 * F.log2(size / 64))).cast("int")


def near_words(words: DataFrame, *, points: int = 250_000) -> DataFrame:
    """``word``, ``n_near``, ``form_n`` and ``form`` (the near word of largest ``n``), partly: a
    word has a row for each block in which some are near it.

    A word of length L asks by its first L // 2 code points, forward and backward, and is
    held under the halves by which words one longer, as long or one shorter ask. Halves are dealt over blocks
    of about ``points`` code points; a block that a common half makes more than twice as
    large is held in parts, and what asks there goes to all of them, so no word is lost.
    """
    size = F.length("word")
    lengths = F.array_distinct(F.array(((size - 1) / 2).cast("int"), ((size + 1) / 2).cast("int")))
    ways = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    ways = ways.select("word", "n", "back", F.explode(lengths).alias("half"))
    start = F.when(F.col("back"), F.right("word", F.col("half"))).otherwise(F.left("word", F.col("half")))
    keyed = ways.select("word", "n", "back", (F.col("half") == (size / 2).cast("int")).alias("asks"), _length_class(F.col("half")).alias("class"), F.xxhash64("back", start).alias("h"))
    sizes = {r["class"]: r["points"] for r in keyed.groupBy("class").agg(F.sum(size).alias("points")).collect()}  # a row a class
    if not sizes:
        return words.sparkSession.createDataFrame([], NEAR)
    blocks = F.create_map(*(F.lit(x) for c, p in sizes.items() for x in (c, max(1, -(-p // (2 * points))))))
    placed = keyed.withColumn("block", F.pmod("h", blocks[F.col("class")]).cast("int"))
    parts = placed.groupBy("back", "class", "block").agg(F.ceil(F.sum(size) / points).cast("int").alias("parts")).filter("parts > 2")  # at most a row for 2 * points code points
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    dealt = placed.join(F.broadcast(parts), ["back", "class", "block"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = dealt.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).withColumn("holds", F.col("own") == F.col("part")).filter("holds OR asks")
    return rows.groupBy("back", "class", "block", "part").applyInArrow(block_variants, NEAR)


def spelling_variants(words: DataFrame, *, ratio: int = 10, points: int = 250_000) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of words with their counts.

    ``words`` has distinct ``word`` (of code points up to U+00FF, not empty) and ``n``
    from 1. Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. A word's form is its near word of largest ``n``, of equal ones
    the first in code-point order, if that ``n`` is at least ``ratio`` (2 or more) times
    its own; the root is where forms lead in the end, the word itself without a form. A form has more
    than its word, so there are no circles, and chains grow with the logarithm of ``n``;
    paths double in each turn. Words of one code point have an empty half and so meet all
    words as short. Other columns are ignored, an empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    given = cut(words.select("word", F.col("n").cast("long").alias("n")))
    blank = given.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    every = blank.unionByName(near_words(given, points=points), allowMissingColumns=True)
    best = F.min(F.when(F.col("form_n").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("w")))).alias("best")
    one = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = cut(one.select("word", "n", "n_near", F.when(enough, F.col("best.w")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    paths = cut(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = cut(paths.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        paths = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return found.join(paths, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def corpus_words(docs: DataFrame, *, least: int = 7, seen: int = 2, every: int = 31, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``: the words of ``least`` code points and ``seen`` occurrences or more.

    Words are maximal runs of Latin letters up to U+00FF, A-Z in small letters. To plant
    errors, a run of which the checksum with its document's id is a multiple of ``every`` loses the
    code point that the checksum points at; a null id counts as empty. Null and empty
    texts have no words; repeated rows count each.
    """
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), run.alias("run")).withColumn("run", F.translate("run", CAPITALS, SMALL))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut_out = F.concat(F.expr("left(run, int(pmod(h, length(run))))"), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut_out).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= seen)
