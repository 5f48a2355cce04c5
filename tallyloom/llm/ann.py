"""Approximate nearest neighbours by additive quantisation (Babenko and Lempitsky, 2014)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import cut


@dataclass(frozen=True)
class Codebooks:
    """``tables`` has one full-dimensional codebook a level: levels x codes x dimensions."""

    tables: np.ndarray

    def encode(self, x: np.ndarray, beam: int) -> np.ndarray:
        """Codes (rows x levels) found by beam search over the residuals.

        Each level extends every kept sum by every codeword and keeps the ``beam`` sums
        that leave the least squared residual.
        """
        levels, codes, _ = self.tables.shape
        out = np.zeros((len(x), levels), np.uint8)
        for at in range(0, len(x), 1024):
            part = x[at : at + 1024].astype(np.float32)
            n = len(part)
            rest, chosen = part[:, None, :], np.zeros((n, 1, 0), np.uint8)
            for level in range(levels):
                book = self.tables[level]
                cost = np.einsum("nbd,nbd->nb", rest, rest)[:, :, None] - 2 * rest @ book.T + np.einsum("kd,kd->k", book, book)
                flat = cost.reshape(n, -1)
                keep = min(beam, flat.shape[1]) if level < levels - 1 else 1
                best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
                parent, word = best // codes, best % codes
                row = np.arange(n)[:, None]
                rest = rest[row, parent] - book[word]
                chosen = np.concatenate([chosen[row, parent], word[:, :, None].astype(np.uint8)], axis=2)
            out[at : at + n] = chosen[:, 0]
        return out

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The sums of codewords."""
        return sum(self.tables[m][codes[:, m]] for m in range(len(self.tables)))

    @staticmethod
    def fit(x: np.ndarray, levels: int, codes: int, seed: int = 0) -> Codebooks:
        """Codebooks of a sample: k-means of what the levels before leave over."""
        rest, tables = x.astype(np.float32).copy(), []
        for level in range(levels):
            book = centres(rest, codes, seed + level)
            rest -= book[closest(rest, book)]
            tables.append(book)
        return Codebooks(np.stack(tables))


def closest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest row of ``book`` for each row of ``x``."""
    square = np.einsum("kd,kd->k", book, book)
    return np.concatenate([(square - 2 * x[at : at + 4096] @ book.T).argmin(1) for at in range(0, len(x), 4096)])


def centres(x: np.ndarray, n: int, seed: int, rounds: int = 8) -> np.ndarray:
    """``n`` centres of the rows by k-means."""
    draw = np.random.default_rng(seed)
    book = x[draw.choice(len(x), n, replace=len(x) < n)].copy()
    for _ in range(rounds):
        near = closest(x, book)
        order = np.argsort(near, kind="stable")
        held, starts = np.unique(near[order], return_index=True)
        book[held] = np.add.reduceat(x[order], starts) / np.diff(np.append(starts, len(x)))[:, None]
    return book


@dataclass(frozen=True)
class Frame:
    """Coordinates around the middle of a sample, in units of its median reach, in double
    precision: neither a common offset nor a few huge vectors use up the digits of the rest.
    Entries are held within 1e60, so squares are finite."""

    first: float
    middle: np.ndarray
    second: float

    @staticmethod
    def of(sample: np.ndarray) -> Frame:
        power = lambda v: 2.0 ** -min(max(math.frexp(v)[1], -1000), 1000)
        first = power(float(np.abs(sample).max()))
        middle = np.median(sample * first, axis=0)
        reach = np.abs(sample * first - middle).max(axis=1)
        return Frame(first, middle, power(float(np.median(reach[reach > 0]))) if (reach > 0).any() else 1.0)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        return np.clip((vectors * self.first - self.middle) * self.second, -1e60, 1e60)


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths of rows; a zero row has the direction zero."""
    size = np.sqrt(np.einsum("nd,nd->n", x, x))
    return x / np.where(size > 0, size, 1)[:, None], size


@dataclass(frozen=True)
class Index:
    """``lists`` are centres that every vector belongs to the nearest of; ``books`` code the direction of what a centre leaves over."""

    lists: np.ndarray
    books: Codebooks

    @staticmethod
    def fit(x: np.ndarray, lists: int, levels: int, codes: int) -> Index:
        middle = np.zeros((1, x.shape[1]), x.dtype)  # where sizes differ by orders of magnitude, means of lists are far from most rows
        rough = np.vstack([centres(x, lists - 1, 1), middle]) if lists > 1 else middle
        return Index(rough, Codebooks.fit(unit(x - rough[closest(x, rough)])[0], levels, codes))

    def near(self, asks: np.ndarray, own: np.ndarray, codes: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Squared distances (asks x rows) to the vectors that codes stand for."""
        there = self.lists[own] + gain[:, None] * self.books.decode(codes)
        return np.stack([np.einsum("nd,nd->n", there - a, there - a) for a in asks])

    def probes(self, x: np.ndarray, k: int, share: float, asked: int = 256) -> int:
        """How many of the nearest lists hold ``share`` of the true neighbours of rows of the
        sample ``x`` within it. Neighbours are nearer among all vectors, so this errs upward."""
        if len(self.lists) == 1 or len(x) < 2:
            return 1
        some = np.random.default_rng(2).choice(len(x), min(asked, len(x)), replace=False)
        own, square = closest(x, self.lists), np.einsum("nd,nd->n", x, x)
        far = square[None] - 2 * x[some] @ x.T
        far[np.arange(len(some)), some] = np.inf
        near = np.argpartition(far, min(k, len(x) - 1) - 1, axis=1)[:, : min(k, len(x) - 1)]
        place = np.argsort(np.argsort(self.away(x[some]), axis=1), axis=1)
        needed = np.take_along_axis(place, own[near], axis=1)
        return min(len(self.lists), int(np.quantile(needed, share)) + 2)

    def away(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of rows to all centres, up to the row's own square."""
        return np.einsum("kd,kd->k", self.lists, self.lists)[None] - 2 * x @ self.lists.T


def searchable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part: not null, not zero, all
    components finite, with an id. Rows that share an id count once, with the least vector.
    """
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = vectors.select(F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v"), F.coalesce(fine, F.lit(False)).alias("fine")).filter("fine AND id IS NOT NULL")
    return kept.groupBy("id").agg(F.min("v").alias("v"))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """Equal vectors as one: ``id`` (the least), ``v`` and ``ids`` (the ``keep`` least).

    A neighbour list of ``keep`` rows never reaches further into a class, and the limit
    acts before the shuffle, so a very common vector is no large group.
    """
    by_id = Window.partitionBy("h", "v").orderBy("id")
    first = rows.withColumn("h", F.xxhash64("v")).withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= keep)
    return first.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "v", "ids")


def fit_sample(vectors: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` vectors, those of the least hashed ids, on the driver."""
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(most).select("v")
    return np.array([r[0] for r in picked.collect()])


def effort(held: DataFrame, coded: DataFrame, wanted: DataFrame, frame: Frame, index: Index, k: int, share: float, probes: int, asked: int = 64) -> tuple[int, int, int]:
    """What it takes to find ``share`` of the true neighbours of ``asked`` queries: lists
    (``probes`` at least), places by coded distance among those lists, and places within a list.

    The neighbours are found by brute force over all of ``held``, and their places are
    counted over all of ``coded``: two scans, a row a neighbour to the driver.
    """
    picked = wanted.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(asked).collect()
    if not picked:
        return probes, 0, 0
    ids, asks = np.array([r["id"] for r in picked]), frame.place(np.array([r["v"] for r in picked]))

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, x = batch["id"].to_numpy(), frame.place(np.stack(batch["v"].to_numpy())) if len(batch) else None
            for i, ask in enumerate(asks if len(batch) else ()):
                far = np.einsum("nd,nd->n", x - ask, x - ask)
                far[own == ids[i]] = np.inf
                best = np.argpartition(far, min(k, len(far)) - 1)[:k]
                yield pd.DataFrame({"ask": i, "id": own[best], "far": far[best]})[lambda t: np.isfinite(t["far"])]

    nearest_first = Window.partitionBy("ask").orderBy("far", "id")
    true = held.select("id", "v").mapInPandas(brute, "ask int, id long, far double").withColumn("n", F.row_number().over(nearest_first)).filter(F.col("n") <= k)
    found = coded.join(F.broadcast(true.select("ask", "id")), "id").toPandas()
    if not len(found):
        return probes, 0, 0
    place = np.argsort(np.argsort(index.away(asks), axis=1), axis=1)
    ask, own = found["ask"].to_numpy(), found["list"].to_numpy()
    codes = np.frombuffer(b"".join(found["codes"]), np.uint8).reshape(len(found), -1)
    reach = index.near(asks, own, codes, found["gain"].to_numpy())[ask, np.arange(len(found))] * (1 + 1e-9)
    probes = max(probes, min(len(index.lists), int(np.quantile(place[ask, own], share)) + 1))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, len(ask)), np.int64)
        for batch in batches:
            if len(batch):
                lists = batch["list"].to_numpy()
                near = index.near(asks, lists, np.frombuffer(b"".join(batch["codes"]), np.uint8).reshape(len(batch), -1), batch["gain"].to_numpy())
                for j, a in enumerate(ask):
                    below = lists[near[a] <= reach[j]]
                    total[:, j] += np.count_nonzero(place[a, below] < probes), np.count_nonzero(below == own[j])
        yield pd.DataFrame({"j": np.arange(len(ask)), "every": total[0], "within": total[1]})

    sums = coded.mapInPandas(counted, "j int, every long, within long").groupBy("j").agg(F.sum("every").alias("every"), F.sum("within").alias("within")).toPandas().sort_values("j")
    met = place[ask, own] < probes
    return probes, math.ceil(np.quantile(sums["every"].to_numpy()[met], share)), math.ceil(np.quantile(sums["within"].to_numpy()[met], share))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance in double precision."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def nearest(vectors: DataFrame, queries: str, *, key: str = "vec_id", vector: str = "embedding", k: int = 10, rerank: int | None = None, **options) -> DataFrame:
    """The ``k`` nearest other vectors of each query, which are the vectors whose ``id``
    meets the condition ``queries``: ``query_id``, ``rank``, ``vec_id``,
    ``score`` (exact distance), nearest first, ties to the smaller id.

    Only vectors of equal length have a distance, so each length is searched by itself.
    Null, zero and non-finite vectors take no part; rows that share an id count once;
    other columns are not read; a table without vectors that take part gives an empty
    result. Equal vectors are one class: they are scored once, whatever their number,
    and their ids come back in order, so ties are exact.
    """
    rows = cut(searchable(vectors, key, vector))
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for row in rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect():
        same = rows.filter(F.size("v") == row["dim"])
        found = found.unionByName(_nearest(same, queries, k, rerank or 300 + 4 * round(row["n"] ** (1 / 3)), row["n"], **options))
    return found


def _nearest(rows: DataFrame, queries: str, k: int, rerank: int, n: int, *, levels: int = 16, codes: int = 256, beam: int = 4, share: float = 0.98, list_rows: int = 2048, sample: int = 16384, rows_block: int = 32768, queries_block: int = 8192) -> DataFrame:
    """``nearest`` among vectors of one length.

    The index is fitted on a ``sample`` of bounded size and covers every vector: a vector
    belongs to the list of its nearest centre, and beam search codes what that leaves
    over as a direction; its length and the norm of the sum are stored. A query asks the
    nearest lists, as many as held ``share`` of the neighbours within the sample, and
    scores their codes by lookup tables; a list sends four times its even share of
    ``rerank`` and ``k`` more, and the ``rerank`` best of all are measured exactly. All
    three rise to what ``effort`` measures over the whole table. Lists grow in number
    with the table, up to an eighth of the sample. A list of over ``rows_block`` rows and
    the queries of a list are dealt over tasks in blocks of fixed size. Only the index
    and a row a list are broadcast or come to the driver.
    """
    held = cut(classes(rows, k + 1))
    seen = fit_sample(held, sample)
    frame = Frame.of(seen)
    seen = frame.place(seen)
    index = Index.fit(seen, max(1, min(n // list_rows, len(seen) // 8)), levels, min(codes, len(seen)))
    probes = index.probes(seen, k, share)
    asked = rows.filter(queries).withColumn("h", F.xxhash64("v"))
    member = cut(asked.join(held.select(F.xxhash64("v").alias("h"), "v", F.col("id").alias("class")), ["h", "v"]).select(F.col("id").alias("query_id"), "class"))
    wanted = held.join(member.select(F.col("class").alias("id")).distinct(), "id", "left_semi").select("id", "v")

    dim = seen.shape[1]

    def placed(v: pd.Series) -> np.ndarray:
        return frame.place(np.stack(v.to_numpy())) if len(v) else np.zeros((0, dim))

    @F.pandas_udf("list int, codes binary, gain double, norm double")
    def encoded(v: pd.Series) -> pd.DataFrame:
        x = placed(v)
        own = closest(x, index.lists) if len(x) else np.zeros(0, np.int64)
        way, gain = unit(x - index.lists[own])
        found = index.books.encode(way, beam)
        sums = gain[:, None] * index.books.decode(found)
        return pd.DataFrame({"list": own.astype(np.int32), "codes": [c.tobytes() for c in found], "gain": gain, "norm": np.einsum("nd,nd->n", sums, sums)})

    coded = cut(held.withColumn("e", encoded("v")).select("id", "e.*"))
    probes, least, least_within = effort(held, coded, wanted, frame, index, k, (1 + share) / 2, probes)
    most = min(rerank, math.ceil(4 * rerank / probes) + k)
    rerank, most = max(rerank, least), max(most, least_within)

    @F.pandas_udf("array<int>")
    def nearby(v: pd.Series) -> pd.Series:
        away = index.away(placed(v))
        return pd.Series(list(np.argpartition(away, probes - 1, axis=1)[:, :probes].astype(np.int32)))

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "id": [], "near": []})
        found = np.frombuffer(b"".join(left["codes"]), np.uint8).reshape(len(left), -1)
        ids, norm, centre = left["id"].to_numpy(np.int64), left["norm"].to_numpy(), index.lists[left["list"].iloc[0]]
        by_id = np.argsort(ids)
        found, ids, norm, gain = found[by_id], ids[by_id], norm[by_id], left["gain"].to_numpy()[by_id]
        out = []
        for at in range(0, len(right), 64):
            asks = placed(right["ask"].iloc[at : at + 64]) - centre
            tables, rough = -2 * np.einsum("qd,mkd->qmk", asks, index.books.tables), np.einsum("qd,qd->q", asks, asks)
            for i, query in enumerate(right["query_id"].iloc[at : at + 64]):
                along = np.zeros(len(ids))
                for m in range(found.shape[1]):
                    along += tables[i, m][found[:, m]]
                near = rough[i] + norm + gain * along
                top = np.arange(len(near))
                if len(near) > most:  # of equal scores the smaller ids
                    last = np.partition(near, most - 1)[most - 1]
                    below = np.flatnonzero(near < last)
                    top = np.concatenate([below, np.flatnonzero(near == last)[: most - len(below)]])
                out.append(pd.DataFrame({"query_id": np.full(len(top), query), "id": ids[top], "near": near[top]}))
        return pd.concat(out)

    probed = cut(wanted.select(F.col("id").alias("query_id"), F.col("v").alias("ask"), F.explode(nearby("v")).alias("list")))
    parts = coded.groupBy("list").agg(F.ceil(F.count("*") / rows_block).cast("int").alias("r_parts"))
    ask_parts = probed.groupBy("list").agg(F.ceil(F.count("*") / queries_block).cast("int").alias("q_parts"))
    plan = F.broadcast(parts.join(ask_parts, "list"))  # a row a list
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = coded.join(plan, "list").select("list", "id", "codes", "gain", "norm", dealt("id", "r_parts").alias("r"), spread("q_parts").alias("q"))
    right = probed.join(plan, "list").select(F.col("list").alias("at"), "query_id", "ask", dealt("query_id", "q_parts").alias("aq"), spread("r_parts").alias("ar"))
    met = left.groupBy("list", "r", "q").cogroup(right.groupBy("at", "ar", "aq")).applyInPandas(scored, "query_id long, id long, near double")
    best = Window.partitionBy("query_id").orderBy("near", "id")
    some = met.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= rerank).select("query_id", "id")
    exact = some.join(held.select("id", F.col("v").alias("there"), "ids"), "id").join(wanted.select(F.col("id").alias("query_id"), "v"), "query_id")
    measured = exact.select(F.col("query_id").alias("class"), "id", "ids", distance(F.col("v"), F.col("there")).alias("score"))
    order = Window.partitionBy("class").orderBy("score", "id")
    close = measured.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    each = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct("score", i.alias("vec_id")))))
    lists = close.groupBy("class").agg(F.slice(F.sort_array(each), 1, k + 1).alias("near"))
    others = member.join(lists, "class").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
