"""Embedding whitening: Welford updates in partition iterators, merged states, a symmetric QR eigen-solve."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import cut

#: Beyond this size entries are cut off, so that sums of whole numbers stay exact.
LARGEST = 1 << 40
STATE = "dim int, at int, n long, origin array<double>, mean array<double>, square array<double>, total array<decimal(38,0)>"


@dataclass(frozen=True)
class Moments:
    """Of ``n`` rows: the ``mean`` as a difference to ``origin`` (one of the rows, so that the
    difference is about as large as the spread), the centred sums of products ``square``, and exact sums ``total``."""

    n: int
    origin: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    total: list[int]

    @staticmethod
    def empty(origin: np.ndarray) -> Moments:
        d = len(origin)
        return Moments(0, origin, np.zeros(d), np.zeros((d, d)), [0] * d)

    def add(self, rows: np.ndarray, total: list[int]) -> Moments:
        """With more rows, by one rank-one update each (Welford)."""
        n, mean, square = self.n, self.mean.copy(), self.square.copy()
        for x in rows - self.origin:
            n += 1
            before = x - mean
            mean += before / n
            square += np.multiply.outer(before, before * ((n - 1) / n))
        return replace(self, n=n, mean=mean, square=square, total=[a + b for a, b in zip(self.total, total, strict=True)])

    def merge(self, other: Moments) -> Moments:
        """Of both sets of rows, by the parallel update formula (Chan, Golub and LeVeque)."""
        n = self.n + other.n
        apart = (other.origin - self.origin) + (other.mean - self.mean)
        square = self.square + other.square + np.multiply.outer(apart, apart * (self.n * other.n / n))
        return Moments(n, self.origin, self.mean + apart * (other.n / n), square, [a + b for a, b in zip(self.total, other.total, strict=True)])

    def row(self) -> tuple:
        return self.n, self.origin.tolist(), self.mean.tolist(), self.square.ravel().tolist(), [Decimal(x) for x in self.total]

    @staticmethod
    def of(row: object) -> Moments:
        d = len(row.origin)
        return Moments(int(row.n), np.array(row.origin, float), np.array(row.mean, float), np.array(row.square, float).reshape(d, d), [int(x) for x in row.total])


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Householder reflections make it tridiagonal; QR steps with Wilkinson's shift, each a
    chain of rotations, make that diagonal (Golub and Van Loan, section 8.3).
    """
    n = len(a)
    scale = 2.0 ** math.frexp(float(np.abs(a).max()))[1]  # no square is too small or too large
    t, q = np.array(a, float) / scale, np.eye(n)
    for k in range(n - 2):
        x = t[k + 1 :, k]
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            continue
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        v /= np.linalg.norm(v)
        t[k + 1 :, k:] -= 2 * np.outer(v, v @ t[k + 1 :, k:])
        t[:, k + 1 :] -= 2 * np.outer(t[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    d, e = t.diagonal().copy(), t.diagonal(-1).copy()
    turn = q.T.copy()  # rows are easier to rotate
    eps, high = np.finfo(float).eps, n - 1
    while high > 0:
        small = np.abs(e[:high]) <= eps * (np.abs(d[:high]) + np.abs(d[1 : high + 1]))
        e[:high][small] = 0.0
        if e[high - 1] == 0:
            high -= 1
            continue
        split = np.flatnonzero(e[:high] == 0)
        low = int(split[-1]) + 1 if len(split) else 0
        gap = (d[high - 1] - d[high]) / 2
        shift = d[high] - e[high - 1] ** 2 / (gap + math.copysign(math.hypot(gap, e[high - 1]), gap))
        x, z = d[low] - shift, e[low]
        for k in range(low, high):
            r = math.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > low:
                e[k - 1] = r
            one, two, off = d[k], d[k + 1], e[k]
            d[k] = c * c * one + 2 * c * s * off + s * s * two
            d[k + 1] = s * s * one - 2 * c * s * off + c * c * two
            e[k] = c * s * (two - one) + (c * c - s * s) * off
            if k + 1 < high:
                z, e[k + 1] = s * e[k + 1], c * e[k + 1]
                x = e[k]
            turn[[k, k + 1]] = np.array([[c, s], [-s, c]]) @ turn[[k, k + 1]]
    order = np.argsort(-d, kind="stable")
    return d[order] * scale, turn[order].T


def lists_of(held: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lengths and starts of an array of lists without nulls, in its flat values."""
    ends = held.offsets.to_numpy() - held.offsets[0].as_py()
    return np.diff(ends), ends[:-1]


def moments(vectors: DataFrame, column: str, *, whole: bool, fan: int = 16) -> DataFrame:
    """A row (``STATE``) for each ``dim``; vectors of one ``dim`` are equally long.

    Each partition streams its rows through a state a ``dim``; then states are merged, at
    most ``fan`` in a task, turn after turn. A state has as many numbers as the
    square of the length. ``whole``: the entries are whole numbers, and their exact sums are kept.
    """
    shape = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), *((c, pa.list_(pa.float64())) for c in ("origin", "mean", "square")), ("total", pa.list_(pa.decimal128(38, 0)))])

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, Moments] = {}
        for batch in batches:
            sizes, starts = lists_of(batch.column(1))
            flat, dims = batch.column(1).flatten().to_numpy(zero_copy_only=False), batch.column(0).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = flat[starts[at][:, None] + np.arange(sizes[at[0]])]
                total = rows.sum(axis=0, dtype=np.int64).tolist() if whole else [0] * rows.shape[1]
                before = states.get(int(dim)) or Moments.empty(rows[0].astype(float))
                states[int(dim)] = before.add(rows.astype(float), total)
        own = TaskContext.get().partitionId()
        for dim, state in states.items():  # one at a time: a state may be large
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((dim, own, *state.row()), shape, strict=True)], schema=shape)

    def merged(by: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*by, *reduce(Moments.merge, map(Moments.of, rows.itertuples())).row())], columns=shape.names)

    states = cut(vectors.select("dim", column).mapInArrow(streamed, STATE))
    while (states.agg(F.max("at")).first()[0] or 0) > 0:
        states = cut(states.withColumn("at", (F.col("at") / fan).cast("int")).groupBy("dim", "at").applyInPandas(merged, STATE))
    return states


@dataclass(frozen=True)
class Whitener:
    """For vectors of one length: ``n`` of them with the sums ``total`` gave the components,
    whose ``values`` are eigenvalues (zero: no spread there) and ``shares`` those of the trace."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    shares: list[float]

    @staticmethod
    def fit(state: Moments, components: int) -> Whitener:
        values, vectors = symmetric_qr(state.square / state.n)
        spread = float(np.trace(state.square)) / state.n
        values = np.where(values > 1e-13 * values[0], values, 0.0)[:components]
        return Whitener(state.n, state.total, values, vectors[:, :components], (values / spread if spread else np.zeros(len(values))).tolist())

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in whole numbers of any size where 64 bits are too few."""
        sums = np.array(self.total, object)
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.total)) < 1 << 62:
            return x * self.n - sums.astype(np.int64)
        return x.astype(object) * self.n - sums

    def deviations(self, apart: np.ndarray) -> list[int | None]:
        """Sums of squares, exact; None where they have no place in a long."""
        exact = apart if apart.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 < 1 << 63 else apart.astype(object)
        return [int(x) if x < 1 << 63 else None for x in (exact * exact).sum(axis=1)]

    def whitened(self, apart: np.ndarray) -> np.ndarray:
        """Projections on the components over the roots of their values; NaN without spread."""
        centred = (apart / self.n).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, centred @ self.vectors / np.sqrt(self.values), np.nan)


def projected(rows: DataFrame, known: dict[int, Whitener]) -> DataFrame:
    """``id``, ``dim``, ``deviation`` and ``whitened`` (an entry a component, null without spread) of ``x``."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, starts = lists_of(batch.column("x"))
            flat = batch.column("x").flatten().to_numpy()
            deviation, whitened = np.empty(len(sizes), object), np.empty(len(sizes), object)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                apart = known[int(d)].apart(flat[starts[at][:, None] + np.arange(d)])
                deviation[at] = known[int(d)].deviations(apart)
                for i, values in zip(at, known[int(d)].whitened(apart), strict=True):
                    whitened[i] = values
            ends = np.concatenate([[0], np.cumsum([len(w) for w in whitened])])
            values = np.concatenate([np.zeros(0), *whitened])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, mask=np.isnan(values)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dim"), pa.array(deviation, pa.int64()), lists], ["id", "dim", "deviation", "whitened"])

    return rows.select("id", "dim", "x").mapInArrow(done, "id long, dim int, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = 16, chunk: int = 1 << 25) -> DataFrame:
    """A row a vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    Entries c become whole numbers floor(64 * c) + 1000000 (cut off at 2^40). The distinct vectors are fitted: their
    covariance by ``moments``, its eigenvectors by ``symmetric_qr`` in one task, as many numbers
    as the square of the length. ``identity_error`` is measured on the whitened fit list.

    Vectors that are null, empty or hold null or non-finite entries take no part. Equal
    vectors count once in the fit and come back each, as do repeated rows; a null id stays
    null. Vectors of different lengths are fitted apart; their components are handed to
    the tasks in turns of at most ``chunk`` bytes. There are as many components as entries
    at most; one without spread (few or equal vectors) has no whitened value, and explains 0. A
    deviation of 2^63 or more is null. Other columns are not read; an empty table gives no rows.
    """
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & (F.size(v) > 0)

    def scaled(c: Column) -> Column:
        return F.floor(F.greatest(F.least(64 * c, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long") + 1_000_000

    rows = vectors.filter(F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("id"), F.size(vector).alias("dim"), F.transform(v, scaled).alias("x"))
    listed = cut(rows.select("dim", "x").distinct())
    states = moments(listed, "x", whole=True)
    out = vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")

    def solved(by: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        one = Whitener.fit(Moments.of(next(pdf.itertuples())), components)
        return pd.DataFrame([(*by, one.n, [str(x) for x in one.total], one.values.tolist(), one.vectors.ravel().tolist(), one.shares)], columns=["dim", "n", "total", "values", "vectors", "shares"])

    models = cut(states.groupBy("dim").applyInPandas(solved, "dim int, n long, total array<string>, values array<double>, vectors array<double>, shares array<double>"))
    turns: list[list[int]] = []
    room = 0
    for (dim,) in models.select("dim").orderBy("dim").collect():  # lengths, of which long ones are few in a turn
        room -= 8 * dim * (components + 2)
        if not turns or room < 0:
            turns.append([])
            room = chunk
        turns[-1].append(dim)
    for dims in turns:
        some = F.col("dim").isin(dims)
        known = {r["dim"]: Whitener(r["n"], [int(x) for x in r["total"]], np.array(r["values"]), np.array(r["vectors"]).reshape(r["dim"], -1), r["shares"]) for r in models.filter(some).collect()}
        back = projected(listed.filter(some).withColumn("id", F.lit(None).cast("long")), known).withColumn("whitened", F.filter("whitened", lambda w: w.isNotNull())).filter(F.size("whitened") > 0)
        errors = {r["dim"]: float(np.abs(np.array(r["square"]).reshape(len(r["mean"]), -1) / r["n"] - np.eye(len(r["mean"]))).max()) for r in moments(back, "whitened", whole=False).collect()}
        said = vectors.sparkSession.createDataFrame([(d, one.n, one.shares, errors.get(d)) for d, one in known.items()], "dim int, n long, shares array<double>, identity_error double")
        each = projected(rows.filter(some), known).join(F.broadcast(said), "dim").select("id", "n", "deviation", "shares", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
        out = out.unionByName(each.select(F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get("shares", "at").alias("explained"), "identity_error"))
    return out
