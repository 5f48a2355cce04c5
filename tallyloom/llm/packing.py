"""Packing token sequences by cutting-stock column generation (Gilmore and Gomory, 1961)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.encode import encoder
from tallyloom.llm.shared import cut, hash_bucket, running_start


def best_pattern(worth: np.ndarray) -> tuple[float, np.ndarray]:
    """The most worth that fits one sequence, and how many of each length it takes.

    ``worth[i]`` is the worth of length i + 1 (below zero: not for sale); the knapsack
    may take a length repeatedly.
    """
    capacity = len(worth)
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gains = best[room - 1 :: -1] + worth[:room] if room < capacity else best[-2::-1] + worth
        top = int(gains.argmax())
        if gains[top] > best[room - 1]:
            best[room], took[room] = gains[top], top + 1
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(capacity, np.int64), capacity
    while room:
        if took[room]:
            counts[took[room] - 1] += 1
        room -= int(took[room]) or 1
    return float(best[capacity]), counts


def cutting_plan(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3, rounds: int = 6000) -> list[tuple[int, dict[int, int]]]:
    """How often to use which pattern, so that every piece gets a place exactly once.

    Column generation for the linear program over patterns: the simplex basis has a
    pattern a length, the knapsack prices new ones, and it ends within ``gap`` of
    Farley's lower bound (``rounds`` only bounds the work; stopping early costs padding,
    never a piece). Counts are rounded down; what is left is placed largest first.
    """
    n = len(lengths)
    if not n:
        return []
    basis = np.diag(capacity // lengths).astype(np.int64)
    inverse = np.diag(1.0 / (capacity // lengths))
    level = demand / (capacity // lengths)
    for _ in range(rounds):
        dual = inverse.sum(axis=0)
        worth = np.full(capacity, -1.0)
        worth[lengths - 1] = dual
        value, counts = best_pattern(worth)
        if value <= 1 + 1e-7 or level.sum() * value <= (1 + gap) * max(float(dual @ demand), 1e-9):
            break
        column = counts[lengths - 1]
        change = inverse @ column
        able = change > 1e-9
        ratio = np.full(n, np.inf)
        ratio[able] = level[able] / change[able]
        out = int(ratio.argmin())
        step = max(ratio[out], 0.0)
        level = np.maximum(level - step * change, 0.0)
        level[out] = step
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
        basis[:, out] = column
    used = np.floor(level + 1e-9).astype(np.int64)
    rest = demand - basis @ used
    while (rest < 0).any():  # rounding noise took a piece too many
        used[int(np.flatnonzero((basis[int(np.flatnonzero(rest < 0)[0])] > 0) & (used > 0))[0])] -= 1
        rest = demand - basis @ used
    plan = [(int(used[k]), {int(lengths[i]): int(basis[i, k]) for i in np.flatnonzero(basis[:, k])}) for k in range(n) if used[k]]
    order = np.argsort(-lengths)
    sizes, rest = lengths[order], rest[order].copy()
    while rest.any():
        room, took = capacity, {}
        for i in np.flatnonzero(rest):
            if fits := min(int(rest[i]), room // int(sizes[i])):
                took[int(sizes[i])] = fits
                room -= fits * int(sizes[i])
        many = min(int(rest[i]) // took[int(sizes[i])] for i in np.flatnonzero(rest) if int(sizes[i]) in took)
        for i in np.flatnonzero(rest):
            rest[i] -= many * took.get(int(sizes[i]), 0)
        plan.append((many, took))
    return plan


def pack(pieces: DataFrame, capacity: int, *, length: str = "length", order: list[str] | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    Only the histogram of lengths, at most ``capacity`` rows, goes to the driver, which
    plans patterns of lengths. Pieces of a length are ranked (by hash buckets, so a very
    common length is dealt over tasks) and the k-th takes the k-th place for its length.
    There is a bucket for about 250,000 pieces, 64 at least. Each piece gets one place; places in a sequence leave no gaps; the same rows get the
    same packing. Ties in ``order`` (all columns if not given) are rows that are equal.
    An empty table gives an empty result.
    """
    order = order if order is not None else list(pieces.columns)
    tally = sorted((r[length], r["n"]) for r in pieces.groupBy(length).agg(F.count("*").alias("n")).collect())
    if tally and not 1 <= tally[0][0] <= tally[-1][0] <= capacity:
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    inner = [(size, n) for size, n in tally if size < capacity]
    plan = cutting_plan(np.array([x[0] for x in inner], np.int64), np.array([x[1] for x in inner], np.int64), capacity)
    plan += [(n, {size: 1}) for size, n in tally if size == capacity]
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for many, pattern in plan:
        offset = 0
        for size, count in sorted(pattern.items(), reverse=True):
            places.setdefault(size, []).append((taken.get(size, 0), count, sequence, offset))
            taken[size] = taken.get(size, 0) + many * count
            offset += size * count
        sequence += many
    flat = np.array([(size << 40 | first, first, count, start, offset) for size in sorted(places) for first, count, start, offset in places[size]], np.int64).reshape(-1, 5)

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, rank = size.to_numpy(np.int64), rank.to_numpy(np.int64)
        row = flat[np.searchsorted(flat[:, 0], size << 40 | rank, "right") - 1]
        nth = rank - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + nth // row[:, 2], "offset": row[:, 4] + nth % row[:, 2] * size})

    buckets = max(64, sum(n for _, n in tally) // 250_000)
    ranked = running_start(pieces, [length], order, F.lit(1), "__rank", hash_bucket(order, buckets))
    placed = ranked.withColumn("__place", place(F.col(length).cast("long"), "__rank"))
    return placed.select(*pieces.columns, "__place.sequence_id", "__place.offset")


def token_pieces(docs: DataFrame, tokenizer: str, *, kind: str, end_id: int, capacity: int, grain: int, key: str = "doc_id", text: str = "text", ids: bool = False, specials: bool = False) -> DataFrame:
    """Tokens of every whole text and ``end_id``, cut into pieces.

    They are as many pieces of ``capacity`` as there are, then one of a multiple of
    ``grain``, then one of less than ``grain``; so there are few lengths, and long
    rests, which would leave gaps that nothing fills, end on even lengths.

    A row a piece: ``doc_id``, ``start``, ``length``, ``ids_crc32`` (ids as unsigned 32-bit
    little-endian integers), ``doc_tokens`` and, if wanted, ``ids``. A null text is empty
    and makes the piece of its end id. Repeated rows and null keys keep their own pieces.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())] + [("ids", pa.list_(pa.int64()))] * ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, kind, specials)
        for batch in batches:
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), enc.stream(x.as_py() for x in batch.column(1)), strict=True):
                tokens = np.append(found, np.uint32(end_id)).astype("<u4")
                whole_parts = len(tokens) // capacity * capacity
                cuts = [*range(0, whole_parts, capacity), *sorted({whole_parts, len(tokens) // grain * grain, len(tokens)})]
                for start, stop in pairwise(cuts):
                    piece = tokens[start:stop]
                    rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(tokens), *([piece.astype(np.int64)] if ids else [])))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(x, f[1]) for x, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))

    kinds = ", ".join(f"{name} {'array<long>' if name == 'ids' else 'long'}" for name, _ in fields)
    return docs.select(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit(""))).mapInArrow(encode, kinds)


def pack_documents(docs: DataFrame, tokenizer: str, *, kind: str, end_id: int, capacity: int, grain: int, key: str = "doc_id", text: str = "text", specials: bool = False) -> DataFrame:
    """``token_pieces`` packed: texts are encoded once, and what follows reads the pieces' table."""
    pieces = cut(token_pieces(docs, tokenizer, kind=kind, end_id=end_id, capacity=capacity, grain=grain, key=key, text=text, specials=specials))
    return pack(pieces, capacity, order=["doc_id", "start", "ids_crc32", "doc_tokens"])
