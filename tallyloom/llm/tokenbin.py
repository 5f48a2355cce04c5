"""Token ids in files of Simple-8b words (Anh and Moffat, 2010).

A word of 64 bits has a selector in its top four bits and, below it, as many ids as
fit at one width. A file is a table of blocks; each block holds whole documents:

    part, block   place in the order of documents
    first         ids in this part before the block
    doc_ids, lengths   its documents, in order
    payload       "S8B1", then how many ids, words and escapes (unsigned 32-bit,
                  little endian), then the words, then the escapes

Selector 0 is an escape: the word holds an index into the escapes, which are values
too wide for 60 bits. All widths of a block follow from its selectors, so a prefix
sum gives each word's offset and a block is decoded without a loop over ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.encode import encoder

# Ids and bits of each selector; 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8B1"


_WIDTHS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value takes."""
    if len(values) and values.max() < len(_WIDTHS):
        return _WIDTHS[values.astype(np.uint16)]
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.uint8)


def pack(values: np.ndarray) -> bytes:
    """The payload of a block: each word takes as many of the next values as fit."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    width = np.zeros(n + 60, np.uint8)  # past the end there are zeros
    width[:n] = _bits(values)
    selector = np.where(width[:n] > 60, 0, len(COUNTS) - 1).astype(np.uint8)
    widest, span = width.copy(), 1
    for choice in range(len(COUNTS) - 2, 0, -1):
        while span < COUNTS[choice]:
            step = min(span, COUNTS[choice] - span)
            widest[: len(widest) - step] = np.maximum(widest[: len(widest) - step], widest[step:])
            span += step
        np.copyto(selector, np.uint8(choice), where=widest[:n] <= BITS[choice])
    steps, starts, at = COUNTS[selector].astype(np.uint8).tobytes(), [], 0
    add = starts.append
    while at < n:
        add(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts] if n else selector
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    words = np.zeros(len(starts), np.uint64)
    escapes = values[starts[chosen == 0]] if n else values
    words[chosen == 0] = np.arange(len(escapes), dtype=np.uint64)
    for choice in range(1, len(COUNTS)):
        where = np.flatnonzero(chosen == choice)
        if len(where):
            first, word = starts[where], np.full(len(where), choice << 60, np.uint64)
            for held in range(COUNTS[choice]):
                word |= padded[first + held] << np.uint64(held * BITS[choice])
            words[where] = word
    return MAGIC + np.array([n, len(words), len(escapes)], "<u4").tobytes() + words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """The values of a block, unsigned 64-bit."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b block")
    n, n_words, n_escapes = np.frombuffer(payload, "<u4", 3, 4)
    words = np.frombuffer(payload, "<u8", n_words, 16)
    escapes = np.frombuffer(payload, "<u8", n_escapes, 16 + 8 * int(n_words))
    chosen = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[chosen])
    starts = ends - COUNTS[chosen]
    out = np.zeros(int(ends[-1]) if n_words else 0, np.uint64)
    out[starts[chosen == 0]] = escapes[words[chosen == 0].astype(np.int64)] if n_escapes else 0
    for choice in range(1, len(COUNTS)):
        where = np.flatnonzero(chosen == choice)
        if len(where):
            held = np.arange(COUNTS[choice])
            shifted = words[where][:, None] >> (held * BITS[choice]).astype(np.uint64)
            out[starts[where][:, None] + held] = shifted & np.uint64((1 << int(BITS[choice])) - 1)
    return out[: int(n)]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, kind: str, end_id: int, key: str = "doc_id", text: str = "text", block: int = 65536, specials: bool = False) -> None:
    """Encodes the whole ``text`` of every row, adds ``end_id`` to each and writes the
    ids in ascending ``key`` order to ``path``, a folder that all executors share.

    A null text is empty and a null key comes first; rows that share a key are ordered
    by their text. Rows are dealt by ranges of (key, hash of text), so a key with most
    rows still spreads, and blocks close at ``block`` ids or more. Other columns are
    not read. An empty table leaves files without blocks.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, kind, specials)
        held: dict[str, list] = {"doc": [], "ids": []}
        size = first = number = part = 0

        def closed() -> pa.RecordBatch:
            lengths = [len(x) for x in held["ids"]]
            row = {"part": [part], "block": [number], "first": [first], "n_ids": [size], "doc_ids": [held["doc"]], "lengths": [lengths], "payload": [pack(np.concatenate(held["ids"]).astype(np.uint64))]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]))

        for batch in batches:
            texts = (x.as_py() for x in batch.column(1))
            for doc, ids, part in zip(batch.column(0).to_pylist(), enc.stream(texts), batch.column(2).to_pylist(), strict=True):  # noqa: B020
                held["doc"].append(doc)
                held["ids"].append(np.append(ids, np.uint32(end_id)))
                size += len(ids) + 1
                if size >= block:
                    yield closed()
                    first, number, size = first + size, number + 1, 0
                    held = {"doc": [], "ids": []}
        if size:
            yield closed()

    slim = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    dealt = slim.withColumn("h", F.xxhash64("t")).repartitionByRange("k", "h").sortWithinPartitions("k", "h")
    blocks = dealt.select("k", "t", F.spark_partition_id().alias("p")).mapInArrow(encode, "part int, block int, first long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary")
    blocks.write.mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """Reads files of ``write_tokens``: a row a document with ``doc_id``, ``start`` (ids
    of all documents before it), ``n_tokens``, ``ids_crc32`` (of the ids as unsigned
    32-bit little-endian integers) and, if wanted, ``ids``.

    Only one row a part, of which there are as many as write tasks, is summed in one
    place to find where parts start, and broadcast.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, lengths = unpack(row["payload"]), np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                small = values.astype("<u4")
                crcs = [zlib.crc32(small[a:b].tobytes()) for a, b in zip(ends - lengths, ends, strict=True)]
                out = [row["doc_ids"], row["before"] + ends - lengths, lengths, crcs]
                if ids:
                    out.append([values[a:b].astype(np.int64) for a, b in zip(ends - lengths, ends, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(x, f[1]) for x, f in zip(out, fields, strict=True)], schema=pa.schema(fields))

    blocks = spark.read.parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    placed = blocks.join(F.broadcast(offsets), "part").select("doc_ids", "lengths", "payload", (F.col("o") + F.col("first")).alias("before"))
    kinds = {"doc_id": "long", "start": "long", "n_tokens": "long", "ids_crc32": "long", "ids": "array<long>"}
    return placed.mapInArrow(decode, ", ".join(f"{f[0]} {kinds[f[0]]}" for f in fields))
