"""Near-duplicates by SimHash and ball hashing that meets in the middle."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.components import components
from tallyloom.llm.shared import cut

SEED = 42


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """64-bit hashes of a text's shingles, repeats included.

    A-Z count as a-z. A text of fewer words than ``width`` has its words as the one
    shingle; one without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Signed 64 bits: each is set where over half of the hashes set it; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: bytes, width: int) -> int:
    """The fingerprint of a text, from all its shingles; zero without words."""
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, *, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fingerprint`` (signed 64 bits) of whole texts; null
    counts as empty. Texts stream through the workers and do not come back."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(x.as_py(), width) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "text_hash", "fingerprint"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.cast("binary").alias("raw"))
    return rows.mapInArrow(hashed, "doc_id long, text_hash long, fingerprint long")


def ball_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (``a``, ``b``) that join all distinct fingerprints within ``radius`` bits.

    Every fingerprint emits all variants within half the radius; two within the radius
    share one. ``radius`` is even, so all that share a variant are within it, and there
    are at most as many of them as variants: each is linked to the least of them, which
    joins the same fingerprints as all pairs would. The distance is verified.
    """
    if radius < 0 or radius % 2:
        raise ValueError("radius must be even")
    masks = [sum(1 << i for i in bits) for n in range(radius // 2 + 1) for bits in combinations(range(64), n)]
    signed = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks))
    emitted = prints.select("fingerprint", F.explode(signed).alias("mask")).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"))
    same = Window.partitionBy("variant").orderBy("fingerprint")
    pairs = emitted.select(F.col("fingerprint").alias("a"), F.first("fingerprint").over(same).alias("b"))
    return pairs.filter("a <> b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def near_duplicates(docs: DataFrame, *, width: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document: ``doc_id``, ``text_hash``, ``fingerprint`` and ``component_id``.

    Documents are linked when their fingerprints differ in at most ``radius`` bits;
    component_id is the least doc_id that links reach, itself included (null only if
    no document there has an id). Copies share a fingerprint and stand for one node, so
    any number of them adds no links. Null texts are empty, and all texts without words
    are linked by their zero fingerprint. Repeated rows give repeated rows, other
    columns are ignored, and an empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, width=width, key=key, text=text))
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    roots = components(ball_links(prints, radius))
    rooted = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    rooted = cut(rooted)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id")


def keep_one(docs: DataFrame, *, width: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each near-duplicate group left: that of the least id.

    Of rows that share that id, the least text hash stays, and of rows that repeat
    both, the first by their other columns.
    """
    return kept_rows(docs, near_duplicates(docs, width=width, radius=radius, key=key, text=text), key=key, text=text)


def kept_rows(docs: DataFrame, found: DataFrame, *, key: str, text: str) -> DataFrame:
    """The documents that stand for the components ``found`` (``doc_id``, ``text_hash``, ``component_id``).

    Who stays is decided on those narrow rows; texts move once, dealt by id and text.
    """
    shown = lambda c: F.coalesce(F.concat(F.lit("k"), c.cast("string")), F.lit("n"))
    own = F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("text_hash"))
    chosen = found.groupBy("component_id").agg(F.min(own).alias("__text_hash")).select(shown(F.col("component_id")).alias("__id"), "__text_hash")
    hashed = docs.withColumns({"__id": shown(F.col(key).cast("long")), "__text_hash": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    kept = hashed.join(chosen, ["__id", "__text_hash"], "left_semi")
    first = Window.partitionBy("__id", "__text_hash").orderBy(*[c for c in docs.columns if c not in (key, text)])
    return kept.withColumn("__n", F.row_number().over(first)).filter("__n = 1").select(*docs.columns)
