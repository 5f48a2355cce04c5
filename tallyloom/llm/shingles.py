"""Near copies by word shingles: SimHash balls and MinHash bands propose pairs, the shingles decide."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.shared import cut, swept
from tallyloom.llm.simhash import SEED, ball_links, kept_rows, majority, shingle_hashes


@lru_cache(maxsize=4)
def _factors(n: int) -> np.ndarray:
    """Odd factors and summands of ``n`` multiplicative hashes."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, (2, n), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_values(hashes: np.ndarray, bands: int, rows: int) -> list[int]:
    """A signed 64-bit value a band: equal where the least of ``rows`` permuted hashes are."""
    odd, add = _factors(bands * rows)
    least = np.full(bands * rows, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 128):
        least = np.minimum(least, (odd[:, None] * hashes[at : at + 128] + add[:, None]).min(axis=1))
    parts = least.astype("<u8").reshape(bands, rows)
    return [xxhash.xxh64_intdigest(part.tobytes(), seed=band) - (1 << 63) for band, part in enumerate(parts)]


#: Bits of a text's parities, as longs.
PARITY_WORDS = 16


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of 1024 cells of hash values, whether it holds an odd number of the distinct hashes.

    Two sets that differ in k hashes differ in k bits at most, so the bits in which they
    differ never exceed what the sets do.
    """
    odd = np.bincount((hashes >> np.uint64(54)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, *, width: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """``doc_id``, ``text_hash``, ``size`` (distinct shingles), ``fingerprint`` (SimHash), ``bands``
    and ``parity`` of whole texts; null counts as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, values, odd = [], [], [], []
            for x in batch.column(2):
                every = shingle_hashes(x.as_py(), width)
                found = np.unique(every)
                sizes.append(len(found))
                prints.append(majority(every))
                values.append(band_values(found, bands, rows))
                odd.append(parities(found))
            longs = pa.list_(pa.int64())
            made = [pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(values, longs), pa.array(odd, longs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "text_hash", "size", "fingerprint", "bands", "parity"])

    whole = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.cast("binary").alias("raw"))
    return given.mapInArrow(hashed, "doc_id long, text_hash long, size long, fingerprint long, bands array<long>, parity array<long>")


#: Texts whose hashes are broadcast at most, so that other texts stay where they are; beyond that all are dealt by hash.
MOST_SENT = 1 << 20


def shingle_sets(nodes: DataFrame, docs: DataFrame, *, width: int, text: str) -> DataFrame:
    """``node`` (text hash) and ``shingles`` (distinct hashes) of the texts of ``nodes``, each read once."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(x.as_py(), width)).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    whole = F.coalesce(F.col(text), F.lit(""))
    wanted = cut(nodes.select("node").distinct())
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.xxhash64(whole).alias("node"), whole.cast("binary").alias("raw")).join(wanted, "node", "left_semi")
    return cut(texts.groupBy("node").agg(F.first("raw")).mapInArrow(sets, "node long, shingles array<long>"))


def verified(pairs: DataFrame, docs: DataFrame, *, width: int, percent: int, text: str) -> DataFrame:
    """The pairs (``a``, ``b``: text hashes) whose shingle sets have the Jaccard similarity, in whole percent."""
    held = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), docs, width=width, text=text)
    met = pairs.join(held.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(held.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return met.filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether two sets of these sizes can have the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _near(percent: int) -> Column:
    """Whether ``parity`` and ``parity_b`` of sets of ``size`` and ``size_b`` leave room for the
    similarity: sets that have it differ in (100 - percent) / (100 + percent) of their sizes' sum at most."""
    bits = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    return _alike("size", "size_b", percent) & ((100 + percent) * bits <= (100 - percent) * (F.col("size") + F.col("size_b")))


def fingerprint_pairs(nodes: DataFrame, radius: int, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of texts whose SimHashes differ in at most ``radius`` bits: texts of
    one fingerprint meet its least text, and least texts of linked fingerprints meet."""
    least = F.min(F.struct("node", "size"))
    one = nodes.groupBy("fingerprint").agg(least.alias("least"))
    same = nodes.join(one, "fingerprint").filter(F.col("least.node") != F.col("node")).filter(_alike("least.size", "size", percent)).select(F.col("least.node").alias("a"), F.col("node").alias("b"))
    links = ball_links(one.select("fingerprint"), radius)
    ends = links.join(one.select(F.col("fingerprint").alias("a"), F.col("least").alias("x")), "a").join(one.select(F.col("fingerprint").alias("b"), F.col("least").alias("y")), "b")
    return same.unionByName(ends.filter(_alike("x.size", "y.size", percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def near_copies(docs: DataFrame, *, width: int = 5, percent: int = 80, radius: int = 2, bands: int = 24, rows: int = 5, turns: int = 1, pivots: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document: ``doc_id``, ``text_hash`` and ``component_id``, the least doc_id that links reach.

    Texts are linked when the Jaccard similarity of their shingle sets is ``percent`` or
    more, which is verified on the whole sets. Two kinds of candidates are compared: texts
    whose SimHashes over the same shingles differ in at most ``radius`` bits (ball
    hashing), and texts that share a MinHash band, as pairs at 0.8 are about ten bits
    apart: of them, 24 bands of 5 miss one in 14,000, of closer ones fewer.

    In a band all texts meet one of them, then, ``turns`` times, those not linked to it
    yet meet ``pivots`` others, drawn anew; so a large family is joined by a link a
    text, and few are left apart. Once the bands that are left have no more pairs of texts apart
    than there are rows, or the turns are over, all pairs within them that may be near are
    compared: those whose parities (1024 bits a text) differ in no more bits than near sets
    differ in shingles, which no near pair fails. Copies stand for one node. Null and blank texts have no shingles and are never
    near copies of other texts; equal texts always are. Repeated rows give repeated
    rows; other columns are ignored; an empty table gives an empty result.
    """
    given = cut(signatures(docs, width=width, bands=bands, rows=rows, key=key, text=text))
    nodes = cut(given.groupBy(F.col("text_hash").alias("node")).agg(F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("fingerprint").alias("fingerprint"), F.first("bands").alias("bands"), F.first("parity").alias("parity")))
    some = nodes.filter("size > 0")
    emitted = some.select("node", "size", F.explode("bands").alias("band"))
    shared = emitted.groupBy("band").agg(F.min(F.struct("node", "size")).alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = cut(emitted.join(shared, "band").select("band", "node", "size", "least"))
    banded = members.filter(F.col("least.node") != F.col("node")).filter(_alike("least.size", "size", percent)).select(F.col("least.node").alias("a"), F.col("node").alias("b"))

    def met(pairs: DataFrame) -> DataFrame:
        return cut(verified(pairs, docs, width=width, percent=percent, text=text))

    def fresh(pairs: DataFrame) -> DataFrame:
        """Pairs that were not compared yet, smaller node first."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return cut(ordered.join(tried, ["a", "b"], "left_anti"))

    tried = cut(banded.unionByName(fingerprint_pairs(some, radius, percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links, left = met(tried), members.select("band", "node", "size")
    few = left.count()
    for turn in range(turns + 1):
        placed = left.join(components(links), "node", "left").select("band", "node", "size", F.coalesce("root", "node").alias("root"))
        drawn = [F.struct(F.xxhash64("node", F.lit(turn * pivots + i)), F.col("node").alias("p"), F.col("size").alias("p_size"), F.col("root").alias("p_root")) for i in range(pivots)]
        by_root = placed.groupBy("band", "root").agg(F.count("*").alias("k"), *(F.min(x).alias(f"p{i}") for i, x in enumerate(drawn)))
        pairs_apart = (F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2
        met_by = F.array_distinct(F.transform(F.array(*(F.min(f"p{i}") for i in range(pivots))), lambda x: F.struct(x["p"], x["p_size"], x["p_root"])))
        split = by_root.groupBy("band").agg(F.count("*").alias("roots"), (pairs_apart / F.sum("k")).alias("a_row"), met_by.alias("pivots")).filter("roots > 1")
        left = cut(placed.join(split.select("band", "a_row", "pivots"), "band"))
        total = swept(left.agg(F.sum("a_row"))).collect()[0][0]
        if not total:
            break
        last = turn == turns or total <= few  # no more pairs than rows: no need to draw on
        if not last:
            pairs = left.select("node", "size", "root", F.inline("pivots")).filter("root <> p_root").filter(_alike("size", "p_size", percent)).select(F.col("p").alias("a"), F.col("node").alias("b"))
        else:
            apart = cut(left.select("band", "node", "size", "root").join(nodes.select("node", "parity"), "node"))
            other = apart.select("band", *(F.col(c).alias(f"{c}_b") for c in ("node", "size", "root", "parity")))
            pairs = apart.join(other, "band").filter("node < node_b AND root <> root_b").filter(_near(percent)).select(F.col("node").alias("a"), F.col("node_b").alias("b"))
        new = fresh(pairs)
        links = cut(links.unionByName(met(new)))
        if last:
            break
        tried, left = cut(tried.unionByName(new)), left.select("band", "node", "size")
    rooted = cut(nodes.select("node", "first").join(components(links), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return given.select("doc_id", "text_hash").join(rooted.join(least, "root").select(F.col("node").alias("text_hash"), "component_id"), "text_hash").select("doc_id", "text_hash", "component_id")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with one of each group of near copies left: that of the least id."""
    return kept_rows(docs, near_copies(docs, key=key, text=text, **options), key=key, text=text)
