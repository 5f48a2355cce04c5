"""Corpus operators: preparing, sharing one result among equal texts, profiling."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import WS_CHARS, is_blank, order_key, text_key, trim_ws
from tallyloom.operators.order import position

EMPTY_REASON = "empty text"


def reviews_of(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Records as the other operators know them: ``review_id``, ``review_text``, ``text_key`` and all other columns."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns({"review_id": F.col(id_column).cast("string"), "review_text": whole, "text_key": text_key(whole)}).drop(text)


def originals(reviews: DataFrame, seed: str) -> DataFrame:
    """(``text_key``, ``original``): of equal texts that are not blank, the first id in run order."""
    keyed = reviews.filter(~is_blank(F.col("review_text"))).select("text_key", "review_id", order_key(seed, F.col("review_id")).alias("k"))
    return keyed.groupBy("text_key").agg(F.min(F.struct("k", "review_id")).alias("m")).select("text_key", F.col("m.review_id").alias("original"))


def prepare(reviews: DataFrame, seed: str) -> DataFrame:
    """Adds ``status``, ``reason``, ``run_order`` and ``cache_source_id`` to each record.

    Blank texts are quarantined with a reason and are never copies; a copy points at the
    original of its text, an original at nothing. Originals come from partial minima by
    text, so a text with very many copies is no window of its own.
    """
    blank = is_blank(F.col("review_text"))
    marked = reviews.withColumns({"status": F.when(blank, "quarantined").otherwise("pending"), "reason": F.when(blank, EMPTY_REASON), "order_key": order_key(seed, F.col("review_id"))})
    ordered = position(marked, "order_key", ["review_id"], "run_order")
    found = ordered.join(originals(reviews, seed), "text_key", "left")
    return found.withColumn("cache_source_id", F.when((F.col("status") == "pending") & (F.col("original") != F.col("review_id")), F.col("original"))).drop("original")


def prepare_counts(reviews: DataFrame) -> DataFrame:
    """Records, empty ones, distinct texts and copies."""
    blank = is_blank(F.col("review_text"))
    row = reviews.agg(F.count("*").alias("records"), F.count_if(blank).alias("empty"), F.countDistinct(F.when(~blank, F.col("text_key"))).alias("distinct_texts"))
    return row.withColumn("copies", F.col("records") - F.col("empty") - F.col("distinct_texts"))


def text_volume(reviews: DataFrame) -> DataFrame:
    """UTF-8 bytes of texts that are not blank, over records and over distinct texts."""
    some = reviews.filter(~is_blank(F.col("review_text"))).select("text_key", F.octet_length("review_text").cast("long").alias("b"))
    per_text = some.groupBy("text_key").agg(F.count("*").alias("n"), F.min("b").alias("b"))
    return per_text.agg(F.sum("n").alias("records"), F.sum(F.col("n") * F.col("b")).alias("bytes"), F.count("*").alias("distinct_texts"), F.sum("b").alias("distinct_bytes"))


def folded_and_composed() -> Callable[[pa.Array], pa.Array]:
    """SHA-256 of the trimmed, case-folded text and of the composed one; only hashes are kept, a text at a time."""

    def hashes(texts: pa.Array) -> pa.Array:
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        made = ((None, None) if t is None else (sha(t.strip(WS_CHARS).casefold()), sha(unicodedata.normalize("NFC", t))) for t in (x.as_py() for x in texts))
        folded, composed = map(list, zip(*made, strict=True)) if len(texts) else ([], [])
        return pa.StructArray.from_arrays([pa.array(folded, pa.string()), pa.array(composed, pa.string())], ["casefold", "nfc"])

    return hashes


def dedup_variants(reviews: DataFrame) -> DataFrame:
    """How many distinct texts each normal form leaves: one scan, one hash a form.

    Spark has no case folding or composition, so texts beyond ASCII take these two from
    Arrow batches; of an ASCII text the one is lower case and the other the text itself.
    """
    text = F.col("review_text")
    ascii_only = F.octet_length(text) == F.char_length(text)
    read = reviews.select("review_text", ascii_only.alias("plain"), F.arrow_udf(folded_and_composed(), "casefold string, nfc string")(F.when(~ascii_only, text)).alias("u"))
    sha = lambda form: F.sha2(form, 256)
    lowered = F.lower(trim_ws(text))
    forms = {
        "casefold": F.when(F.col("plain"), sha(lowered)).otherwise(F.col("u.casefold")), "nfc": F.when(F.col("plain"), sha(text)).otherwise(F.col("u.nfc")), "exact": sha(text),
        "stripped": sha(trim_ws(text)), "lowered": sha(lowered), "collapsed": sha(F.regexp_replace(lowered, r"[ \t\r\n]+", " ")),
    }
    row = read.agg(*(F.countDistinct(v).alias(k) for k, v in forms.items()))
    return row.unpivot([], list(forms), "form", "distinct_texts")


def duplicate_groups(reviews: DataFrame, *extra: Column) -> DataFrame:
    """Texts that several records share: ``copies`` and whatever else is asked of the group."""
    return reviews.groupBy("text_key").agg(F.count("*").alias("copies"), F.min("review_id").alias("first_id"), *extra).filter("copies > 1")


def rows_digest(df: DataFrame, key: Column) -> DataFrame:
    """A digest of all rows in any order: their number and the sum of 60-bit prefixes of their hashes."""
    part = F.conv(F.substring(key, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("records"), F.sum(part).cast("string").alias("digest"))


def tree_digest(df: DataFrame, place: str, digest: str, width: int = 1024, levels: int = 4) -> DataFrame:
    """One digest of all rows in their order: ``records`` and ``digest``, null without rows.

    ``place`` numbers the rows from 0. SHA-256 of the joined hex digests of ``width``
    neighbours makes one of the level above, ``levels`` times (10^12 rows by default), so
    no task reads more than its own ranges and a change of any row, or of the order of any
    two that differ, changes the root. A null digest counts as an empty one.
    """
    tree = df.select(F.col(place).cast("long").alias("p"), F.coalesce(digest, F.lit("")).alias("d"), F.lit(1).cast("long").alias("n"))
    for _ in range(levels):
        nodes = tree.groupBy(F.floor(F.col("p") / width).alias("p")).agg(F.array_sort(F.collect_list(F.struct("p", "d"))).alias("m"), F.sum("n").alias("n"))
        tree = nodes.select("p", F.sha2(F.array_join("m.d", ""), 256).alias("d"), "n")
    return tree.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.min("d").alias("digest"))


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows that share a key, the first by ``order``: a partial minimum, so a key with many rows is no group in one task."""
    others = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.min(F.struct(order, *others)).alias("__m")).select(key, "__m.*")
