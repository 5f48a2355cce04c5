"""The queries over the test tables: one thin query for each operator."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.ann import nearest
from tallyloom.llm.chat import format_trees, masked_text, parsed_turns, threads
from tallyloom.llm.licenses import scan_licenses
from tallyloom.llm.mixing import mix
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.quality import counts, judged
from tallyloom.llm.secrets import find_secrets, shown
from tallyloom.llm.sharding import shard
from tallyloom.llm.shared import cut, shared_dir
from tallyloom.llm.simhash import near_duplicates
from tallyloom.llm.spelling import corpus_words, spelling_variants
from tallyloom.llm.sql import SPELLING, licenses
from tallyloom.llm.tokenbin import read_tokens, write_tokens
from tallyloom.llm.toxicity import score_toxicity
from tallyloom.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards under the law ``key``.

    A null text has size 1 and the checksum of no bytes; a null doc_id is a key like any
    other; equal rows share a shard and take their slots in any order; very long texts are
    read whole for size and checksum only; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = shard(docs, ["doc_id"], 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with fingerprint and component.

    Null, empty and blank texts have fingerprint zero and are one component; equal rows
    each come back; ties of component_id cannot be, as the least doc_id is one; a null
    doc_id stays null and names a component only if no row there has one.
    """
    found = near_duplicates(_table(spark, sf_dir, "documents"), width=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op3_format_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back.

    A conversation is a tree without branches here. Null texts and roles are empty; rows
    of one turn come by role and text, equal rows are turns of their own; rows without
    conv_id are one conversation; empty tables leave conversation -7.
    """
    odd = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), odd.alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = format_trees(threads(rows))
    turns, loss = parsed_turns(F.col("formatted")), masked_text(F.col("formatted"), F.col("loss_spans"))
    read = done.select("tree", "formatted", turns.alias("turns"), loss.alias("loss"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.when(F.col("tree") != "n", F.substring("tree", 2, 40)).cast("long").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens.

    A null or empty text is its end id alone; equal rows are packed each; long texts are
    cut into pieces, of which each id lies in one; a null doc_id stays null; an empty
    table gives no rows.
    """
    docs = _table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), kind="byte", end_id=0, capacity=1024, grain=128, specials=True)


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of every hundredth vector; ties by vec_id. Vectors that take no part, repeated
    ids, equal vectors and empty tables are as ``nearest`` says."""
    return nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "id % 100 = 0", k=10)


def op6_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the spans of their secrets; null and empty texts have none, equal rows
    have the same, and offsets in very long texts are 64-bit."""
    found = find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "random")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("secrets")).alias("spans"))


def op7_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored, by a model of the labels that are not held out.

    Null and empty texts get the score of one empty sentence; equal texts score alike; a
    null doc_id is not held out; without documents there are no rows.
    """
    scored = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("offending").cast("long").alias("n_offending"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their counts and verdicts: texts are read once, and the fences and
    verdicts come from the table of counts."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judged(cut(counts(docs).drop("text"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of them.

    A null or empty text has size 0 and is not taken; a null source is one of its own,
    last; equal rows have their own places; an empty table gives no rows.
    """
    mixed = mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), limit=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in token files, read back.

    A null text is empty and has its end id; a null doc_id comes first; rows of one doc_id
    come by the hash of their text; a very long text is one document in one block; an
    empty table leaves files without blocks and no rows. The folder stays as long as the
    result is needed.
    """
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), kind="word", end_id=1, specials=True)
    return read_tokens(spark, path, ids=False)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of 7 code points and 2 occurrences or more, with their forms and roots.

    Null, empty and blank texts have no words; a null doc_id counts as empty text; repeated
    rows count each; of equally frequent near words the first in code-point order is the
    form; a very long run is one word; an empty table gives no rows.
    """
    return spelling_variants(corpus_words(_table(spark, sf_dir, "documents"), least=7, seen=2, every=31), ratio=10)


def op12_scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the phrases and notices of licenses in them.

    Null, empty and blank texts have no words, no labels and score 0; repeated rows come
    back each; equal texts score alike; a null doc_id stays null; very long texts are read
    whole; an empty table gives no rows.
    """
    return scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def op13_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the first 16 components of their distinct values' covariance.

    Vectors that are null or hold null or non-finite entries are dropped; zero vectors take
    part; equal vectors and repeated ids come back each; a null vec_id stays null; lengths
    are fitted apart; without vectors there are no rows.
    """
    return whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=16)


QUERIES = {f.__name__: f for f in (op1_shard_documents, op2_near_duplicates, op3_format_conversations, op4_pack_documents, op5_nearest_vectors, op6_find_secrets, op7_score_toxicity, op8_quality_rules, op9_mix_sources, op10_token_files, op11_spelling_variants, op12_scan_licenses, op13_whiten_embeddings)}
_CONVERSATIONS = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10)))
    + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

ORACLES: dict[str, str] = {"op3_format_conversations": _CONVERSATIONS, "op11_spelling_variants": SPELLING, "op12_scan_licenses": licenses()}
