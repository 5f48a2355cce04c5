"""The corpus pipeline: five stages over the table of documents, each on what the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.mixing import mixed_documents
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.quality import counts, judged
from tallyloom.llm.secrets import redact
from tallyloom.llm.shingles import keep_one
from tallyloom.session import drop_folder, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts go; equal rows share a verdict; a null language or source
    is a group of its own; other columns are dropped; an empty table stays empty.
    """
    return judged(counts(docs.select(*COLUMNS))).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % or more of their 5-word shingles.

    It is that of the least doc_id, a null one last, and of equal rows one. Null and blank
    texts without shingles are copies of each other only where they are equal.
    """
    return keep_one(docs.select(*COLUMNS), width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark.

    Null texts stay null, and ``n_chars`` counts the text as it is now; no row is lost.
    """
    clean = redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in the order of the mix.

    Texts without words are not taken; equal rows are one, as often as they are taken
    together; a null source is one of its own.
    """
    return mixed_documents(docs.select(*COLUMNS), weights=(5, 2, 1), limit=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    A document that the mix takes several times is packed each time; a null or empty text
    is its end id alone; an empty table gives no pieces.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), kind="byte", end_id=0, capacity=1024, grain=128, specials=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Fingerprints, quantile sketches and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; what a stage read is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    last = ""
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs, before = spark.read.parquet(f"{folder}/{name}"), last
        if before:
            drop_folder(spark, before)
        last = f"{folder}/{name}"
    return docs
