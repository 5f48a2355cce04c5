"""Labelers, and labelling each distinct text once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.labels import INTENT_RULES, NO_PROBLEM, TOPIC_RULES
from tallyloom.functions.text import first_match, pieces, text_key


class Labeler(Protocol):
    """Whatever adds label columns to a table of ``text_key`` and ``review_text``."""

    def label(self, texts: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class RuleLabeler:
    """Keyword rules, the first match wins; severity 3 and a negative tone for problems."""

    intents: Sequence[tuple[str, Sequence[str]]] = INTENT_RULES
    topics: Sequence[tuple[str, Sequence[str]]] = TOPIC_RULES

    def label(self, texts: DataFrame) -> DataFrame:
        text = F.col("review_text")
        labelled = texts.withColumns({"topic": first_match(text, self.topics, "other"), "intent": first_match(text, self.intents, "unclear")})
        calm = F.col("intent").isin(*NO_PROBLEM)
        return labelled.withColumns({"severity": F.when(calm, 1).otherwise(3), "sentiment": F.when(F.col("intent") == "praise", 0.5).when(calm, 0.0).otherwise(-0.5)})


@dataclass(frozen=True)
class ReplayLabeler:
    """Saved answers by ``text_key`` (``topic``, ``intent``); another labeler where there is none."""

    saved: DataFrame
    fallback: Labeler

    def label(self, texts: DataFrame) -> DataFrame:
        kept = self.saved.select("text_key", F.col("topic").alias("__topic"), F.col("intent").alias("__intent"), F.lit(True).alias("__saved"))
        met = self.fallback.label(texts).join(kept, "text_key", "left")
        replayed = F.coalesce("__saved", F.lit(False))
        chosen = {name: F.when(replayed, F.col(f"__{name}")).otherwise(F.col(name)) for name in ("topic", "intent")}
        return met.withColumns(chosen | {"replayed": replayed}).drop("__topic", "__intent", "__saved")


@dataclass(frozen=True)
class PandasLabeler:
    """A callable from texts to label columns, such as a model's client, run on batches inside tasks."""

    call: Callable[[pd.Series], pd.DataFrame]
    schema: str

    def label(self, texts: DataFrame) -> DataFrame:
        call = self.call

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.concat([batch[["text_key"]].reset_index(drop=True), call(batch["review_text"]).reset_index(drop=True)], axis=1)

        return texts.select("text_key", "review_text").mapInPandas(run, f"text_key string, {self.schema}")


def label_corpus(reviews: DataFrame, labeler: Labeler) -> DataFrame:
    """Labels each distinct text once and puts the labels on all its copies.

    Texts are grouped by key before the labeler sees them, so copies cost a join.
    """
    texts = reviews.groupBy("text_key").agg(F.min("review_text").alias("review_text"))
    labels = labeler.label(texts).drop("review_text")
    return reviews.join(labels, "text_key")


def degenerate(results: DataFrame, *, cutoff: float, least: int) -> DataFrame:
    """One row about all labels: texts, the commonest topic's, flagged ones, and the names of failed guards.

    With ``least`` texts or more, a topic of over 95 of 100 texts, flags everywhere and
    flags nowhere are failures. Topics are counted first, so one pass makes the row.
    """
    by_topic = results.groupBy("topic").agg(F.count("*").alias("n"), F.count_if(F.col("min_top") < cutoff).alias("flagged"))
    row = by_topic.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("texts"), F.coalesce(F.max("n"), F.lit(0)).alias("top_topic"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged"))
    enough = F.col("texts") >= least
    checks = {"one_topic": F.col("top_topic") * 100 > F.col("texts") * 95, "all_flagged": F.col("flagged") == F.col("texts"), "none_flagged": F.col("flagged") == 0}
    return row.withColumn("failed", F.concat_ws(",", *(F.when(enough & bad, name) for name, bad in checks.items())))


def propagate(reviews: DataFrame, done: DataFrame) -> DataFrame:
    """``status`` of every record: completed where some record of its text is in ``done``."""
    keys = done.select("text_key", F.lit("completed").alias("status")).distinct()
    return reviews.join(keys, "text_key", "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def sentence_rollup(reviews: DataFrame, label: Callable[[DataFrame], DataFrame], precedence: Sequence[str]) -> DataFrame:
    """Labels each record's sentences and rolls them up.

    The record gets the intent that comes first in ``precedence``, the greatest severity, and
    the topic of the first sentence with that severity whose topic is specific (not
    ``other``), or of the first one if none is. Equal sentences
    are labelled once; partial aggregates roll up, so a record's sentences are not
    gathered.
    """
    cut = reviews.select("review_id", F.posexplode(pieces(F.col("review_text"))).alias("at", "sentence")).withColumn("text_key", text_key(F.col("sentence")))
    labels = label(cut.select("text_key").distinct())
    order: Column = F.array_position(F.array(*map(F.lit, precedence)), F.col("intent"))
    rolled = cut.join(labels, "text_key").groupBy("review_id").agg(
        F.min(order).alias("first"), F.max("severity").alias("severity"), F.min_by("topic", F.struct((-F.col("severity")).alias("s"), (F.col("topic") == "other").alias("vague"), "at")).alias("topic"), F.count("*").alias("sentences")
    )
    return rolled.select("review_id", F.element_at(F.array(*map(F.lit, precedence)), F.col("first").cast("int")).alias("intent"), "severity", "topic", "sentences")


def label_sanity(cells: DataFrame, *, most: int = 90, least: int = 3) -> DataFrame:
    """By field (``field``, ``label``): classes, rows of the commonest, and whether it has over ``most`` of a hundred
    or there are under ``least`` classes."""
    counts = cells.groupBy("field", "label").agg(F.count("*").alias("n"))
    row = counts.groupBy("field").agg(F.count("*").alias("classes"), F.max("n").alias("top"), F.sum("n").alias("n"))
    return row.withColumns({"one_label": F.col("top") * 100 > most * F.col("n"), "few_classes": F.col("classes") < least})
