"""Provenance: one record followed through all tables, configurations compared, results reused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trace(records: DataFrame, members: DataFrame, ranking: DataFrame, calls: DataFrame, verified: DataFrame, claims: DataFrame, memos: DataFrame, review_id: str) -> DataFrame:
    """One row about one record: source and labels, the second labeler's, issue and rank, the issue's claims,
    the calls that name it or its original, and the memos that cite it.

    The id filters every table before anything is exploded or joined, so what is joined is a few rows. An unknown id gives no row.
    """
    is_it = F.col("review_id") == review_id
    one = records.filter(is_it).select("review_id", "source", "topic", "intent", "severity", F.coalesce("cache_source_id", "review_id").alias("__source"))
    second = verified.filter(is_it).select("review_id", F.col("topic").alias("verify_topic"), F.col("intent").alias("verify_intent"))
    issue = members.filter(is_it).join(F.broadcast(ranking.select("issue_id", "rank")), "issue_id", "left")
    said = claims.join(F.broadcast(issue.select("issue_id")), "issue_id").agg(F.sort_array(F.collect_list("claim_id")).alias("claims"))
    used = calls.join(F.broadcast(one.select("__source")), F.array_contains("review_ids", F.col("__source"))).agg(F.sort_array(F.collect_set("request_id")).alias("requests"))
    cited = memos.filter(F.contains("memo", F.lit(f"[review:{review_id}]"))).agg(F.sort_array(F.collect_list("memo_id")).alias("memos"))
    met = one.drop("__source").join(second, "review_id", "left").join(issue, "review_id", "left")
    return met.crossJoin(said).crossJoin(used).crossJoin(cited)


def config_label(*parts: Column) -> Column:
    """Model, prompt, schema and cut-off as one label."""
    return F.concat_ws("/", *parts)


def config_changes(before: Column, after: Column) -> Column:
    """Keys of two maps whose values differ, sorted."""
    keys = F.array_sort(F.array_distinct(F.concat(F.map_keys(before), F.map_keys(after))))
    return F.filter(keys, lambda k: ~F.element_at(before, k).eqNullSafe(F.element_at(after, k)))


def cached(wanted: DataFrame, artifacts: DataFrame, run: str, warm_from: str) -> DataFrame:
    """The stored answer of each key: the run's own, else that of the run it starts from."""
    usable = artifacts.filter(F.col("run").isin(run, warm_from))
    best = usable.groupBy("key").agg(F.min_by("output", F.when(F.col("run") == run, 0).otherwise(1)).alias("output"))
    return wanted.join(best, "key", "left")


def differing(a: DataFrame, b: DataFrame, key: str, *fields: str) -> DataFrame:
    """Keys that one table lacks or that differ in a field."""
    left = a.select(key, F.struct(*fields).alias("x"))
    right = b.select(key, F.struct(*fields).alias("y"))
    return left.join(right, key, "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select(key)


def tagged_union(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Ids of several tables with the sorted names of those that hold them."""
    marked = [df.select(key, F.lit(name).alias("tag")) for name, df in tables.items()]
    every = marked[0]
    for more in marked[1:]:
        every = every.unionByName(more)
    return every.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"))


def last_wins(tables: list[DataFrame], key: str, *fields: str) -> DataFrame:
    """Rows of several tables, a later table's row replacing an earlier one's of the same key."""
    numbered = [df.select(key, F.lit(i).alias("__i"), *fields) for i, df in enumerate(tables)]
    every = numbered[0]
    for more in numbered[1:]:
        every = every.unionByName(more)
    return every.groupBy(key).agg(F.max_by(F.struct(*fields), "__i").alias("r")).select(key, "r.*")
