"""The views that queries share, in Spark and in SQL: documents stand in for reviews, a hash for the labeler, events for calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.labels import INTENTS, TOPICS
from tallyloom.functions.text import hash_mod
from tallyloom.operators.corpus import originals, reviews_of

SEED, VERIFY_SEED = "run-v1", "verify-v1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_of(table(spark, sf_dir, "documents"))


def blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews, of which one in forty has a text of white space only."""
    found = reviews(spark, sf_dir)
    return found.withColumn("review_text", F.when(hash_mod("blank", F.col("review_id"), 40) == 0, " \t\u3000\n").otherwise(F.col("review_text")))


def hash_labels(keys: DataFrame, prefix: str = "") -> DataFrame:
    """Labels that hashes of ``text_key`` decide: a labeler for tests that any engine can repeat."""
    h = lambda salt, k: hash_mod(prefix + salt, F.col("text_key"), k)
    topic = F.element_at(F.array(*map(F.lit, TOPICS)), (h("topic", 8) + 1).cast("int"))
    at = h("intent", 100)
    intent = F.when(at < 40, "complaint").when(at < 45, "cancellation").when(at < 60, "request").when(at < 90, "praise").otherwise("unclear")
    labelled = keys.withColumns({"topic": topic, "intent": intent, "sentiment": h("tone", 401) / 200.0 - 1.0, "min_top": 0.5 + h("p", 50) / 100.0, "__s": h("sev", 5)})
    return labelled.withColumn("severity", F.when(F.col("intent").isin("complaint", "cancellation"), 1 + F.col("__s")).otherwise(1).cast("int")).drop("__s")


assert INTENTS == ("cancellation", "complaint", "request", "praise", "unclear")


def results(revs: DataFrame) -> DataFrame:
    """One label set for each distinct text."""
    return hash_labels(revs.select("text_key").distinct())


def second_results(revs: DataFrame) -> DataFrame:
    """Another labeler, which differs on three texts of ten."""
    keys = revs.select("text_key").distinct()
    first, other = hash_labels(keys), hash_labels(keys, "b_").select("text_key", *(F.col(c).alias(f"o_{c}") for c in ("topic", "intent", "severity", "sentiment", "min_top")))
    swap = hash_mod("v", F.col("text_key"), 10) < 3
    pick: dict[str, Column] = {c: F.when(swap, F.col(f"o_{c}")).otherwise(F.col(c)) for c in ("topic", "intent", "severity", "sentiment", "min_top")}
    return first.join(other, "text_key").select("text_key", *(v.alias(k) for k, v in pick.items()))


def records(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """Every record with its text's labels, fanned out to copies, and its original."""
    revs = reviews(spark, sf_dir)
    labelled = revs.join(second_results(revs) if second else results(revs), "text_key")
    found = labelled.join(originals(revs, SEED), "text_key", "left")
    quote = F.substring("review_text", 1, 12).substr(F.lit(1), 2 * F.col("severity"))
    return found.withColumns({"cache_source_id": F.when(F.col("original") != F.col("review_id"), F.col("original")), "evidence_quote": quote}).drop("original")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls of models."""
    e = table(spark, sf_dir, "events")
    ids = F.array((F.col("event_id") % 200).cast("string"), F.concat(F.lit("u"), "user_id"))
    role = F.element_at(F.array(*map(F.lit, ("enrich", "verify", "group", "memo"))), (hash_mod("role", F.col("event_id").cast("string"), 4) + 1).cast("int"))
    kind = hash_mod("outcome", F.col("event_id").cast("string"), 10)
    known = kind < 9
    return e.select(
        F.col("event_id").alias("request_id"), "ts", "user_id", "event_type", F.to_date("ts").alias("session"), role.alias("role"),
        F.when(kind < 8, "succeeded").when(kind < 9, "failed").otherwise("pending").alias("outcome"), F.when(known, F.col("event_id") % 1000).alias("input_tokens"),
        F.when(known, F.col("event_id") % 300).alias("output_tokens"), (F.col("event_id") % 1000 + 50).alias("reserved_tokens"), F.col("value").alias("seconds"), ids.alias("review_ids"),
    )


def h(salt: str, key: str, k: int) -> str:
    """``hash_mod`` in SQL."""
    return f"(CAST('0x' || substr(sha256('{salt}:' || {key}), 1, 8) AS BIGINT) % {k})"


def labels_sql(prefix: str = "") -> str:
    topics = "[" + ", ".join(f"'{t}'" for t in TOPICS) + "]"
    s = lambda salt, k: h(prefix + salt, "text_key", k)
    intent = f"CASE WHEN {s('intent', 100)} < 40 THEN 'complaint' WHEN {s('intent', 100)} < 45 THEN 'cancellation' WHEN {s('intent', 100)} < 60 THEN 'request' WHEN {s('intent', 100)} < 90 THEN 'praise' ELSE 'unclear' END"
    severity = f"CAST(CASE WHEN {s('intent', 100)} < 45 THEN 1 + {s('sev', 5)} ELSE 1 END AS INTEGER)"
    return f"SELECT text_key, {topics}[{s('topic', 8)} + 1] AS topic, {intent} AS intent, {severity} AS severity, CAST({s('tone', 401)} AS DOUBLE) / 200 - 1 AS sentiment, CAST(0.5 AS DOUBLE) + CAST({s('p', 50)} AS DOUBLE) / 100 AS min_top FROM (SELECT DISTINCT text_key FROM rev)"


REV = "rev AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS review_id, coalesce(text, '') AS review_text, sha256(coalesce(text, '')) AS text_key, lang, source, n_chars FROM documents)"
RES = f"res AS ({labels_sql()})"
RES_B = f"res_b AS ({labels_sql('b_')})"
RES2 = f"res2 AS (SELECT a.text_key, CASE WHEN {h('v', 'a.text_key', 10)} < 3 THEN b.topic ELSE a.topic END AS topic, CASE WHEN {h('v', 'a.text_key', 10)} < 3 THEN b.intent ELSE a.intent END AS intent, CASE WHEN {h('v', 'a.text_key', 10)} < 3 THEN b.severity ELSE a.severity END AS severity FROM res a JOIN res_b b USING (text_key))"
ORIG = f"orig AS (SELECT text_key, arg_min(review_id, sha256('{SEED}:' || review_id)) AS original FROM rev WHERE trim(review_text, ' ' || chr(9) || chr(10) || chr(13)) <> '' GROUP BY text_key)"
REC = "rec AS (SELECT rev.*, res.topic, res.intent, res.severity, res.sentiment, res.min_top, CASE WHEN original <> review_id THEN original END AS cache_source_id FROM rev JOIN res USING (text_key) LEFT JOIN orig USING (text_key))"
REC2 = "rec2 AS (SELECT rev.review_id, res2.topic, res2.intent, res2.severity FROM rev JOIN res2 USING (text_key))"
PAIRS = "p AS (SELECT review_id, a.min_top, a.topic AS a_topic, b.topic AS b_topic, a.intent AS a_intent, b.intent AS b_intent, a.severity AS a_severity, b.severity AS b_severity FROM rec a JOIN rec2 b USING (review_id))"
MEMBER = "m AS (SELECT 'IS-' || topic AS issue_id, review_id FROM rec WHERE intent IN ('complaint', 'cancellation'))"
RANKING = "t AS (SELECT issue_id, count(*) AS complaint_count, CAST(sum(severity) AS BIGINT) AS severity_sum FROM m JOIN rec USING (review_id) GROUP BY issue_id), ranking AS (SELECT row_number() OVER (ORDER BY severity_sum DESC, issue_id) AS rank, issue_id, complaint_count, severity_sum, (2 * severity_sum * 1000000 + complaint_count) // (2 * complaint_count) AS micro FROM t)"
CALLS = f"calls AS (SELECT event_id AS request_id, ts, user_id, event_type, CAST(ts AS DATE) AS session, ['enrich', 'verify', 'group', 'memo'][{h('role', 'CAST(event_id AS VARCHAR)', 4)} + 1] AS role, CASE WHEN {h('outcome', 'CAST(event_id AS VARCHAR)', 10)} < 8 THEN 'succeeded' WHEN {h('outcome', 'CAST(event_id AS VARCHAR)', 10)} < 9 THEN 'failed' ELSE 'pending' END AS outcome, CASE WHEN {h('outcome', 'CAST(event_id AS VARCHAR)', 10)} < 9 THEN event_id % 1000 END AS input_tokens, CASE WHEN {h('outcome', 'CAST(event_id AS VARCHAR)', 10)} < 9 THEN event_id % 300 END AS output_tokens, event_id % 1000 + 50 AS reserved_tokens, value AS seconds, [CAST(event_id % 200 AS VARCHAR), 'u' || CAST(user_id AS VARCHAR)] AS review_ids FROM events)"
MEAN = "CAST(micro // 1000000 AS VARCHAR) || '.' || lpad(CAST(micro % 1000000 AS VARCHAR), 6, '0')"

BASE = (REV, RES, ORIG, REC)
TWO = (REV, RES, RES_B, RES2, ORIG, REC, REC2, PAIRS)
RANKED = (*BASE, MEMBER, RANKING)


def sql(parts: tuple[str, ...], select: str) -> str:
    """A query over shared views."""
    return f"WITH {', '.join(parts)} {select}"


#: Pieces of texts (``p``) in SQL, for texts whose white space is plain.
SPLIT_SQL = r"list_transform(string_split_regex(regexp_replace(regexp_replace(review_text, '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), '[\r\n]+', chr(1), 'g'), chr(1)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13)))"
PIECES_SQL = rf"pc AS (SELECT review_id, review_text, lang, CASE WHEN len(l) = 0 THEN [trim(review_text, ' ' || chr(9) || chr(10) || chr(13))] ELSE l END AS p FROM (SELECT *, list_filter({SPLIT_SQL}, lambda x: regexp_matches(x, '[\pL\pN]')) AS l FROM rev))"

BLANKED = f"rev AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, CASE WHEN {h('blank', 'CAST(doc_id AS VARCHAR)', 40)} = 0 THEN ' ' ELSE coalesce(text, '') END AS review_text FROM documents)"
