"""Audit queries over an export that is broken on purpose, set operations, provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.labels import INTENTS, TOPICS
from tallyloom.functions.text import hash_mod
from tallyloom.operators import agreement, audit, corpus, ranking, trace
from tallyloom.plans.base import BASE, CALLS, MEMBER, RANKED, RES2, RES_B, REV, calls, h, records, reviews, sql, table
from tallyloom.plans.label_queries import RANK_COLUMNS, ranked, with_issues
from tallyloom.plans.registry import query

ROLES, OUTCOMES = ("enrich", "verify", "group", "memo"), ("succeeded", "failed")
MUT = h("mut", "review_id", 40)
IN = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"
#: The export: records, of which some are broken, each in one way. Two of forty sources are blank.
BLANK = "trim({x}, ' ' || chr(9) || chr(10) || chr(13)) = ''"
EXPORT = f"""src AS (SELECT review_id, sha256(review_text || ':' || coalesce(lang, '')) AS true_sha, CASE WHEN {MUT} IN (9, 10) THEN ' ' ELSE review_text END AS review_text FROM rev),
  ex0 AS (SELECT rec.*, sha256(review_text || ':' || coalesce(lang, '')) AS sha, {MUT} AS mut FROM rec),
  ex1 AS (SELECT CASE WHEN mut = 8 THEN 'x' || review_id ELSE review_id END AS review_id, text_key, CASE WHEN mut = 0 THEN 'x' ELSE sha END AS source_sha256, CASE WHEN mut = 3 THEN 'odd' WHEN mut IN (6, 9, 10) THEN 'quarantined' ELSE 'completed' END AS status,
    CASE mut WHEN 6 THEN ' ' WHEN 9 THEN 'odd reason' WHEN 10 THEN 'empty text' END AS reason, topic, intent, CASE WHEN mut = 1 THEN 9 ELSE severity END AS severity, sentiment, CASE WHEN mut = 2 THEN review_text || '!' WHEN mut IN (9, 10) THEN ' ' ELSE review_text END AS evidence_quote,
    CASE WHEN mut = 7 THEN 'nobody' WHEN mut NOT IN (9, 10) THEN cache_source_id END AS cache_source_id, mut FROM ex0 WHERE mut <> 4),
  ex AS (SELECT * EXCLUDE (mut) FROM ex1 UNION ALL SELECT * EXCLUDE (mut) FROM ex1 WHERE mut = 5),
  met0 AS (SELECT ex.*, true_sha, src.review_text, o.review_id IS NOT NULL AS o_there, o.cache_source_id AS o_c, o.text_key AS o_k, o.topic AS o_t, o.intent AS o_i, o.severity AS o_s, o.sentiment AS o_m, o.evidence_quote AS o_q
    FROM ex LEFT JOIN src USING (review_id) LEFT JOIN (SELECT DISTINCT * FROM ex) o ON ex.cache_source_id = o.review_id),
  met AS (SELECT *, true_sha IS NOT NULL AS known, coalesce(source_sha256 = true_sha, false) AS same, trim(coalesce(reason, '')) = '' AS no_reason, {BLANK.format(x="coalesce(review_text, '')")} AS blank,
    topic IN {IN(TOPICS)} AND intent IN {IN(INTENTS)} AND severity BETWEEN 1 AND 5 AND sentiment BETWEEN -1 AND 1 AND NOT ({BLANK.format(x='evidence_quote')}) AS fine, coalesce(contains(review_text, evidence_quote), false) AS exact,
    cache_source_id IS NOT NULL AND (NOT o_there OR o_c IS NOT NULL OR text_key IS DISTINCT FROM o_k OR topic IS DISTINCT FROM o_t OR intent IS DISTINCT FROM o_i OR severity IS DISTINCT FROM o_s OR sentiment IS DISTINCT FROM o_m OR evidence_quote IS DISTINCT FROM o_q) AS bad_reuse FROM met0)"""
RULES = {
    "unknown_review_id": "NOT known", "source_mismatch": "known AND NOT same", "quarantine_without_reason": "known AND same AND status = 'quarantined' AND no_reason",
    "incorrect_empty_reason": "known AND same AND status = 'quarantined' AND NOT no_reason AND blank AND reason <> 'empty text'", "invalid_status": "known AND same AND status NOT IN ('completed', 'quarantined')",
    "invalid_schema": "known AND same AND status = 'completed' AND NOT fine", "unsupported_quote": "known AND same AND status = 'completed' AND fine AND NOT exact", "invalid_cache_reuse": "bad_reuse",
}
VALID = f"""st AS (SELECT review_id, count(*) AS rows_, max(CASE WHEN NOT ({" OR ".join(f"({c})" for c in RULES.values())}) THEN status END) AS s, max(cache_source_id) IS NOT NULL AS cached FROM met WHERE known GROUP BY review_id),
  ok AS (SELECT review_id, rows_, CASE WHEN rows_ = 1 THEN s END AS state, cached FROM st)"""
VIOLATIONS = f"""{VALID}, v AS (
  {" UNION ALL ".join(f"SELECT '{code}' AS code, review_id AS detail FROM met WHERE {c}" for code, c in RULES.items())}
  UNION ALL SELECT 'duplicate_review_id', review_id FROM ex GROUP BY review_id HAVING count(*) > 1
  UNION ALL SELECT 'missing_records', review_id FROM src WHERE review_id NOT IN (SELECT review_id FROM ex)
  UNION ALL SELECT 'unfinished_classification', review_id FROM src WHERE NOT ({BLANK.format(x='review_text')}) AND review_id NOT IN (SELECT review_id FROM ok WHERE state = 'completed'))"""


def source_rows(spark: SparkSession, d: str) -> DataFrame:
    sha = F.sha2(F.concat("review_text", F.lit(":"), F.coalesce("lang", F.lit(""))), 256)
    blank = hash_mod("mut", F.col("review_id"), 40).isin(9, 10)
    return reviews(spark, d).select("review_id", sha.alias("source_sha256"), F.when(blank, " ").otherwise(F.col("review_text")).alias("review_text"))


def export_rows(spark: SparkSession, d: str) -> DataFrame:
    """Records as exported; every fortieth hash breaks one thing."""
    mut = F.col("mut")
    sha = F.sha2(F.concat("review_text", F.lit(":"), F.coalesce("lang", F.lit(""))), 256)
    kept = records(spark, d).withColumn("mut", hash_mod("mut", F.col("review_id"), 40)).filter("mut <> 4")
    blank = mut.isin(9, 10)
    broken: dict[str, Column] = {
        "review_id": F.when(mut == 8, F.concat(F.lit("x"), "review_id")).otherwise(F.col("review_id")), "source_sha256": F.when(mut == 0, "x").otherwise(sha),
        "status": F.when(mut == 3, "odd").when(blank | (mut == 6), "quarantined").otherwise("completed"), "reason": F.when(mut == 6, " ").when(mut == 9, "odd reason").when(mut == 10, "empty text"),
        "severity": F.when(mut == 1, 9).otherwise(F.col("severity")), "evidence_quote": F.when(mut == 2, F.concat("review_text", F.lit("!"))).when(blank, " ").otherwise(F.col("review_text")),
        "cache_source_id": F.when(mut == 7, "nobody").when(~blank, F.col("cache_source_id")),
    }
    out = kept.select("mut", *(broken.get(c, F.col(c)).alias(c) for c in ("review_id", "text_key", "source_sha256", "status", "reason", "topic", "intent", "severity", "sentiment", "evidence_quote", "cache_source_id")))
    return out.unionByName(out.filter("mut = 5")).drop("mut")


@query(sql((*BASE, EXPORT, VIOLATIONS), "SELECT code, detail FROM v"))
def audit_records(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with the exported records, a row a violation."""
    return audit.record_violations(export_rows(spark, d), source_rows(spark, d))


SHOWN = "l AS (SELECT code, detail, count(*) AS n, row_number() OVER (PARTITION BY code ORDER BY detail) AS place FROM v GROUP BY code, detail)"


@query(sql((*BASE, EXPORT, VIOLATIONS, SHOWN), "SELECT code, CAST(sum(n) AS BIGINT) AS n, string_agg(detail, ',' ORDER BY detail) FILTER (place <= 10) AS examples FROM l GROUP BY code"))
def audit_flags(spark: SparkSession, d: str) -> DataFrame:
    return audit.flags(audit_records(spark, d))


@query(sql((*BASE, EXPORT), "SELECT review_id FROM met WHERE bad_reuse"))
def cache_reuse_audit(spark: SparkSession, d: str) -> DataFrame:
    found = audit.record_violations(export_rows(spark, d), source_rows(spark, d))
    return found.filter("code = 'invalid_cache_reuse'").select(F.col("detail").alias("review_id"))


@query(sql((*BASE, EXPORT), "SELECT review_id, topic FROM (SELECT *, count(*) OVER (PARTITION BY review_id) AS n FROM ex) WHERE n = 1"))
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    """Records whose id comes once: a repeated id invalidates all its rows."""
    return audit.once(export_rows(spark, d), "review_id").select("review_id", "topic")


@query(sql((*BASE, EXPORT), "SELECT review_id FROM rev EXCEPT SELECT review_id FROM ex"))
def missing_records(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id").exceptAll(export_rows(spark, d).select("review_id").distinct()).distinct()


COVER = f"""c AS (SELECT count(*) AS expected, count(rows_) AS unique_ids, count(*) FILTER (rows_ > 1) AS duplicate_ids, count(*) FILTER (state = 'completed') AS completed, count(*) FILTER (state = 'quarantined') AS quarantined,
    count(*) FILTER (NOT blank) AS labelable, count(*) FILTER (state = 'completed' AND cached) AS cache_reuses, count(*) FILTER (state = 'completed' AND NOT blank) AS labelled, (SELECT count(*) FROM ex) AS received
    FROM (SELECT review_id, {BLANK.format(x='review_text')} AS blank FROM src) LEFT JOIN ok USING (review_id))"""


@query(sql((*BASE, EXPORT, VALID, COVER), """SELECT *, expected - unique_ids AS missing, unique_ids - completed - quarantined AS unresolved, completed + quarantined AS accounted, round(labelled / CAST(labelable AS DOUBLE), 6) AS labelable_fraction,
  round((completed + quarantined) / CAST(expected AS DOUBLE), 6) AS accounted_fraction, round(completed / CAST(expected AS DOUBLE), 6) AS completed_fraction,
  round(CAST(0.2 AS DOUBLE) * (unique_ids = expected)::INT + CAST(0.2 AS DOUBLE) * ((completed + quarantined) / CAST(expected AS DOUBLE)) + CAST(0.6 AS DOUBLE) * (labelled / CAST(labelable AS DOUBLE)), 4) AS points FROM c"""))
def coverage(spark: SparkSession, d: str) -> DataFrame:
    """How much of the source the export covers."""
    return audit.coverage(export_rows(spark, d), source_rows(spark, d))


MEMBERS = f"""bad AS (SELECT issue_id, review_id FROM m WHERE {h('gone', 'review_id', 30)} > 0 UNION ALL SELECT issue_id, review_id FROM m WHERE {h('twice', 'review_id', 30)} = 0 AND {h('gone', 'review_id', 30)} > 0
    UNION ALL SELECT 'IS-other', review_id FROM rec WHERE intent = 'praise' AND {h('praise', 'review_id', 30)} = 0 UNION ALL SELECT 'IS-none', 'x' || review_id FROM m WHERE {h('x', 'review_id', 50)} = 0
    UNION ALL SELECT 'IS-more', review_id FROM m WHERE {h('more', 'review_id', 40)} = 0),
  w AS (SELECT 'invalid_membership' AS code, review_id AS detail FROM bad WHERE review_id NOT IN (SELECT review_id FROM rec)
    UNION ALL SELECT 'duplicate_membership', review_id FROM bad GROUP BY issue_id, review_id HAVING count(*) > 1
    UNION ALL SELECT 'noncomplaint_in_ranking', review_id FROM bad JOIN rec USING (review_id) WHERE intent NOT IN ('complaint', 'cancellation')
    UNION ALL SELECT 'ungrouped_complaints', review_id FROM rec WHERE intent IN ('complaint', 'cancellation') AND review_id NOT IN (SELECT review_id FROM bad)
    UNION ALL SELECT 'undeclared_multi_issue', review_id FROM bad GROUP BY review_id HAVING count(DISTINCT issue_id) > 1)"""


@query(sql((*BASE, MEMBER, MEMBERS), "SELECT code, detail FROM w"))
def bad_membership(spark: SparkSession, d: str) -> DataFrame:
    """Members that are left out, doubled, unknown, no complaints, or in two issues."""
    found, m = with_issues(spark, d)
    chance = lambda salt, k: hash_mod(salt, F.col("review_id"), k)
    kept = m.filter(chance("gone", 30) > 0)
    parts = [kept, kept.filter(chance("twice", 30) == 0), found.filter("intent = 'praise'").filter(chance("praise", 30) == 0).select(F.lit("IS-other").alias("issue_id"), "review_id")]
    parts += [m.filter(chance("x", 50) == 0).select(F.lit("IS-none").alias("issue_id"), F.concat(F.lit("x"), "review_id").alias("review_id")), m.filter(chance("more", 40) == 0).select(F.lit("IS-more").alias("issue_id"), "review_id")]
    return audit.membership_violations(reduce(DataFrame.unionByName, parts), found.withColumn("status", F.lit("completed")))


@query(sql(RANKED, "SELECT 'ranking_mismatch' AS code, issue_id AS detail FROM ranking WHERE rank % 3 = 0 UNION ALL SELECT 'ranking_missing', issue_id FROM ranking WHERE rank % 3 = 0 OR rank = 2 UNION ALL SELECT 'ranking_length', 'expected ' || CAST(count(*) AS VARCHAR) || ', received ' || CAST(count(*) FILTER (rank <> 2) AS VARCHAR) FROM ranking HAVING count(*) FILTER (rank = 2) > 0"))
def ranking_audit(spark: SparkSession, d: str) -> DataFrame:
    """A ranking with a mean changed in every third place and the second left out against the recount."""
    true = ranked(spark, d)
    changed = true.withColumn("mean_severity", F.when(F.col("rank") % 3 == 0, "0.000001").otherwise(F.col("mean_severity")))
    return audit.ranking_violations(changed.filter("rank <> 2"), true)


CLAIMED = f"c AS (SELECT 'CL-' || lpad(CAST((rank - 1) * 4 + k + 1 AS VARCHAR), 3, '0') AS claim_id, (rank - 1) * 4 + k + 1 AS n FROM (SELECT {RANK_COLUMNS} FROM ranking), (SELECT unnest([0, 1, 2, 3]) AS k))"


@query(sql((*RANKED, CLAIMED), "SELECT 'invalid_claim_id' AS code, 'no-' || claim_id AS detail FROM c WHERE n % 5 = 0 UNION ALL SELECT 'claim_mismatch', claim_id FROM c WHERE n % 7 = 0 AND n % 5 <> 0 UNION ALL SELECT 'claim_mismatch', 'no-' || claim_id FROM c WHERE n % 35 = 0"))
def claim_audit(spark: SparkSession, d: str) -> DataFrame:
    """Claims with a wrong name or value against the ranking's cells."""
    true = ranking.claims(ranked(spark, d))
    n = F.substring("claim_id", 4, 20).cast("int")
    said = true.withColumns({"value": F.when(n % 7 == 0, "?").otherwise(F.col("value")), "claim_id": F.when(n % 5 == 0, F.concat(F.lit("no-"), "claim_id")).otherwise(F.col("claim_id"))})
    return audit.claim_violations(said, true)


SNAP = f"""before_ AS (SELECT review_id FROM rev WHERE {h('half', 'review_id', 2)} = 0 UNION ALL SELECT review_id FROM rev WHERE {h('again', 'review_id', 40)} = 0 AND {h('half', 'review_id', 2)} = 0),
  after_ AS (SELECT review_id FROM rev WHERE {h('after', 'review_id', 20)} > 0 UNION ALL SELECT 'x' || review_id FROM rev WHERE {h('after', 'review_id', 50)} = 1)"""


@query(sql((REV, SNAP), "SELECT 'duplicate_checkpoint_id' AS code, review_id AS detail FROM before_ GROUP BY review_id HAVING count(*) > 1 UNION ALL SELECT 'resume_snapshot_mismatch', review_id FROM before_ WHERE review_id NOT IN (SELECT review_id FROM after_) UNION ALL SELECT 'resume_snapshot_mismatch', review_id FROM after_ WHERE review_id NOT IN (SELECT review_id FROM rev)"))
def checkpoint_audit(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of finished ids before and after a resume."""
    ids = reviews(spark, d).select("review_id")
    chance = lambda salt, k: hash_mod(salt, F.col("review_id"), k)
    half = ids.filter(chance("half", 2) == 0)
    before = half.unionByName(half.filter(chance("again", 40) == 0))
    after = ids.filter(chance("after", 20) > 0).unionByName(ids.filter(chance("after", 50) == 1).select(F.concat(F.lit("x"), "review_id").alias("review_id")))
    return audit.checkpoint_violations(before, after, ids)


@query(sql((REV,), f"SELECT review_id FROM rev WHERE {h('half', 'review_id', 2)} = 0 INTERSECT SELECT review_id FROM rev WHERE {h('after', 'review_id', 20)} = 0"))
def reprocessed(spark: SparkSession, d: str) -> DataFrame:
    """Finished ids that came up again."""
    ids = reviews(spark, d).select("review_id")
    return ids.filter(hash_mod("half", F.col("review_id"), 2) == 0).intersect(ids.filter(hash_mod("after", F.col("review_id"), 20) == 0))


LOGGED = """g AS (SELECT CASE WHEN request_id % 211 = 0 THEN '' WHEN request_id % 199 = 0 THEN '1' ELSE CAST(request_id AS VARCHAR) END AS request_id, CASE WHEN request_id % 97 = 0 THEN 'cook' ELSE role END AS role, outcome, input_tokens IS NOT NULL AS usage_known,
    CASE WHEN request_id % 89 = 0 THEN -1 ELSE input_tokens END AS input_tokens, CASE WHEN request_id % 53 = 0 THEN [CAST(user_id AS VARCHAR), 'a', 'b', 'c'] ELSE [CAST(user_id AS VARCHAR)] END AS review_ids FROM calls),
  x AS (SELECT request_id, unnest(review_ids) AS review_id FROM g)"""


@query(sql((REV, CALLS, LOGGED), """SELECT 'invalid_request_id' AS code, request_id AS detail FROM g WHERE trim(request_id) = '' UNION ALL SELECT 'invalid_request_id', request_id FROM g GROUP BY request_id HAVING count(*) > 1
  UNION ALL SELECT 'invalid_call_role', request_id FROM g WHERE role NOT IN ('enrich', 'verify', 'group', 'memo') UNION ALL SELECT 'invalid_call_outcome', request_id FROM g WHERE outcome NOT IN ('succeeded', 'failed')
  UNION ALL SELECT 'invalid_call_ids', request_id FROM x WHERE review_id NOT IN (SELECT review_id FROM rev) UNION ALL SELECT 'invalid_usage', request_id FROM g WHERE usage_known AND (input_tokens IS NULL OR input_tokens < 0)
  UNION ALL SELECT 'unbounded_batch', request_id FROM g WHERE len(review_ids) > 3"""))
def call_audit(spark: SparkSession, d: str) -> DataFrame:
    """Logged calls against their form and the records that they name."""
    r, user = F.col("request_id"), F.col("user_id").cast("string")
    logged = calls(spark, d).select(
        F.when(r % 211 == 0, "").when(r % 199 == 0, "1").otherwise(r.cast("string")).alias("request_id"), F.when(r % 97 == 0, "cook").otherwise(F.col("role")).alias("role"), "outcome", F.col("input_tokens").isNotNull().alias("usage_known"),
        F.when(r % 89 == 0, -1).otherwise(F.col("input_tokens")).alias("input_tokens"), F.when(r % 53 == 0, F.array(user, *map(F.lit, "abc"))).otherwise(F.array(user)).alias("review_ids"),
    )
    return audit.call_violations(logged, reviews(spark, d).select("review_id"), ROLES, OUTCOMES, 3)


@query(sql((REV, "f AS (SELECT review_id, text_key FROM rev), s AS (SELECT CASE WHEN " + h("ref", "review_id", 60) + " = 1 THEN 'x' || review_id ELSE review_id END AS review_id, CASE WHEN " + h("ref", "review_id", 60) + " = 2 THEN 'other' ELSE text_key END AS text_key FROM rev WHERE " + h("ref", "review_id", 3) + " > 0)"), "SELECT s.review_id, CASE WHEN f.review_id IS NULL THEN 'absent' ELSE 'changed' END AS problem FROM s LEFT JOIN f USING (review_id) WHERE f.review_id IS NULL OR f.text_key <> s.text_key"))
def reference_check(spark: SparkSession, d: str) -> DataFrame:
    """A sample's rows that the full file lacks or holds otherwise."""
    full = reviews(spark, d).select("review_id", "text_key")
    at = hash_mod("ref", F.col("review_id"), 60)
    sample = full.filter(hash_mod("ref", F.col("review_id"), 3) > 0).select(F.when(at == 1, F.concat(F.lit("x"), "review_id")).otherwise(F.col("review_id")).alias("review_id"), F.when(at == 2, "other").otherwise(F.col("text_key")).alias("text_key"))
    return audit.against_full(sample, full, "review_id", "text_key")


@query(sql((REV,), "SELECT lang, count(*) AS n, count(*) + 1 AS known FROM rev WHERE lang = 'de' GROUP BY lang UNION ALL SELECT 'xx', NULL, 7"))
def known_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the supplied file against what is known of it, which is wrong for one language and has one too many."""
    counts = reviews(spark, d).groupBy("lang").agg(F.count("*").alias("n"))
    known = counts.withColumn("n", F.when(F.col("lang") == "de", F.col("n") + 1).otherwise(F.col("n"))).unionByName(spark.createDataFrame([("xx", 7)], "lang string, n long"))
    return agreement.count_mismatches(counts, known, "lang")


@query(sql((REV,), "SELECT review_id FROM rev SEMI JOIN (SELECT CAST(doc_id AS VARCHAR) AS review_id FROM labels) USING (review_id)"))
def exists(spark: SparkSession, d: str) -> DataFrame:
    """Records that have a hand label."""
    return reviews(spark, d).select("review_id").join(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("review_id")), "review_id", "left_semi")


@query(sql((REV, f"verify AS (SELECT review_id FROM rev WHERE {h('seen', 'review_id', 3)} = 0)"), "SELECT review_id FROM rev ANTI JOIN verify USING (review_id)"))
def verify_todo(spark: SparkSession, d: str) -> DataFrame:
    """Records that are still to be verified."""
    ids = reviews(spark, d).select("review_id")
    return ids.join(ids.filter(hash_mod("seen", F.col("review_id"), 3) == 0), "review_id", "left_anti")


@query("SELECT DISTINCT lang, source FROM documents")
def distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("lang", "source").distinct()


@query(sql((REV,), f"SELECT review_id, CASE WHEN {h('second', 'review_id', 3)} = 0 THEN 'second' ELSE 'first' END AS sheet FROM rev"))
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Hand sheets of which a later one replaces an earlier one's rows."""
    first = reviews(spark, d).select("review_id", F.lit("first").alias("sheet"))
    second = first.filter(hash_mod("second", F.col("review_id"), 3) == 0).withColumn("sheet", F.lit("second"))
    return trace.last_wins([first, second], "review_id", "sheet")


@query(sql((REV,), "SELECT review_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM (SELECT review_id, 'all' AS tag FROM rev UNION SELECT CAST(doc_id AS VARCHAR), 'labelled' FROM labels) GROUP BY review_id"))
def tagged_union(spark: SparkSession, d: str) -> DataFrame:
    labelled = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("review_id"))
    return trace.tagged_union({"all": reviews(spark, d), "labelled": labelled}, "review_id")


@query(sql((REV,), "SELECT source, min(doc_id) AS doc_id FROM rev GROUP BY source"))
def first_seen(spark: SparkSession, d: str) -> DataFrame:
    return corpus.first_seen(reviews(spark, d).select("source", "doc_id"), "source", "doc_id")


@query(sql((REV,), "SELECT review_id, 'm/p-' || lang || '/s/cut-0.70' AS label_config FROM rev"))
def label_config(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id", trace.config_label(F.lit("m"), F.concat(F.lit("p-"), "lang"), F.lit("s"), F.lit("cut-0.70")).alias("label_config"))


@query("SELECT a.doc_id, CASE WHEN a.lang <> b.lang AND a.source <> b.source THEN 'lang,source' WHEN a.lang <> b.lang THEN 'lang' WHEN a.source <> b.source THEN 'source' ELSE '' END AS changed FROM documents a JOIN documents b ON a.doc_id = b.doc_id + 1")
def config_diff(spark: SparkSession, d: str) -> DataFrame:
    """Settings that differ between each record and the one before."""
    settings = table(spark, d, "documents").select("doc_id", F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("now"))
    before = settings.select((F.col("doc_id") + 1).alias("doc_id"), F.col("now").alias("before"))
    return settings.join(before, "doc_id").select("doc_id", F.array_join(trace.config_changes(F.col("before"), F.col("now")), ",").alias("changed"))


EVIDENCE = f"""logged AS (SELECT request_id, role, outcome, CASE WHEN request_id % 23 = 0 THEN 'later' WHEN request_id % 3 = 0 THEN 'resume' ELSE 'initial' END AS phase, CASE WHEN request_id % 17 = 0 THEN 'old' ELSE 'now' END AS used, review_ids[1] AS review_id FROM calls WHERE role <> 'memo'),
  ok AS (SELECT review_id, {h('cached', 'review_id', 9)} = 0 AS cached FROM rev WHERE {h('valid', 'review_id', 8)} > 0), before_ AS (SELECT review_id FROM ok WHERE {h('before', 'review_id', 2)} = 0),
  used AS (SELECT * FROM logged WHERE role = 'enrich'), met AS (SELECT used.*, cached FROM used JOIN ok USING (review_id) WHERE outcome = 'succeeded'), done AS (SELECT DISTINCT review_id, phase FROM met WHERE used = 'now')"""


@query(sql((REV, CALLS, EVIDENCE), """SELECT 'invalid_run_phase' AS code, CAST(request_id AS VARCHAR) AS detail FROM used WHERE phase = 'later' UNION ALL SELECT 'call_config_mismatch', review_id FROM met WHERE used <> 'now'
  UNION ALL SELECT DISTINCT 'reprocessed_checkpoint', CAST(request_id AS VARCHAR) FROM used SEMI JOIN before_ USING (review_id) WHERE phase = 'resume'
  UNION ALL SELECT 'unlogged_completed_records', review_id FROM ok WHERE NOT cached AND review_id NOT IN (SELECT review_id FROM done)
  UNION ALL SELECT 'resume_call_evidence', review_id FROM before_ WHERE review_id NOT IN (SELECT review_id FROM ok WHERE cached) AND review_id NOT IN (SELECT review_id FROM done WHERE phase = 'initial')
  UNION ALL SELECT 'resume_call_evidence', 'no new record after the resume' FROM (SELECT count(*) AS n FROM ok WHERE NOT cached AND review_id NOT IN (SELECT review_id FROM before_) AND review_id IN (SELECT review_id FROM done WHERE phase = 'resume')) WHERE n = 0
  UNION ALL SELECT 'missing_model_roles', 'memo'"""))
def evidence_audit(spark: SparkSession, d: str) -> DataFrame:
    """Calls as evidence for records and snapshots: phases, configurations, records called again or never."""
    r = F.col("request_id")
    phase = F.when(r % 23 == 0, "later").when(r % 3 == 0, "resume").otherwise("initial")
    logged = calls(spark, d).filter("role <> 'memo'").select("request_id", "role", "outcome", phase.alias("phase"), F.when(r % 17 == 0, "old").otherwise("now").alias("label_config"), F.slice("review_ids", 1, 1).alias("review_ids"))
    chance = lambda salt, k: hash_mod(salt, F.col("review_id"), k)
    valid = reviews(spark, d).filter(chance("valid", 8) > 0).select("review_id", F.lit("now").alias("label_config"), (chance("cached", 9) == 0).alias("cached"))
    return audit.evidence_violations(logged, valid, valid.filter(chance("before", 2) == 0).select("review_id"), valid.select("review_id"), ROLES)


@query(sql((REV,), "SELECT 'run_manifest_mismatch' AS code, 'records' AS detail UNION ALL SELECT 'ingestion_mismatch', 'texts'"))
def identity_audit(spark: SparkSession, d: str) -> DataFrame:
    """A declared run and ingestion, each wrong in one field, against the counts of the file."""
    true = reviews(spark, d).agg(F.count("*").alias("records"), F.countDistinct("text_key").alias("texts"), F.min("review_id").alias("first"))
    return audit.identity_violations(true.withColumn("records", F.col("records") + 1), true, "run_manifest_mismatch").unionByName(audit.identity_violations(true.withColumn("texts", F.lit(None).cast("long")), true, "ingestion_mismatch"))


TRACED = f"""one AS (SELECT * FROM rec WHERE doc_id = (SELECT min(doc_id) FROM rec WHERE intent IN ('complaint', 'cancellation') AND cache_source_id IS NULL)),
  used AS (SELECT list_sort(list(DISTINCT request_id)) AS requests FROM calls WHERE review_ids[1] = (SELECT review_id FROM one)), iss AS (SELECT issue_id, rank FROM m JOIN ranking USING (issue_id) WHERE review_id = (SELECT review_id FROM one)),
  cl AS (SELECT list_sort(list('CL-' || lpad(CAST((rank - 1) * 4 + k AS VARCHAR), 3, '0'))) AS claims FROM iss, (SELECT unnest([1, 2, 3, 4]) AS k))"""


@query(sql((*RANKED, CALLS, RES_B, RES2, TRACED), "SELECT one.review_id, one.source, one.topic, one.intent, one.severity, res2.topic AS verify_topic, res2.intent AS verify_intent, issue_id, rank, claims, requests, list_filter(['memo-1', 'memo-2'], lambda x: x = 'memo-1') AS memos FROM one JOIN res2 USING (text_key), iss, cl, used"))
def trace_(spark: SparkSession, d: str) -> DataFrame:
    """Everything that is known of one record: its source, labels, verification, calls, issue, rank, claims and memos."""
    found, members = with_issues(spark, d)
    one = str(found.filter("intent IN ('complaint', 'cancellation') AND cache_source_id IS NULL").agg(F.min("doc_id")).first()[0])
    order_ = ranking.rank(ranking.tally(members, found))
    memos = spark.createDataFrame([("memo-1", f"as [review:{one}] says"), ("memo-2", "cites [review:none]")], "memo_id string, memo string")
    return trace.trace(found, members, order_, calls(spark, d), records(spark, d, second=True), ranking.claims(order_), memos, one)
