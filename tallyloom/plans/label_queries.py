"""Queries over labels: records, issues, rankings, other readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.labels import INTENT_RULES, INTENTS, TOPIC_RULES, by_rule, invalid_reason, min_top, sentiment_from_tone
from tallyloom.functions.text import first_match, hash_mod, is_blank
from tallyloom.operators import agreement, audit, corpus, labelling, ranking
from tallyloom.plans import base
from tallyloom.plans.base import BASE, BLANKED, MEAN, MEMBER, PIECES_SQL, RANKED, REC2, RES2, RES_B, REV, SEED, blanked, h, labels_sql, records, reviews, sql, table
from tallyloom.plans.registry import query

RULED = "CASE WHEN intent IN ('unclear', 'praise', 'request') THEN 1 ELSE raw END"
RAW = f"SELECT review_id, intent, CAST(1 + {h('raw', 'text_key', 5)} AS INTEGER) AS raw FROM rec"
READINGS_SQL = {"as_labeled": "severity", "four_as_three": "CASE WHEN severity = 4 THEN 3 ELSE severity END", "high_as_three": "least(severity, 3)", "count_only": "1", "blocked_only": "CASE WHEN severity >= 4 THEN 1 ELSE 0 END"}


def rules_sql(rules: tuple, default: str) -> str:
    """First matching keyword rule in SQL."""
    quoted = lambda w: w.replace("'", "''")
    cases = " ".join(f"WHEN {' OR '.join(f"contains(lower(review_text), '{quoted(w)}')" for w in words)} THEN '{label}'" for label, words in rules)
    return f"CASE {cases} ELSE '{default}' END"


def with_issues(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    found = records(spark, d)
    return found, ranking.membership(found)


def ranked(spark: SparkSession, d: str) -> DataFrame:
    found, members = with_issues(spark, d)
    return ranking.rank(ranking.tally(members, found))


@query(sql(BASE, "SELECT review_id, text_key, topic, intent, severity, sentiment, min_top, cache_source_id FROM rec"))
def label_records(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct text labelled once, its labels on every copy."""
    return records(spark, d).select("review_id", "text_key", "topic", "intent", "severity", "sentiment", "min_top", "cache_source_id")


@query(sql((REV,), "SELECT CASE WHEN trim(review_text, ' ' || chr(9) || chr(10) || chr(13)) <> '' THEN 'pending' ELSE 'quarantined' END AS status, count(*) AS n FROM rev GROUP BY 1"))
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    blank = is_blank(F.col("review_text"))
    return reviews(spark, d).groupBy(F.when(blank, "quarantined").otherwise("pending").alias("status")).agg(F.count("*").alias("n"))


@query(sql((BLANKED,), "SELECT 'empty text' AS reason, count(*) AS n FROM rev WHERE trim(review_text, ' ' || chr(9) || chr(10) || chr(13)) = '' GROUP BY 1"))
def quarantine_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why records are quarantined; some texts are blank on purpose."""
    empty = blanked(spark, d).filter(is_blank(F.col("review_text")))
    return empty.groupBy(F.lit(corpus.EMPTY_REASON).alias("reason")).agg(F.count("*").alias("n"))


@query(sql(BASE, "SELECT topic, intent, count(*) AS n FROM rec GROUP BY topic, intent"))
def label_dist(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).groupBy("topic", "intent").agg(F.count("*").alias("n"))


@query(sql((*BASE, f"r AS ({RAW})"), f"SELECT review_id, {RULED} AS severity FROM r"))
def fixed_severity(spark: SparkSession, d: str) -> DataFrame:
    raw = (1 + hash_mod("raw", F.col("text_key"), 5)).cast("int")
    return records(spark, d).select("review_id", by_rule(F.col("intent"), raw).alias("severity"))


@query(sql((*BASE, f"r AS ({RAW})"), f"SELECT intent, count(*) AS records, count(*) FILTER ({RULED} <> raw) AS changed FROM r GROUP BY intent"))
def rule_changes(spark: SparkSession, d: str) -> DataFrame:
    raw = records(spark, d).withColumn("severity", (1 + hash_mod("raw", F.col("text_key"), 5)).cast("int"))
    return agreement.rule_changes(raw)


@query(sql((REV,), f"SELECT review_id, CASE WHEN t BETWEEN 0 AND 4 THEN t / 2 - 1 END AS sentiment FROM (SELECT review_id, CAST({h('tone', 'text_key', 500)} AS DOUBLE) / 100 AS t FROM rev)"))
def sentiment(spark: SparkSession, d: str) -> DataFrame:
    tone = hash_mod("tone", F.col("text_key"), 500) / 100.0
    return reviews(spark, d).select("review_id", sentiment_from_tone(tone).alias("sentiment"))


@query(sql((REV,), f"SELECT review_id, p, p < 0.7 AS needs_review FROM (SELECT review_id, least(greatest(a, 1 - a), greatest(b, 1 - b)) AS p FROM (SELECT review_id, CAST({h('pa', 'text_key', 64)} AS DOUBLE) / 64 AS a, CAST({h('pb', 'text_key', 64)} AS DOUBLE) / 64 AS b FROM rev))"))
def needs_review(spark: SparkSession, d: str) -> DataFrame:
    """The least of the largest probabilities, strictly below a cut-off."""
    chance = lambda salt: hash_mod(salt, F.col("text_key"), 64) / 64.0
    options = lambda p: F.create_map(F.lit("yes"), p, F.lit("no"), 1 - p)
    return reviews(spark, d).select("review_id", min_top(options(chance("pa")), options(chance("pb"))).alias("p")).withColumn("needs_review", F.col("p") < 0.7)


BROKEN = h("broken", "text_key", 12)
REASONS = f"""CASE {BROKEN} WHEN 0 THEN 'no topic of the list' WHEN 1 THEN 'no intent of the list' WHEN 2 THEN 'severity must be 1, 2, 3, 4 or 5'
  WHEN 3 THEN 'sentiment must lie between -1 and 1' WHEN 4 THEN 'needs_review is missing' WHEN 5 THEN 'an entity is blank' WHEN 6 THEN 'no quote is given'
  WHEN 7 THEN 'the quote does not stand in the text' WHEN 8 THEN 'no label_config is given' END"""


@query(sql(BASE, f"SELECT reason, count(*) AS n FROM (SELECT {REASONS} AS reason FROM rec WHERE trim(review_text, ' ' || chr(9) || chr(10) || chr(13)) <> '') GROUP BY reason"))
def validate(spark: SparkSession, d: str) -> DataFrame:
    """The first broken rule of each label, of which every twelfth breaks a given one."""
    at = hash_mod("broken", F.col("text_key"), 12)
    broken = lambda n, bad, good: F.when(at == n, bad).otherwise(good)
    quote = F.when(at == 6, F.lit(" ")).when(at == 7, F.concat("review_text", F.lit("!"))).otherwise(F.col("review_text"))
    entities = F.when(at == 5, F.array(F.lit("a"), F.lit(" "))).otherwise(F.array(F.lit("a")))
    some = records(spark, d).filter(~is_blank(F.col("review_text")))
    reason = invalid_reason(F.col("review_text"), broken(0, F.lit("weather"), F.col("topic")), broken(1, F.lit("angry"), F.col("intent")), broken(2, F.lit(6), F.col("severity")), broken(3, F.lit(float("nan")), F.col("sentiment")), broken(4, F.lit(None).cast("boolean"), F.lit(False)), entities, quote, broken(8, F.lit(""), F.lit("m/p/s/cut-0.70")))
    return some.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(sql((REV,), f"SELECT {rules_sql(INTENT_RULES, 'unclear')} AS intent, {rules_sql(TOPIC_RULES, 'other')} AS topic, count(*) AS n FROM rev GROUP BY 1, 2"))
def classify_rule(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("review_text")
    return reviews(spark, d).groupBy(first_match(text, INTENT_RULES, "unclear").alias("intent"), first_match(text, TOPIC_RULES, "other").alias("topic")).agg(F.count("*").alias("n"))


@query(sql((REV, "both_ AS (SELECT 'documents' AS corpus, review_text FROM rev UNION ALL SELECT 'benchmark', coalesce(text, '') FROM benchmark)"), f"SELECT corpus, topic, count(*) AS n FROM (SELECT corpus, {rules_sql(TOPIC_RULES, 'other')} AS topic FROM both_) GROUP BY corpus, topic"))
def topic_proxy(spark: SparkSession, d: str) -> DataFrame:
    """Keyword topics of two corpora side by side."""
    other = table(spark, d, "benchmark").select(F.lit("benchmark").alias("corpus"), F.coalesce("text", F.lit("")).alias("review_text"))
    both = reviews(spark, d).select(F.lit("documents").alias("corpus"), "review_text").unionByName(other)
    return both.groupBy("corpus", first_match(F.col("review_text"), TOPIC_RULES, "other").alias("topic")).agg(F.count("*").alias("n"))


@query(sql((*BASE, f"saved AS (SELECT text_key, topic, intent FROM res WHERE {h('saved', 'text_key', 2)} = 0)"), f"SELECT review_id, coalesce(saved.intent, {rules_sql(INTENT_RULES, 'unclear')}) AS intent, coalesce(saved.topic, {rules_sql(TOPIC_RULES, 'other')}) AS topic, saved.text_key IS NOT NULL AS replayed FROM rev LEFT JOIN saved USING (text_key)"))
def replay_or_rule(spark: SparkSession, d: str) -> DataFrame:
    """Saved answers where a text has one, rules for the rest."""
    revs = reviews(spark, d)
    saved = base.results(revs).filter(hash_mod("saved", F.col("text_key"), 2) == 0).select("text_key", "topic", "intent")
    return labelling.label_corpus(revs, labelling.ReplayLabeler(saved, labelling.RuleLabeler())).select("review_id", "intent", "topic", "replayed")


@query(sql((*BASE, "t AS (SELECT intent, topic, severity, row_number() OVER (PARTITION BY text_key ORDER BY review_id) AS n FROM rec)"), "SELECT (SELECT count(*) FROM t WHERE n = 1) AS texts, (SELECT max(c) FROM (SELECT count(*) AS c FROM t WHERE n = 1 GROUP BY topic)) AS top_topic, (SELECT count(*) FROM res WHERE min_top < 0.7) AS flagged, CASE WHEN (SELECT max(c) FROM (SELECT count(*) AS c FROM t WHERE n = 1 GROUP BY topic)) * 100 > 95 * (SELECT count(*) FROM t WHERE n = 1) THEN 'one_topic' ELSE '' END AS failed"))
def guards(spark: SparkSession, d: str) -> DataFrame:
    """Signs of labels that say nothing: one topic nearly everywhere, all or none flagged."""
    return labelling.degenerate(base.results(reviews(spark, d)), cutoff=0.7, least=100)


@query(sql((*BASE, MEMBER), "SELECT issue_id, review_id FROM m"))
def membership(spark: SparkSession, d: str) -> DataFrame:
    return with_issues(spark, d)[1]


RANK_COLUMNS = f"rank, issue_id, complaint_count, severity_sum, {MEAN} AS mean_severity, severity_sum AS priority_score"


@query(sql(RANKED, f"SELECT {RANK_COLUMNS} FROM ranking"))
def ranking_(spark: SparkSession, d: str) -> DataFrame:
    return ranked(spark, d)


@query(sql(RANKED, f"SELECT 'CL-' || lpad(CAST((rank - 1) * 4 + k + 1 AS VARCHAR), 3, '0') AS claim_id, issue_id, ['complaint_count', 'severity_sum', 'mean_severity', 'priority_score'][k + 1] AS metric, [CAST(complaint_count AS VARCHAR), CAST(severity_sum AS VARCHAR), {MEAN}, CAST(severity_sum AS VARCHAR)][k + 1] AS value FROM ranking, (SELECT unnest([0, 1, 2, 3]) AS k)"))
def claims(spark: SparkSession, d: str) -> DataFrame:
    return ranking.claims(ranked(spark, d))


@query(sql((*BASE, MEMBER), f"SELECT issue_id, place, review_id, severity FROM (SELECT issue_id, review_id, severity, row_number() OVER (PARTITION BY issue_id ORDER BY sha256('sample-v1:' || review_id), review_id) AS place FROM m JOIN rec USING (review_id) WHERE cache_source_id IS NULL AND length(review_text) <= 500) WHERE place <= 5"))
def quotes(spark: SparkSession, d: str) -> DataFrame:
    found, members = with_issues(spark, d)
    return ranking.quotes(members, found.withColumn("evidence_quote", F.col("review_text")), "sample-v1", 5)


@query(sql((REV,), "SELECT lang, count(*) FILTER (length(review_text) <= 500) AS quotable, count(*) FILTER (length(review_text) > 20000) AS too_long, count(*) AS records FROM rev GROUP BY lang"))
def quote_bound(spark: SparkSession, d: str) -> DataFrame:
    size = F.length("review_text")
    return reviews(spark, d).groupBy("lang").agg(F.count_if(size <= 500).alias("quotable"), F.count_if(size > 20_000).alias("too_long"), F.count("*").alias("records"))


EVIDENCE = """x AS (SELECT issue_id, review_id, severity, sha256('sample-v1:' || review_id) AS k FROM m JOIN rec USING (review_id) WHERE cache_source_id IS NULL),
  s AS (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY severity DESC, k, review_id) AS s FROM x),
  e AS (SELECT *, row_number() OVER (PARTITION BY issue_id, s <= 3 ORDER BY k, review_id) AS h FROM s)"""


CHOSEN = "SELECT issue_id, review_id, severity, CASE WHEN s <= 3 THEN 'severe' ELSE 'hashed' END AS why FROM e WHERE s <= 3 OR h <= 2"


@query(sql((*BASE, MEMBER, EVIDENCE), CHOSEN))
def evidence_top(spark: SparkSession, d: str) -> DataFrame:
    found, members = with_issues(spark, d)
    return ranking.evidence(members, found, "sample-v1")


PACK = """d AS (SELECT issue_id, string_agg('{"why":"' || why || '","review_id":"' || review_id || '","severity":' || severity || '}', ',' ORDER BY why, review_id) AS l FROM chosen GROUP BY issue_id),
  i AS (SELECT string_agg('{"rank":' || rank || ',"issue_id":"' || issue_id || '","complaint_count":' || complaint_count || ',"mean_severity":"' || mean_severity || '","records":[' || l || ']}', ',' ORDER BY rank) AS issues FROM rk JOIN d USING (issue_id))"""


@query(sql((*RANKED, EVIDENCE, f"chosen AS ({CHOSEN}), rk AS (SELECT {RANK_COLUMNS} FROM ranking)", PACK), """SELECT '{"issues":[' || issues || '],"statuses":[{"status":"completed","n":' || (SELECT count(*) FROM rec) || '}]}' AS document FROM i"""))
def evidence_pack(spark: SparkSession, d: str) -> DataFrame:
    """The document that a memo is written from."""
    found, members = with_issues(spark, d)
    chosen = ranking.evidence(members, found, "sample-v1")
    statuses = found.groupBy(F.lit("completed").alias("status")).agg(F.count("*").alias("n"))
    return ranking.evidence_pack(ranking.rank(ranking.tally(members, found)), chosen, statuses)


AB = "ab AS (SELECT 'a' AS engine, topic, intent, severity FROM rec UNION ALL SELECT 'b', topic, intent, severity FROM rec2), t AS (SELECT engine, 'IS-' || topic AS issue_id, count(*) AS complaint_count, CAST(sum(severity) AS BIGINT) AS severity_sum FROM ab WHERE intent IN ('complaint', 'cancellation') GROUP BY engine, topic)"


@query(sql((*BASE, RES_B, RES2, REC2, AB), "SELECT engine, row_number() OVER (PARTITION BY engine ORDER BY severity_sum DESC, issue_id) AS rank, issue_id, complaint_count, severity_sum FROM t"))
def ranking_ab(spark: SparkSession, d: str) -> DataFrame:
    """The rankings of two labelers side by side."""
    out = []
    for engine, second in (("a", False), ("b", True)):
        found = records(spark, d, second)
        tallied = ranking.rank(ranking.tally(ranking.membership(found), found))
        out.append(tallied.select(F.lit(engine).alias("engine"), F.col("rank").cast("long").alias("rank"), "issue_id", "complaint_count", "severity_sum"))
    return out[0].unionByName(out[1])


@query(sql((*BASE, MEMBER, "t AS (" + " UNION ALL ".join(f"SELECT '{k}' AS reading, issue_id, CAST(sum({v}) AS BIGINT) AS total FROM m JOIN rec USING (review_id) GROUP BY issue_id" for k, v in READINGS_SQL.items()) + ")"), "SELECT reading, row_number() OVER (PARTITION BY reading ORDER BY total DESC, issue_id) AS rank, issue_id, total FROM t"))
def whatif(spark: SparkSession, d: str) -> DataFrame:
    """The ranking under five readings of a severity."""
    found, members = with_issues(spark, d)
    return ranking.what_if(members, found)


@query(sql((*BASE, MEMBER), "SELECT issue_id, " + ", ".join(f"count(*) FILTER (severity = {s}) AS s{s}" for s in range(1, 6)) + " FROM m JOIN rec USING (review_id) GROUP BY issue_id"))
def severity_hist(spark: SparkSession, d: str) -> DataFrame:
    found, members = with_issues(spark, d)
    return ranking.severity_histogram(members, found)


@query(sql((*BASE, MEMBER, "t AS (SELECT issue_id, sum(severity) AS t, count(*) FILTER (severity = 4) AS f FROM m JOIN rec USING (review_id) GROUP BY issue_id), p AS (SELECT a.issue_id AS ahead, b.issue_id AS behind, a.t - b.t AS gap, a.f - b.f AS fours FROM t a JOIN t b ON a.t > b.t OR (a.t = b.t AND a.issue_id < b.issue_id))"), "SELECT ahead, behind, CAST((2 * gap * 10000 + fours) // (2 * fours) AS BIGINT) AS share_ten_thousandths FROM p WHERE fours > 0 AND gap > 0 AND gap <= fours"))
def break_even(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of issues that change places when enough 4s count as 3."""
    found, members = with_issues(spark, d)
    return ranking.break_even(ranking.severity_histogram(members, found))


@query(sql(RANKED, "SELECT unnest(['ranking_mismatch', 'ranking_missing']) AS code, issue_id AS detail FROM ranking WHERE rank = 1"))
def rebuild_check(spark: SparkSession, d: str) -> DataFrame:
    """A recount from the severity histogram against a stored ranking, whose first mean was changed."""
    found, members = with_issues(spark, d)
    counts = ranking.severity_histogram(members, found)
    rebuilt = ranking.rank(counts.select("issue_id", F.expr("s1 + s2 + s3 + s4 + s5").alias("complaint_count"), F.expr("s1 + 2 * s2 + 3 * s3 + 4 * s4 + 5 * s5").alias("severity_sum")))
    stored = ranking.rank(ranking.tally(members, found))
    return audit.ranking_violations(rebuilt, stored.withColumn("mean_severity", F.when(F.col("rank") == 1, "9.000000").otherwise(F.col("mean_severity"))))


@query("WITH t AS (SELECT o_orderpriority AS issue_id, count(*) AS complaint_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS severity_sum FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY severity_sum DESC, issue_id) AS rank, (2 * severity_sum * 1000000 + complaint_count) // (2 * complaint_count) AS micro FROM t) " + f"SELECT {RANK_COLUMNS} FROM r")
def scale_rank(spark: SparkSession, d: str) -> DataFrame:
    """The ranking over the largest tables: line items joined to their orders, grouped and ranked."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("review_id"), F.concat(F.col("o_orderpriority")).alias("issue_id"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("review_id"), F.col("l_quantity").cast("long").alias("severity"))
    return ranking.rank(ranking.tally(orders, lines))


@query(sql((*BASE, f"done AS (SELECT DISTINCT text_key FROM rev WHERE {h('done', 'review_id', 5)} = 0)"), "SELECT review_id, CASE WHEN done.text_key IS NOT NULL THEN 'completed' ELSE 'pending' END AS status FROM rev LEFT JOIN done USING (text_key)"))
def propagate(spark: SparkSession, d: str) -> DataFrame:
    """A text that is finished for one record is finished for all its copies."""
    revs = reviews(spark, d)
    done = revs.filter(hash_mod("done", F.col("review_id"), 5) == 0)
    return labelling.propagate(revs, done).select("review_id", "status")


@query("WITH f AS (SELECT source || ':' || CAST(n_chars AS VARCHAR) AS item, doc_id, lang, 1 + n_chars % 6 AS rating, row_number() OVER (PARTITION BY source || ':' || CAST(n_chars AS VARCHAR) ORDER BY doc_id) AS n FROM documents) SELECT item, doc_id, lang FROM f WHERE n = 1 AND rating BETWEEN 1 AND 5 AND item <> ''")
def eligible(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each id, with a rating from 1 to 5."""
    docs = table(spark, d, "documents").select(F.concat("source", F.lit(":"), F.col("n_chars").cast("string")).alias("item"), "doc_id", "lang", (1 + F.col("n_chars") % 6).alias("rating"))
    return corpus.first_seen(docs.filter("item IS NOT NULL"), "item", "doc_id").filter("rating BETWEEN 1 AND 5 AND item <> ''").select("item", "doc_id", "lang")


SENTENCES = f"sent AS (SELECT review_id, unnest(p) AS sentence, unnest(range(len(p))) AS at_, sha256(unnest(p)) AS text_key FROM pc), lab AS ({labels_sql().replace('FROM rev)', 'FROM sent)')}), sl AS (SELECT * FROM sent JOIN lab USING (text_key))"
FIRST_INTENT = "[" + ", ".join(f"'{x}'" for x in INTENTS) + "]"


@query(sql((REV, PIECES_SQL, SENTENCES), f"SELECT review_id, {FIRST_INTENT}[min(list_position({FIRST_INTENT}, intent))] AS intent, max(severity) AS severity, arg_min(topic, (-severity, (topic = 'other')::INT, at_)) AS topic FROM sl GROUP BY review_id"))
def sentence_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Labels of sentences rolled up to records: intent by precedence, greatest severity, and the first specific topic that has it."""
    return labelling.sentence_rollup(reviews(spark, d), base.hash_labels, INTENTS).select("review_id", "intent", "severity", "topic")


PILOT = h("pilot", "text_key", 10)


@query(sql((REV, "c AS (SELECT text_key, CAST(length(review_text) AS DOUBLE) AS n FROM rev)", f"m AS (SELECT (SELECT avg(n) FROM c WHERE {PILOT} = 0) AS pilot, (SELECT avg(n) FROM c) AS rows_, (SELECT avg(n) FROM (SELECT DISTINCT text_key, n FROM c)) AS texts)"), "SELECT round(pilot, 4) AS pilot, round(pilot / rows_ - 1, 6) AS error_rows, round(pilot / texts - 1, 6) AS error_texts FROM m"))
def projection_error(spark: SparkSession, d: str) -> DataFrame:
    """How far a pilot's mean length is from the mean over records and over distinct texts."""
    size = F.length("review_text").cast("long")
    pilot = hash_mod("pilot", F.col("text_key"), 10) == 0
    per_text = reviews(spark, d).groupBy("text_key").agg(F.min(size).alias("n"), F.count("*").alias("k"), F.first(pilot).alias("pilot"))
    total: Column = F.col("n") * F.col("k")
    mean = lambda a, b: F.sum(a) / F.sum(b)
    row = per_text.agg(mean(F.when(F.col("pilot"), total), F.when(F.col("pilot"), F.col("k"))).alias("p"), mean(total, F.col("k")).alias("r"), F.avg("n").alias("t"))
    return row.select(F.round("p", 4).alias("pilot"), F.round(F.col("p") / F.col("r") - 1, 6).alias("error_rows"), F.round(F.col("p") / F.col("t") - 1, 6).alias("error_texts"))


TOTALS_SQL = " UNION ALL ".join(f"SELECT '{k}' AS reading, issue_id, sum({v}) AS total FROM m JOIN rec USING (review_id) GROUP BY issue_id" for k, v in READINGS_SQL.items())


@query(sql((*BASE, MEMBER, f"w AS ({TOTALS_SQL} UNION ALL SELECT 'none', issue_id, 0 FROM m)"), "SELECT reading, count(DISTINCT total) AS totals, count(DISTINCT total) = 1 AS degenerate FROM w GROUP BY reading"))
def reading_checks(spark: SparkSession, d: str) -> DataFrame:
    """Readings that tell no issue from another; one that weighs nothing is added."""
    found, members = with_issues(spark, d)
    ranked_ = ranking.what_if(members, found)
    none = ranked_.filter("reading = 'as_labeled'").withColumns({"reading": F.lit("none"), "total": F.lit(0).cast("long")})
    return ranking.degenerate_readings(ranked_.unionByName(none))


@query(sql(BASE, "SELECT *, top * 100 > 90 * n AS one_label, classes < 3 AS few_classes FROM (SELECT field, count(*) AS classes, max(n) AS top, CAST(sum(n) AS BIGINT) AS n FROM (SELECT field, label, count(*) AS n FROM (SELECT 'topic' AS field, topic AS label FROM rec UNION ALL SELECT 'intent', intent FROM rec UNION ALL SELECT 'flag', CAST(min_top < 0.99 AS VARCHAR) FROM rec UNION ALL SELECT 'fixed', 'x' FROM rec) GROUP BY 1, 2) GROUP BY field)"))
def label_sanity(spark: SparkSession, d: str) -> DataFrame:
    """Fields where one label has nearly all records, or that have too few classes."""
    cells = F.array(*(F.struct(F.lit(k).alias("field"), v.alias("label")) for k, v in {"topic": F.col("topic"), "intent": F.col("intent"), "flag": (F.col("min_top") < 0.99).cast("string"), "fixed": F.lit("x")}.items()))
    return labelling.label_sanity(records(spark, d).select(F.explode(cells).alias("c")).select("c.*"))
