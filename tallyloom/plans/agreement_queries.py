"""Queries that hold labelers against each other and against gold labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.exact import clopper_pearson, mid_p, sign_test
from tallyloom.functions.labels import best_option, by_rule, revision, valid_cutoff
from tallyloom.functions.numbers import percent, wald
from tallyloom.functions.text import hash_mod
from tallyloom.operators import agreement, order, significance, trace
from tallyloom.plans import base
from tallyloom.plans.base import BASE, REV, TWO, h, labels_sql, records, reviews, sql, table
from tallyloom.plans.registry import query

CUTS = (0.5, 0.6, 0.7, 0.8, 0.9)
SAME = {f: f"a_{f} IS NOT DISTINCT FROM b_{f}" for f in agreement.FIELDS}
ALL3 = " AND ".join(SAME.values())
COUNTS = "count(*) AS pairs, " + ", ".join(f"count(*) FILTER ({s}) AS {f}" for f, s in SAME.items()) + f", count(*) FILTER ({ALL3}) AS all_three"
CELLS = "c AS (" + " UNION ALL ".join(f"SELECT review_id, '{f}' AS field, CAST(a_{f} AS VARCHAR) AS a, CAST(b_{f} AS VARCHAR) AS b FROM p" for f in agreement.FIELDS) + ")"
RES_C = f"res_c AS ({labels_sql('c_')})"
THREE = (*TWO, RES_C, "q AS (SELECT p.*, c.topic AS c_topic, c.intent AS c_intent, c.severity AS c_severity FROM p JOIN rev USING (review_id) JOIN res_c c USING (text_key))")


def paired(spark: SparkSession, d: str) -> DataFrame:
    return agreement.pairs(records(spark, d), records(spark, d, second=True), keep=("min_top",))


def three(spark: SparkSession, d: str) -> DataFrame:
    revs = reviews(spark, d)
    third = revs.select("review_id", "text_key").join(base.hash_labels(revs.select("text_key").distinct(), "c_"), "text_key")
    return paired(spark, d).join(third.select("review_id", *(F.col(f).alias(f"c_{f}") for f in agreement.FIELDS)), "review_id")


def ranked_or_rest() -> Column:
    return F.when(F.col("a_intent").isin("complaint", "cancellation"), "ranked").otherwise("rest")


@query(sql(TWO, "SELECT review_id, min_top, a_topic, b_topic, a_intent, b_intent, a_severity, b_severity FROM p"))
def pairs(spark: SparkSession, d: str) -> DataFrame:
    return paired(spark, d)


@query(sql(TWO, f"SELECT {COUNTS} FROM p"))
def agreement_(spark: SparkSession, d: str) -> DataFrame:
    return agreement.agreement(paired(spark, d))


@query(sql(TWO, f"SELECT CASE WHEN a_intent IN ('complaint', 'cancellation') THEN 'ranked' ELSE 'rest' END AS part, a_topic, {COUNTS} FROM p GROUP BY 1, 2"))
def agreement_by(spark: SparkSession, d: str) -> DataFrame:
    return agreement.agreement(paired(spark, d).withColumn("part", ranked_or_rest()), "part", "a_topic")


@query(sql(TWO, f"SELECT count(*) AS pairs, count(*) FILTER ({ALL3}) AS equal, count(*) >= 50 AND count(*) = count(*) FILTER ({ALL3}) AS suspicious FROM p"))
def guard_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Complete agreement over fifty pairs or more points at a copy, not at a second opinion."""
    row = agreement.agreement(paired(spark, d))
    return row.select("pairs", F.col("all_three").alias("equal"), ((F.col("pairs") >= 50) & (F.col("pairs") == F.col("all_three"))).alias("suspicious"))


@query(sql((*TWO, CELLS), "SELECT field, a, b, count(*) AS n FROM c GROUP BY field, a, b"))
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return agreement.confusion(paired(spark, d))


@query(sql((*TWO, CELLS), "SELECT review_id, field, a, b FROM c WHERE a IS DISTINCT FROM b"))
def disagreements(spark: SparkSession, d: str) -> DataFrame:
    return agreement.stacked(paired(spark, d), "review_id").filter("NOT a <=> b")


@query(sql((*TWO, CELLS, "t AS (SELECT field, a AS class, count(*) AS support, count(*) FILTER (a = b) AS hits FROM c GROUP BY 1, 2), s AS (SELECT field, b AS class, count(*) AS predicted FROM c GROUP BY 1, 2)", "m AS (SELECT field, class, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted, coalesce(hits, 0) AS hits FROM t FULL JOIN s USING (field, class))"), "SELECT *, round(hits / nullif(support, 0)::DOUBLE, 6) AS recall, round(hits / nullif(predicted, 0)::DOUBLE, 6) AS precision, round(2 * hits / nullif(support + predicted, 0)::DOUBLE, 6) AS f1 FROM m"))
def class_metrics(spark: SparkSession, d: str) -> DataFrame:
    return agreement.class_metrics(paired(spark, d))


ERROR = """SELECT count(*) AS pairs, CAST(sum(b_severity - a_severity) AS BIGINT) AS signed, CAST(sum(abs(b_severity - a_severity)) AS BIGINT) AS absolute,
  round(sum(b_severity - a_severity) / CAST(count(*) AS DOUBLE), 6) AS mean_signed, round(sum(abs(b_severity - a_severity)) / CAST(count(*) AS DOUBLE), 6) AS mean_absolute,
  round(CAST(sum(abs(CAST(s2 AS DECIMAL(10,3)) - CAST(s1 AS DECIMAL(10,3)))) AS DOUBLE) / count(*), 6) AS sentiment_mae FROM p JOIN rev USING (review_id) JOIN tone USING (text_key)"""
TONE = f"""tone AS (SELECT a.text_key, a.sentiment AS s1, CASE WHEN {h('v', 'a.text_key', 10)} < 3 THEN b.sentiment ELSE a.sentiment END AS s2, a.min_top AS p1,
  CASE WHEN {h('v', 'a.text_key', 10)} < 3 THEN b.min_top ELSE a.min_top END AS p2 FROM res a JOIN res_b b USING (text_key))"""


@query(sql((*TWO, TONE), ERROR))
def golden_error(spark: SparkSession, d: str) -> DataFrame:
    """How far severities and sentiments of two labelers lie apart."""
    tones = [records(spark, d, second=x).select("review_id", F.col("sentiment").alias(f"{n}_sentiment")) for x, n in ((False, "a"), (True, "b"))]
    return agreement.severity_error(paired(spark, d).join(tones[0], "review_id").join(tones[1], "review_id"))


F1 = """t AS (SELECT field, a AS class, count(*) AS support, count(*) FILTER (a = b) AS hits FROM c GROUP BY 1, 2), s AS (SELECT field, b AS class, count(*) AS predicted FROM c GROUP BY 1, 2),
  m AS (SELECT field, round(2 * hits / CAST(support + coalesce(predicted, 0) AS DOUBLE), 6) AS f1 FROM t LEFT JOIN s USING (field, class))"""


@query(sql((*TWO, CELLS, F1), "SELECT field, count(*) AS classes, round(avg(f1), 6) AS macro_f1 FROM m GROUP BY field"))
def macro_f1(spark: SparkSession, d: str) -> DataFrame:
    """The mean F1 over the classes that the truth has."""
    return agreement.macro_f1(agreement.class_metrics(paired(spark, d)))


@query(sql(TWO, "SELECT a_topic AS topic, round(CAST(sum(b_severity - a_severity) AS DOUBLE) / count(*), 4) AS shift FROM p GROUP BY 1"))
def mean_shift(spark: SparkSession, d: str) -> DataFrame:
    gap = (F.col("b_severity") - F.col("a_severity")).cast("long")
    return paired(spark, d).groupBy(F.col("a_topic").alias("topic")).agg(F.round(F.sum(gap) / F.count("*"), 4).alias("shift"))


@query(sql(TWO, "SELECT a_severity - b_severity AS gap, count(*) AS n FROM p GROUP BY 1"))
def gap_hist(spark: SparkSession, d: str) -> DataFrame:
    return agreement.gaps(paired(spark, d))


@query(sql((*TWO, f"k AS (SELECT CAST(unnest({list(CUTS)}) AS DOUBLE) AS cutoff)"), f"SELECT cutoff, count(*) FILTER (min_top < cutoff) AS flagged, count(*) FILTER (min_top < cutoff AND NOT ({ALL3})) AS caught, count(*) FILTER (min_top < cutoff AND {ALL3}) AS agreeing_flagged FROM p, k GROUP BY cutoff"))
def cutoff_table(spark: SparkSession, d: str) -> DataFrame:
    return agreement.cutoff_table(paired(spark, d), CUTS)


@query(sql(TWO, f"SELECT count(*) FILTER (min_top < 0.7 AND NOT ({ALL3})) AS wrong_caught, count(*) FILTER (NOT ({ALL3})) AS wrong, count(*) FILTER (min_top < 0.7 AND {ALL3}) AS right_flagged, count(*) FILTER ({ALL3}) AS right_ FROM p"))
def flag_quality(spark: SparkSession, d: str) -> DataFrame:
    pair = paired(spark, d).select((F.col("min_top") < 0.7).alias("flag"), agreement.all_same().alias("ok"))
    return pair.agg(F.count_if(F.expr("flag AND NOT ok")).alias("wrong_caught"), F.count_if(F.expr("NOT ok")).alias("wrong"), F.count_if(F.expr("flag AND ok")).alias("right_flagged"), F.count_if(F.col("ok")).alias("right_"))


CHANGED = {**{f: f"NOT ({s})" for f, s in SAME.items()}, "any": f"NOT ({ALL3})"}


@query(sql(TWO, " UNION ALL ".join(f"SELECT '{k}' AS field, count(*) AS pairs, count(*) FILTER ({c}) AS changed, (2 * count(*) FILTER ({c}) * 10000 + count(*)) // (2 * count(*)) AS per_ten_thousand FROM p" for k, c in CHANGED.items())))
def change_rate(spark: SparkSession, d: str) -> DataFrame:
    return agreement.change_rate(paired(spark, d))


@query(sql(TWO, "SELECT a_topic || ' -> ' || b_topic AS change, count(*) AS n FROM p WHERE a_topic <> b_topic GROUP BY 1 ORDER BY n DESC, change LIMIT 25"))
def transitions(spark: SparkSession, d: str) -> DataFrame:
    return agreement.transitions(paired(spark, d), "topic", 25)


TALLY = "t AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, CASE WHEN c_{f} = a_{f} THEN 'a' WHEN c_{f} = b_{f} THEN 'b' ELSE 'neither' END AS side FROM q WHERE a_{f} <> b_{f}" for f in agreement.FIELDS) + ")"


@query(sql((*THREE, TALLY), "SELECT field, side, count(*) AS n FROM t GROUP BY field, side UNION ALL SELECT 'all', side, count(*) FROM t GROUP BY side"))
def side_tally(spark: SparkSession, d: str) -> DataFrame:
    """Whom a third labeler agrees with where two differ."""
    return agreement.side_tally(three(spark, d))


PMF = "exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + n * ln(0.5::DOUBLE))"
PAIRED_TESTS = f"""w AS (SELECT field, count(*) FILTER (side = 'a') AS a, count(*) FILTER (side = 'b') AS b FROM (SELECT * FROM t UNION ALL SELECT 'all', side FROM t) GROUP BY field),
  n AS (SELECT *, a + b AS n, least(a, b) AS least_ FROM w), k AS (SELECT n.*, unnest(range(least_ + 1)) AS k FROM n),
  c AS (SELECT field, a, b, sum({PMF}) AS cdf, max({PMF}) FILTER (k = least_) AS last FROM k GROUP BY field, a, b)"""


@query(sql((*THREE, TALLY, PAIRED_TESTS), "SELECT field, a, b, round(least(1, 2 * cdf), 9) AS p, round(CASE WHEN a = b THEN 1 - last / 2 ELSE 2 * (cdf - last / 2) END, 9) AS mid_p FROM c"))
def mcnemar(spark: SparkSession, d: str) -> DataFrame:
    """The exact sign test of those tallies, and its mid-p form."""
    sides = agreement.side_tally(three(spark, d)).groupBy("field").pivot("side", ["a", "b"]).agg(F.first("n"))
    filled = sides.na.fill(0, ["a", "b"])
    return filled.select("field", "a", "b", F.round(sign_test(F.col("a"), F.col("b")), 9).alias("p"), F.round(mid_p(F.col("a"), F.col("b")), 9).alias("mid_p"))


@query(sql(TWO, f"SELECT review_id, a_topic AS topic, a_intent AS intent, a_severity AS severity FROM p WHERE {ALL3}"))
def shared(spark: SparkSession, d: str) -> DataFrame:
    """Labels that both give."""
    return paired(spark, d).filter(agreement.all_same()).select("review_id", *(F.col(f"a_{f}").alias(f) for f in agreement.FIELDS))


@query(sql(TWO, f"SELECT review_id FROM p WHERE NOT ({ALL3})"))
def disputed(spark: SparkSession, d: str) -> DataFrame:
    return paired(spark, d).filter(~agreement.all_same()).select("review_id")


SHEET = f"""g AS (SELECT review_id FROM p WHERE {ALL3} ORDER BY sha256('agreed-v1:' || review_id), review_id LIMIT 20),
  s AS (SELECT review_id, false AS disputed FROM g UNION ALL SELECT review_id, true FROM p WHERE NOT ({ALL3}))"""


@query(sql((*TWO, SHEET), "SELECT review_id, disputed, row_number() OVER (ORDER BY sha256('sheet-v1:' || review_id), review_id) - 1 AS place FROM s"))
def adjudication_sheet(spark: SparkSession, d: str) -> DataFrame:
    """Twenty agreed records in one hash order and all disputed ones, dealt anew in another."""
    pair = paired(spark, d).select("review_id", (~agreement.all_same()).alias("disputed"))
    agreed = order.hash_sample(pair.filter("NOT disputed"), "agreed-v1", 20).select("review_id", "disputed")
    both = order.seeded(agreed.unionByName(pair.filter("disputed")), "sheet-v1")
    return order.position(both, "order_key", ["review_id"], "place").select("review_id", "disputed", "place")


#: Arms and the pairs of them that are compared: a, b and c are labelers, d is a again, e says one topic only.
ARMS = (("a", "b"), ("a", "c"), ("b", "c"), ("a", "d"), ("a", "e"))
ARM_LABELS = {f"{f}_{x}": {"d": f"a_{f}", "e": "'other'" if f == "topic" else f"a_{f}"}.get(x, f"{x}_{f}") for x in "abcde" for f in agreement.FIELDS}
CANARY = f"""w AS (SELECT unnest([rev.lang, 'all']) AS set_, {", ".join(f"{v} AS {k}" for k, v in ARM_LABELS.items())} FROM q JOIN rev USING (review_id)),
  n AS ({" UNION ALL ".join(f"SELECT set_, '{x}{y}' AS arms, '{y}' AS arm, count(*) AS pairs, count(*) FILTER ({' OR '.join(f'{f}_{x} <> {f}_{y}' for f in agreement.FIELDS)}) AS changed FROM w GROUP BY set_" for x, y in ARMS)}),
  o AS ({" UNION ALL ".join(f"SELECT set_, '{y}' AS arm, max(n) AS top FROM (SELECT set_, topic_{y}, count(*) AS n FROM w GROUP BY 1, 2) GROUP BY set_" for y in "bcde")})"""


@query(sql((*THREE, CANARY), "SELECT set_ AS set, arms, pairs, changed, changed * 100 <= 6 * pairs AS anchored, changed = 0 AS identical, top * 100 > 90 * pairs AS collapsed FROM n JOIN o USING (set_, arm)"))
def canary(spark: SparkSession, d: str) -> DataFrame:
    """Changes between five pairs of arms, by language and over all: which stay under six of a hundred, which are identical, which arm has collapsed."""
    revs, first = reviews(spark, d), records(spark, d)
    third = revs.join(base.hash_labels(revs.select("text_key").distinct(), "c_"), "text_key")
    met = agreement.arms({"a": first, "b": records(spark, d, second=True), "c": third, "d": first, "e": first.withColumn("topic", F.lit("other"))})
    return agreement.arm_changes(met.join(revs.select("review_id", F.col("lang").alias("set")), "review_id"), list(ARMS), anchor=6)


QUOTE = lambda s: f"substr(substr(review_text, 1, 12), 1, 2 * {s})"


@query(sql((*TWO, TONE), f"""SELECT count(*) AS pairs, count(*) FILTER (NOT ({ALL3})) AS changed, count(*) FILTER ({QUOTE('a_severity')} <> {QUOTE('b_severity')}) AS quotes, count(*) FILTER ((p1 < 0.7) <> (p2 < 0.7)) AS flags,
  count(*) FILTER (s1 <> s2) AS tone_moved, round(coalesce(max(abs(s1 - s2)), 0), 6) AS tone_most FROM p JOIN rev USING (review_id) JOIN tone USING (text_key)"""))
def nested_report(spark: SparkSession, d: str) -> DataFrame:
    """What moved between two runs over the same records."""
    return agreement.nested_report(records(spark, d), records(spark, d, second=True))


@query(sql((*TWO, TONE), "SELECT round(median(abs(p1 - p2)), 6) AS middle, round(max(abs(p1 - p2)), 6) AS most FROM rev JOIN tone USING (text_key)"))
def prob_shift(spark: SparkSession, d: str) -> DataFrame:
    """Median and largest shift of a probability between two runs; probabilities come in few steps."""
    met = records(spark, d).select("review_id", "min_top").join(records(spark, d, second=True).select("review_id", F.col("min_top").alias("other")), "review_id")
    shift = F.round(F.abs(F.col("min_top") - F.col("other")), 9)
    return met.agg(F.round(F.median(shift), 6).alias("middle"), F.round(F.max(shift), 6).alias("most"))


@query(sql(TWO, f"SELECT count(*) AS pairs, count(*) FILTER ({SAME['intent']}) * 100 >= 70 * count(*) AS intent_mark, count(*) FILTER ({SAME['topic']}) * 100 >= 90 * count(*) AS topic_mark, max(abs(a_severity - b_severity)) <= 3 AS gap_mark FROM p"))
def wording_trial(spark: SparkSession, d: str) -> DataFrame:
    """Which pass marks a candidate wording meets."""
    hit = lambda f, mark: (F.count_if(agreement.same(f)) * 100 >= mark * F.count("*")).alias(f"{f}_mark")
    return paired(spark, d).agg(F.count("*").alias("pairs"), hit("intent", 70), hit("topic", 90), (F.max(F.abs(F.col("a_severity") - F.col("b_severity"))) <= 3).alias("gap_mark"))


HALF = "k AS (SELECT review_id, row_number() OVER (ORDER BY sha256('halves-v1:' || review_id), review_id) - 1 AS place, count(*) OVER () AS n FROM rev)"


@query(sql((*TWO, HALF), f"SELECT {COUNTS} FROM p JOIN k USING (review_id) WHERE place * 2 >= n"))
def holdout(spark: SparkSession, d: str) -> DataFrame:
    """Agreement on the half that no wording was tuned on."""
    revs = reviews(spark, d).select("review_id")
    kept = order.halves(revs, revs.limit(0), "halves-v1").filter("half = 'holdout'").select("review_id")
    return agreement.agreement(paired(spark, d).join(kept, "review_id", "left_semi"))


@query(sql(THREE, f"SELECT CASE WHEN {ALL3} THEN 'agree' ELSE 'differ' END AS engines, count(*) AS records, count(*) FILTER (c_topic = a_topic) AS a_right, count(*) FILTER (c_topic = b_topic) AS b_right FROM q GROUP BY 1"))
def engine_split(spark: SparkSession, d: str) -> DataFrame:
    """How often each is right where both agree and where they differ."""
    part = F.when(agreement.all_same(), "agree").otherwise("differ")
    return three(spark, d).groupBy(part.alias("engines")).agg(F.count("*").alias("records"), F.count_if(F.col("c_topic") == F.col("a_topic")).alias("a_right"), F.count_if(F.col("c_topic") == F.col("b_topic")).alias("b_right"))


@query(sql(THREE, "SELECT a_topic AS topic, count(*) FILTER (a_topic = b_topic) AS direct, count(*) FILTER (a_topic <> b_topic AND contains('alt topic: ' || c_topic, 'alt topic: ' || b_topic)) AS alternate, count(*) FILTER (contains(a_intent, b_intent) OR contains(b_intent, a_intent)) AS overlapping FROM q GROUP BY 1"))
def alt_labels(spark: SparkSession, d: str) -> DataFrame:
    """Hits on the label itself, and on the alternate that a note allows."""
    note = F.concat(F.lit("alt topic: "), F.col("c_topic"))
    other = (F.col("a_topic") != F.col("b_topic")) & F.contains(note, F.concat(F.lit("alt topic: "), F.col("b_topic")))
    overlap = F.contains("a_intent", "b_intent") | F.contains("b_intent", "a_intent")
    return three(spark, d).groupBy(F.col("a_topic").alias("topic")).agg(F.count_if(F.col("a_topic") == F.col("b_topic")).alias("direct"), F.count_if(other).alias("alternate"), F.count_if(overlap).alias("overlapping"))


@query(sql(TWO, "SELECT a_topic AS topic, count(*) AS n, count(*) FILTER (b_intent = 'unclear') AS abstained, count(*) FILTER (b_topic = a_topic AND b_intent IN (a_intent, 'unclear') AND b_severity IN (a_severity, a_severity + 1)) AS accepted, CAST(sum(least(abs(b_severity - a_severity), abs(b_severity - a_severity - 1))) AS BIGINT) AS distance FROM p GROUP BY 1"))
def gold_benchmark(spark: SparkSession, d: str) -> DataFrame:
    """A labeler against sets of accepted answers: joint hits, abstentions, distance to the nearest accepted severity."""
    cases = paired(spark, d).select("review_id", F.col("a_topic").alias("group"), F.array("a_topic").alias("topics"), F.array("a_intent", F.lit("unclear")).alias("intents"), F.array("a_severity", F.col("a_severity") + 1).alias("severities"), F.col("b_topic").alias("topic"), F.col("b_intent").alias("intent"), F.col("b_severity").alias("severity"))
    return agreement.accepted_scores(cases).withColumnRenamed("group", "topic")


GOLD = """gold AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
  pred AS (SELECT review_id, CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS p_quality, CASE WHEN contains(lower(review_text), 'password') THEN 1 ELSE 0 END AS p_toxic FROM rev WHERE """ + h("pred", "review_id", 10) + """ > 0),
  cases AS (SELECT gold.*, p_quality, p_toxic, pred.review_id IS NULL AS missing FROM gold LEFT JOIN pred USING (review_id))"""


def gold_and_predictions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    gold = table(spark, d, "labels").groupBy(F.col("doc_id").cast("string").alias("review_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    made = reviews(spark, d).filter(hash_mod("pred", F.col("review_id"), 10) > 0)
    return gold, made.select("review_id", (F.col("n_chars") >= 500).cast("int").alias("p_quality"), F.contains(F.lower("review_text"), F.lit("password")).cast("int").alias("p_toxic"))


@query(sql((REV, GOLD), "SELECT review_id, quality, p_quality, toxic, p_toxic, missing, coalesce(quality = p_quality, false) AS quality_ok, coalesce(toxic = p_toxic, false) AS toxic_ok FROM cases"))
def golden_cases(spark: SparkSession, d: str) -> DataFrame:
    """A row a gold label, those without a prediction included."""
    return agreement.golden_cases(*gold_and_predictions(spark, d), fields=("quality", "toxic"))


READ = "CASE WHEN {x}_intent IN ('unclear', 'praise', 'request') THEN 1 ELSE {x}_severity END"
SCORE = f"""g AS (SELECT 'as_labeled' AS reading, a_topic = b_topic AS t, a_intent = b_intent AS i, a_severity AS x, b_severity AS y FROM p
  UNION ALL SELECT 'by_rule', a_topic = b_topic, a_intent = b_intent, {READ.format(x="a")}, {READ.format(x="b")} FROM p)"""


@query(sql((*TWO, SCORE), "SELECT reading, count(*) AS cases, count(*) FILTER (t) AS topic, count(*) FILTER (i) AS intent, count(*) FILTER (x = y) AS severity, count(*) FILTER (t AND i AND x = y) AS all_three, CAST(sum(abs(x - y)) AS BIGINT) AS distance FROM g GROUP BY reading"))
def golden_score(spark: SparkSession, d: str) -> DataFrame:
    """A labeler's score against gold labels under two readings: severities as labelled, and by the fixed rule."""
    pair = paired(spark, d)
    ruled = pair.withColumns({f"{x}_severity": by_rule(F.col(f"{x}_intent"), F.col(f"{x}_severity")) for x in "ab"})
    both = pair.withColumn("reading", F.lit("as_labeled")).unionByName(ruled.withColumn("reading", F.lit("by_rule")))
    gap = F.abs(F.col("a_severity") - F.col("b_severity")).cast("long")
    return both.groupBy("reading").agg(F.count("*").alias("cases"), *(F.count_if(agreement.same(f)).alias(f) for f in agreement.FIELDS), F.count_if(agreement.all_same()).alias("all_three"), F.sum(gap).alias("distance"))


@query(sql((REV, GOLD), "SELECT 'quality' AS field, count(*) FILTER (quality = p_quality) AS counted, count(*) FILTER (quality = p_quality) AS saved, true AS equal FROM cases UNION ALL SELECT 'toxic', count(*) FILTER (toxic = p_toxic), count(*) FILTER (toxic = p_toxic) + 1, false FROM cases"))
def golden_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the cases against a saved score, of which one field is wrong on purpose."""
    cases = agreement.golden_cases(*gold_and_predictions(spark, d), fields=("quality", "toxic"))
    saved = cases.agg(F.count_if(F.col("quality_ok")).alias("quality"), (F.count_if(F.col("toxic_ok")) + 1).alias("toxic"))
    return agreement.totals_match(cases, saved, ("quality", "toxic"))


@query(f"WITH s AS (SELECT CASE WHEN {h('cell', 'CAST(doc_id AS VARCHAR)', 20)} = 0 THEN 7 WHEN {h('cell', 'CAST(doc_id AS VARCHAR)', 20)} = 1 THEN NULL ELSE quality END AS quality, toxic FROM labels) SELECT 'quality' AS field, 'not in the list' AS problem, count(*) AS n FROM s WHERE quality NOT IN (0, 1) UNION ALL SELECT 'quality', 'blank', count(*) FROM s WHERE quality IS NULL UNION ALL SELECT 'quote', 'not exact', count(*) FROM labels JOIN documents USING (doc_id) WHERE {h('quote', 'CAST(doc_id AS VARCHAR)', 9)} = 0 OR text IS NULL")
def label_checks(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a gold sheet that are blank or not in the list; some are broken on purpose."""
    at = hash_mod("cell", F.col("doc_id").cast("string"), 20)
    sheet = table(spark, d, "labels").select(F.when(at == 0, 7).when(at == 1, F.lit(None)).otherwise(F.col("quality")).alias("quality"), "toxic")
    cells = agreement.cell_problems(sheet, {"quality": (0, 1), "toxic": (0, 1)})
    wrong = F.when(hash_mod("quote", F.col("doc_id").cast("string"), 9) == 0, "\u0000").otherwise("")
    quoted = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "text"), "doc_id").withColumn("quote", F.concat(F.substring("text", 1, 20), wrong))
    inexact = quoted.filter(~F.coalesce(F.contains("text", "quote"), F.lit(False))).agg(F.count("*").alias("n"))
    return cells.unionByName(inexact.select(F.lit("quote").alias("field"), F.lit("not exact").alias("problem"), "n"))


FLIPS = "k AS (SELECT review_id, row_number() OVER (ORDER BY sha256('flip-v1:' || review_id), review_id) - 1 AS place FROM rec)"


@query(sql((*BASE, FLIPS), "SELECT review_id FROM k WHERE place % 50 = 0"))
def planted_flips(spark: SparkSession, d: str) -> DataFrame:
    """Changes planted in a copy: the comparison must find exactly these."""
    found = records(spark, d)
    flipped = agreement.planted_flips(found, 50, "flip-v1")
    return trace.differing(found, flipped, "review_id", "topic", "intent", "severity")


LOST = h("lost", "review_id", 40)
ORDERS = f"""k AS (SELECT review_id, lang, row_number() OVER (ORDER BY sha256('run-v1:' || review_id), review_id) - 1 AS place FROM rev),
  s AS (SELECT review_id, CASE WHEN {LOST} = 1 THEN 'xx' ELSE lang END AS lang, row_number() OVER (ORDER BY sha256('run-v1:' || review_id), review_id) - 1 AS there FROM rev WHERE {LOST} <> 0 QUALIFY there < 100)"""


@query(sql((REV, ORDERS), "SELECT count(there) AS sampled, count(*) FILTER (there <> place) AS misplaced, count(*) FILTER (there IS NULL OR place IS NULL) AS lacking, count(*) FILTER (s.lang IS DISTINCT FROM k.lang AND there IS NOT NULL AND place IS NOT NULL) AS changed FROM s FULL JOIN (SELECT * FROM k WHERE place < 100) k USING (review_id)"))
def order_check(spark: SparkSession, d: str) -> DataFrame:
    """A sample that lacks some rows and has others changed against the first places of the whole order."""
    rows = reviews(spark, d).select("review_id", "lang")
    at = hash_mod("lost", F.col("review_id"), 40)
    damaged = rows.filter(at != 0).withColumn("lang", F.when(at == 1, "xx").otherwise(F.col("lang")))
    sample = order.hash_sample(damaged, base.SEED, 100).select("review_id", F.col("place").alias("there"), F.col("lang").alias("other"))
    whole = order.position(order.seeded(rows, base.SEED), "order_key", ["review_id"], "place").filter("place < 100").select("review_id", "place", "lang")
    met = sample.join(whole, "review_id", "full_outer")
    both = F.col("there").isNotNull() & F.col("place").isNotNull()
    return met.agg(F.count("there").alias("sampled"), F.count_if(F.col("there") != F.col("place")).alias("misplaced"), F.count_if(~both).alias("lacking"), F.count_if(both & ~F.col("lang").eqNullSafe(F.col("other"))).alias("changed"))


@query(sql((REV, "t AS (SELECT review_id, 'golden' AS tag FROM rev SEMI JOIN (SELECT CAST(doc_id AS VARCHAR) AS review_id FROM labels WHERE toxic = 1) USING (review_id) UNION SELECT review_id, 'long' FROM rev WHERE n_chars > 5000 UNION SELECT review_id, 'copied' FROM rev WHERE text_key IN (SELECT text_key FROM rev GROUP BY text_key HAVING count(*) > 1))", "g AS (SELECT review_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM t GROUP BY review_id)"), "SELECT review_id, tags, row_number() OVER (ORDER BY sha256('items-v1:' || review_id), review_id) - 1 AS place FROM g"))
def rater_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of three sets with the names of their sets, in one salted order."""
    revs = reviews(spark, d)
    toxic = table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("review_id"))
    copied = revs.groupBy("text_key").agg(F.count("*").alias("n")).filter("n > 1").select("text_key")
    sets = {"golden": revs.join(toxic, "review_id", "left_semi"), "long": revs.filter("n_chars > 5000"), "copied": revs.join(copied, "text_key", "left_semi")}
    return order.position(order.seeded(trace.tagged_union(sets, "review_id"), "items-v1"), "order_key", ["review_id"], "place").select("review_id", "tags", "place")


BY_REFERENCE = f"""b AS (SELECT 'b' AS reference, min_top, NOT ({ALL3}) AS wrong, c_topic <> a_topic AS disputed FROM q
  UNION ALL SELECT 'c', min_top, a_topic <> c_topic OR a_intent <> c_intent OR a_severity <> c_severity, c_topic <> a_topic FROM q), k AS (SELECT CAST(unnest({list(CUTS)}) AS DOUBLE) AS cutoff)"""


@query(sql((*THREE, BY_REFERENCE), "SELECT reference, disputed, cutoff, count(*) FILTER (min_top < cutoff) AS flagged, count(*) FILTER (min_top < cutoff AND wrong) AS caught, count(*) FILTER (min_top < cutoff AND NOT wrong) AS agreeing_flagged FROM b, k GROUP BY 1, 2, 3"))
def cutoff_by_reference(spark: SparkSession, d: str) -> DataFrame:
    """The cut-off table against each of two references, disputed records apart."""
    met = three(spark, d).withColumn("disputed", F.col("c_topic") != F.col("a_topic"))
    other = met.withColumns({f"b_{f}": F.col(f"c_{f}") for f in agreement.FIELDS})
    parts = []
    for name, pair in (("b", met), ("c", other)):
        for disputed in (True, False):
            rows = agreement.cutoff_table(pair.filter(F.col("disputed") == disputed), CUTS)
            parts.append(rows.select(F.lit(name).alias("reference"), F.lit(disputed).alias("disputed"), "cutoff", "flagged", "caught", "agreeing_flagged"))
    return reduce(DataFrame.unionByName, parts)


CUT = "CASE doc_id % 5 WHEN 0 THEN CAST(n_chars % 13 AS VARCHAR) WHEN 1 THEN '0.' || CAST(n_chars % 100 AS VARCHAR) WHEN 2 THEN '0.' || CAST(n_chars AS VARCHAR) WHEN 3 THEN '-0.' || CAST(n_chars % 10 AS VARCHAR) ELSE coalesce(lang, '') END"


@query(sql((REV, f"c AS (SELECT review_id, {CUT} AS cell FROM rev)"), "SELECT review_id, cell, coalesce(TRY_CAST(cell AS DECIMAL(20,10)) BETWEEN 0 AND 1 AND TRY_CAST(cell AS DECIMAL(20,10)) * 100 = floor(TRY_CAST(cell AS DECIMAL(20,10)) * 100), false) AS valid FROM c"))
def cutoff_validity(spark: SparkSession, d: str) -> DataFrame:
    """Which cells are cut-offs, numbers from 0 to 1 of at most two decimals."""
    n, kind = F.col("n_chars"), F.col("doc_id") % 5
    after = lambda start, x: F.concat(F.lit(start), x.cast("string"))
    cell = F.when(kind == 0, (n % 13).cast("string")).when(kind == 1, after("0.", n % 100)).when(kind == 2, after("0.", n)).when(kind == 3, after("-0.", n % 10)).otherwise(F.coalesce("lang", F.lit("")))
    return reviews(spark, d).select("review_id", cell.alias("cell")).withColumn("valid", valid_cutoff(F.col("cell")))


OPTIONS = ("billing", "access", "other", "support")


@query(sql((REV, "o AS (SELECT review_id, unnest([" + ", ".join(f"{{'p': {h('opt-' + o, 'text_key', 7)}, 'o': '{o}'}}" for o in OPTIONS) + "], recursive := true) FROM rev)"), "SELECT review_id, arg_min(o, o) AS choice FROM (SELECT * FROM o QUALIFY p = max(p) OVER (PARTITION BY review_id)) GROUP BY review_id"))
def argmax_choice(spark: SparkSession, d: str) -> DataFrame:
    """The option of the largest probability, ties to the first by name."""
    chances = F.create_map(*(x for o in OPTIONS for x in (F.lit(o), hash_mod(f"opt-{o}", F.col("text_key"), 7) / 7.0)))
    return reviews(spark, d).select("review_id", best_option(chances).alias("choice"))


@query(sql(TWO, f"SELECT a_topic AS topic, CAST((2 * count(*) FILTER ({ALL3}) * 1000 + count(*)) // (2 * count(*)) // 10 AS VARCHAR) || '.' || CAST((2 * count(*) FILTER ({ALL3}) * 1000 + count(*)) // (2 * count(*)) % 10 AS VARCHAR) || '%' AS one, CAST((2 * count(*) FILTER ({ALL3}) * 10000 + count(*)) // (2 * count(*)) // 100 AS VARCHAR) || '.' || lpad(CAST((2 * count(*) FILTER ({ALL3}) * 10000 + count(*)) // (2 * count(*)) % 100 AS VARCHAR), 2, '0') || '%' AS two FROM p GROUP BY 1"))
def percent_strings(spark: SparkSession, d: str) -> DataFrame:
    """Agreement by topic in percent, as texts of one and of two decimals."""
    row = agreement.agreement(paired(spark, d), "a_topic")
    return row.select(F.col("a_topic").alias("topic"), percent(F.col("all_three"), F.col("pairs")).alias("one"), percent(F.col("all_three"), F.col("pairs"), 2).alias("two"))


@query(sql(TWO, "SELECT review_id, CASE a_severity WHEN 1 THEN 'topic' WHEN 2 THEN 'severity' END AS field, CASE a_severity WHEN 1 THEN b_topic WHEN 2 THEN CAST(b_severity AS VARCHAR) END AS was FROM p"))
def revisions(spark: SparkSession, d: str) -> DataFrame:
    """What hand-written notes say was revised."""
    field = F.when(F.col("a_severity") == 1, "topic").when(F.col("a_severity") == 2, "severity")
    was = F.when(F.col("a_severity") == 1, F.col("b_topic")).otherwise(F.col("b_severity").cast("string"))
    note = F.coalesce(F.concat(F.lit("seen; revised on day 2: "), field, F.lit(" was "), was, F.lit(" before")), F.lit("no change"))
    return paired(spark, d).select("review_id", revision(note).alias("r")).select("review_id", "r.field", "r.was")


ACCEPTED = ("topic:billing", "topic:other", "source:a")
FAILED = "f AS (SELECT guard FROM (SELECT unnest(['topic:' || topic, 'source:' || source]) AS guard, severity FROM rec) WHERE guard IS NOT NULL GROUP BY guard HAVING count(*) FILTER (severity = 5) * 11 < count(*))"


@query(sql((*BASE, FAILED), "SELECT guard, supplied OR guard NOT IN (" + ", ".join(f"'{g}'" for g in ACCEPTED) + ") AS blocked, supplied FROM f, (SELECT unnest([true, false]) AS supplied)"))
def guard_settlement(spark: SparkSession, d: str) -> DataFrame:
    """Topics and sources with too few of the gravest records are failed guards, of a supplied and of an own labeler; some are accepted."""
    guards = records(spark, d).select(F.explode(F.array(F.concat(F.lit("topic:"), "topic"), F.concat(F.lit("source:"), "source"))).alias("guard"), "severity").filter("guard IS NOT NULL")
    failed = guards.groupBy("guard").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == 5).alias("grave")).filter("grave * 11 < n")
    parts = [agreement.settled_guards(failed, supplied, ACCEPTED).withColumn("supplied", F.lit(supplied)) for supplied in (True, False)]
    return parts[0].unionByName(parts[1])


NOISE = (0, 5, 10, 20)


@query(sql(TWO, f"SELECT topic, noise, round(agree * (1 - noise / 100.0::DOUBLE) + (1 - agree) * (noise / 100.0::DOUBLE) / 7, 6) AS seen FROM (SELECT a_topic AS topic, CAST(count(*) FILTER (a_topic = b_topic) AS DOUBLE) / count(*) AS agree FROM p GROUP BY 1), (SELECT unnest({list(NOISE)}) AS noise)"))
def noise_grid(spark: SparkSession, d: str) -> DataFrame:
    """How noise in the truth, in percent, would lower the agreement of two labelers by topic: wrong labels fall on the seven others alike."""
    agree = paired(spark, d).groupBy(F.col("a_topic").alias("topic")).agg((F.count_if(F.col("a_topic") == F.col("b_topic")) / F.count("*")).alias("agree"))
    grid = agree.select("topic", "agree", F.explode(F.array(*map(F.lit, NOISE))).alias("noise"))
    noise = F.col("noise") / 100
    return grid.select("topic", "noise", F.round(F.col("agree") * (1 - noise) + (1 - F.col("agree")) * noise / 7, 6).alias("seen"))


@query(sql(BASE, "SELECT lang, round(hits / n - 1.959964 * sqrt(hits / n * (1 - hits / n) / n), 6) AS low, round(hits / n + 1.959964 * sqrt(hits / n * (1 - hits / n) / n), 6) AS high FROM (SELECT lang, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (intent = 'complaint') AS DOUBLE) AS hits FROM rec GROUP BY lang)"))
def wald_ci(spark: SparkSession, d: str) -> DataFrame:
    """Wald's interval of the share of complaints by language."""
    tally = records(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("intent") == "complaint").alias("hits"))
    low, high = wald(F.col("hits"), F.col("n"))
    return tally.select("lang", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


#: Clopper and Pearson's ends in SQL: bisection on sums of the binomial distribution.
EXACT_CI = """WITH RECURSIVE %s, tally AS (SELECT topic, count(*) AS n, count(*) FILTER (severity = 5) AS hits FROM rec GROUP BY topic),
  ends AS (SELECT *, unnest([0, 1]) AS upper, 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM tally
    UNION ALL SELECT topic, n, hits, upper, i + 1, CASE WHEN up THEN middle ELSE low END, CASE WHEN up THEN high ELSE middle END
    FROM (SELECT *, CASE WHEN upper = 1 THEN tail > 0.025 ELSE 1 - tail < 0.025 END AS up
      FROM (SELECT *, (low + high) / 2 AS middle, coalesce(list_sum(list_transform(range(hits + upper), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln((low + high) / 2) + (n - k) * ln(1 - (low + high) / 2)))), 0) AS tail
        FROM ends WHERE i < 40))),
  done AS (SELECT topic, n, hits, max(CASE WHEN hits = 0 THEN 0 ELSE (low + high) / 2 END) FILTER (upper = 0) AS low, max(CASE WHEN hits = n THEN 1 ELSE (low + high) / 2 END) FILTER (upper = 1) AS high FROM ends WHERE i = 40 GROUP BY ALL)
SELECT topic, n, hits, round(low, 6) AS low, round(high, 6) AS high FROM done""" % ", ".join(BASE)


@query(EXACT_CI)
def exact_ci(spark: SparkSession, d: str) -> DataFrame:
    """Clopper and Pearson's interval of the share of the worst severity, by topic."""
    tally = records(spark, d).groupBy("topic").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == 5).alias("hits"))
    low, high = clopper_pearson(F.col("hits"), F.col("n"))
    return tally.select("topic", "n", "hits", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


#: Shares of pairs that one labeler alone gets right, held against the third.
ONLY = "o AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, avg(CAST(a_{f} = c_{f} AND b_{f} <> c_{f} AS INT)) AS only_a, avg(CAST(b_{f} = c_{f} AND a_{f} <> c_{f} AS INT)) AS only_b FROM q" for f in agreement.FIELDS) + ")"
#: All splits of all numbers of discordant pairs: ``p`` at even chances, ``w`` at those of the design.
SPLITS = """size AS (SELECT unnest([50, 100, 200]) AS n), design AS (SELECT * FROM o, size),
  even AS (SELECT d, k, exp(lgamma(d + 1) - lgamma(k + 1) - lgamma(d - k + 1) + d * ln(0.5::DOUBLE)) AS p FROM (SELECT d, unnest(range(d + 1)) AS k FROM (SELECT unnest(range(201)) AS d))),
  sums AS (SELECT d, k, sum(p) OVER (PARTITION BY d ORDER BY k) AS cdf FROM even),
  most AS (SELECT d, coalesce(max(k) FILTER (2 * cdf <= 0.05 AND 2 * k < d), -1) AS most FROM sums GROUP BY d),
  splits AS (SELECT field, n, d, k, most, exp(lgamma(n + 1) - lgamma(d + 1) - lgamma(n - d + 1) + d * ln(only_a + only_b) + (n - d) * ln(1 - only_a - only_b)
    + lgamma(d + 1) - lgamma(k + 1) - lgamma(d - k + 1) + k * ln(only_a / (only_a + only_b)) + (d - k) * ln(only_b / (only_a + only_b))) AS w FROM design JOIN (SELECT d, k, most FROM even JOIN most USING (d)) ON d <= n)"""


@query(sql((*THREE, ONLY, SPLITS), "SELECT field, n, round(sum(w) FILTER (k <= most OR d - k <= most), 9) AS power, round(coalesce(sum(w) FILTER (d - k <= most), 0), 9) AS power_a, round(sum(w) FILTER (2 * k > d), 9) AS win, round(sum(w) FILTER (2 * k = d), 9) AS tie, round(sum(w) FILTER (2 * k < d), 9) AS lose FROM splits GROUP BY field, n"))
def mcnemar_power(spark: SparkSession, d: str) -> DataFrame:
    """What samples of 50 to 200 pairs would show of the difference between two labelers."""
    rows = three(spark, d)
    alone = lambda f, one, other: F.avg(((F.col(f"{one}_{f}") == F.col(f"c_{f}")) & (F.col(f"{other}_{f}") != F.col(f"c_{f}"))).cast("int"))
    shares = rows.agg(F.array(*(F.struct(F.lit(f).alias("field"), alone(f, "a", "b").alias("only_a"), alone(f, "b", "a").alias("only_b")) for f in agreement.FIELDS)).alias("x"))
    designs = shares.select(F.explode("x").alias("x"), F.array(*map(F.lit, (50, 100, 200))).alias("sizes")).select("x.*", F.explode("sizes").alias("n"))
    found = significance.mcnemar_power(designs)
    return found.select("field", "n", *(F.round(c, 9).alias(c) for c in ("power", "power_a", "win", "tie", "lose")))
