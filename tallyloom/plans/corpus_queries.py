"""Queries over the corpus: preparing, orders and samples, profiles, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.functions.draws import poisson
from tallyloom.functions.labels import FEATURES, MARKERS, STOP_WORDS
from tallyloom.functions.numbers import wilson
from tallyloom.functions.text import SENTENCE_END, canonical_json, entities, has_content, hash_mod, is_blank, lang_bucket, part_tags, piece_count, pieces, row_sha, shuffled_options, token_estimate, trim_ws
from tallyloom.operators import agreement, corpus, ledger, order
from tallyloom.plans.base import BLANKED, CALLS, PIECES_SQL, REV, SEED, SPLIT_SQL, VERIFY_SEED, blanked, calls, h, reviews, sql, table
from tallyloom.plans.registry import query
from tallyloom.session import settled

# What stands in for feature and stop words of the corpus' invented prose: terms that it has.
TERMS = ("the", "ist", "los", "in", "le", "password", "of the")
NB = "trim(review_text, ' ' || chr(9) || chr(10) || chr(13)) <> ''"
ORDERED = f"o AS (SELECT *, row_number() OVER (ORDER BY sha256('{SEED}:' || review_id), review_id) - 1 AS run_order FROM rev)"


@query(sql((REV,), f"SELECT count(*) AS records, count(*) FILTER (NOT ({NB})) AS empty, count(DISTINCT text_key) FILTER ({NB}) AS distinct_texts, count(*) FILTER ({NB}) - count(DISTINCT text_key) FILTER ({NB}) AS copies FROM rev"))
def prepare_counts(spark: SparkSession, d: str) -> DataFrame:
    return corpus.prepare_counts(reviews(spark, d))


@query(sql((REV, ORDERED, f"orig AS (SELECT text_key, arg_min(review_id, run_order) AS original FROM o WHERE {NB} GROUP BY text_key)"), f"SELECT review_id, CASE WHEN {NB} THEN 'pending' ELSE 'quarantined' END AS status, CASE WHEN NOT ({NB}) THEN 'empty text' END AS reason, run_order, CASE WHEN original <> review_id AND {NB} THEN original END AS cache_source_id FROM o LEFT JOIN orig USING (text_key)"))
def prepare(spark: SparkSession, d: str) -> DataFrame:
    return corpus.prepare(reviews(spark, d), SEED).select("review_id", "status", "reason", "run_order", "cache_source_id")


@query(sql((REV, ORDERED), "SELECT review_id, run_order FROM o"))
def run_order(spark: SparkSession, d: str) -> DataFrame:
    return order.position(order.seeded(reviews(spark, d), SEED), "order_key", ["review_id"], "run_order").select("review_id", "run_order")


@query(sql((REV, ORDERED), f"SELECT text_key, arg_min(review_id, run_order) AS original FROM o WHERE {NB} GROUP BY text_key"))
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    return corpus.originals(reviews(spark, d), SEED)


@query(sql((REV, ORDERED, f"orig AS (SELECT text_key, arg_min(review_id, run_order) AS original FROM o WHERE {NB} GROUP BY text_key)"), "SELECT review_id, run_order FROM o JOIN orig USING (text_key) WHERE original = review_id"))
def pending_originals(spark: SparkSession, d: str) -> DataFrame:
    return corpus.prepare(reviews(spark, d), SEED).filter("status = 'pending' AND cache_source_id IS NULL").select("review_id", "run_order")


@query("SELECT count(*) AS records, count(*) - count(DISTINCT doc_id) AS repeated_ids, count(*) FILTER (trim(coalesce(text, '')) = '') AS empty, count(*) FILTER (lang IS NULL) AS missing_lang, min(n_chars) AS least, max(n_chars) AS most FROM documents")
def profile(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.agg(F.count("*").alias("records"), (F.count("*") - F.countDistinct("doc_id")).alias("repeated_ids"), F.count_if(is_blank(F.col("text"))).alias("empty"), F.count_if(F.col("lang").isNull()).alias("missing_lang"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"))


@query("SELECT source, lang, count(*) AS records, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY GROUPING SETS ((source), (lang), ())")
def profile_by(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "lang", "n_chars")
    return docs.groupingSets([["source"], ["lang"], []], "source", "lang").agg(F.count("*").alias("records"), F.sum("n_chars").alias("chars"))


@query(sql((BLANKED,), f"SELECT review_id FROM rev WHERE NOT ({NB})"))
def empty_text(spark: SparkSession, d: str) -> DataFrame:
    """Records without a text; some are blank on purpose, with white space beyond ASCII."""
    return blanked(spark, d).filter(is_blank(F.col("review_text"))).select("review_id")


@query("SELECT doc_id AS record_id, lang AS language FROM documents WHERE n_chars >= 100 AND n_chars < 1000")
def window_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("n_chars >= 100 AND n_chars < 1000").select(F.col("doc_id").alias("record_id"), F.col("lang").alias("language"))


@query("SELECT event_id, ts FROM events WHERE substr(strftime(ts, '%Y-%m-%d'), 1, 10) >= '2024-01-05' AND strftime(ts, '%Y-%m-%d') < '2024-01-10'")
def date_window(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").filter("ts >= timestamp'2024-01-05' AND ts < timestamp'2024-01-10'").select("event_id", "ts")


@query(sql((REV,), f"SELECT count(*) AS records, CAST(sum(strlen(review_text)) AS BIGINT) AS bytes, count(DISTINCT text_key) AS distinct_texts, (SELECT CAST(sum(b) AS BIGINT) FROM (SELECT text_key, min(strlen(review_text)) AS b FROM rev WHERE {NB} GROUP BY 1)) AS distinct_bytes FROM rev WHERE {NB}"))
def text_volume(spark: SparkSession, d: str) -> DataFrame:
    return corpus.text_volume(reviews(spark, d))


@query(sql((REV,), "SELECT CASE WHEN length(review_text) < 100 THEN 'a' WHEN length(review_text) < 1000 THEN 'b' WHEN length(review_text) < 5000 THEN 'c' ELSE 'd' END AS bucket, count(*) AS n FROM rev GROUP BY 1"))
def length_buckets(spark: SparkSession, d: str) -> DataFrame:
    size = F.length("review_text")
    return reviews(spark, d).groupBy(F.when(size < 100, "a").when(size < 1000, "b").when(size < 5000, "c").otherwise("d").alias("bucket")).agg(F.count("*").alias("n"))


@query(sql((REV,), "SELECT lang, CAST(quantile_disc(length(review_text), 0.5) AS BIGINT) AS p50, CAST(quantile_disc(length(review_text), 0.9) AS BIGINT) AS p90, CAST(quantile_disc(length(review_text), 0.99) AS BIGINT) AS p99 FROM rev GROUP BY lang"))
def length_pct(spark: SparkSession, d: str) -> DataFrame:
    at = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY length(review_text))").cast("long")
    return reviews(spark, d).groupBy("lang").agg(at(0.5).alias("p50"), at(0.9).alias("p90"), at(0.99).alias("p99"))


@query(sql((REV,), "SELECT lang, round(avg(length(review_text)), 4) AS mean, round(stddev_pop(length(review_text)), 4) AS sd FROM rev GROUP BY lang"))
def length_desc(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).groupBy("lang").agg(F.round(F.avg(F.length("review_text")), 4).alias("mean"), F.round(F.stddev_pop(F.length("review_text")), 4).alias("sd"))


@query(sql((REV,), f"SELECT review_id, row_number() OVER (ORDER BY sha256('{VERIFY_SEED}:' || review_id), review_id) - 1 AS place FROM rev WHERE {NB} QUALIFY place < 50"))
def verify_sample(spark: SparkSession, d: str) -> DataFrame:
    some = reviews(spark, d).filter(~is_blank(F.col("review_text")))
    return order.hash_sample(some.select("review_id"), VERIFY_SEED, 50).select("review_id", F.col("place").cast("long").alias("place"))


@query(sql((REV, "k AS (SELECT review_id, row_number() OVER (ORDER BY sha256('nested-v1:' || review_id), review_id) - 1 AS place FROM rev)"), "SELECT review_id, place, 'hundred' AS sample FROM k WHERE place < 100 UNION ALL SELECT review_id, place, 'ten' FROM k WHERE place < 10 UNION ALL SELECT review_id, place, 'next_fifty' FROM k WHERE place >= 100 AND place < 150"))
def nested_samples(spark: SparkSession, d: str) -> DataFrame:
    sizes = {"hundred": (0, 100), "ten": (0, 10), "next_fifty": (100, 150)}
    return order.nested_samples(reviews(spark, d).select("review_id"), "nested-v1", sizes).withColumn("place", F.col("place").cast("long"))


@query(sql((REV, "k AS (SELECT DISTINCT ON (text_key) text_key, review_id FROM rev WHERE lang = 'en' ORDER BY text_key, review_id)"), "SELECT text_key, sha256('distinct-v1:' || text_key) AS order_key FROM k ORDER BY 2, 1 LIMIT 30"))
def distinct_sample(spark: SparkSession, d: str) -> DataFrame:
    keys = reviews(spark, d).filter("lang = 'en'").select("text_key").distinct()
    return order.hash_sample(keys, "distinct-v1", 30, "text_key").select("text_key", "order_key")


@query(sql((REV, "w AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS review_id FROM labels)", "k AS (SELECT review_id, row_number() OVER (ORDER BY sha256('halves-v1:' || review_id), review_id) - 1 AS place, count(*) OVER () AS n FROM rev WHERE review_id NOT IN (SELECT review_id FROM w))"), "SELECT review_id, place, CASE WHEN place * 2 < n THEN 'tune' ELSE 'holdout' END AS half FROM k"))
def halves(spark: SparkSession, d: str) -> DataFrame:
    without = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("review_id"))
    return order.halves(reviews(spark, d).select("review_id"), without, "halves-v1")


@query(sql((REV,), "SELECT review_id, place, CAST(place % 2 AS INTEGER) AS side FROM (SELECT review_id, row_number() OVER (ORDER BY sha256('parity-v1:' || review_id), review_id) - 1 AS place FROM rev)"))
def parity_split(spark: SparkSession, d: str) -> DataFrame:
    return order.alternating(reviews(spark, d).select("review_id"), "parity-v1")


@query(sql((REV,), "SELECT 'exact' AS form, count(DISTINCT review_text) AS distinct_texts FROM rev UNION ALL SELECT 'stripped', count(DISTINCT trim(review_text, ' ' || chr(9) || chr(10) || chr(13))) FROM rev UNION ALL SELECT 'lowered', count(DISTINCT lower(trim(review_text, ' ' || chr(9) || chr(10) || chr(13)))) FROM rev UNION ALL SELECT 'casefold', count(DISTINCT replace(lower(trim(review_text, ' ' || chr(9) || chr(10) || chr(13))), 'ß', 'ss')) FROM rev UNION ALL SELECT 'nfc', count(DISTINCT nfc_normalize(review_text)) FROM rev UNION ALL SELECT 'collapsed', count(DISTINCT regexp_replace(lower(trim(review_text, ' ' || chr(9) || chr(10) || chr(13))), '[ \\t\\r\\n]+', ' ', 'g')) FROM rev"))
def dedup_variants(spark: SparkSession, d: str) -> DataFrame:
    return corpus.dedup_variants(reviews(spark, d))


@query(sql((REV,), "SELECT text_key, count(*) AS copies, min(review_id) AS first_id, count(DISTINCT source) AS sources FROM rev GROUP BY text_key HAVING count(*) > 1"))
def dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return corpus.duplicate_groups(reviews(spark, d), F.countDistinct("source").alias("sources"))


@query(sql((REV,), "SELECT text_key, count(*) AS copies FROM rev GROUP BY text_key HAVING count(*) > 1 ORDER BY copies DESC, text_key LIMIT 15"))
def dup_top(spark: SparkSession, d: str) -> DataFrame:
    return corpus.duplicate_groups(reviews(spark, d)).orderBy(F.desc("copies"), "text_key").limit(15).select("text_key", "copies")


@query(sql((REV,), "SELECT text_key, count(*) AS copies FROM rev GROUP BY text_key HAVING count(*) > 1 AND bool_or(" + h("rate", "review_id", 2) + " = 0) AND bool_or(" + h("rate", "review_id", 2) + " = 1)"))
def mixed_groups(spark: SparkSession, d: str) -> DataFrame:
    """Equal texts whose ratings are both low and high."""
    met = reviews(spark, d).select("text_key", "review_id", hash_mod("rate", F.col("review_id"), 2).alias("quality"))
    mixed = corpus.duplicate_groups(met, F.bool_or(F.col("quality") == 0).alias("low"), F.bool_or(F.col("quality") == 1).alias("high"))
    return mixed.filter("low AND high").select("text_key", "copies")


@query(sql((REV,), "SELECT review_id, sha256(CAST(json_array(review_id, review_text, coalesce(lang, ''), coalesce(source, '')) AS VARCHAR)) AS sha FROM rev"))
def row_digest(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id", row_sha(F.col("review_id"), F.col("review_text"), F.col("lang"), F.col("source")).alias("sha"))


@query(sql((REV, "k AS (SELECT sha256(CAST(json_array(review_id, review_text) AS VARCHAR)) AS s FROM rev)"), "SELECT count(*) AS records, CAST(sum(CAST('0x' || substr(s, 1, 15) AS HUGEINT)) AS VARCHAR) AS digest FROM k"))
def rows_digest(spark: SparkSession, d: str) -> DataFrame:
    keyed = reviews(spark, d).withColumn("s", row_sha(F.col("review_id"), F.col("review_text")))
    return corpus.rows_digest(keyed, F.col("s"))


@query(sql((REV,), """SELECT review_id, sha256('{"lang":' || to_json(lang) || ',"source":' || to_json(source) || '}') AS key FROM rev"""))
def artifact_key(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id", F.sha2(canonical_json(source=F.col("source"), lang=F.col("lang")), 256).alias("key"))


@query(sql((REV, r"s AS (SELECT review_id, list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(review_text, '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), '[\r\n]+', chr(1), 'g'), chr(1)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: regexp_matches(x, '[\pL\pN]')) AS l FROM rev)"), "SELECT review_id, greatest(len(l), 1) AS n_pieces FROM s"))
def piece_counts(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id", F.size(pieces(F.col("review_text"))).cast("long").alias("n_pieces"))


HAS = lambda test: f"count(*) FILTER (len(list_filter(p, lambda x: {test})) > 0)"


@query(sql((REV, PIECES_SQL), f"SELECT max(len(p)) AS most, count(*) FILTER (len(p) = 1) AS single, {HAS('length(x) > 300')} AS with_long, {HAS('length(x) < 3')} AS with_tiny, {HAS(chr(39).join(['regexp_matches(x, ', '[.!?][A-Za-z]', ')']))} AS with_glued, {HAS('NOT contains(review_text, x)')} AS inexact, (SELECT count(*) FROM rev WHERE len(list_filter({SPLIT_SQL}, lambda x: x <> '' AND NOT regexp_matches(x, '[\\pL\\pN]'))) > 0) AS with_empty FROM pc"))
def piece_quality(spark: SparkSession, d: str) -> DataFrame:
    """Records with long, tiny, glued and inexact pieces, and with parts that hold no letter or digit."""
    split = reviews(spark, d).select("review_text", F.split("review_text", SENTENCE_END, -1).alias("parts"))
    cut = split.select(pieces(F.col("review_text"), F.col("parts")).alias("p"), "review_text", F.exists("parts", lambda x: ~has_content(x) & ~is_blank(x)).alias("empty"))
    has = lambda test: F.count_if(F.exists("p", test))
    return cut.agg(
        F.max(F.size("p")).alias("most"), F.count_if(F.size("p") == 1).alias("single"), has(lambda x: F.length(x) > 300).alias("with_long"), has(lambda x: F.length(x) < 3).alias("with_tiny"),
        has(lambda x: x.rlike("[.!?][A-Za-z]")).alias("with_glued"), F.count_if(~F.forall("p", lambda x: F.contains("review_text", x))).alias("inexact"), F.count_if("empty").alias("with_empty"),
    )


@query(sql((REV, PIECES_SQL, "o AS (SELECT lang, list_sort(list(length(review_text)) FILTER (len(p) = 1)) AS l, count(*) AS n FROM pc GROUP BY lang)"), "SELECT lang, len(l) AS n, l[CAST(floor(len(l) * 0.5) AS BIGINT) + 1] AS p50, l[CAST(floor(len(l) * 0.9) AS BIGINT) + 1] AS p90, round(len(l) / CAST(n AS DOUBLE), 6) AS share FROM o WHERE len(l) > 0"))
def single_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Texts of one piece: their share, and lengths at places floor(share * n) of their sorted lengths, by language."""
    cut = settled(reviews(spark, d).select("lang", piece_count(F.col("review_text")).alias("k"), F.length("review_text").alias("size")))  # texts are split once, then numbers are read
    at = {q: agreement.value_at(cut.filter("k = 1"), "lang", "size", q) for q in (0.5, 0.9)}
    share = cut.groupBy("lang").agg(F.round(F.count_if(F.col("k") == 1) / F.count("*"), 6).alias("share"))
    return at[0.5].select("lang", "n", F.col("at").alias("p50")).join(at[0.9].select("lang", F.col("at").alias("p90")), "lang").join(share, "lang")


@query(sql((REV, PIECES_SQL), f"SELECT review_id, NOT ({h('gap', 'review_id', 5)} = 0 AND len(p) >= 3) AS covered FROM pc"))
def cover_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether pieces follow each other through the text without leaving out a letter or digit; from some the second is taken away."""
    every = F.col("every")
    gap = (hash_mod("gap", F.col("review_id"), 5) == 0) & (F.size(every) >= 3)
    cut = reviews(spark, d).select("review_id", "review_text", pieces(F.col("review_text")).alias("every")).select("review_id", "review_text", F.when(gap, F.concat(F.slice(every, 1, 1), F.slice(every, 3, F.greatest(F.size(every) - 2, F.lit(0))))).otherwise(every).alias("p"))

    def step(rest: Column, x: Column) -> Column:
        at = F.call_function("locate", x, rest)
        clean = (at > 0) & ~F.substring(rest, F.lit(1), at - 1).rlike(r"[\p{L}\p{N}]")
        return F.when(clean, F.substring(rest, at + F.length(x), F.lit(2**31 - 1)))

    rest = F.aggregate("p", F.col("review_text"), step)
    return cut.select("review_id", F.coalesce(~rest.rlike(r"[\p{L}\p{N}]"), F.lit(False)).alias("covered"))


PARTS_SQL = {"marks": r"string_split_regex(regexp_replace(review_text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))", "lines": r"string_split_regex(review_text, '[\r\n]+')"}
TRIMMED = lambda parts: f"list_transform({parts}, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13)))"
VARIANTS = "w AS (" + " UNION ALL ".join(f"SELECT '{k}' AS variant, {TRIMMED(v)} AS p FROM rev" for k, v in PARTS_SQL.items()) + f" UNION ALL SELECT 'all', {SPLIT_SQL} FROM rev)"


@query(sql((REV, VARIANTS), "SELECT variant, CAST(sum(len(p)) AS BIGINT) AS pieces, count(*) FILTER (len(list_filter(p, lambda x: x = '')) > 0) AS with_blank, max(len(p)) AS most FROM w GROUP BY variant"))
def splitter_variants(spark: SparkSession, d: str) -> DataFrame:
    """Three splitters over one scan: pieces, records with a blank one, the most in a record."""
    names = {"marks": r"(?<=[.!?])\s+", "lines": r"[\r\n]+", "all": SENTENCE_END}
    parts = F.array(*(F.struct(F.lit(k).alias("variant"), F.transform(F.split("review_text", v, -1), trim_ws).alias("p")) for k, v in names.items()))
    long = reviews(spark, d).select(F.explode(parts).alias("c")).select("c.*")
    return long.groupBy("variant").agg(F.sum(F.size("p")).alias("pieces"), F.count_if(F.exists("p", lambda x: x == "")).alias("with_blank"), F.max(F.size("p")).alias("most"))


@query(sql((REV, PIECES_SQL, "t AS (SELECT unnest(range(len(p))) AS i FROM pc)"), "SELECT 'part_' || chr(CAST(97 + i // 26 AS INTEGER)) || chr(CAST(97 + i % 26 AS INTEGER)) AS tag, count(*) AS n FROM t GROUP BY 1"))
def part_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = reviews(spark, d).select(pieces(F.col("review_text")).alias("p"))
    return parts.select(F.explode(F.map_keys(part_tags(F.col("p")))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query(sql((REV,), "SELECT CAST(sum(len(regexp_extract_all(review_text, '[.!?][^ \\t\\r\\n.!?]'))) AS BIGINT) AS missed FROM rev"))
def missed_marks(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).agg(F.sum(F.regexp_count("review_text", F.lit(r"[.!?][^ \t\r\n.!?]"))).cast("long").alias("missed"))


def named_sql(features: tuple[str, ...]) -> str:
    """``entities`` in SQL: word boundaries stand for the look-arounds, as underscores are taken away first."""
    pattern = "|".join(sorted(features, key=lambda f: (-len(f), f)))
    found = f"regexp_extract_all(replace(lower(review_text), '_', ' '), '\\b({pattern})s?\\b', 1)"
    return f"list_filter({found}, lambda x, i: list_position({found}, x) = i)"


@query(sql((REV, f"w AS (SELECT unnest({named_sql(TERMS)}) AS feature FROM rev)"), "SELECT feature, count(*) AS n FROM w GROUP BY feature HAVING count(*) >= 20"))
def feature_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents that name each feature, of features that twenty or more name; a phrase wins over a word inside it."""
    found = reviews(spark, d).select(F.explode(entities(F.col("review_text"), TERMS)).alias("feature"))
    return found.groupBy("feature").agg(F.count("*").alias("n")).filter("n >= 20")


@query(sql((REV,), f"SELECT review_id, {named_sql(FEATURES + TERMS)} AS entities FROM rev"))
def entity_lists(spark: SparkSession, d: str) -> DataFrame:
    """The features that each text names, once each, in order."""
    return reviews(spark, d).select("review_id", entities(F.col("review_text"), FEATURES + TERMS).alias("entities"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.countDistinct("user_id").alias("users"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, day LIMIT 5")
def busiest_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "day").limit(5)


@query("SELECT month, event_type, n FROM (SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS n, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m') ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r = 1")
def monthly_top(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "event_type").agg(F.count("*").alias("n"))
    top = counts.groupBy("month").agg(F.min(F.struct((-F.col("n")).alias("m"), "event_type", "n")).alias("t"))
    return top.select("month", "t.event_type", "t.n")


@query(sql((REV,), r"SELECT count(*) FILTER (regexp_matches(review_text, '[A-Za-z]')) AS latin, count(*) FILTER (regexp_matches(review_text, '[\x{00C0}-\x{024F}]')) AS accented, count(*) FILTER (regexp_matches(review_text, '[\x{0400}-\x{04FF}]')) AS cyrillic, count(*) FILTER (regexp_matches(review_text, '[0-9]')) AS digits, count(*) FILTER (regexp_matches(review_text, '[^\x00-\x7F]')) AS beyond_ascii FROM rev"))
def script_counts(spark: SparkSession, d: str) -> DataFrame:
    has = lambda p: F.count_if(F.col("review_text").rlike(p))
    return reviews(spark, d).agg(has("[A-Za-z]").alias("latin"), has(r"[À-ɏ]").alias("accented"), has(r"[Ѐ-ӿ]").alias("cyrillic"), has("[0-9]").alias("digits"), has(r"[^\x00-\x7F]").alias("beyond_ascii"))


@query(sql((REV,), "SELECT lang, count(*) FILTER (contains(lower(review_text), 'password') OR contains(lower(review_text), 'token')) AS access, count(*) FILTER (contains(lower(review_text), 'license')) AS license, count(*) AS records FROM rev GROUP BY lang"))
def keyword_prevalence(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("review_text")
    has = lambda *ws: F.count_if(F.greatest(*(F.contains(low, F.lit(w)) for w in ws), F.lit(False)))
    return reviews(spark, d).groupBy("lang").agg(has("password", "token").alias("access"), has("license").alias("license"), F.count("*").alias("records"))


@query(sql((REV,), r"SELECT count(*) FILTER (review_text IN ('', 'NA', 'N/A', 'None', 'null', 'NaN')) AS na_like, count(*) FILTER (regexp_matches(review_text, '^[0-9.,]+$')) AS number_like, count(*) FILTER (regexp_matches(review_text, '^[=+@-]')) AS formula_like, count(*) FILTER (regexp_matches(review_text, '[\x00-\x08\x0B\x0C\x0E-\x1F]')) AS control, count(*) FILTER (regexp_matches(review_text, '^[ \t\r\n]|[ \t\r\n]$')) AS padded FROM rev"))
def text_hazards(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("review_text")
    return reviews(spark, d).agg(
        F.count_if(text.isin("", "NA", "N/A", "None", "null", "NaN")).alias("na_like"), F.count_if(text.rlike("^[0-9.,]+$")).alias("number_like"), F.count_if(text.rlike("^[=+@-]")).alias("formula_like"),
        F.count_if(text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]")).alias("control"), F.count_if(text.rlike(r"^[ \t\r\n]|[ \t\r\n]\z")).alias("padded"),
    )


LISTED = lambda words: "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
BUCKETS = f"""w AS (SELECT lang, regexp_extract_all(lower(review_text), '\\pL+''?\\pL*') AS l FROM rev), t AS (SELECT lang, l, array_to_string(l, '') AS s FROM w),
  b AS (SELECT lang, CASE WHEN length(s) = 0 THEN 'no_letters' WHEN length(regexp_replace(s, '[a-z]', '', 'g')) / CAST(length(s) AS DOUBLE) > 0.3 OR (len(l) >= 2 AND list_has_any(l, {LISTED(MARKERS)})) THEN 'non_english'
    WHEN len(l) >= 4 AND NOT list_has_any(l, {LISTED(STOP_WORDS)}) THEN 'ascii_unsure' WHEN len(l) >= 4 THEN 'english' ELSE 'short' END AS bucket FROM t)"""


@query(sql((REV, BUCKETS), "SELECT lang, bucket, count(*) AS n FROM b GROUP BY lang, bucket"))
def lang_buckets(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).groupBy("lang", lang_bucket(F.col("review_text"), MARKERS, STOP_WORDS).alias("bucket")).agg(F.count("*").alias("n"))


@query(sql((REV, "w AS (SELECT review_id, lang, list_distinct(regexp_extract_all(lower(review_text), '[a-z]+')) AS l FROM rev)"), "SELECT lang, count(*) FILTER (len(list_intersect(l, ['the', 'of', 'and'])) >= 2) AS english, count(*) FILTER (len(list_intersect(l, ['der', 'die', 'und'])) >= 2) AS german, count(*) FILTER (len(list_intersect(l, ['le', 'et', 'que'])) >= 2) AS french FROM w GROUP BY lang"))
def stopword_lang(spark: SparkSession, d: str) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all(F.lower("review_text"), F.lit("[a-z]+"), F.lit(0)))
    lists = {"english": ("the", "of", "and"), "german": ("der", "die", "und"), "french": ("le", "et", "que")}
    seen = reviews(spark, d).select("lang", found.alias("w"))
    return seen.groupBy("lang").agg(*(F.count_if(F.size(F.array_intersect("w", F.array(*map(F.lit, ws)))) >= 2).alias(k) for k, ws in lists.items()))


@query(sql((REV, f"w AS (SELECT source AS part, unnest(list_distinct(regexp_extract_all(lower(review_text), '[a-z]+'))) AS word FROM rev SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 0) USING (doc_id))", f"c AS (SELECT part, word, count(*) AS n, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, word) AS place FROM w WHERE word NOT IN (SELECT unnest({LISTED(STOP_WORDS)})) GROUP BY part, word)"), "SELECT part, place, word, n FROM c WHERE place <= 10"))
def top_words(spark: SparkSession, d: str) -> DataFrame:
    """Words that most documents of low quality have, by part of the corpus, without stop words."""
    low = table(spark, d, "labels").filter("quality = 0").select("doc_id")
    found = F.array_except(F.array_distinct(F.regexp_extract_all(F.lower("review_text"), F.lit("[a-z]+"), F.lit(0))), F.array(*map(F.lit, STOP_WORDS)))
    words = reviews(spark, d).join(low, "doc_id", "left_semi").select(F.col("source").alias("part"), F.explode(found).alias("word"))
    counts = words.groupBy("part", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "word"))
    return counts.withColumn("place", place).filter("place <= 10").select("part", F.col("place").cast("long").alias("place"), "word", "n")


MONTH = "strftime(DATE '2024-01-01' + CAST(doc_id % 200 AS INTEGER), '%Y-%m')"
LOW_WORDS = f"w AS (SELECT DISTINCT doc_id, {MONTH} AS month, unnest(regexp_extract_all(lower(review_text), '[a-z]+')) AS word FROM rev SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 0) USING (doc_id))"
BY_MONTH = f"k AS (SELECT month, word, count(*) AS n FROM w WHERE word NOT IN (SELECT unnest({LISTED(STOP_WORDS)})) GROUP BY month, word), o AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY n DESC, word) AS place FROM k), a AS (SELECT month, count(DISTINCT doc_id) AS documents FROM w GROUP BY month)"


@query(sql((REV, LOW_WORDS, BY_MONTH), "SELECT month, place, word, n, documents, (2 * n * 10000 + documents) // (2 * documents) AS per_ten_thousand FROM o JOIN a USING (month) WHERE place <= 5"))
def top_words_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Words that most documents of low quality have, by month, with the documents of the month that have words."""
    low = table(spark, d, "labels").filter("quality = 0").select("doc_id")
    month = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 200).cast("int")), "yyyy-MM")
    found = F.array_distinct(F.regexp_extract_all(F.lower("review_text"), F.lit("[a-z]+"), F.lit(0)))
    dated = reviews(spark, d).join(low, "doc_id", "left_semi").select(month.alias("month"), found.alias("words")).filter(F.size("words") > 0)
    return order.top_words(dated, "month", STOP_WORDS, 5)


@query(sql((REV, f"c AS (SELECT review_id, unnest(list_distinct(list_filter(regexp_extract_all(review_text || CASE WHEN {h('mark', 'review_id', 3)} = 0 THEN '“x”…' ELSE '¡' END, '\\pP'), lambda x: ord(x) > 127))) AS mark FROM rev)"), "SELECT mark, count(*) AS n FROM c GROUP BY mark"))
def punct_rows(spark: SparkSession, d: str) -> DataFrame:
    """Records that hold each punctuation mark beyond ASCII; two kinds are planted."""
    text = F.concat("review_text", F.when(hash_mod("mark", F.col("review_id"), 3) == 0, "“x”…").otherwise("¡"))
    marks = F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\p{P}&&[^\x00-\x7F]]"), F.lit(0)))
    return reviews(spark, d).select(F.explode(marks).alias("mark")).groupBy("mark").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (regexp_matches(CAST(doc_id AS VARCHAR), '^[0-9]+$')) AS numeric_ids, count(DISTINCT source) AS sources, count(DISTINCT source) - count(DISTINCT lower(source)) AS case_collisions, count(*) FILTER (lang IS NULL OR lang = '') AS blank_lang FROM documents")
def metadata_checks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg(F.count_if(F.col("doc_id").cast("string").rlike("^[0-9]+$")).alias("numeric_ids"), F.countDistinct("source").alias("sources"), (F.countDistinct("source") - F.countDistinct(F.lower("source"))).alias("case_collisions"), F.count_if(F.col("lang").isNull() | (F.col("lang") == "")).alias("blank_lang"))


@query(sql((REV,), "SELECT review_id, greatest(1, CAST(ceil(strlen(review_text) * 10 / 24.0) AS BIGINT)) AS tokens FROM rev"))
def tokens(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id", token_estimate(F.octet_length("review_text")).alias("tokens"))


@query(sql((REV,), "SELECT review_id, list_transform(list_sort(list_transform(['a', 'b', 'c', 'd'], lambda o: sha256('shuffle-v1:' || text_key || ':' || o) || o)), lambda x: right(x, 1)) AS options FROM rev"))
def option_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """Options in an order that depends on the text alone."""
    return reviews(spark, d).select("review_id", shuffled_options(("a", "b", "c", "d"), F.col("text_key"), "shuffle-v1").alias("options"))


@query("SELECT user_id, CAST(max(s) AS DOUBLE) AS max_sliding, (SELECT CAST(max(t) AS DOUBLE) FROM (SELECT sum(v) AS t FROM (SELECT user_id AS u, round(value * 1000) AS v, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS b FROM events) x WHERE x.u = k.user_id GROUP BY b HAVING count(*) = 10)) AS max_aligned FROM (SELECT user_id, n, sum(v) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s FROM (SELECT user_id, event_id, round(value * 1000) AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)) k WHERE n >= 10 GROUP BY user_id")
def window_sum(spark: SparkSession, d: str) -> DataFrame:
    return order.sliding_sums(table(spark, d, "events"), "event_id", F.round(F.col("value") * 1000), 10, "user_id")


@query(sql((REV,), "SELECT review_id, place FROM (SELECT review_id, row_number() OVER (ORDER BY sha256('stride-v1:' || review_id), review_id) - 1 AS place FROM rev) WHERE place % 7 = 0"))
def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    return order.every_nth(reviews(spark, d).select("review_id"), "stride-v1", 7)


@query(sql((REV,), "SELECT lang, count(*) AS n, count(*) FILTER (contains(lower(review_text), 'the')) AS hits, round((hits / n::DOUBLE + 1.959964 * 1.959964 / (2 * n) - 1.959964 * sqrt(hits / n::DOUBLE * (1 - hits / n::DOUBLE) / n + 1.959964 * 1.959964 / (4 * n * n))) / (1 + 1.959964 * 1.959964 / n), 6) AS low, round((hits / n::DOUBLE + 1.959964 * 1.959964 / (2 * n) + 1.959964 * sqrt(hits / n::DOUBLE * (1 - hits / n::DOUBLE) / n + 1.959964 * 1.959964 / (4 * n * n))) / (1 + 1.959964 * 1.959964 / n), 6) AS high FROM rev GROUP BY lang"))
def wilson_ci(spark: SparkSession, d: str) -> DataFrame:
    counts = reviews(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.contains(F.lower("review_text"), F.lit("the"))).alias("hits"))
    low, high = wilson(F.col("hits"), F.col("n"))
    return counts.select("lang", "n", "hits", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query()
def bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """Means of 200 resamples by Poisson weights, all in one pass: a hash of length and round seeds the weight of
    each record among the records of that length, whose weights add up to a Poisson number again.

    Records are counted by length first, so rounds multiply lengths and not records.
    """
    counts = reviews(spark, d).groupBy(F.length("review_text").alias("x")).agg(F.count("*").alias("k"))
    drawn = counts.select("x", "k", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("round")).repartition("round")
    weighed = drawn.withColumn("w", poisson(F.col("k"), "x", "round"))
    return weighed.groupBy("round").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mean"))


DRAWS = """d AS (SELECT r.i AS round, lang, row_number() OVER (PARTITION BY r.i ORDER BY sha256('draw-v1:' || r.i || ':' || review_id), review_id) AS n FROM rev, range(1, 41) AS r(i)),
  a AS (SELECT count(*) FILTER (lang = 'en') AS hits, count(*) AS total FROM rev)"""


@query(sql((REV, DRAWS), "SELECT CAST(round AS INTEGER) AS round, count(*) AS drawn, count(*) FILTER (lang = 'en') AS hits, CAST(round(abs(count(*) FILTER (lang = 'en') / CAST(count(*) AS DOUBLE) - (SELECT hits / CAST(total AS DOUBLE) FROM a)), 6) AS DOUBLE) AS error FROM d WHERE n <= 150 GROUP BY round"))
def monte_carlo(spark: SparkSession, d: str) -> DataFrame:
    """How far the share of a language in 40 draws of 150 records, without replacement, lies from that of all."""
    r = reviews(spark, d).select("review_id", "lang")
    draws = order.repeated_draws(r, "draw-v1", 150, 40).groupBy("round").agg(F.count("*").alias("drawn"), F.count_if(F.col("lang") == "en").alias("hits"))
    whole = r.agg((F.count_if(F.col("lang") == "en") / F.count("*")).alias("share"))
    return draws.crossJoin(F.broadcast(whole)).select("round", "drawn", "hits", F.round(F.abs(F.col("hits") / F.col("drawn") - F.col("share")), 6).alias("error"))


@query(sql((REV, "g AS (SELECT text_key, count(*) AS copies, min(length(review_text)) AS n FROM rev GROUP BY text_key HAVING count(*) > 1)"), "SELECT CASE WHEN n < 100 THEN 'a' WHEN n < 1000 THEN 'b' ELSE 'c' END AS length_class, count(*) AS groups, CAST(sum(copies) AS BIGINT) AS records, max(copies) AS most, max(n) AS longest FROM g GROUP BY 1"))
def dup_classes(spark: SparkSession, d: str) -> DataFrame:
    """Groups of equal texts by class of length: how many, their records, the most copies and the longest text."""
    groups = corpus.duplicate_groups(reviews(spark, d), F.min(F.length("review_text")).alias("n"))
    kind = F.when(F.col("n") < 100, "a").when(F.col("n") < 1000, "b").otherwise("c")
    return groups.groupBy(kind.alias("length_class")).agg(F.count("*").alias("groups"), F.sum("copies").alias("records"), F.max("copies").alias("most"), F.max("n").alias("longest"))


MONTHS = """e AS (SELECT strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d') AS day, event_type, user_id FROM events), u AS (SELECT month, user_id, count(*) AS k FROM e GROUP BY 1, 2), dy AS (SELECT month, day, count(*) AS k FROM e GROUP BY 1, 2)"""


@query(sql((MONTHS,), "SELECT month, count(*) AS n, round(count(*) FILTER (event_type = 'error') / CAST(count(*) AS DOUBLE), 6) AS low_share, (SELECT arg_min(user_id, (-k, user_id)) FROM u WHERE u.month = e.month) AS top_user, (SELECT median(k) FROM dy WHERE dy.month = e.month) AS median_day FROM e GROUP BY month"))
def monthly(spark: SparkSession, d: str) -> DataFrame:
    """By month: rows, the share of bad ones, the commonest subject and the median day."""
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM").alias("month"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "user_id")
    top = e.groupBy("month", "user_id").agg(F.count("*").alias("k")).groupBy("month").agg(F.min(F.struct((-F.col("k")).alias("m"), "user_id"))["user_id"].alias("top_user"))
    days = e.groupBy("month", "day").agg(F.count("*").alias("k")).groupBy("month").agg(F.median("k").alias("median_day"))
    rows = e.groupBy("month").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 6).alias("low_share"))
    return rows.join(top, "month").join(days, "month")


@query(sql((REV, CALLS, f"todo AS (SELECT review_id FROM rev WHERE {h('seen', 'review_id', 3)} > 0)"), "SELECT review_id, (SELECT CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) FROM calls WHERE role = 'verify') AS spent FROM todo ORDER BY sha256('verify-v1:' || review_id), review_id LIMIT 20"))
def verify_queue(spark: SparkSession, d: str) -> DataFrame:
    """The next twenty records to verify, in seeded order, with what was spent so far."""
    todo = reviews(spark, d).filter(hash_mod("seen", F.col("review_id"), 3) > 0).select("review_id")
    spent = calls(spark, d).filter("role = 'verify'").agg(F.sum(F.coalesce("input_tokens", F.lit(0))).alias("spent"))
    return order.hash_sample(todo, VERIFY_SEED, 20).select("review_id").crossJoin(spent)


@query(sql((REV, f"b AS (SELECT doc_id // 10 AS batch, CASE WHEN {h('index', 'review_id', 30)} = 0 THEN 1 ELSE doc_id % 10 + 1 END AS idx, {h('exact', 'review_id', 25)} = 0 OR review_text = '' AS inexact FROM rev)"), "SELECT batch, 'index' AS problem FROM b GROUP BY batch HAVING count(*) <> max(idx) OR count(DISTINCT idx) <> count(*) UNION ALL SELECT DISTINCT batch, 'quote' FROM b WHERE inexact"))
def batch_replies(spark: SparkSession, d: str) -> DataFrame:
    """Batches of replies where an index is missing or repeated, or where a quote is not exact."""
    index = F.when(hash_mod("index", F.col("review_id"), 30) == 0, 1).otherwise(F.col("doc_id") % 10 + 1)
    quote = F.when(hash_mod("exact", F.col("review_id"), 25) == 0, "\u0000").otherwise(F.substring("review_text", 1, 10))
    items = reviews(spark, d).select(F.floor(F.col("doc_id") / 10).alias("batch"), index.alias("idx"), quote.alias("quote"), "review_text")
    inexact = items.filter((F.col("quote") == "") | ~F.contains("review_text", "quote")).select("batch").distinct()
    return ledger.bad_batches(items, "batch", "idx").withColumn("problem", F.lit("index")).unionByName(inexact.withColumn("problem", F.lit("quote")))


STOPS = """n AS (SELECT session, ts, request_id, event_type = 'error' AND user_id = 3 AS fatal, row_number() OVER w AS n, sum(reserved_tokens * 42000) OVER w AS spent, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY session) AS us FROM calls WINDOW w AS (PARTITION BY session ORDER BY ts, request_id)),
  g AS (SELECT session, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY session ORDER BY ts, request_id) AS gap FROM calls WHERE outcome = 'succeeded'),
  f AS (SELECT session, ts, 'cap' AS reason FROM n WHERE spent > 600000000 UNION ALL SELECT session, ts, 'count' FROM n WHERE n >= 35 UNION ALL SELECT session, ts, 'fatal' FROM n WHERE fatal UNION ALL SELECT session, ts, 'time' FROM n WHERE us > 36000000000 UNION ALL SELECT session, ts, 'outage' FROM g WHERE gap > 9000000000)"""


@query(sql((CALLS, STOPS), "SELECT session, arg_min(reason, (ts, reason)) AS reason, min(ts) AS ts FROM f GROUP BY session"))
def stop_conditions(spark: SparkSession, d: str) -> DataFrame:
    """Why and when each session stops: time, count, cap, a fatal answer, or an outage."""
    fatal = calls(spark, d).withColumn("fatal", (F.col("event_type") == "error") & (F.col("user_id") == 3))
    return ledger.stops(fatal, most_us=36_000_000_000, most=35, cap_pico=600_000_000, rate_in=42_000, longest_us=9_000_000_000)


#: A session is a user's day here, so that some end by each condition.
ENDS = """c AS (SELECT user_id || '/' || CAST(session AS VARCHAR) AS session, request_id, ts, outcome, reserved_tokens, event_type = 'error' AND request_id % 40 = 3 AS fatal, request_id % 61 = 5 AS interrupted, request_id % 7 AS item FROM calls),
  n AS (SELECT *, row_number() OVER w AS n, sum(reserved_tokens * 42000) OVER w AS spent, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY session) AS us, count(*) FILTER (outcome = 'failed') OVER w AS f FROM c WINDOW w AS (PARTITION BY session ORDER BY ts, request_id)),
  b AS (SELECT *, f - coalesce(max(CASE WHEN outcome = 'succeeded' THEN f END) OVER (PARTITION BY session ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING), 0) AS since FROM n),
  g AS (SELECT session, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY session ORDER BY ts, request_id) AS gap FROM c WHERE outcome = 'succeeded'),
  f AS (SELECT session, ts, 'cap' AS reason FROM b WHERE spent > 130000000 UNION ALL SELECT session, ts, 'count' FROM b WHERE n >= 6 UNION ALL SELECT session, ts, 'fatal' FROM b WHERE fatal UNION ALL SELECT session, ts, 'time' FROM b WHERE us > 72000000000 UNION ALL SELECT session, ts, 'outage' FROM g WHERE gap > 60000000000
    UNION ALL SELECT session, ts, 'interrupted' FROM b WHERE interrupted UNION ALL SELECT session, ts, 'breaker' FROM b WHERE since >= 2),
  first AS (SELECT session, arg_min(reason, (ts, reason)) AS reason, min(ts) AS ts FROM f GROUP BY session),
  last AS (SELECT session, count(*) FILTER (outcome = 'failed') AS stuck FROM (SELECT session, arg_max(outcome, (ts, request_id)) AS outcome FROM c WHERE outcome <> 'pending' GROUP BY session, item) GROUP BY session),
  e AS (SELECT session, max(ts) AS ended FROM c GROUP BY session)"""


@query(sql((CALLS, ENDS), "SELECT session, coalesce(reason, CASE WHEN coalesce(stuck, 0) > 0 THEN 'stuck' ELSE 'finished' END) AS reason, coalesce(ts, ended) AS ts, coalesce(stuck, 0) AS stuck FROM e LEFT JOIN first USING (session) LEFT JOIN last USING (session)"))
def session_ends(spark: SparkSession, d: str) -> DataFrame:
    """How each session ends: all nine ways, finished and stuck among them."""
    c = calls(spark, d)
    n = F.col("request_id")
    marked = c.withColumns({"session": F.concat_ws("/", "user_id", "session"), "fatal": (F.col("event_type") == "error") & (n % 40 == 3), "interrupted": n % 61 == 5, "item": n % 7})
    return ledger.session_ends(marked, breaker=2, item="item", most_us=72_000_000_000, most=6, cap_pico=130_000_000, rate_in=42_000, longest_us=60_000_000_000)


TRIES = "t AS (SELECT text_key FROM rev JOIN (SELECT review_ids[1] AS review_id FROM calls WHERE outcome = 'failed') USING (review_id) GROUP BY text_key HAVING count(*) >= 2)"


@query(sql((REV, CALLS, TRIES), "SELECT review_id, CASE WHEN t.text_key IS NULL THEN 'pending' ELSE 'quarantined' END AS status FROM rev LEFT JOIN t USING (text_key)"))
def quarantine_copies(spark: SparkSession, d: str) -> DataFrame:
    """A text that failed twice is quarantined with all its copies."""
    revs = reviews(spark, d)
    failed = calls(spark, d).filter("outcome = 'failed'").select(F.col("review_ids")[0].alias("review_id"))
    tried = failed.join(revs.select("review_id", "text_key"), "review_id").groupBy("text_key").agg(F.count("*").alias("n")).filter("n >= 2")
    return revs.select("review_id", "text_key").join(tried, "text_key", "left").select("review_id", F.when(F.col("n").isNull(), "pending").otherwise("quarantined").alias("status"))
