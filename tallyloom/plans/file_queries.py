"""Queries that go through files, streams and memos. Each run writes a folder of its own in the shared place."""

from __future__ import annotations

import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.labels import INTENT_RULES, TOPIC_RULES
from tallyloom.functions.text import hash_mod, scrub
from tallyloom.operators import audit, export, labelling, memo, ranking
from tallyloom.plans.base import BASE, RANKED, REV, calls, h, reviews, sql, table
from tallyloom.plans.label_queries import ranked, rules_sql, with_issues
from tallyloom.plans.registry import query
from tallyloom.session import drop_folder, shared_dir
from tallyloom.sources import exports, files, sheets, stores, zips
from tallyloom.streaming.classify import classify_stream


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def run_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables of a run as it is exported; a ninth of the records is quarantined."""
    found, members = with_issues(spark, d)
    bad = hash_mod("state", F.col("review_id"), 9) == 0
    state = found.withColumns({"status": F.when(bad, "quarantined").otherwise("completed"), "reason": F.when(bad, "no valid answer"), "needs_review": F.col("min_top") < 0.7})
    order_ = ranking.rank(ranking.tally(members, found))
    done = state.filter("status = 'completed'").select("review_id")
    before = done.filter(hash_mod("half", F.col("review_id"), 2) == 0)
    return {"records": state, "calls": calls(spark, d), "membership": members, "ranking": order_, "claims": ranking.claims(order_), "before": before, "after": done}


FIELDS = ("review_id", "review_text", "lang", "source")
CELLS = sql((REV,), "SELECT review_id, review_text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM rev")


def sheet(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("review_id", "review_text", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


@query(CELLS)
def scan_csv(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as CSV and read back exactly by splits, quotes, line feeds and all."""
    path = folder(spark, "csv")
    files.write_csv(sheet(spark, d), path, FIELDS)
    return sheets.scan_csv(spark, path, FIELDS, key="review_id")


BROKEN = h("broken", "review_id", 30)


@query(sql((REV,), f"SELECT CASE {BROKEN} WHEN 0 THEN 'stray_quote' WHEN 1 THEN 'cells' WHEN 2 THEN 'bare_return' ELSE 'none' END AS fault, count(*) AS n FROM rev GROUP BY 1"))
def csv_faults(spark: SparkSession, d: str) -> DataFrame:
    """Records of CSV files that are broken on purpose, by what is wrong, read by splits."""
    path = folder(spark, "csv")
    cell = F.concat(F.lit('"'), F.replace("review_text", F.lit('"'), F.lit('""')), F.lit('"'))
    at = hash_mod("broken", F.col("review_id"), 30)
    more = F.when(at == 0, 'x"y"').when(at == 1, "x,y").when(at == 2, "x\ry").otherwise('"x ""y"""')
    reviews(spark, d).select(F.concat_ws(",", "review_id", cell, more).alias("value")).write.option("lineSep", "\n").text(path)
    found = sheets.csv_records(spark, path).select(F.coalesce(sheets.csv_fault(F.col("value"), 3), F.lit("none")).alias("fault"))
    return found.groupBy("fault").agg(F.count("*").alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, quality, toxic FROM labels")
def scan_sheet(spark: SparkSession, d: str) -> DataFrame:
    """A small sheet with typed cells; cells of a wrong type are refused."""
    path = folder(spark, "sheet")
    files.write_csv(table(spark, d, "labels"), path, ("doc_id", "quality", "toxic"))
    rows = files.scan_csv(spark, path, ("doc_id", "quality", "toxic"))
    if not files.bad_cells(rows, {"quality": "int", "toxic": "int"}).isEmpty():
        raise ValueError("cells of a wrong type")
    return rows.select("doc_id", F.col("quality").try_cast("int").alias("quality"), F.col("toxic").try_cast("int").alias("toxic"))


@query(CELLS)
def scan_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as compressed JSON lines and read back."""
    path = folder(spark, "jsonl")
    files.write_jsonl(sheet(spark, d), path, compressed=True)
    return files.scan_jsonl(spark, path, "review_id string, review_text string, lang string, source string")


BAD = h("line", "review_id", 8)


@query(sql((REV,), f"SELECT {BAD} NOT IN (0, 1, 2, 3) AS line_ok, count(*) AS n FROM rev GROUP BY 1"))
def scan_jsonl_strict(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are one object with each key once; some are broken on purpose."""
    path = folder(spark, "lines")
    at = hash_mod("line", F.col("review_id"), 8)
    line = F.to_json(F.struct("review_id", F.lit(0.5).alias("score")))
    broken = F.when(at == 0, F.concat(F.lit("["), line, F.lit("]"))).when(at == 1, F.lit('{"review_id":"1","review_id":"2"}')).when(at == 2, F.lit('{"review_id":')).when(at == 3, F.lit('{"review_id":"1","score":NaN}')).otherwise(line)
    reviews(spark, d).select(broken.alias("value")).write.text(path)
    return files.scan_jsonl_strict(spark, path, "review_id string, score double").groupBy("line_ok").agg(F.count("*").alias("n"))


@query(sql((REV,), "SELECT review_id FROM rev WHERE contains(lang, 'de')"))
def scan_needle(spark: SparkSession, d: str) -> DataFrame:
    """Lines that hold a text, which is looked for before they are parsed."""
    path = folder(spark, "needle")
    files.write_jsonl(sheet(spark, d).select("review_id", "lang"), path)
    return files.scan_needle(spark, path, '"lang":"de', "review_id string, lang string").select("review_id")


FORMS = "o AS (SELECT review_id, topic, intent, severity, cache_source_id, " + h("state", "review_id", 9) + " AS st FROM rec)"


@query(sql((*BASE, FORMS), "SELECT review_id, CASE WHEN st = 0 THEN 'quarantined' ELSE 'completed' END AS status, CASE WHEN st = 0 THEN 'no valid answer' END AS reason, CASE WHEN st > 0 THEN topic END AS topic, CASE WHEN st > 0 THEN intent END AS intent, CASE WHEN st > 0 THEN CAST(severity AS BIGINT) END AS severity, CASE WHEN st > 0 THEN cache_source_id END AS cache_source_id FROM o"))
def export_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of an exported run, read back: quarantined ones carry their reason only."""
    path = folder(spark, "run")
    export.export_run(spark, path, run_tables(spark, d), gzip_over=1000)
    return files.scan_jsonl(spark, f"{path}/records.jsonl.gz", "review_id string, status string, reason string, topic string, intent string, severity long, cache_source_id string")


@query("SELECT * FROM (VALUES ('records.jsonl.gz'), ('calls.jsonl.gz'), ('membership.csv'), ('ranking.csv'), ('claims.csv'), ('checkpoint_before.json'), ('checkpoint_after.json'), ('run.json')) AS v(file)")
def export_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of an exported run; long ones are compressed and their plain form is gone."""
    path = folder(spark, "run")
    return spark.createDataFrame([(x,) for x in export.export_run(spark, path, run_tables(spark, d), gzip_over=1000)], "file string")


@query(sql(RANKED, f"SELECT issue_id, CAST(rank AS VARCHAR) AS rank, CAST(severity_sum AS VARCHAR) AS priority_score FROM ranking"))
def export_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The ranking of an exported run, read back as exact strings."""
    path = folder(spark, "run")
    export.export_run(spark, path, run_tables(spark, d))
    return files.scan_csv(spark, f"{path}/ranking.csv", ("issue_id", "rank", "priority_score"), key="issue_id")


AT = h("line", "CAST(event_id AS VARCHAR)", 50)
BAD_LINES = f"l AS (SELECT row_number() OVER (ORDER BY event_id) AS line, {AT} AS kind FROM events)"


@query(f"WITH {BAD_LINES} SELECT 'malformed_jsonl' AS code, 'calls.jsonl:' || line AS detail FROM l WHERE kind < 3 UNION ALL SELECT 'unreadable_file', 'claims.csv' UNION ALL SELECT 'ambiguous_file', 'records.jsonl'")
def form_audit(spark: SparkSession, d: str) -> DataFrame:
    """An exported folder that lacks a file, has one in two forms, and has calls of which some lines are no strict JSON."""
    path = folder(spark, "run")
    export.export_run(spark, path, run_tables(spark, d), gzip_over=1000)
    drop_folder(spark, f"{path}/claims.csv")
    drop_folder(spark, f"{path}/calls.jsonl.gz")
    spark.read.text(f"{path}/records.jsonl.gz").write.text(f"{path}/records.jsonl")
    line, at = F.to_json(F.struct("event_id", "user_id")), hash_mod("line", F.col("event_id").cast("string"), 50)
    broken = F.when(at == 0, F.concat(F.lit("["), line, F.lit("]"))).when(at == 1, F.regexp_replace(line, "user_id", "event_id")).when(at == 2, F.regexp_replace(line, "[}]$", "")).otherwise(line)
    table(spark, d, "events").orderBy("event_id").select(broken.alias("value")).write.text(f"{path}/calls.jsonl")
    listed = spark.createDataFrame([(x,) for x in exports.names_of(spark, path)], "file string")
    read = files.strict_lines(files.placed_lines(spark, f"{path}/calls.jsonl"), "event_id long, user_id long").filter("fault IS NOT NULL")
    return audit.form_violations(listed, ("records.jsonl", "calls.jsonl", "claims.csv"), read.select(F.lit("calls.jsonl").alias("file"), (F.col("place") + 1).alias("line")))


@query(sql((REV,), f"SELECT review_id, {h('keys', 'review_id', 5)} NOT IN (2, 3) AS unique_keys FROM rev"))
def json_keys(spark: SparkSession, d: str) -> DataFrame:
    """Whether objects made of the texts name a key twice: equal keys of different objects, or within a text, are no repetition."""
    at = hash_mod("keys", F.col("review_id"), 5)
    cell = F.to_json(F.struct(F.col("review_text").alias("a")))
    said = F.concat(F.lit('"{'), F.lit(r'\"b\":1,\"b\":2'), F.lit('}"'))
    line = (
        F.when(at == 0, F.concat(F.lit('{"a":'), cell, F.lit(',"b":'), cell, F.lit(',"c":['), cell, F.lit(","), cell, F.lit("]}")))
        .when(at == 1, F.concat(F.lit('{"a":'), said, F.lit(',"b":'), cell, F.lit("}")))
        .when(at == 2, F.concat(F.lit('{"b":'), cell, F.lit(',"c":{"x":1,"x":'), cell, F.lit("}}")))
        .when(at == 3, F.concat(F.lit('{"a":'), cell, F.lit(',"a":2}')))
        .otherwise(cell)
    )
    return reviews(spark, d).select("review_id", audit.unique_keys(line).alias("unique_keys"))


TOTALS = "SELECT count(*) AS n, CAST(sum(length(review_text)) AS BIGINT) AS chars, min(source) AS first, max(source) AS last FROM rev"


@query(sql((REV, f"t AS ({TOTALS})"), """SELECT '{"chars":' || chars || ',"mean":null,"sources":{"first":"' || first || '","last":"' || last || '"},"total":' || n || '}' AS document FROM t"""))
def sink_json(spark: SparkSession, d: str) -> DataFrame:
    """A document of totals with sorted keys at every level, written and read back; not a number is null."""
    path = folder(spark, "document")
    ends = F.struct(F.max("source").alias("last"), F.min("source").alias("first"))
    row = reviews(spark, d).agg(F.count("*").alias("total"), ends.alias("sources"), F.lit(float("nan")).alias("mean"), F.sum(F.length("review_text")).alias("chars"))
    files.write_document(row, path)
    return spark.read.text(path).select(F.col("value").alias("document"))


@query(sql((REV,), "SELECT review_id, source, CASE WHEN n_chars % 2 = 0 THEN 'second' ELSE 'first' END AS layout FROM rev"))
def scan_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Answers from files of two layouts, told by their first row; a later file's answer wins."""
    path, revs = folder(spark, "layouts"), reviews(spark, d)
    files.write_jsonl(revs.select("review_id", "source", F.lit("first").alias("layout")), f"{path}/1")
    nested = revs.filter("n_chars % 2 = 0").select(F.struct("review_id").alias("request"), F.struct("source", F.lit("second").alias("layout")).alias("answer"))
    files.write_jsonl(nested, f"{path}/2")
    return files.scan_layouts(spark, [f"{path}/1", f"{path}/2"], "review_id", ("source", "layout"))


#: Texts by source and thousand of ids: a file each, so no file grows with its source.
LINES = "f AS (SELECT coalesce(source, 'none') AS source, doc_id // 1000 AS block, doc_id, {bad} AS changed, review_id || ' ' || text_key || chr(10) AS line FROM rev)"
NAMED = "'source=' || source || '/block=' || block AS file"
LOST, MOVED = h("lost", "review_id", 60) + " = 0", h("moved", "source", 6) + " = 0"
FAULTS = f"k AS (SELECT source, block, bool_or(changed) AS changed FROM f GROUP BY source, block), m AS (SELECT *, {MOVED} AS moved FROM k)"


def write_blocks(spark: SparkSession, d: str, path: str, lost: bool) -> None:
    """A file for each source and thousand of ids, lines in order of id; ``lost`` changes some lines and moves some sources."""
    source = F.coalesce("source", F.lit("none"))
    key = F.when((hash_mod("lost", F.col("review_id"), 60) == 0) & F.lit(lost), "").otherwise(F.col("text_key"))
    moved = F.when((hash_mod("moved", source, 6) == 0) & F.lit(lost), F.concat(source, F.lit("-moved"))).otherwise(source)
    lines = reviews(spark, d).select(moved.alias("source"), F.floor(F.col("doc_id") / 1000).alias("block"), "doc_id", F.concat_ws(" ", "review_id", key).alias("value"))
    target = stores.qualified(spark, path)
    if stores.scheme_of(spark, path) not in stores.STREAMED:
        dealt = stores.spread(lines, "source", "block").sortWithinPartitions("source", "block", "doc_id").drop("doc_id")
        dealt.write.partitionBy("source", "block").text(path)
        return

    def write(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        for source, part in found.sort_values("doc_id").groupby("source"):
            store, inner = stores.opened(f"{target}/source={source}/block={key[0]}/lines.txt")
            store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(inner, compression=None) as file:
                file.write("".join(f"{x}\n" for x in part["value"]).encode())
        return found[[]].head(0)

    stores.spread(lines, "block").groupBy("block").applyInPandas(write, "").write.format("noop").mode("overwrite").save()


@query(sql((REV, LINES.format(bad="false")), f"SELECT {NAMED}, sha256(string_agg(line, '' ORDER BY doc_id)) AS sha256, CAST(sum(strlen(line)) AS BIGINT) AS length FROM f GROUP BY source, block"))
def manifest(spark: SparkSession, d: str) -> DataFrame:
    """A manifest of files (SHA-256 of their bytes, length), written and read back."""
    path = folder(spark, "blocks")
    write_blocks(spark, d, f"{path}/files", lost=False)
    files.write_manifest(spark, f"{path}/files", f"{path}/manifest")
    said = files.scan_jsonl(spark, f"{path}/manifest", "file string, sha256 string, length long")
    return said.select(F.regexp_replace("file", "/[^/]*$", "").alias("file"), "sha256", "length")


@query(sql((REV, LINES.format(bad=LOST), FAULTS), f"SELECT {NAMED}, CASE WHEN moved THEN 'missing' ELSE 'changed' END AS fault FROM m WHERE changed OR moved UNION ALL SELECT 'source=' || source || '-moved/block=' || block, 'unlisted' FROM m WHERE moved"))
def manifest_check(spark: SparkSession, d: str) -> DataFrame:
    """Files that are not what a manifest says: after it was written some lines were changed and some files moved."""
    path = folder(spark, "blocks")
    for name, lost in (("before", False), ("after", True)):
        write_blocks(spark, d, f"{path}/{name}", lost)
    hashes = files.file_hashes(spark, f"{path}/before", f"{path}/before").withColumn("file", F.regexp_replace("file", "/[^/]*$", ""))
    files.write_jsonl(hashes, f"{path}/manifest")
    return files.manifest_faults(spark, f"{path}/after", f"{path}/manifest", F.regexp_replace("file", "/[^/]*$", ""))


def tree_sql(levels: int) -> str:
    step = lambda i: f"t{i + 1} AS (SELECT p // 1024 AS p, sha256(string_agg(d, '' ORDER BY p)) AS d, CAST(sum(n) AS BIGINT) AS n FROM t{i} GROUP BY 1)"
    return ", ".join(step(i) for i in range(levels))


LEAVES = "t0 AS (SELECT row_number() OVER (ORDER BY doc_id, text_key) - 1 AS p, sha256(review_id || ' ' || text_key || ' ' || coalesce(source, '')) AS d, 1 AS n FROM rev)"


@query(sql((REV, LEAVES, tree_sql(4)), "SELECT n AS records, d AS digest FROM t4"))
def ordered_digest(spark: SparkSession, d: str) -> DataFrame:
    """A digest of a table's rows in file order: a tree of hashes over the lines of its files."""
    path = folder(spark, "ordered")
    line = F.concat_ws(" ", "review_id", "text_key", F.coalesce("source", F.lit("")))
    reviews(spark, d).select("doc_id", "text_key", line.alias("value")).orderBy("doc_id", "text_key").select("value").write.text(path)
    return files.lines_digest(spark, path)


def write_zips(rows: DataFrame, path: str) -> None:
    """A zip file for each thousand ids, made where its rows are, with a CSV member for each source."""

    target = stores.qualified(rows.sparkSession, path)

    def write(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        store, inner = stores.opened(f"{target}/{key[0]}.zip")
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(inner, compression=None) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            for source, part in found.sort_values("doc_id").groupby("source"):
                archive.writestr(f"reviews/{source}.csv", part[["at", "id", "body"]].to_csv(index=False, lineterminator="\n"))
        return found[[]].head(0)

    dealt = stores.spread(rows.withColumn("block", F.floor(F.col("doc_id") / 1000)), "block")
    dealt.groupBy("block").applyInPandas(write, "").write.format("noop").mode("overwrite").save()


DAY = "strftime(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER), '%Y-%m-%d') || 'T08:00'"


@query(sql((REV,), f"SELECT review_id, review_text, {DAY} AS ts FROM rev WHERE {DAY} >= '2024-01-15' AND {DAY} < '2024-02-20'"))
def scan_zip(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the CSV members of zip files, renamed, within a window of dates that the reader applies."""
    path = folder(spark, "zips")
    day = F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")), "yyyy-MM-dd"), F.lit("T08:00"))
    write_zips(reviews(spark, d).select("doc_id", F.coalesce("source", F.lit("none")).alias("source"), day.alias("at"), F.col("review_id").alias("id"), F.col("review_text").alias("body")), path)
    return zips.scan_zip(spark, path, {"id": "review_id", "body": "review_text", "at": "ts"}, date="at", start="2024-01-15", end="2024-02-20")


RULES_SQL = f"{rules_sql(TOPIC_RULES, 'other')} AS topic, {rules_sql(INTENT_RULES, 'unclear')} AS intent"
LABELLED = f"SELECT *, CASE WHEN intent IN ('unclear', 'praise', 'request') THEN 1 ELSE 3 END AS severity, CASE WHEN intent = 'praise' THEN 0.5 WHEN intent IN ('unclear', 'request') THEN 0.0 ELSE -0.5 END::DOUBLE AS sentiment FROM (SELECT DISTINCT text_key, {RULES_SQL} FROM rev)"


@query(sql((REV,), LABELLED))
def rule_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels by rule, with severity and tone, one set a text."""
    texts = reviews(spark, d).groupBy("text_key").agg(F.min("review_text").alias("review_text"))
    return labelling.RuleLabeler().label(texts).select("text_key", "topic", "intent", "severity", "sentiment")


@query(sql((REV,), f"SELECT text_key, topic, intent, severity FROM ({LABELLED})"))
def stream_classify(spark: SparkSession, d: str) -> DataFrame:
    """Labels from a stream of files: each text once, whichever batch brings it."""
    path = folder(spark, "stream")
    texts = reviews(spark, d).select("text_key", "review_text")
    texts.write.parquet(f"{path}/in")
    label = lambda batch: labelling.RuleLabeler().label(batch)
    done = classify_stream(spark, f"{path}/in", "text_key string, review_text string", label, f"{path}/out", f"{path}/state")
    return done.select("text_key", "topic", "intent", "severity")


#: Three memos: a good one, one that breaks each rule of a line, one that lacks everything. {v} is a claim's value, {i} its issue.
MEMOS = (
    "## Recommendation\n1. Fix {i} first. It has {v} [CL-001] of 77 records. \"12 of 13\" say [review:r1].\n## Limits\nIt ranks 1, number 4.",
    "## Recommendation\nFix it. IS-nothing has 1,234.5 [CL-001].\nSee [CL-999] and [review:r9]. Revenue falls by 3.\n## Limits\nNone.",
    "All is <|end|> well",
)
MEMO_SQL = """f AS (SELECT issue_id AS i FROM ranking WHERE rank = 1)
  SELECT unnest(['rank_one_missing', 'unsupported_subject', 'no_claim', 'no_review', 'no_recommendation', 'no_limits', 'template_token', 'unknown_claim', 'unknown_review', 'unknown_issue', 'claim_without_issue', 'unsupported_number', 'unsupported_number']) AS code,
  unnest(['2', '2', '3', '3', '3', '3', '3', '2:CL-999', '2:r9', '2:IS-nothing', '2:CL-001', '2:1234.500000', '2:3.000000']) AS detail FROM f"""


@query(f"WITH {', '.join(RANKED)}, {MEMO_SQL}")
def memo_check(spark: SparkSession, d: str) -> DataFrame:
    """Memos that keep and break the rules, against claims, issues, cited records and facts."""
    order_ = ranked(spark, d)
    claims = ranking.claims(order_)
    one = claims.filter("claim_id = 'CL-001'").select("issue_id", "value").first()
    text = [(n + 1, m.format(v=one["value"], i=one["issue_id"])) for n, m in enumerate(MEMOS)]
    facts = spark.createDataFrame([("77",)], "value string")
    cited_ids = spark.createDataFrame([("r1",)], "review_id string")
    return memo.memo_violations(spark.createDataFrame(text, "memo_id int, memo string"), claims, first_issue=one["issue_id"], issues=order_, evidence=cited_ids, facts=facts)


@query(sql((REV,), "SELECT review_id, [CAST(CAST(n_chars AS DECIMAL(30,6)) AS VARCHAR), '1234567.000000', '2.500000'] AS numbers FROM rev"))
def memo_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers that a sentence states itself, without those of citations, ranks, quotes and list items."""
    said = F.concat(F.lit("3. Of "), F.col("n_chars").cast("string"), F.lit(' (rank 2, [CL-004], "40 of 50") 1,234,567 at 2.5 and v1.2 in [review:8]'))
    return reviews(spark, d).select("review_id", F.transform(memo.numbers(said), lambda x: x.cast("string")).alias("numbers"))


@query(sql((REV,), "SELECT review_id, 'Fix ' || lang || chr(10) || 'now' AS recommendation, CAST(NULL AS VARCHAR) AS limits FROM rev"))
def memo_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of a memo by their headings; null where a heading is lacking."""
    text = F.concat(F.lit("# Title\nx\n## recommendation: now\nFix "), F.col("lang"), F.lit("\nnow\n\n### Other\ny"))
    return reviews(spark, d).select("review_id", memo.section(text, "Recommendation").alias("recommendation"), memo.section(text, "Limits").alias("limits"))


@query(sql((REV,), "SELECT review_id, ['CL-' || lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0'), 'CL-007'] AS claims, [review_id] AS reviews, ['IS-access', 'IS-' || lang] AS issues FROM rev WHERE n_chars % 1000 <> 7"))
def citations(spark: SparkSession, d: str) -> DataFrame:
    """Claims, records and issues that a text cites, once each, in order."""
    claim = F.concat(F.lit("[CL-"), F.lpad((F.col("n_chars") % 1000).cast("string"), 3, "0"), F.lit("]"))
    text = F.concat(F.lit("IS-access "), claim, F.lit(" [review:"), F.col("review_id"), F.lit("] IS-"), F.col("lang"), F.lit(" [CL-007]"), claim, F.lit(" CL-008 [review:"), F.col("review_id"), F.lit("]"))
    made = reviews(spark, d).filter("n_chars % 1000 <> 7").select("review_id", text.alias("t"))
    return made.select("review_id", memo.cited(F.col("t")).alias("claims"), memo.cited(F.col("t"), memo.REVIEW).alias("reviews"), memo.cited(F.col("t"), memo.ISSUE, 0).alias("issues"))


@query(sql((REV,), "SELECT review_id, 'Bearer [removed] at [removed] ' || lang || ' bearer x' AS text FROM rev"))
def scrubbed(spark: SparkSession, d: str) -> DataFrame:
    """Error texts as they may be saved: bearer tokens and a given key taken out."""
    said = F.concat(F.lit("Bearer   "), F.col("text_key"), F.lit("~+/= at KEY-1 "), F.col("lang"), F.lit(" bearer x"))
    return reviews(spark, d).select("review_id", scrub(said, "KEY-1").alias("text"))


@query(sql((REV,), f"SELECT review_id, {h('leak', 'review_id', 5)} = 0 AS leaking FROM rev"))
def nested_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Answers with a template token somewhere in their nested values."""
    note = F.when(hash_mod("leak", F.col("review_id"), 5) == 0, "ends </s>").otherwise("ends <s")
    return reviews(spark, d).select("review_id", memo.nested_leaks(F.struct(F.array(F.create_map(F.lit("k"), F.struct(note.alias("note")))).alias("a"))).alias("leaking"))


@query(sql((REV,), "SELECT count(*) AS records, count(*) FILTER (regexp_matches(review_text, '<\\|[a-z_]*\\|?>|</?s>|\\[/?INST\\]')) AS leaking FROM rev"))
def leak_check(spark: SparkSession, d: str) -> DataFrame:
    """Texts with a template token of a model."""
    return reviews(spark, d).agg(F.count("*").alias("records"), F.count_if(memo.leaks(F.col("review_text"))).alias("leaking"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN -(doc_id + 0.5) WHEN doc_id % 3 = 1 THEN doc_id + 0.5 END::DOUBLE AS cell FROM labels")
def tidy(spark: SparkSession, d: str) -> DataFrame:
    """Label cells typed by hand, with Unicode minus, decimal comma and words."""
    number = F.concat(F.col("doc_id").cast("string"), F.lit(",5 "))
    cell = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("−"), number)).when(F.col("doc_id") % 3 == 1, number).otherwise("n/a")
    return table(spark, d, "labels").select("doc_id", memo.tidy_number(cell).alias("cell"))


HIDDEN = h("hidden", "review_id", 25)


@query(sql((REV,), rf"SELECT review_id FROM rev WHERE regexp_matches(review_text, '[\x{{200B}}-\x{{200F}}\x{{202A}}-\x{{202E}}\x{{2060}}\x{{FEFF}}]') OR {HIDDEN} IN (0, 1)"))
def invisible(spark: SparkSession, d: str) -> DataFrame:
    """Texts with characters that do not show or that turn the direction; two are planted, a soft space that shows is not one."""
    at = hash_mod("hidden", F.col("review_id"), 25)
    text = F.concat("review_text", F.when(at == 0, "a\u200bb").when(at == 1, "\u202e").when(at == 2, "\u00a0").otherwise(""))
    return reviews(spark, d).filter(text.rlike(r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}\x{FEFF}]")).select("review_id")
