"""Audit: one query of violations for each rule, all in one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.functions.json import json_fault
from tallyloom.functions.labels import INTENTS, RANKED, TOPICS
from tallyloom.functions.numbers import fraction
from tallyloom.functions.text import is_blank
from tallyloom.operators import ranking
from tallyloom.operators.corpus import EMPTY_REASON
from tallyloom.session import settled

ID = "review_id"


def flagged(df: DataFrame, code: str, detail: str | Column = ID) -> DataFrame:
    """Violations of one rule: its code and what breaks it."""
    shown = F.col(detail) if isinstance(detail, str) else detail
    return df.select(F.lit(code).alias("code"), shown.cast("string").alias("detail"))


def repeated(df: DataFrame, *key: str) -> DataFrame:
    """Keys that come more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def once(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key comes once: a repeated key invalidates all its rows. A semi join on counts, so a key with many rows is no window."""
    single = df.groupBy(key).agg(F.count("*").alias("n")).filter("n = 1").select(key)
    return df.join(single, key, "left_semi")


def unique_keys(json_text: Column) -> Column:
    """Whether no object in a JSON text names a key twice, at any depth; keys are compared as unescaped."""
    return ~json_fault(json_text).eqNullSafe("repeated_key")


def coded(df: DataFrame, rules: dict[str, Column], detail: str = ID) -> DataFrame:
    """Violations of several rules over the same rows, in one pass: a row for each rule that a row breaks."""
    codes = F.array_compact(F.array(*(F.when(broken, code) for code, broken in rules.items())))
    return df.select(F.explode(codes).alias("code"), F.col(detail).cast("string").alias("detail"))


LABELS = ("topic", "intent", "severity", "sentiment", "evidence_quote")


def met_records(records: DataFrame, source: DataFrame) -> DataFrame:
    """Records beside their source (``true_sha``) and their original (``o``): one join each.

    Of rows that share an id one stands as the original, so a repeated original repeats nothing.
    What the rules ask of texts is read off after the first join (``no_text``, ``no_quote``,
    ``exact``; ``evidence_quote`` is its hash from then on), so no text is dealt by its
    original; and records without an original, which are most, are dealt by their own ids.
    """
    known = source.select(ID, F.col("source_sha256").alias("true_sha"), "review_text")
    fields = ("cache_source_id", "text_key", *LABELS)
    hashed = {"evidence_quote": F.sha2("evidence_quote", 256)}
    originals = records.withColumns(hashed).groupBy(F.concat(F.lit("="), ID).alias("__o")).agg(F.min(F.struct(*fields)).alias("o"), F.lit(True).alias("o_there"))
    texts = {"no_text": is_blank(F.col("review_text")), "no_quote": is_blank(F.col("evidence_quote")), "exact": F.coalesce(F.contains("review_text", "evidence_quote"), F.lit(False))}
    read = records.join(known, ID, "left").withColumns(texts).withColumns(hashed).drop("review_text")
    dealt = F.coalesce(F.concat(F.lit("="), "cache_source_id"), F.concat(F.lit("-"), F.xxhash64(ID).cast("string")))
    met = read.withColumn("__o", dealt).join(originals, "__o", "left")
    return met.drop("__o").withColumn("o_there", F.coalesce("o_there", F.lit(False)))


def record_rules() -> dict[str, Column]:
    """What may be wrong with a record of ``met_records``."""
    c = F.col
    known, same = c("true_sha").isNotNull(), c("source_sha256").eqNullSafe(c("true_sha"))
    quarantined, completed = c("status").eqNullSafe("quarantined"), c("status").eqNullSafe("completed")
    schema = F.coalesce(c("topic").isin(*TOPICS) & c("intent").isin(*INTENTS) & c("severity").between(1, 5) & c("sentiment").between(-1, 1) & ~c("no_quote"), F.lit(False))
    differs = reduce(lambda a, b: a | b, [~c(f).eqNullSafe(c(f"o.{f}")) for f in ("text_key", *LABELS)])
    reason = is_blank(c("reason"))
    return {
        "unknown_review_id": ~known,
        "source_mismatch": known & ~same,
        "quarantine_without_reason": known & same & quarantined & reason,
        "incorrect_empty_reason": known & same & quarantined & ~reason & c("no_text") & (c("reason") != EMPTY_REASON),
        "invalid_status": known & same & ~quarantined & ~completed,
        "invalid_schema": known & same & completed & ~schema,
        "unsupported_quote": known & same & completed & schema & ~c("exact"),
        "invalid_cache_reuse": c("cache_source_id").isNotNull() & (~c("o_there") | c("o.cache_source_id").isNotNull() | differs),
    }


def record_violations(records: DataFrame, source: DataFrame) -> DataFrame:
    """Exported records against their source: ids, hashes, states, types, quotes, reuse, and what is left over.

    All rules about one record are read off one joined table; only rules about the set
    (repeated, missing and unfinished ids) group or join by id again.
    """
    parts = [
        coded(met_records(records, source), record_rules()),
        flagged(repeated(records, ID), "duplicate_review_id"),
        flagged(source.join(records.select(ID).distinct(), ID, "left_anti"), "missing_records"),
        flagged(source.filter(~is_blank(F.col("review_text"))).join(valid_records(records, source), ID, "left_anti"), "unfinished_classification"),
    ]
    return reduce(DataFrame.unionByName, parts)


def record_states(records: DataFrame, source: DataFrame) -> DataFrame:
    """A row a known id: ``rows`` (of the export), ``state`` (completed, quarantined or null, if a
    rule is broken or the id is repeated) and ``cached``."""
    wrong = reduce(lambda a, b: a | b, record_rules().values())
    fine = met_records(records, source).filter("true_sha IS NOT NULL").select(ID, F.when(~wrong, F.col("status")).alias("state"), F.col("cache_source_id").isNotNull().alias("cached"))
    return fine.groupBy(ID).agg(F.count("*").alias("rows"), F.max("state").alias("s"), F.max("cached").alias("c")).select(ID, "rows", F.when(F.col("rows") == 1, F.col("s")).alias("state"), F.col("c").alias("cached"))


def valid_records(records: DataFrame, source: DataFrame) -> DataFrame:
    """Ids of completed records that break no rule, with ``cached``."""
    return record_states(records, source).filter("state = 'completed'").select(ID, "cached")


def membership_violations(members: DataFrame, records: DataFrame) -> DataFrame:
    """Issues against records: members that exist, are ranked, are grouped once, none left out."""
    ranked = records.filter((F.col("status") == "completed") & F.col("intent").isin(*RANKED))
    other = records.join(ranked.select(ID), ID, "left_anti")
    issues = members.select("issue_id", ID).distinct().groupBy(ID).agg(F.count("*").alias("n"))
    parts = [
        flagged(members.join(records, ID, "left_anti"), "invalid_membership"),
        flagged(repeated(members, "issue_id", ID), "duplicate_membership"),
        flagged(members.join(other.select(ID), ID, "left_semi"), "noncomplaint_in_ranking"),
        flagged(ranked.join(members, ID, "left_anti"), "ungrouped_complaints"),
        flagged(issues.filter("n > 1"), "undeclared_multi_issue"),
    ]
    return reduce(DataFrame.unionByName, parts)


def ranking_violations(submitted: DataFrame, recomputed: DataFrame) -> DataFrame:
    """A submitted ranking against the recount, cell by cell as texts. Both have a row an issue."""
    text = lambda df: df.select(*(F.col(c).cast("string").alias(c) for c in recomputed.columns))
    a, b = text(submitted), text(recomputed)
    counts = a.agg(F.count("*").alias("n")).crossJoin(b.agg(F.count("*").alias("m"))).filter("n <> m")
    length = flagged(counts, "ranking_length", F.format_string("expected %d, received %d", "m", "n"))
    return reduce(DataFrame.unionByName, [flagged(repeated(a, "issue_id"), "duplicate_ranked_issue", "issue_id"), flagged(a.exceptAll(b), "ranking_mismatch", "issue_id"), flagged(b.exceptAll(a), "ranking_missing", "issue_id"), length])


def claim_violations(claims: DataFrame, true_claims: DataFrame) -> DataFrame:
    """Claims that are missing altogether, malformed or repeated, or say another value than the ranking's cell."""
    cell = true_claims.select("issue_id", "metric", F.col("value").alias("true_value"))
    met = claims.join(cell, ["issue_id", "metric"], "left")
    none = claims.agg(F.count("*").alias("n")).filter("n = 0")
    parts = [
        flagged(none, "missing_claims", F.lit("no claims")),
        flagged(claims.filter(~F.coalesce(F.col("claim_id").rlike("^CL-[0-9]{3,}$"), F.lit(False))), "invalid_claim_id", "claim_id"),
        flagged(repeated(claims, "claim_id"), "invalid_claim_id", "claim_id"),
        flagged(met.filter("NOT value <=> true_value"), "claim_mismatch", "claim_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def checkpoint_violations(before: DataFrame, after: DataFrame, valid: DataFrame) -> DataFrame:
    """Snapshots of finished ids: none repeated, before not empty and a proper subset of after, after within the valid ones."""
    more = after.select(ID).distinct().join(before, ID, "left_anti").agg(F.count("*").alias("n")).filter("n = 0")
    some = before.agg(F.count("*").alias("n")).filter("n = 0")
    parts = [
        flagged(repeated(before, ID), "duplicate_checkpoint_id"),
        flagged(repeated(after, ID), "duplicate_checkpoint_id"),
        flagged(before.join(after, ID, "left_anti"), "resume_snapshot_mismatch"),
        flagged(after.join(valid, ID, "left_anti"), "resume_snapshot_mismatch"),
        flagged(more, "resume_snapshot_mismatch", F.lit("nothing was added")),
        flagged(some, "resume_snapshot_mismatch", F.lit("nothing was finished before")),
    ]
    return reduce(DataFrame.unionByName, parts)


def evidence_violations(calls: DataFrame, valid: DataFrame, before: DataFrame, after: DataFrame, roles: tuple[str, ...]) -> DataFrame:
    """Calls (``request_id``, ``role``, ``outcome``, ``phase``, ``label_config``, ``review_ids``) as evidence
    for the valid records (``review_id``, ``label_config``, ``cached``) and the two snapshots of finished ids."""
    enrich = calls.filter("role = 'enrich'")
    used = enrich.select("request_id", "outcome", "phase", F.col("label_config").alias("used"), F.explode("review_ids").alias(ID))
    met = used.filter("outcome = 'succeeded'").join(valid, ID)
    logged = met.filter("used <=> label_config").select(ID, "phase").distinct()
    own = valid.filter("NOT cached").select(ID)
    first, again = before.join(valid.filter("cached").select(ID), ID, "left_anti"), after.join(before, ID, "left_anti").join(own, ID, "left_semi")
    resumed = again.join(logged.filter("phase = 'resume'"), ID, "left_semi").agg(F.count("*").alias("n")).filter("n = 0")
    said = calls.filter("outcome = 'succeeded'").groupBy("role").agg(F.count("*").alias("n"))
    wanted = calls.sparkSession.createDataFrame([(r,) for r in roles], "role string")
    parts = [
        flagged(enrich.filter("NOT coalesce(phase IN ('initial', 'resume'), false)"), "invalid_run_phase", "request_id"),
        flagged(met.filter("NOT used <=> label_config"), "call_config_mismatch"),
        flagged(used.filter("phase = 'resume'").join(before.distinct(), ID, "left_semi").select("request_id").distinct(), "reprocessed_checkpoint", "request_id"),
        flagged(own.join(logged, ID, "left_anti"), "unlogged_completed_records"),
        flagged(first.join(logged.filter("phase = 'initial'"), ID, "left_anti"), "resume_call_evidence"),
        flagged(resumed, "resume_call_evidence", F.lit("no new record after the resume")),
        flagged(wanted.join(said, "role", "left_anti"), "missing_model_roles", "role"),
    ]
    return reduce(DataFrame.unionByName, parts)


def identity_violations(declared: DataFrame, reference: DataFrame, code: str) -> DataFrame:
    """Fields of a declared identity that differ from the reference's; both tables have one row."""
    fields = [c for c in declared.columns if c in reference.columns]
    long = lambda df, n: df.select(*(F.col(f).cast("string").alias(f) for f in fields)).unpivot([], fields, "field", n)
    return flagged(long(declared, "a").join(long(reference, "b"), "field").filter("NOT a <=> b"), code, "field")


def form_violations(files: DataFrame, wanted: tuple[str, ...], bad_lines: DataFrame) -> DataFrame:
    """Files of an export by name (``file``): wanted ones that are not there, ones that are there both plain
    and compressed, and lines (``file``, ``line``) that are no JSON."""
    plain = files.select(F.regexp_replace("file", r"\.gz$", "").alias("file"))
    there = files.sparkSession.createDataFrame([(w,) for w in wanted], "file string")
    parts = [
        flagged(there.join(plain, "file", "left_anti"), "unreadable_file", "file"),
        flagged(repeated(plain, "file"), "ambiguous_file", "file"),
        flagged(bad_lines, "malformed_jsonl", F.concat_ws(":", "file", F.col("line").cast("string"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def call_violations(calls: DataFrame, valid: DataFrame, roles: tuple[str, ...], outcomes: tuple[str, ...], batch: int) -> DataFrame:
    """Calls against the records they name; ``review_ids`` is an array."""
    ids = calls.select("request_id", F.explode("review_ids").alias(ID))
    parts = [
        flagged(calls.filter(is_blank(F.col("request_id").cast("string"))), "invalid_request_id", "request_id"),
        flagged(repeated(calls, "request_id"), "invalid_request_id", "request_id"),
        flagged(calls.filter(~F.col("role").isin(*roles)), "invalid_call_role", "request_id"),
        flagged(calls.filter(~F.col("outcome").isin(*outcomes)), "invalid_call_outcome", "request_id"),
        flagged(ids.join(valid, ID, "left_anti"), "invalid_call_ids", "request_id"),
        flagged(calls.filter("usage_known AND (input_tokens IS NULL OR input_tokens < 0)"), "invalid_usage", "request_id"),
        flagged(calls.filter(F.size("review_ids") > batch), "unbounded_batch", "request_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def coverage(records: DataFrame, source: DataFrame) -> DataFrame:
    """One row: how much of the source the records cover, and the points for it: a fifth for a complete
    ingestion, a fifth for the share accounted for, three fifths for the share of texts labelled."""
    states = record_states(records, source)
    per_id = source.select(ID, (~is_blank(F.col("review_text"))).alias("labelable")).join(states, ID, "left")
    completed, quarantined = F.coalesce(F.col("state") == "completed", F.lit(False)), F.coalesce(F.col("state") == "quarantined", F.lit(False))
    row = per_id.agg(
        F.count("*").alias("expected"), F.count("rows").alias("unique_ids"), F.count_if(F.col("rows") > 1).alias("duplicate_ids"), F.count_if(completed).alias("completed"), F.count_if(quarantined).alias("quarantined"),
        F.count_if(F.col("labelable")).alias("labelable"), F.count_if(completed & F.col("cached")).alias("cache_reuses"), F.count_if(completed & F.col("labelable")).alias("labelled"),
    )
    row = row.crossJoin(records.agg(F.count("*").alias("received")))
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    row = row.withColumns({"missing": F.col("expected") - F.col("unique_ids"), "unresolved": F.col("unique_ids") - F.col("completed") - F.col("quarantined"), "accounted": F.col("completed") + F.col("quarantined")})
    full = (F.col("unique_ids") == F.col("expected")).cast("double")
    points = F.round(0.2 * full + 0.2 * share("accounted", "expected") + 0.6 * share("labelled", "labelable"), 4)
    return row.select("*", fraction(F.col("labelled"), F.col("labelable")).alias("labelable_fraction"), fraction(F.col("accounted"), F.col("expected")).alias("accounted_fraction"), fraction(F.col("completed"), F.col("expected")).alias("completed_fraction"), points.alias("points"))


def against_full(sample: DataFrame, full: DataFrame, key: str, content: str) -> DataFrame:
    """Rows of a sample that the full table lacks (``absent``) or holds with other content (``changed``)."""
    known = full.select(key, F.col(content).alias("__there"))
    met = sample.select(key, content).join(known, key, "left")
    problem = F.when(F.col("__there").isNull(), "absent").when(F.col("__there") != F.col(content), "changed")
    return met.select(key, problem.alias("problem")).filter("problem IS NOT NULL")


def flags(violations: DataFrame, examples: int = 10) -> DataFrame:
    """Violations by code, with the first few as examples: partial counts first, then the least details by code."""
    listed = violations.groupBy("code", "detail").agg(F.count("*").alias("n"))

    order = Window.partitionBy("code").orderBy("detail")
    first = listed.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= examples)
    shown = first.groupBy("code").agg(F.concat_ws(",", F.sort_array(F.collect_list("detail"))).alias("examples"))
    return listed.groupBy("code").agg(F.sum("n").alias("n")).join(shown, "code").select("code", "n", "examples")


def usage_violations(calls: DataFrame) -> DataFrame:
    """Token counts (as written) that are no whole numbers from 0, one for each of the two."""
    fields = F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).rlike("^[0-9]+$"), F.lit(False)).alias("fine")) for f in ("input_tokens", "output_tokens")))
    bad = calls.select("request_id", F.explode(fields).alias("x")).filter("NOT x.fine")
    return flagged(bad, "invalid_usage", F.concat_ws(":", "request_id", "x.field"))


def export_violations(tables: dict[str, DataFrame], source: DataFrame, *, roles: tuple[str, ...] = ("enrich", "verify", "group", "memo"), outcomes: tuple[str, ...] = ("succeeded", "failed")) -> DataFrame:
    """All that is wrong with the tables of an export folder, recounted from ``source`` (``review_id``, ``source_sha256``, ``review_text``).

    Rankings, claims, memberships and snapshots are held against valid records alone: a record
    that breaks a rule counts nowhere else. A call that names an unknown record, or does not
    say which it covers, is no evidence.
    """
    said = tables["records"].join(source.select(ID, F.sha2("review_text", 256).alias("true_key")), ID, "left")
    typed = {"severity": F.col("severity").try_cast("int"), "sentiment": F.col("sentiment").try_cast("double"), "source_sha256": F.coalesce("source_sha256", "text_key"), "text_key": F.col("true_key")}
    records = settled(said.withColumns(typed).drop("true_key"))
    states = settled(record_states(records, source))
    finished = states.filter("state = 'completed'").select(ID, "cached")
    valid = settled(records.join(finished, ID))
    members, calls = tables["membership"], tables["calls"]
    recounted = ranking.rank(ranking.tally(ranking.membership(valid), valid))
    before, after = tables["checkpoint_before"].select(ID), tables["checkpoint_after"].select(ID)
    covers = F.coalesce("review_ids", F.array(F.lit(None).cast("string")))  # one unknown record where a call does not say
    named = calls.select("request_id", F.explode(covers).alias(ID))
    astray = named.join(source, ID, "left_anti").select("request_id").distinct()
    evidence = calls.filter("review_ids IS NOT NULL").join(astray, "request_id", "left_anti")
    names = calls.filter(is_blank(F.coalesce("request_id", F.lit("")))), repeated(calls.filter("request_id IS NOT NULL"), "request_id")
    shown = F.coalesce("request_id", F.lit("none"))
    parts = [
        record_violations(records, source),
        membership_violations(members, valid),
        ranking_violations(tables["ranking"], recounted).withColumn("code", F.regexp_replace("code", "^ranking_missing$", "ranking_mismatch")),
        claim_violations(tables["claims"], ranking.claims(recounted)),
        checkpoint_violations(before, after, finished.select(ID)),
        evidence_violations(evidence, valid.select(ID, "label_config", "cached"), before, after, roles),
        *(flagged(bad, "invalid_request_id", shown) for bad in names),
        flagged(calls.filter(~F.coalesce(F.col("role").isin(*roles), F.lit(False))), "invalid_call_role", shown),
        flagged(calls.filter(~F.coalesce(F.col("outcome").isin(*outcomes), F.lit(False))), "invalid_call_outcome", shown),
        flagged(astray, "invalid_call_ids", shown),
        usage_violations(calls),
    ]
    return reduce(DataFrame.unionByName, parts)
