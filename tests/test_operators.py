"""Operators without SQL twins, on small cases with known answers."""

from __future__ import annotations

from math import comb

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.labels import FEATURES, MARKERS, STOP_WORDS
from tallyloom.functions.exact import clopper_pearson, hypergeometric_pmf, mid_p, sign_test
from tallyloom.functions.numbers import micro_mean, six_places
from tallyloom.functions.text import entities, json_string, lang_bucket, part_tags, pieces, scrub, shuffled_options, trim_ws
from tallyloom.operators import agreement, audit, labelling, ledger, memo, order
from tallyloom.plans import corpus_queries
from tallyloom.sources import files
from tallyloom.streaming.classify import classify_stream


def one(spark, column, value: str):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("One. Two!  Three?", ["One.", "Two!", "Three?"]),
        ("a.b c", ["a.b c"]),
        ("Line\nnext\r\n\r\nlast", ["Line", "next", "last"]),
        (" ... !!! ", ["... !!!"]),
        ("これ。それ", ["これ。", "それ"]),
        ("", [""]),
    ],
)
def test_pieces(spark, text, want):
    assert one(spark, pieces(F.col("t")), text) == want


def test_pieces_keep_all_letters(spark):
    text = "Hi there. ok  yes! 3.5 stars\n\n--- \nend"
    found = one(spark, pieces(F.col("t")), text)
    assert all(p in text for p in found)
    assert "".join(c for p in found for c in p if c.isalnum()) == "".join(c for c in text if c.isalnum())
    assert list(one(spark, part_tags(pieces(F.col("t"))), text)) == ["part_aa", "part_ab", "part_ac", "part_ad"]


def test_trimming_knows_unicode_space(spark):
    assert one(spark, trim_ws(F.col("t")), "　\x1f a  b\x85\n") == "a  b"


def test_json_string_escapes_like_compact_json(spark):
    assert one(spark, json_string(F.col("t")), 'a"\\\n\x01\x1fé/') == '"a\\"\\\\\\n\\u0001\\u001fé/"'


def test_entities_are_whole_words_longest_first(spark):
    assert one(spark, entities(F.col("t"), FEATURES), "Smart Shuffle! adsense ads, playlists; shuffle. Ads") == ["smart shuffle", "ads", "playlist", "shuffle"]
    assert one(spark, entities(F.col("t"), ()), "ads") == []


def test_language_buckets(spark):
    bucket = lang_bucket(F.col("t"), MARKERS, STOP_WORDS)
    cases = {"": "no_letters", "12 !": "no_letters", "this is the best app": "english", "good app": "short", "muito bom": "non_english", "хорошее приложение": "non_english", "lorem ipsum dolor amet": "ascii_unsure"}
    for text, want in cases.items():
        assert one(spark, bucket, text) == want, text


def test_scrub_and_option_order(spark):
    assert one(spark, scrub(F.col("t"), "sk-12345678ab"), "Bearer abc.def/=~ and sk-12345678ab, bearer x") == "Bearer [removed] and [removed], bearer x"
    assert one(spark, scrub(F.col("t")), "sk-12345678ab") == "sk-12345678ab"
    a, b = (one(spark, shuffled_options(("x", "y", "z"), F.col("t"), "s"), t) for t in ("one", "two"))
    assert sorted(a) == sorted(b) == ["x", "y", "z"]


def test_exact_numbers(spark):
    rows = spark.createDataFrame([(1, 3, 5, 1), (2, 3, 0, 0), (5, 8, 30, 10)], "s long, n long, w long, l long")
    got = rows.select(six_places(micro_mean("s", "n")).alias("m"), sign_test(F.col("w"), F.col("l")).alias("p")).collect()
    assert [r["m"] for r in got] == ["0.333333", "0.666667", "0.625000"]
    for r, (w, lost) in zip(got, ((5, 1), (0, 0), (30, 10)), strict=True):
        n = w + lost
        assert abs(r["p"] - min(1.0, 2 * sum(comb(n, k) for k in range(min(w, lost) + 1)) / 2**n)) < 1e-9


def test_value_at_place(spark):
    values = [(g, float((i * 7919) % 1009 % 50)) for g, n in (("a", 1000), ("b", 7), ("c", 1)) for i in range(n)]
    got = {r["g"]: r["at"] for r in agreement.value_at(spark.createDataFrame([*values, ("a", None)], "g string, v double"), "g", "v", 0.95).collect()}
    for g in "abc":
        mine = sorted(v for k, v in values if k == g)
        assert got[g] == mine[int(0.95 * len(mine))]


def test_positions_do_not_depend_on_partitions(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("review_id"))
    placed = [order.position(order.seeded(ids.repartition(n), "s"), "order_key", ["review_id"], "place").select("review_id", "place") for n in (1, 7)]
    assert set(map(tuple, placed[0].collect())) == set(map(tuple, placed[1].collect()))
    assert sorted(r["place"] for r in placed[0].collect()) == list(range(500))


def test_labelling_each_text_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(texts: pd.Series) -> pd.DataFrame:
        calls.add(len(texts))
        return pd.DataFrame({"topic": ["other"] * len(texts), "size": texts.str.len()})

    rows = spark.createDataFrame([(str(i), t, t) for i, t in enumerate(["a", "bb", "a", "a"])], "review_id string, review_text string, text_key string")
    got = labelling.label_corpus(rows, labelling.PandasLabeler(model, "topic string, size long")).collect()
    assert sorted((r["review_id"], r["size"]) for r in got) == [("0", 1), ("1", 2), ("2", 1), ("3", 1)]
    assert calls.value == 2


def test_rule_labeler(spark):
    rows = spark.createDataFrame([("1", "I will CANCEL, it crashes"), ("2", "love the lyrics"), ("3", "meh")], "text_key string, review_text string")
    got = {r["text_key"]: (r["topic"], r["intent"], r["severity"]) for r in labelling.RuleLabeler().label(rows).collect()}
    assert got == {"1": ("playback", "cancellation", 3), "2": ("catalog", "praise", 1), "3": ("other", "unclear", 1)}


def test_sentences_roll_up(spark):
    rows = spark.createDataFrame([("r", "Great. Broken. Bad.")], "review_id string, review_text string")

    def label(keys):
        seen = spark.createDataFrame([("Great.", "praise", 1, "other"), ("Broken.", "complaint", 4, "playback"), ("Bad.", "complaint", 4, "billing")], "s string, intent string, severity int, topic string")
        return keys.join(seen.withColumn("text_key", F.sha2("s", 256)), "text_key").drop("s")

    got = labelling.sentence_rollup(rows, label, ("cancellation", "complaint", "request", "praise", "unclear")).first()
    assert (got["intent"], got["severity"], got["topic"], got["sentences"]) == ("complaint", 4, "playback", 3)


def test_memo_checks(spark):
    claims = spark.createDataFrame([("CL-001", "IS-a", "1234"), ("CL-002", "IS-b", "0.500000")], "claim_id string, issue_id string, value string")
    text = '# Memo 9\n1. IS-a had 1,234 cases [CL-001], "77" said one. It fell by 1234.\nA mean of 0.5 [CL-002] but 9 [CL-003].\n## Recommendation\nFix IS-a first, as 88 say [review:r1].\n## Limits\nIt ranks 1.'
    memos = spark.createDataFrame([(1, text), (2, "Churn.")], "memo_id int, memo string")
    issues, evidence, facts = (spark.createDataFrame([(x,) for x in xs], f"{n} string") for xs, n in ((("IS-a", "IS-b"), "issue_id"), (("r1",), "review_id"), (("88",), "value")))
    found = memo.memo_violations(memos, claims, first_issue="IS-a", issues=issues, evidence=evidence, facts=facts).collect()
    got = sorted((r["code"], r["detail"]) for r in found)
    assert got == [
        ("claim_without_issue", "1:CL-002"), ("no_claim", "2"), ("no_limits", "2"), ("no_recommendation", "2"), ("no_review", "2"), ("unknown_claim", "1:CL-003"),
        ("unsupported_number", "1:1234.000000"), ("unsupported_number", "1:9.000000"), ("unsupported_subject", "2"),
    ]
    assert one(spark, memo.section(F.col("t"), "Risks"), "# Intro\na\n## Risks\nb\nc\n# End\nd") == "b\nc"


def test_projection_at_the_size_of_a_full_run(spark):
    measured = spark.createDataFrame([(20_338_561_782_000, 484_189)], "pico_usd long, requests long")
    scenarios = spark.createDataFrame([("all", 660_609, 35_000_000_000_000)], "scenario string, rows long, cap long")
    row = ledger.cost_project(measured, scenarios, F.lit(1000)).first()
    assert int(row["pico_usd"]) == (2 * 20_338_561_782_000 * 660_609 + 1000) // 2000 and int(row["requests"]) == (2 * 484_189 * 660_609 + 1000) // 2000 and row["over_cap"]


def test_intervals_and_tests_against_sums(spark):
    cases = [(0, 10), (3, 10), (10, 10), (27, 60), (1, 1)]
    table = spark.createDataFrame(cases, "k long, n long")
    low, high = clopper_pearson(F.col("k"), F.col("n"))
    tail = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for r in table.select("k", "n", low.alias("low"), high.alias("high"), mid_p(F.col("k"), F.col("n") - F.col("k")).alias("mid"), hypergeometric_pmf(F.lit(1), F.lit(3), F.lit(4), F.lit(9)).alias("hyper")).collect():
        k, n = r["k"], r["n"]
        assert (k == 0 and r["low"] == 0) or abs(1 - tail(k - 1, n, r["low"]) - 0.025) < 1e-6
        assert (k == n and r["high"] == 1) or abs(tail(k, n, r["high"]) - 0.025) < 1e-6
        least, half = min(k, n - k), comb(n, min(k, n - k)) / 2**n / 2
        assert abs(r["mid"] - (1 - half if 2 * k == n else 2 * (tail(least, n, 0.5) - half))) < 1e-9
        assert abs(r["hyper"] - comb(4, 1) * comb(5, 2) / comb(9, 3)) < 1e-12


def test_running_totals_across_buckets(spark):
    rows = [("a" if i % 3 else "b", i, (i * 7919) % 101 - 50) for i in range(300)]
    table = spark.createDataFrame(rows, "g string, at long, v long").repartition(5)
    for largest in (False, True):
        for before in (False, True):
            got = {r["at"]: r["out"] for r in order.running(table, "g", F.floor(F.col("at") / 17), ["at"], F.col("v"), "out", largest=largest, before=before).collect()}
            for g, at, _ in rows:
                seen = [v for h, i, v in rows if h == g and (i < at if before else i <= at)]
                assert got[at] == ((max(seen) if seen else None) if largest else sum(seen))


def test_keys_are_unique_within_their_object(spark):
    for text, want in (('{"a":1}', True), ('{"a":{"x":1},"b":{"x":2}}', True), ('{"a":{"x":1,"x":2}}', False), ('{"a":"}{","b":[{"c":1},{"c":2}]}', True), ('{"a":[{"c":1,"c":2}]}', False), ('{"a":1,"b":{"a":1},"a":2}', False)):
        assert one(spark, audit.unique_keys(F.col("t")), text) is want


def test_each_broken_rule_has_one_flag(spark):
    source = spark.createDataFrame([(str(i), "h", "some text") for i in range(5)], "review_id string, source_sha256 string, review_text string")
    good = ("h", "k", "completed", None, "other", "praise", 1, 0.0, "text", None)
    schema = "review_id string, source_sha256 string, text_key string, status string, reason string, topic string, intent string, severity int, sentiment double, evidence_quote string, cache_source_id string"
    base = [(str(i), *good) for i in range(5)]
    breaks = {"source_mismatch": (1, "x"), "invalid_status": (3, "odd"), "invalid_schema": (7, 6), "unsupported_quote": (9, "txt"), "invalid_cache_reuse": (10, "9"), "unknown_review_id": (0, "77")}
    assert audit.record_violations(spark.createDataFrame(base, schema), source).count() == 0
    for code, (at, value) in breaks.items():
        row = [*base[0]]
        row[at] = value
        found = {r["code"] for r in audit.flags(audit.record_violations(spark.createDataFrame([tuple(row), *base[1:]], schema), source)).collect()}
        also = {"unknown_review_id": {"missing_records"}}.get(code, set())
        assert found == {code, "unfinished_classification", *also}


def test_csv_is_strict(spark, tmp_path):
    (tmp_path / "good.csv").write_bytes('﻿id,text,more\n1,"a ""q"",\nb",x\n2,,y\n'.encode())
    got = files.scan_csv(spark, str(tmp_path / "good.csv"), ("id", "text"), key="id").collect()
    assert [tuple(r) for r in got] == [("1", 'a "q",\nb'), ("2", "")]
    (tmp_path / "twice.csv").write_text("id,text,id\n1,a,2\n")
    (tmp_path / "keys.csv").write_text("id,text\n1,a\n1,b\n")
    for name, message in (("twice.csv", "repeats"), ("keys.csv", "repeated")):
        with pytest.raises(ValueError, match=message):
            files.scan_csv(spark, str(tmp_path / name), ("id", "text"), key="id")
    with pytest.raises(ValueError, match="lacks"):
        files.scan_csv(spark, str(tmp_path / "keys.csv"), ("id", "other"))


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    rows = lambda xs: spark.createDataFrame([(x, x) for x in xs], "text_key string, review_text string")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    label = lambda batch: batch.withColumn("n", F.length("review_text"))
    args = (source, "text_key string, review_text string", label, out, state)
    rows(["a", "bb", "a"]).write.parquet(source)
    assert sorted(r["text_key"] for r in classify_stream(spark, *args).collect()) == ["a", "bb"]
    rows(["bb", "ccc"]).write.mode("append").parquet(source)
    assert sorted(r["text_key"] for r in classify_stream(spark, *args).collect()) == ["a", "bb", "ccc"]


def test_part_tags_of_very_long_texts_are_counted(spark, monkeypatch):
    sizes = [2, 676, 677, 700, 5000]
    table = spark.createDataFrame([(" ".join(f"Part {i}." for i in range(n)),) for n in sizes], "review_text string")
    monkeypatch.setattr(corpus_queries, "reviews", lambda *_: table)
    got = {r["tag"]: r["n"] for r in corpus_queries.part_tag_counts(spark, "unused").collect()}
    assert got == {f"part_{chr(97 + i // 26)}{chr(97 + i % 26)}": sum(i < n for n in sizes) for i in range(5000)}


def test_records_without_an_original_are_dealt_over_tasks_without_their_texts(spark):
    rows = [(str(i), "k", "h", "completed", None, "billing", "praise", 1, 0.0, "some text", None) for i in range(400)]
    schema = "review_id string, text_key string, source_sha256 string, status string, reason string, topic string, intent string, severity int, sentiment double, evidence_quote string, cache_source_id string"
    source = spark.createDataFrame([(str(i), "h", "some text") for i in range(400)], "review_id string, source_sha256 string, review_text string")
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        met = audit.met_records(spark.createDataFrame(rows, schema), source)
        tasks = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == 400 and max(tasks) < 200
    assert "review_text" not in met.columns


def test_a_text_is_split_once_for_its_pieces(spark, capsys):
    texts = spark.createDataFrame([("One. Two! 　\n...\n3",), (" ... ",), ("",)], "t string")
    cut = texts.select(pieces(F.col("t")).alias("p"))
    assert [r["p"] for r in cut.collect()] == [["One.", "Two!", "3"], ["..."], [""]]
    cut.explain()
    assert capsys.readouterr().out.count("split(") == 1


def test_single_pieces_reads_texts_once(spark, capsys):
    corpus_queries.single_pieces(spark, "/root/testdata/sf0.001").explain()
    assert "split(" not in capsys.readouterr().out
