"""Two labelers compared: agreement, confusion, class metrics, cut-offs, arms of a trial."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.functions.labels import by_rule
from tallyloom.functions.numbers import fraction
from tallyloom.operators.order import every_nth

FIELDS = ("topic", "intent", "severity")


def pairs(a: DataFrame, b: DataFrame, key: str = "review_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Labels side by side: ``a_topic``, ``b_topic`` and on, for ids that both have, and the columns of ``a`` to keep."""
    left, right = (x.select(key, *more, *(F.col(f).alias(f"{n}_{f}") for f in FIELDS)) for x, n, more in ((a, "a", keep), (b, "b", ())))
    return left.join(right, key)


def same(field: str) -> Column:
    return F.col(f"a_{field}").eqNullSafe(F.col(f"b_{field}"))


def all_same() -> Column:
    """Whether all fields of a pair are equal."""
    return reduce(lambda x, y: x & y, map(same, FIELDS))


def agreement(paired: DataFrame, *by: str) -> DataFrame:
    """Pairs, equal ones by field, and those equal in all, overall or by group."""
    return paired.groupBy(*by).agg(F.count("*").alias("pairs"), *(F.count_if(same(f)).alias(f) for f in FIELDS), F.count_if(all_same()).alias("all_three"))


def stacked(paired: DataFrame, *keep: str) -> DataFrame:
    """A row for each field of each pair: ``field``, ``a``, ``b``."""
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").cast("string").alias("a"), F.col(f"b_{f}").cast("string").alias("b")) for f in FIELDS))
    return paired.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*")


def confusion(paired: DataFrame) -> DataFrame:
    """How often the one says a where the other says b."""
    return stacked(paired).groupBy("field", "a", "b").agg(F.count("*").alias("n"))


def class_metrics(paired: DataFrame) -> DataFrame:
    """Support, predictions, hits, recall, precision and F1 of each class, a being the truth.

    Rates come from the confusion counts, which are few.
    """
    counts = confusion(paired)
    truth = counts.groupBy("field", F.col("a").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("hits"))
    said = counts.groupBy("field", F.col("b").alias("class")).agg(F.sum("n").alias("predicted"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = truth.join(said, ["field", "class"], "full_outer").select("field", "class", zero("support").alias("support"), zero("predicted").alias("predicted"), zero("hits").alias("hits"))
    return joined.select("*", fraction(F.col("hits"), F.col("support")).alias("recall"), fraction(F.col("hits"), F.col("predicted")).alias("precision"), fraction(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"))


def cutoff_table(paired: DataFrame, cuts: tuple[float, ...]) -> DataFrame:
    """For each cut-off on ``min_top``: flagged pairs, flagged among the differing, and among the equal."""
    differ = ~all_same()
    flags = [F.col("min_top") < c for c in cuts]
    aggs = [F.struct(F.lit(c).alias("cutoff"), F.count_if(f).alias("flagged"), F.count_if(f & differ).alias("caught"), F.count_if(f & ~differ).alias("agreeing_flagged")) for c, f in zip(cuts, flags, strict=True)]
    return paired.agg(F.array(*aggs).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def change_rate(paired: DataFrame) -> DataFrame:
    """Pairs whose label changed, by field and in any, with hundredths of a percent, half up."""
    changed = {f: ~same(f) for f in FIELDS} | {"any": ~all_same()}
    row = paired.agg(F.count("*").alias("pairs"), *(F.count_if(c).alias(k) for k, c in changed.items()))
    long = row.unpivot(["pairs"], list(changed), "field", "changed")
    return long.select("field", "pairs", "changed", F.expr("(2 * changed * 10000 + pairs) DIV (2 * pairs)").alias("per_ten_thousand"))


def transitions(paired: DataFrame, field: str, top: int) -> DataFrame:
    """The most frequent changes, ties by name."""
    moved = paired.filter(~same(field)).groupBy(F.concat_ws(" -> ", f"a_{field}", f"b_{field}").alias("change")).agg(F.count("*").alias("n"))
    return moved.orderBy(F.desc("n"), "change").limit(top)


def rule_changes(records: DataFrame) -> DataFrame:
    """Labels that the fixed severity rule would change, by intent."""
    ruled = records.withColumn("ruled", by_rule(F.col("intent"), F.col("severity")))
    return ruled.groupBy("intent").agg(F.count("*").alias("records"), F.count_if(F.col("ruled") != F.col("severity")).alias("changed"))


def severity_error(paired: DataFrame) -> DataFrame:
    """Signed and absolute differences of severity, as sums and as means to six places, and
    the mean absolute difference of sentiments, which are exact decimals of three places."""
    gap = (F.col("b_severity") - F.col("a_severity")).cast("long")
    tone = F.abs(F.col("b_sentiment").cast("decimal(10,3)") - F.col("a_sentiment").cast("decimal(10,3)"))
    row = paired.agg(F.count("*").alias("pairs"), F.sum(gap).alias("signed"), F.sum(F.abs(gap)).alias("absolute"), F.sum(tone).cast("double").alias("tone"))
    mean = lambda c: fraction(F.col(c), F.col("pairs"))
    return row.select("pairs", "signed", "absolute", mean("signed").alias("mean_signed"), mean("absolute").alias("mean_absolute"), mean("tone").alias("sentiment_mae"))


def macro_f1(metrics: DataFrame) -> DataFrame:
    """By field, how many classes the truth has and the mean of their F1 to six places; ``metrics`` is of ``class_metrics``."""
    return metrics.filter("support > 0").groupBy("field").agg(F.count("*").alias("classes"), F.round(F.avg("f1"), 6).alias("macro_f1"))


def gaps(paired: DataFrame) -> DataFrame:
    """How often the severities of two raters are how far apart."""
    return paired.groupBy((F.col("a_severity") - F.col("b_severity")).alias("gap")).agg(F.count("*").alias("n"))


def side_tally(three: DataFrame) -> DataFrame:
    """Where two raters differ, whom a third agrees with, by field and over ``all`` of them; ``c_`` are the third's labels."""
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.when(F.col(f"c_{f}").eqNullSafe(F.col(f"a_{f}")), "a").when(F.col(f"c_{f}").eqNullSafe(F.col(f"b_{f}")), "b").otherwise("neither").alias("side"), (~same(f)).alias("differ")) for f in FIELDS))
    long = three.select(F.explode(cells).alias("c")).select("c.*").filter("differ")
    counted = long.groupBy("field", "side").agg(F.count("*").alias("n"))
    return counted.unionByName(counted.groupBy("side").agg(F.sum("n").alias("n")).withColumn("field", F.lit("all")))


def arms(results: dict[str, DataFrame], key: str = "review_id") -> DataFrame:
    """Labels of several arms in one row for ids that all have: ``topic_x`` and on."""
    renamed = [df.select(key, *(F.col(f).alias(f"{f}_{name}") for f in FIELDS)) for name, df in results.items()]
    return reduce(lambda x, y: x.join(y, key), renamed)


def arm_changes(met: DataFrame, compared: list[tuple[str, str]], anchor: int, sets: str = "set", most: int = 90) -> DataFrame:
    """Changed labels between arms of ``arms``, by set of records and over ``all``: whether at most
    ``anchor`` of a hundred changed, whether none did, and whether the second arm has collapsed,
    which is one topic for over ``most`` of a hundred records. Topics are counted first."""
    topics = sorted({y for _, y in compared})
    differ = {x + y: ~reduce(lambda p, q: p & q, [F.col(f"{f}_{x}").eqNullSafe(F.col(f"{f}_{y}")) for f in FIELDS]) for x, y in compared}
    named = met.withColumn(sets, F.explode(F.array(F.col(sets), F.lit("all"))))
    rows = named.groupBy(sets).agg(F.count("*").alias("pairs"), *(F.count_if(c).alias(k) for k, c in differ.items()))
    long = rows.unpivot([sets, "pairs"], list(differ), "arms", "changed").withColumn("arm", F.substring("arms", 2, 1))
    said = named.select(sets, F.explode(F.array(*(F.struct(F.lit(y).alias("arm"), F.col(f"topic_{y}").alias("topic")) for y in topics))).alias("c")).select(sets, "c.*")
    top = said.groupBy(sets, "arm", "topic").agg(F.count("*").alias("n")).groupBy(sets, "arm").agg(F.max("n").alias("top"))
    guards = ((F.col("changed") * 100 <= anchor * F.col("pairs")).alias("anchored"), (F.col("changed") == 0).alias("identical"), (F.col("top") * 100 > most * F.col("pairs")).alias("collapsed"))
    return long.join(top, [sets, "arm"]).select(sets, "arms", "pairs", "changed", *guards)


def nested_report(a: DataFrame, b: DataFrame, key: str = "review_id", cutoff: float = 0.7) -> DataFrame:
    """Two runs over the same records: changed labels, quotes and flags, moved tones and the largest move."""
    other = b.select(key, *(F.col(c).alias(f"o_{c}") for c in ("sentiment", "min_top", "evidence_quote")))
    met = pairs(a, b, key, keep=("sentiment", "min_top", "evidence_quote")).join(other, key)
    move = F.abs(F.col("sentiment") - F.col("o_sentiment"))
    flag = (F.col("min_top") < cutoff) != (F.col("o_min_top") < cutoff)
    return met.agg(
        F.count("*").alias("pairs"), F.count_if(~all_same()).alias("changed"), F.count_if(~F.col("evidence_quote").eqNullSafe(F.col("o_evidence_quote"))).alias("quotes"), F.count_if(flag).alias("flags"),
        F.count_if(move != 0).alias("tone_moved"), F.round(F.coalesce(F.max(move), F.lit(0.0)), 6).alias("tone_most"),
    )


def accepted_scores(cases: DataFrame) -> DataFrame:
    """Labels against arrays of accepted answers (``topics``, ``intents``, ``severities``), by ``group``."""
    hit = F.array_contains("topics", F.col("topic")) & F.array_contains("intents", F.col("intent")) & F.array_contains("severities", F.col("severity"))
    distance = F.array_min(F.transform("severities", lambda s: F.abs(F.col("severity") - s)))
    return cases.groupBy("group").agg(F.count("*").alias("n"), F.count_if(F.col("intent") == "unclear").alias("abstained"), F.count_if(hit).alias("accepted"), F.sum(distance).cast("long").alias("distance"))


def golden_cases(gold: DataFrame, predicted: DataFrame, fields: tuple[str, ...], key: str = "review_id") -> DataFrame:
    """A row a gold case with its prediction (``p_`` and the field), ``missing``, and whether each field is right."""
    met = gold.join(predicted.withColumn("__there", F.lit(True)), key, "left")
    right = [F.coalesce(F.col(f) == F.col(f"p_{f}"), F.lit(False)).alias(f"{f}_ok") for f in fields]
    return met.select(key, *(c for f in fields for c in (f, f"p_{f}")), F.col("__there").isNull().alias("missing"), *right)


def cell_problems(sheet: DataFrame, allowed: dict[str, tuple]) -> DataFrame:
    """Cells that are blank or not in their column's list, counted by column and problem."""
    problem = lambda f, xs: F.when(F.col(f).isNull(), "blank").when(~F.col(f).isin(*xs), "not in the list")
    cells = F.array(*(F.struct(F.lit(f).alias("field"), problem(f, xs).alias("problem")) for f, xs in allowed.items()))
    return sheet.select(F.explode(cells).alias("c")).select("c.*").filter("problem IS NOT NULL").groupBy("field", "problem").agg(F.count("*").alias("n"))


def value_at(df: DataFrame, group: str, value: str, share: float, slack: float = 0.005, place: Column | None = None) -> DataFrame:
    """(``group``, ``n``, ``at``): the value at place floor(share * n), from 0, of each group's sorted
    values, or at ``place``, an expression of ``n`` that is near to it.

    A quantile sketch brackets the place, values below the bracket are only counted, and
    those inside are summed by value, so no group is sorted as a whole. Groups are few
    enough to broadcast their brackets (AQE decides).
    """
    ends = F.percentile_approx(value, [max(share - slack, 0.0), min(share + slack, 1.0)], 10_000)
    brackets = df.groupBy(group).agg(ends.alias("__e"), F.count(value).alias("n"))
    met = df.join(brackets, group).filter(F.col(value).isNotNull())
    low, high = F.col("__e")[0], F.col("__e")[1]
    below = F.when(F.col(value) >= low, F.col(value))  # null: below the bracket
    steps = met.filter(F.col(value) <= high).groupBy(group, "n", below.alias("__v")).agg(F.count("*").alias("__k"))
    run = Window.partitionBy(group).orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    placed = steps.withColumn("__r", F.sum("__k").over(run)).filter(F.col("__r") > (F.floor(F.col("n") * share) if place is None else place))
    return placed.groupBy(group, "n").agg(F.min("__v").alias("at"))


def planted_flips(records: DataFrame, step: int, seed: str) -> DataFrame:
    """A copy of the records where every ``step``-th in seeded order has another topic, with ``planted`` marked."""
    picked = every_nth(records, seed, step).select("review_id", F.lit(True).alias("planted"))
    joined = records.join(picked, "review_id", "left").withColumn("planted", F.coalesce("planted", F.lit(False)))
    return joined.withColumn("topic", F.when(F.col("planted"), F.when(F.col("topic") == "other", "access").otherwise("other")).otherwise(F.col("topic")))


def prefix_match(groups: DataFrame, order: str, totals: dict[str, Column]) -> DataFrame:
    """Boundaries in time at which the running totals of all columns meet their targets; groups are few."""
    run = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = groups.withColumns({f"running_{c}": F.sum(c).over(run) for c in totals})
    return summed.filter(reduce(lambda x, y: x & y, [F.col(f"running_{c}") == target for c, target in totals.items()]))


def spread(df: DataFrame, group: str, value: str) -> DataFrame:
    """By group the median (the mean of the middle two), and the values at floor(0.95 n) and at 0.9 (n - 1), rounded half to even."""
    at = lambda share, place=None: value_at(df, group, value, share, place=place)
    low, high = at(0.5, place=F.floor((F.col("n") - 1) / 2)), at(0.5)
    parts = [low.select(group, "n", F.col("at").alias("low")), high.select(group, F.col("at").alias("high")), at(0.95).select(group, F.col("at").alias("p95")), at(0.9, F.bround(0.9 * (F.col("n") - 1))).select(group, F.col("at").alias("q90"))]
    met = reduce(lambda x, y: x.join(y, group), parts)
    return met.select(group, "n", ((F.col("low") + F.col("high")) / 2).alias("median"), "p95", "q90")


def settled_guards(failed: DataFrame, supplied: bool, accepted: tuple[str, ...]) -> DataFrame:
    """Failed guards (``guard``) with ``blocked``: supplied labels block whatever was accepted, others unless it was."""
    known = F.col("guard").isin(*accepted) if accepted else F.lit(False)
    return failed.select("guard", (F.lit(supplied) | ~known).alias("blocked"))


def count_mismatches(measured: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Counts ``n`` by ``key`` that differ from the known ones, or that one side lacks."""
    there = known.select(key, F.col("n").alias("known"))
    return measured.select(key, "n").join(there, key, "full_outer").filter(~F.col("n").eqNullSafe(F.col("known")))


def totals_match(cases: DataFrame, saved: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Whether the totals of cases equal a saved score, field by field."""
    row = cases.agg(*(F.count_if(F.col(f"{f}_ok")).alias(f) for f in fields))
    long = row.unpivot([], list(fields), "field", "counted")
    return long.join(saved.unpivot([], list(fields), "field", "saved"), "field").withColumn("equal", F.col("counted") == F.col("saved"))
