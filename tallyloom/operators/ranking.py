"""From labels to issues, exact rankings, claims and quotes; and rankings under other readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.functions.labels import RANKED
from tallyloom.functions.numbers import micro_mean, six_places
from tallyloom.functions.text import order_key

METRICS = ("complaint_count", "severity_sum", "mean_severity", "priority_score")


def membership(records: DataFrame) -> DataFrame:
    """(``issue_id``, ``review_id``) of complaints and cancellations: the issue of a topic."""
    return records.filter(F.col("intent").isin(*RANKED)).select(F.concat(F.lit("IS-"), "topic").alias("issue_id"), "review_id")


def tally(members: DataFrame, records: DataFrame) -> DataFrame:
    """Complaints and sum of severities by issue."""
    met = members.join(records.select("review_id", "severity"), "review_id")
    return met.groupBy("issue_id").agg(F.count("*").alias("complaint_count"), F.sum("severity").cast("long").alias("severity_sum"))


def rank(tallied: DataFrame) -> DataFrame:
    """The ranking: score is the sum of severities, ties go to the smaller id; means are exact to six places, half up.

    There is one row an issue, which is why one task may order them.
    """
    order = Window.orderBy(F.desc("severity_sum"), "issue_id")
    ranked = tallied.withColumn("rank", F.row_number().over(order))
    mean = six_places(micro_mean("severity_sum", "complaint_count"))
    return ranked.select("rank", "issue_id", "complaint_count", "severity_sum", mean.alias("mean_severity"), F.col("severity_sum").alias("priority_score"))


def claims(ranking: DataFrame) -> DataFrame:
    """One numbered claim for each cell of the ranking."""
    cells = F.array(*(F.struct(F.lit(i).alias("m"), F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for i, m in enumerate(METRICS)))
    long = ranking.select("rank", "issue_id", F.explode(cells).alias("c")).select("rank", "issue_id", "c.*")
    number = ((F.col("rank") - 1) * len(METRICS) + F.col("m") + 1).cast("int")
    return long.select(F.format_string("CL-%03d", number).alias("claim_id"), "issue_id", "metric", "value")


def quotes(members: DataFrame, records: DataFrame, seed: str, limit: int, longest: int = 500) -> DataFrame:
    """Up to ``limit`` quotes an issue in seeded order, from originals, none cut: longer texts are left out."""
    met = members.join(records, "review_id").filter(F.col("cache_source_id").isNull() & (F.length("evidence_quote") <= longest))
    order = Window.partitionBy("issue_id").orderBy(order_key(seed, F.col("review_id")), "review_id")
    return met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit).select("issue_id", "place", "review_id", "severity")


def evidence(members: DataFrame, records: DataFrame, seed: str, severe: int = 3, hashed: int = 2) -> DataFrame:
    """Per issue the most severe records and then further ones in seeded order.

    Both are limits of a window, which act before rows move: the first ``severe`` by
    severity, and of the first ``severe + hashed`` by hash those that are left.
    """
    met = members.join(records, "review_id").filter(F.col("cache_source_id").isNull()).select("issue_id", "review_id", "severity", order_key(seed, F.col("review_id")).alias("k"))
    first = lambda df, n, *by: df.withColumn("__n", F.row_number().over(Window.partitionBy("issue_id").orderBy(*by, "k", "review_id"))).filter(F.col("__n") <= n).drop("__n")
    worst = first(met, severe, F.desc("severity"))
    rest = first(met, severe + hashed).join(worst.select("issue_id", "review_id"), ["issue_id", "review_id"], "left_anti")
    return worst.withColumn("why", F.lit("severe")).unionByName(first(rest, hashed).withColumn("why", F.lit("hashed"))).drop("k")


def evidence_pack(ranking: DataFrame, chosen: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row with a JSON ``document``: the ranking, the chosen records by issue, the counts of statuses."""
    listed = chosen.groupBy("issue_id").agg(F.sort_array(F.collect_list(F.struct("why", "review_id", "severity"))).alias("records"))
    issues = ranking.join(listed, "issue_id", "left").agg(F.sort_array(F.collect_list(F.struct("rank", "issue_id", "complaint_count", "mean_severity", "records"))).alias("issues"))
    whole = issues.crossJoin(statuses.agg(F.sort_array(F.collect_list(F.struct("status", "n"))).alias("statuses")))
    return whole.select(F.to_json(F.struct("issues", "statuses")).alias("document"))


def readings() -> dict[str, Column]:
    """Weights that other readings give a severity."""
    s = F.col("severity")
    return {"as_labeled": s, "four_as_three": F.when(s == 4, 3).otherwise(s), "high_as_three": F.least(s, F.lit(3)), "count_only": F.lit(1), "blocked_only": (s >= 4).cast("int")}


def what_if(members: DataFrame, records: DataFrame) -> DataFrame:
    """The ranking under every reading, all from one pass over the members."""
    met = members.join(records.select("review_id", "severity"), "review_id")
    totals = met.groupBy("issue_id").agg(*(F.sum(w).cast("long").alias(k) for k, w in readings().items()))
    long = totals.unpivot(["issue_id"], list(readings()), "reading", "total")
    order = Window.partitionBy("reading").orderBy(F.desc("total"), "issue_id")
    return long.withColumn("rank", F.row_number().over(order)).select("reading", "rank", "issue_id", "total")


def severity_histogram(members: DataFrame, records: DataFrame) -> DataFrame:
    """Records of each severity by issue."""
    met = members.join(records.select("review_id", "severity"), "review_id")
    return met.groupBy("issue_id").agg(*(F.count_if(F.col("severity") == s).alias(f"s{s}") for s in range(1, 6)))


def break_even(histogram: DataFrame) -> DataFrame:
    """Pairs of issues that change places once some share of all 4s counts as 3, and that share in ten-thousandths, half up.

    Issues are few: the inequality joins one row an issue with itself.
    """
    total = F.expr("s1 + 2 * s2 + 3 * s3 + 4 * s4 + 5 * s5")
    sums = histogram.select("issue_id", "s4", total.alias("t"))
    a, b = sums.alias("a"), F.broadcast(sums).alias("b")
    ahead = (F.col("a.t") > F.col("b.t")) | ((F.col("a.t") == F.col("b.t")) & (F.col("a.issue_id") < F.col("b.issue_id")))
    pairs = a.join(b, ahead).select(F.col("a.issue_id").alias("ahead"), F.col("b.issue_id").alias("behind"), (F.col("a.t") - F.col("b.t")).alias("gap"), (F.col("a.s4") - F.col("b.s4")).alias("fours"))
    return pairs.filter("fours > 0 AND gap > 0 AND gap <= fours").select("ahead", "behind", F.expr("(2 * gap * 10000 + fours) DIV (2 * fours)").alias("share_ten_thousandths"))


def degenerate_readings(ranked: DataFrame) -> DataFrame:
    """Readings under which all issues have one total, so that the ranking says nothing."""
    return ranked.groupBy("reading").agg(F.countDistinct("total").alias("totals"), (F.countDistinct("total") == 1).alias("degenerate"))
