"""Queries over calls, spend, cost and the state of runs. Money is whole pico-dollars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import hash_mod
from tallyloom.operators import agreement, ledger, pacing, trace
from tallyloom.plans import base
from tallyloom.plans.base import BASE, CALLS, REV, calls, h, records, reviews, sql, table
from tallyloom.plans.registry import query

#: Micro-dollars for a million tokens, in and out; memo has no rate, so its cost is unknown.
RATES = {"enrich": (42_000, 84_000), "verify": (0, 0), "group": (10_000, 30_000)}
RATES_SQL = "rates AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', CAST({a} AS BIGINT), CAST({b} AS BIGINT))" for k, (a, b) in RATES.items()) + ") AS v(role, rate_in, rate_out))"
SPEND = "coalesce(input_tokens, 0) * 42000 + coalesce(output_tokens, 0) * 84000"
TALLY = "count(*) AS calls, count(*) FILTER (outcome = 'succeeded') AS succeeded, count(*) FILTER (outcome = 'failed') AS failed, CAST(coalesce(sum(input_tokens), 0) AS BIGINT) AS input_tokens, CAST(coalesce(sum(output_tokens), 0) AS BIGINT) AS output_tokens, count(*) FILTER (input_tokens IS NULL) AS usage_unknown"
FIRST = "b AS (SELECT CASE WHEN count(*) > 1 THEN min(session) END AS boundary, count(*) AS sessions FROM (SELECT DISTINCT session FROM calls WHERE outcome = 'succeeded' AND role = 'enrich'))"
PHASED = "f AS (SELECT calls.*, CASE WHEN role = 'enrich' THEN CASE WHEN coalesce(session <= boundary, true) THEN 'initial' ELSE 'resume' END END AS phase FROM calls, b)"
MEASURED = f"{RATES_SQL}, t AS (SELECT role, count(*) AS requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM calls GROUP BY role), c AS (SELECT t.*, input_tokens * rate_in + output_tokens * rate_out AS pico_usd, rate_in IS NULL AS unknown FROM t LEFT JOIN rates USING (role))"


def rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, a, b) for k, (a, b) in RATES.items()], "role string, rate_in long, rate_out long")


def spend_column() -> Column:
    return ledger.spend_of(F.col("input_tokens"), F.col("output_tokens"), 42_000, 84_000)


@query(sql((CALLS,), f"SELECT role, {TALLY} FROM calls GROUP BY role"))
def calls_by_role(spark: SparkSession, d: str) -> DataFrame:
    return ledger.calls_by(calls(spark, d), "role")


@query(sql((CALLS, FIRST, PHASED), f"SELECT session, phase, {TALLY} FROM f GROUP BY session, phase"))
def calls_by_run(spark: SparkSession, d: str) -> DataFrame:
    """Calls of each session and phase."""
    c = calls(spark, d)
    return ledger.calls_by(ledger.with_phase(c, ledger.boundary(c)), "session", "phase")


@query(sql((CALLS, FIRST, PHASED), "SELECT request_id, phase FROM f"))
def call_phase(spark: SparkSession, d: str) -> DataFrame:
    c = calls(spark, d)
    return ledger.with_phase(c, ledger.boundary(c)).select("request_id", "phase")


@query(sql((CALLS,), "SELECT request_id, coalesce(input_tokens, 0) AS input_tokens, coalesce(output_tokens, 0) AS output_tokens, input_tokens IS NOT NULL AND output_tokens IS NOT NULL AS usage_known FROM calls"))
def call_usage(spark: SparkSession, d: str) -> DataFrame:
    """Unknown usage shows as zero and a flag."""
    known = F.col("input_tokens").isNotNull() & F.col("output_tokens").isNotNull()
    return calls(spark, d).select("request_id", F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"), F.coalesce("output_tokens", F.lit(0)).alias("output_tokens"), known.alias("usage_known"))


@query(sql((CALLS,), "SELECT coalesce(role, 'end_to_end') AS role, count(*) AS requests, CAST(coalesce(sum(input_tokens), 0) AS BIGINT) AS input_tokens, count(DISTINCT review_ids) AS distinct_requests FROM calls GROUP BY ROLLUP (role)"))
def usage_rows(spark: SparkSession, d: str) -> DataFrame:
    return ledger.usage_rows(calls(spark, d))


@query(sql((CALLS,), f"SELECT role, outcome, CAST(sum({SPEND}) AS BIGINT) AS pico_usd FROM calls GROUP BY role, outcome"))
def spend(spark: SparkSession, d: str) -> DataFrame:
    return calls(spark, d).groupBy("role", "outcome").agg(F.sum(spend_column()).alias("pico_usd"))


@query(sql((CALLS,), f"SELECT CAST(sum({SPEND}) FILTER (role = 'memo') AS BIGINT) AS memo, CAST(sum({SPEND}) FILTER (role <> 'memo') AS BIGINT) AS other, CAST(sum(reserved_tokens * 42000) FILTER (outcome = 'pending') AS BIGINT) AS kept FROM calls"))
def spend_split(spark: SparkSession, d: str) -> DataFrame:
    """Spend of the memo, of the rest, and the reservations that calls without an outcome keep."""
    memo = F.col("role") == "memo"
    return calls(spark, d).agg(F.sum(F.when(memo, spend_column())).alias("memo"), F.sum(F.when(~memo, spend_column())).alias("other"), F.sum(F.when(F.col("outcome") == "pending", F.col("reserved_tokens") * 42_000)).alias("kept"))


@query(sql((CALLS,), "SELECT count(*) AS open, CAST(coalesce(sum(reserved_tokens * 42000), 0) AS BIGINT) AS reserved_pico_usd FROM calls WHERE outcome NOT IN ('succeeded', 'failed')"))
def reserved_usd(spark: SparkSession, d: str) -> DataFrame:
    return ledger.reserved(calls(spark, d), 42_000)


@query(sql((CALLS, FIRST), "SELECT boundary, sessions FROM b"))
def boundary(spark: SparkSession, d: str) -> DataFrame:
    return ledger.boundary(calls(spark, d))


@query(sql((CALLS, "r AS (SELECT session, sum(reserved_tokens * 42000) OVER (PARTITION BY session ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING) AS running FROM calls)"), "SELECT session, count(*) FILTER (running <= 2000000000) AS admitted, count(*) FILTER (running > 2000000000) AS stopped FROM r GROUP BY session"))
def cap_admission(spark: SparkSession, d: str) -> DataFrame:
    """Calls that each session's cap admits."""
    return ledger.admitted(calls(spark, d), 2_000_000_000, 42_000)


@query(sql((CALLS, MEASURED), "SELECT role, requests, input_tokens, output_tokens, pico_usd, unknown FROM c"))
def cost_measured(spark: SparkSession, d: str) -> DataFrame:
    return ledger.cost_measured(calls(spark, d), rates(spark))


@query(sql((CALLS, MEASURED), "SELECT role, requests FROM c WHERE unknown"))
def cost_unknown(spark: SparkSession, d: str) -> DataFrame:
    """Stages whose cost is unknown, which is not zero."""
    return ledger.cost_measured(calls(spark, d), rates(spark)).filter("unknown").select("role", "requests")


SCENARIOS = {"base": (484_189, 40_000_000_000_000), "no_reuse": (660_609, 40_000_000_000_000), "conservative": (508_398, 10_000_000_000)}
SCENARIOS_SQL = "s AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', CAST({r} AS HUGEINT), CAST({c} AS HUGEINT))" for k, (r, c) in SCENARIOS.items()) + ") AS v(scenario, n_rows, cap)), u AS (SELECT CAST(sum(pico_usd) AS HUGEINT) AS p, CAST(sum(requests) AS HUGEINT) AS q FROM c)"


@query(sql((CALLS, MEASURED, SCENARIOS_SQL), "SELECT scenario, CAST((2 * q * n_rows + 1000) // 2000 AS BIGINT) AS requests, CAST((2 * p * n_rows + 1000) // 2000 AS BIGINT) AS pico_usd, (2 * p * n_rows + 1000) // 2000 > cap AS over_cap FROM u, s"))
def cost_project(spark: SparkSession, d: str) -> DataFrame:
    """Measured cost carried to three scenarios, as if a thousand rows had been measured."""
    scenarios = spark.createDataFrame([(k, r, c) for k, (r, c) in SCENARIOS.items()], "scenario string, rows long, cap long")
    return ledger.cost_project(ledger.cost_measured(calls(spark, d), rates(spark)), scenarios, F.lit(1000))


@query(sql((CALLS,), "SELECT c.request_id, c.outcome, r.reserved_tokens FROM calls c LEFT JOIN (SELECT request_id, reserved_tokens FROM calls WHERE outcome <> 'failed') r USING (request_id)"))
def pilot_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls beside their reservations."""
    c = calls(spark, d)
    return c.select("request_id", "outcome").join(c.filter("outcome <> 'failed'").select("request_id", "reserved_tokens"), "request_id", "left")


@query(sql((REV,), "SELECT review_id, greatest(1, CAST(ceil(strlen(review_text) * 10 / 24.0) AS BIGINT)) * 42000 + 300 * 84000 AS pico_usd FROM rev"))
def worst_case(spark: SparkSession, d: str) -> DataFrame:
    return ledger.worst_case(reviews(spark, d), 42_000, 84_000, 300)


LATE = "o AS (SELECT request_id, ts, outcome, input_tokens FROM calls WHERE outcome <> 'pending' UNION ALL SELECT request_id, ts + INTERVAL 1 SECOND, 'failed', NULL FROM calls WHERE outcome = 'succeeded' AND request_id % 5 = 0)"


@query(sql((CALLS, LATE), "SELECT request_id, outcome, input_tokens FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts, outcome) AS n FROM o) WHERE n = 1"))
def settled(spark: SparkSession, d: str) -> DataFrame:
    """A request settles once, whatever comes later."""
    c = calls(spark, d).select("request_id", "ts", "outcome", "input_tokens")
    late = c.filter("outcome = 'succeeded' AND request_id % 5 = 0").select("request_id", (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ts"), F.lit("failed").alias("outcome"), F.lit(None).cast("long").alias("input_tokens"))
    return ledger.settled_once(c.filter("outcome <> 'pending'").unionByName(late)).select("request_id", "outcome", "input_tokens")


@query(sql((CALLS,), "SELECT request_id, 'failed' AS outcome, 'kept' AS kind, reserved_tokens FROM calls WHERE outcome = 'pending'"))
def orphans(spark: SparkSession, d: str) -> DataFrame:
    return ledger.orphans(calls(spark, d))


ENDS = f"s AS (SELECT session, min(ts) AS started, max(ts) AS last, CASE WHEN {h('crash', 'CAST(session AS VARCHAR)', 3)} > 0 THEN max(ts) + INTERVAL 1 MINUTE END AS ended FROM calls GROUP BY session)"


@query(sql((CALLS, ENDS), "SELECT session, started, coalesce(ended, last, started) AS ended, CASE WHEN ended IS NULL THEN 'crashed' ELSE 'finished' END AS ended_how FROM s"))
def sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with their end; one that crashed ends at its last heartbeat."""
    found = calls(spark, d).groupBy("session").agg(F.min("ts").alias("started"), F.max("ts").alias("last"))
    well = hash_mod("crash", F.col("session").cast("string"), 3) > 0
    open_ones = found.withColumns({"ended": F.when(well, F.col("last") + F.expr("INTERVAL 1 MINUTE")), "ended_how": F.when(well, "finished")})
    return ledger.closed_sessions(open_ones).select("session", "started", "ended", "ended_how")


@query(sql((CALLS,), "SELECT user_id, count(*) FILTER (outcome = 'failed') AS attempts, CASE WHEN count(*) FILTER (outcome = 'succeeded') > 40 THEN 'completed' WHEN count(*) FILTER (outcome = 'failed') >= 6 THEN 'quarantined' ELSE 'pending' END AS status FROM calls GROUP BY user_id"))
def attempts(spark: SparkSession, d: str) -> DataFrame:
    """Failed attempts by subject, and what becomes of it."""
    c = calls(spark, d).groupBy("user_id").agg(F.count_if(F.col("outcome") == "failed").alias("attempts"), F.count_if(F.col("outcome") == "succeeded").alias("done"))
    return c.select("user_id", "attempts", F.when(F.col("done") > 40, "completed").when(F.col("attempts") >= 6, "quarantined").otherwise("pending").alias("status"))


GAPS = "g AS (SELECT session, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY session ORDER BY ts, request_id) AS gap FROM calls WHERE outcome = 'succeeded')"


@query(sql((CALLS, GAPS), "SELECT session, max(gap) AS longest_us, count(*) FILTER (gap > 60000000) AS outages FROM g GROUP BY session"))
def outages(spark: SparkSession, d: str) -> DataFrame:
    """The longest time without a success in each session, and how often it passed a minute."""
    return ledger.outages(calls(spark, d), 60_000_000)


@query(sql((CALLS, "n AS (SELECT request_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), request_id) - 1 AS i FROM calls)"), "SELECT request_id, us, max(us - i * 1000000) OVER (PARTITION BY user_id ORDER BY us, request_id ROWS UNBOUNDED PRECEDING) + i * 1000000 AS slot FROM n"))
def paced(spark: SparkSession, d: str) -> DataFrame:
    """When an even pace of one a second lets each request of a user go."""
    c = calls(spark, d).select("request_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return ledger.paced(c, "user_id", "us", 1_000_000).select("request_id", "us", "slot")


def micro(rate: Column) -> Column:
    """Millionths, half up."""
    return F.floor(rate * F.lit(1e6) + 0.5)


LIMITS = {"ceiling": 2.0, "recover": 0.02, "tokens_per_second": 1000}
#: Times are a thousandth of the events', so that requests come close enough together to wait.
TIMED = "e AS (SELECT request_id, event_type, epoch_us(ts) // 1000 AS us, reserved_tokens, outcome FROM calls), slow AS (SELECT DISTINCT event_type, us FROM e WHERE outcome = 'failed')"
HALVED = """later AS MATERIALIZED (SELECT event_type, us, min(us) OVER (PARTITION BY event_type ORDER BY us RANGE BETWEEN 10000000 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_us FROM slow),
  p AS (SELECT event_type, min(us) AS us, CAST(1.0 AS DOUBLE) AS rate FROM slow GROUP BY event_type
    UNION ALL SELECT l.event_type, l.next_us, greatest(CAST(1.0 AS DOUBLE), least(CAST(2.0 AS DOUBLE), p.rate + CAST(0.02 AS DOUBLE) * (CAST(l.next_us - l.us AS DOUBLE) / CAST(1e6 AS DOUBLE))) / 2) FROM p JOIN later l ON l.event_type = p.event_type AND l.us = p.us WHERE l.next_us IS NOT NULL)"""
SLOTS = """q AS (SELECT e.request_id, e.event_type, e.us, e.reserved_tokens, coalesce(least(CAST(2.0 AS DOUBLE), p.rate + CAST(0.02 AS DOUBLE) * (CAST(e.us - p.us AS DOUBLE) / CAST(1e6 AS DOUBLE))), CAST(2.0 AS DOUBLE)) AS rate FROM e ASOF LEFT JOIN p ON e.event_type = p.event_type AND e.us >= p.us),
  w AS (SELECT *, greatest(CAST(floor(CAST(1e6 AS DOUBLE) / rate + 0.5) AS BIGINT), reserved_tokens * 1000) AS gap FROM q),
  g AS (SELECT *, coalesce(sum(gap) OVER (PARTITION BY event_type ORDER BY us, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM w)"""


@query(sql((f"RECURSIVE {CALLS}", TIMED, HALVED, SLOTS), "SELECT request_id, us, CAST(floor(rate * CAST(1e6 AS DOUBLE) + 0.5) AS BIGINT) AS micro_rate, CAST(max(us - g) OVER (PARTITION BY event_type ORDER BY us, request_id ROWS UNBOUNDED PRECEDING) + g AS BIGINT) AS slot FROM g"))
def limiter(spark: SparkSession, d: str) -> DataFrame:
    """When a limiter lets each request of a kind go: even pace, halved by failed calls at most once in ten seconds, recovering."""
    c = calls(spark, d).select("request_id", "event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("us"), "reserved_tokens", "outcome")
    slow = c.filter("outcome = 'failed'").select("event_type", "us")
    found = pacing.limited(c.drop("outcome"), slow, "event_type", "us", "reserved_tokens", **LIMITS)
    return found.select("request_id", "us", micro(F.col("rate")).alias("micro_rate"), "slot")


@query(sql((f"RECURSIVE {CALLS}", TIMED, HALVED), "SELECT event_type, us, CAST(floor(rate * CAST(1e6 AS DOUBLE) + 0.5) AS BIGINT) AS micro_rate FROM p"))
def limiter_halvings(spark: SparkSession, d: str) -> DataFrame:
    """When the rate of each kind of call halves, and to what."""
    slow = calls(spark, d).filter("outcome = 'failed'").select("event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("us"))
    return pacing.halvings(slow, "event_type", "us", ceiling=2.0, recover=0.02).select("event_type", "us", micro(F.col("rate")).alias("micro_rate"))


DAYS = "t AS (SELECT session, count(*) AS n, sum(coalesce(input_tokens, 0)) AS k FROM calls GROUP BY session), r AS (SELECT session, sum(n) OVER w AS running_n, sum(k) OVER w AS running_k FROM t WINDOW w AS (ORDER BY session ROWS UNBOUNDED PRECEDING))"


@query(sql((CALLS, DAYS), "SELECT session, CAST(running_n AS BIGINT) AS running_n, CAST(running_k AS BIGINT) AS running_k FROM r WHERE (running_n, running_k) = (SELECT (count(*), sum(coalesce(input_tokens, 0))) FROM calls WHERE session <= DATE '2024-01-10')"))
def prefix_match(spark: SparkSession, d: str) -> DataFrame:
    """The session up to which calls and tokens add up to known totals."""
    c = calls(spark, d).withColumn("k", F.coalesce("input_tokens", F.lit(0)))
    total = c.filter("session <= DATE'2024-01-10'").agg(F.count("*").alias("target_n"), F.sum("k").alias("target_k"))
    by_day = c.groupBy("session").agg(F.count("*").alias("n"), F.sum("k").alias("k")).crossJoin(F.broadcast(total))
    return agreement.prefix_match(by_day, "session", {"n": F.col("target_n"), "k": F.col("target_k")}).select("session", "running_n", "running_k")


@query(sql((CALLS,), "SELECT role, CAST(sum(input_tokens) AS BIGINT) AS input_only, CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS all_tokens, abs(sum(input_tokens) - (sum(input_tokens) + sum(output_tokens))) * 100 <= 5 * sum(input_tokens) AS fits FROM calls GROUP BY role"))
def billing_fit(spark: SparkSession, d: str) -> DataFrame:
    """Whether a bill over all tokens is within five of a hundred of one over input alone."""
    c = calls(spark, d).groupBy("role").agg(F.sum("input_tokens").alias("input_only"), (F.sum("input_tokens") + F.sum("output_tokens")).alias("all_tokens"))
    return c.withColumn("fits", F.abs(F.col("input_only") - F.col("all_tokens")) * 100 <= 5 * F.col("input_only"))


@query(sql(BASE, "SELECT count(*) AS records, count(cache_source_id) AS reused, count(*) - count(cache_source_id) AS labelled, count(DISTINCT cache_source_id) AS sources FROM rec"))
def cache_stats(spark: SparkSession, d: str) -> DataFrame:
    """How many records took another's labels."""
    reused = F.col("cache_source_id").isNotNull()
    return records(spark, d).agg(F.count("*").alias("records"), F.count_if(reused).alias("reused"), F.count_if(~reused).alias("labelled"), F.countDistinct("cache_source_id").alias("sources"))


@query(sql((*BASE, f"old AS (SELECT text_key, topic FROM res), own AS (SELECT text_key, 'other' AS topic FROM res WHERE {h('own', 'text_key', 4)} = 0)"), "SELECT 'warm' AS run, text_key, coalesce(own.topic, old.topic) AS topic FROM old LEFT JOIN own USING (text_key)"))
def warm_copy(spark: SparkSession, d: str) -> DataFrame:
    """A new run that starts from an earlier one's results, its own taking precedence."""
    old = base.results(reviews(spark, d)).select("text_key", "topic")
    own = old.filter(hash_mod("own", F.col("text_key"), 4) == 0).withColumn("topic", F.lit("other"))
    return trace.last_wins([old, own], "text_key", "topic").select(F.lit("warm").alias("run"), "text_key", "topic")


@query(sql((*BASE, f"own AS (SELECT text_key, topic FROM res WHERE {h('own', 'text_key', 4)} = 0)"), "SELECT rev.text_key, coalesce(own.topic, 'from_cold') AS output FROM (SELECT DISTINCT text_key FROM rev) rev LEFT JOIN own USING (text_key)"))
def cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Stored answers by key: the run's own, else those of the run that it starts from."""
    results = base.results(reviews(spark, d))
    own = results.filter(hash_mod("own", F.col("text_key"), 4) == 0).select(F.lit("warm").alias("run"), F.col("text_key").alias("key"), F.col("topic").alias("output"))
    cold = results.select(F.lit("cold").alias("run"), F.col("text_key").alias("key"), F.lit("from_cold").alias("output"))
    wanted = results.select(F.col("text_key").alias("key"))
    return trace.cached(wanted, own.unionByName(cold), "warm", "cold").select(F.col("key").alias("text_key"), "output")


@query(sql((*BASE, "k AS (SELECT review_id, CASE WHEN review_text = '' THEN 'quarantined' ELSE 'completed' END AS status FROM rev)"), f"SELECT review_id FROM k WHERE {h('lost', 'review_id', 30)} = 0"))
def run_equal(spark: SparkSession, d: str) -> DataFrame:
    """Records that differ between two runs or that one lacks."""
    first = reviews(spark, d).select("review_id", F.when(F.col("review_text") == "", "quarantined").otherwise("completed").alias("status"))
    lost = hash_mod("lost", F.col("review_id"), 30) == 0
    odd = F.col("review_id").substr(-1, 1) == "1"
    second = first.filter(~(lost & odd)).withColumn("status", F.when(lost, "pending").otherwise(F.col("status")))
    return trace.differing(first, second, "review_id", "status")


@query("SELECT event_type, count(value) AS n, round(median(value), 6) AS median, list_sort(list(value))[CAST(floor(count(value) * 0.95) AS BIGINT) + 1] AS p95, list_sort(list(value))[CAST(round_even(0.9 * (count(value) - 1), 0) AS BIGINT) + 1] AS q90, round(CAST(sum(event_id % 1000) AS DOUBLE) / count(*), 6) AS mean_tokens FROM events GROUP BY event_type")
def arm_stats(spark: SparkSession, d: str) -> DataFrame:
    """Median, the values at places floor(0.95 n) and 0.9 (n - 1) of each kind's sorted values, and mean tokens."""
    events = table(spark, d, "events")
    means = events.groupBy("event_type").agg(F.round(F.sum(F.col("event_id") % 1000) / F.count("*"), 6).alias("mean_tokens"))
    return agreement.spread(events, "event_type", "value").join(means, "event_type").withColumn("median", F.round("median", 6))


@query(sql((CALLS, "t AS (SELECT event_type AS model, session, avg(seconds) < 64 AND count(*) >= 3 AS passed, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS cost FROM calls GROUP BY 1, 2)", "m AS (SELECT model, bool_and(passed) AS passed, CAST(sum(cost) AS BIGINT) AS cost FROM t GROUP BY model)"), "SELECT model, cost FROM m WHERE passed ORDER BY cost, model LIMIT 1"))
def cheapest(spark: SparkSession, d: str) -> DataFrame:
    """The cheapest of the models that passed in all trials."""
    trials = calls(spark, d).groupBy(F.col("event_type").alias("model"), "session").agg(((F.avg("seconds") < 64) & (F.count("*") >= 3)).alias("passed"), F.sum(F.coalesce("input_tokens", F.lit(0))).alias("cost"))
    return ledger.cheapest(trials)


@query("SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) <> max(l_linenumber) OR count(DISTINCT l_linenumber) <> count(*)")
def batch_ids(spark: SparkSession, d: str) -> DataFrame:
    """Batches in which a requested index is missing or comes twice."""
    return ledger.bad_batches(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")
