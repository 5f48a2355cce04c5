"""Calls, spend and cost. Money is whole pico-dollars, so sums are exact: tokens times a rate in micro-dollars a million tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import token_estimate
from tallyloom.operators.order import running


def spend_of(tokens_in: Column, tokens_out: Column, rate_in: int, rate_out: int) -> Column:
    """Pico-dollars of a call."""
    return F.coalesce(tokens_in, F.lit(0)) * rate_in + F.coalesce(tokens_out, F.lit(0)) * rate_out


def calls_by(calls: DataFrame, *by: str) -> DataFrame:
    """Calls, successes, failures, tokens and calls of unknown usage."""
    return calls.groupBy(*by).agg(
        F.count("*").alias("calls"), F.count_if(F.col("outcome") == "succeeded").alias("succeeded"), F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"), F.count_if(F.col("input_tokens").isNull()).alias("usage_unknown"),
    )


def usage_rows(calls: DataFrame) -> DataFrame:
    """Usage by stage and one row for all of them; a request is known by its list of ids."""
    rolled = calls.rollup("role").agg(F.count("*").alias("requests"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.countDistinct("review_ids").alias("distinct_requests"))
    return rolled.withColumn("role", F.coalesce("role", F.lit("end_to_end")))


def boundary(calls: DataFrame) -> DataFrame:
    """The first of two or more sessions with finished originals; null if there is but one."""
    done = calls.filter("outcome = 'succeeded' AND role = 'enrich'").select("session").distinct()
    return done.agg(F.when(F.count("*") > 1, F.min("session")).alias("boundary"), F.count("*").alias("sessions"))


def with_phase(calls: DataFrame, first_session: DataFrame) -> DataFrame:
    """Adds ``phase``: initial up to the boundary session, then resume; only for enriching calls."""
    joined = calls.crossJoin(F.broadcast(first_session.select("boundary")))
    phase = F.when(F.coalesce(F.col("session") <= F.col("boundary"), F.lit(True)), "initial").otherwise("resume")
    return joined.withColumn("phase", F.when(F.col("role") == "enrich", phase)).drop("boundary")


def reserved(calls: DataFrame, rate_in: int) -> DataFrame:
    """Reservations without a settlement: those of calls that have no outcome yet, in pico-dollars."""
    settled = calls.filter("outcome IN ('succeeded', 'failed')").select("request_id")
    open_calls = calls.join(settled, "request_id", "left_anti")
    return open_calls.agg(F.count("*").alias("open"), F.coalesce(F.sum(F.col("reserved_tokens") * rate_in), F.lit(0)).alias("reserved_pico_usd"))


def admitted(calls: DataFrame, cap_pico: int, rate_in: int, part: str = "session") -> DataFrame:
    """Calls that a cap admits within each ``part``, in order of time: the running reservation stays under the cap. Dealt by hour."""
    hour = F.date_trunc("hour", F.col("ts"))
    run = running(calls, part, hour, ["ts", "request_id"], F.col("reserved_tokens") * rate_in, "running")
    return run.groupBy(part).agg(F.count_if(F.col("running") <= cap_pico).alias("admitted"), F.count_if(F.col("running") > cap_pico).alias("stopped"))


def settled_once(outcomes: DataFrame) -> DataFrame:
    """One settlement a request: the first by time."""
    return outcomes.groupBy("request_id").agg(F.min_by(F.struct(*[c for c in outcomes.columns if c != "request_id"]), F.struct("ts", "outcome")).alias("o")).select("request_id", "o.*")


def orphans(calls: DataFrame) -> DataFrame:
    """Calls without an outcome become failed calls that keep their reservation."""
    return calls.filter("outcome = 'pending'").select("request_id", F.lit("failed").alias("outcome"), F.lit("kept").alias("kind"), "reserved_tokens")


def cost_measured(calls: DataFrame, rates: DataFrame) -> DataFrame:
    """Requests, tokens and cost by stage; a stage without a rate has an unknown cost, never zero. Rates are few."""
    totals = calls.groupBy("role").agg(F.count("*").alias("requests"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
    priced = totals.join(F.broadcast(rates), "role", "left")
    return priced.select("role", "requests", "input_tokens", "output_tokens", (F.col("input_tokens") * F.col("rate_in") + F.col("output_tokens") * F.col("rate_out")).alias("pico_usd"), F.col("rate_in").isNull().alias("unknown"))


def cost_project(measured: DataFrame, scenarios: DataFrame, sample: Column) -> DataFrame:
    """Measured cost carried to each scenario's rows, half up; ``over_cap`` says which pass their cap. Both tables are few rows."""
    whole = "decimal(38,0)"  # products pass 64 bits
    total = measured.agg(F.sum("pico_usd").cast(whole).alias("pico_usd"), F.sum("requests").cast(whole).alias("requests"))
    crossed = total.crossJoin(F.broadcast(scenarios)).withColumns({"n": sample.cast("decimal(18,0)"), "rows": F.col("rows").cast("decimal(18,0)")})
    scaled = lambda c: F.expr(f"CAST(((2 * {c} * rows + n) - (2 * {c} * rows + n) % (2 * n)) / (2 * n) AS {whole})")
    made = crossed.withColumns({"q": scaled("requests"), "p": scaled("pico_usd")})
    return made.select("scenario", F.col("q").alias("requests"), F.col("p").alias("pico_usd"), (F.col("p") > F.col("cap")).alias("over_cap"))


def worst_case(texts: DataFrame, rate_in: int, rate_out: int, most_out: int) -> DataFrame:
    """The most that one request a text may cost, in pico-dollars."""
    cost = token_estimate(F.octet_length("review_text")) * rate_in + most_out * rate_out
    return texts.select("review_id", cost.alias("pico_usd"))


def closed_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with their end: the last heartbeat, or the start, where a session crashed."""
    return sessions.withColumns({"ended_how": F.when(F.col("ended").isNull(), "crashed").otherwise(F.col("ended_how")), "ended": F.coalesce("ended", "last", "started")})


def paced(requests: DataFrame, part: str, at: str, gap: int, bucket: int = 3_600_000_000) -> DataFrame:
    """When an even pace lets each request go: ``gap`` after the one before, not earlier than it came.

    slot_i = max over j <= i of (came_j + (i - j) * gap), a running maximum; rows are dealt
    by ``bucket``, a span of time.
    """
    span = F.floor(F.col(at) / bucket)
    numbered = running(requests, part, span, [at, "request_id"], F.lit(1), "__n", before=True)
    done = running(numbered, part, span, [at, "request_id"], F.col(at) - F.col("__n") * gap, "__m", largest=True)
    return done.withColumn("slot", F.col("__m") + F.col("__n") * gap).drop("__n", "__m")


def with_gaps(calls: DataFrame, part: str = "session") -> DataFrame:
    """Successes with ``gap``: microseconds since the success before in the same ``part``. Dealt by hour."""
    done = calls.filter("outcome = 'succeeded'").withColumn("__us", F.unix_micros(F.col("ts").cast("timestamp")))
    seen = running(done, part, F.date_trunc("hour", F.col("ts")), ["ts", "request_id"], F.col("__us"), "__last", largest=True, before=True)
    return seen.withColumn("gap", F.col("__us") - F.col("__last")).drop("__us", "__last")


def outages(calls: DataFrame, longest_us: int, part: str = "session") -> DataFrame:
    """The longest time between two successes within each ``part``, and how many passed ``longest_us``."""
    return with_gaps(calls, part).groupBy(part).agg(F.max("gap").alias("longest_us"), F.count_if(F.col("gap") > longest_us).alias("outages"))


def stops(calls: DataFrame, *, most_us: int, most: int, cap_pico: int, rate_in: int, longest_us: int, part: str = "session") -> DataFrame:
    """Why and when each ``part`` stops first: its time is up, its count is reached, the cap would be
    passed, a fatal answer came, or too long a time passed without a success; ties by reason."""
    hour, order_ = F.date_trunc("hour", F.col("ts")), ["ts", "request_id"]
    timed = calls.withColumn("__us", F.unix_micros(F.col("ts").cast("timestamp")))
    start = timed.groupBy(part).agg(F.min("__us").alias("__start"))
    counted = running(timed.join(start, part), part, hour, order_, F.lit(1), "__n")
    spent = running(counted, part, hour, order_, F.col("reserved_tokens") * rate_in, "__spent")
    checks = {"cap": F.col("__spent") > cap_pico, "count": F.col("__n") >= most, "fatal": F.col("fatal"), "time": F.col("__us") - F.col("__start") > most_us}
    reasons = F.array_compact(F.array(*(F.when(c, k) for k, c in checks.items())))
    found = spent.select(part, F.explode(reasons).alias("reason"), "ts").unionByName(with_gaps(calls, part).filter(F.col("gap") > longest_us).select(part, F.lit("outage").alias("reason"), "ts"))
    return found.groupBy(part).agg(F.min(F.struct("ts", "reason")).alias("m")).select(part, "m.reason", "m.ts")


def session_ends(calls: DataFrame, *, breaker: int, item: str, part: str = "session", **limits: int) -> DataFrame:
    """How and when each ``part`` ends: the first of the conditions of ``stops``, of ``interrupted`` (a row marked so) and of
    ``breaker`` (that many failures since the last success); where none came, at its last row as ``stuck`` (an ``item``
    whose last outcome is a failure) or ``finished``. Ties of a moment go by reason.
    """
    hour, order_ = F.date_trunc("hour", F.col("ts")), ["ts", "request_id"]
    failed = running(calls, part, hour, order_, (F.col("outcome") == "failed").cast("long"), "__f")
    since = running(failed, part, hour, order_, F.when(F.col("outcome") == "succeeded", F.col("__f")), "__s", largest=True)
    broken = since.filter(F.col("__f") - F.coalesce("__s", F.lit(0)) >= breaker).select(part, F.lit("breaker").alias("reason"), "ts")
    halted = calls.filter("interrupted").select(part, F.lit("interrupted").alias("reason"), "ts")
    found = stops(calls, part=part, **limits).unionByName(broken).unionByName(halted)
    first = found.groupBy(part).agg(F.min(F.struct("ts", "reason")).alias("m"))
    settled = calls.filter("outcome IN ('succeeded', 'failed')").groupBy(part, item).agg(F.max_by("outcome", F.struct(*order_)).alias("last"))
    stuck = settled.groupBy(part).agg(F.count_if(F.col("last") == "failed").alias("stuck"))
    ends = calls.groupBy(part).agg(F.max("ts").alias("end"), F.count("*").alias("calls"))
    met = ends.join(first, part, "left").join(stuck, part, "left").withColumn("stuck", F.coalesce("stuck", F.lit(0)))
    quiet = F.when(F.col("stuck") > 0, "stuck").otherwise("finished")
    return met.select(part, F.coalesce("m.reason", quiet).alias("reason"), F.coalesce("m.ts", "end").alias("ts"), "stuck")


def cheapest(trials: DataFrame) -> DataFrame:
    """Of the models that passed in all their trials, the one of the least cost, ties by name."""
    models = trials.groupBy("model").agg(F.bool_and("passed").alias("passed"), F.sum("cost").alias("cost"))
    return models.filter("passed").select("model", "cost").orderBy("cost", "model").limit(1)


def bad_batches(items: DataFrame, batch: str, index: str) -> DataFrame:
    """Batches whose indices are not exactly 1 to their number."""
    tallied = items.groupBy(batch).agg(F.count("*").alias("n"), F.max(index).alias("most"), F.countDistinct(index).alias("distinct"))
    return tallied.filter("n <> most OR distinct <> n").select(batch)
