"""A rate limiter replayed over a log: even pace, halved by slow-down answers, climbing back."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.order import running


def _next_of(times: np.ndarray, every: int) -> np.ndarray:
    """For each time the place of the first one at least ``every`` later (their number, if there is none)."""
    return np.searchsorted(times, times + every)


def spread_out(marks: DataFrame, part: str, at: str, every: int, block: int = 600_000_000) -> DataFrame:
    """Of the marks of each ``part`` the first, then always the first that is at least ``every`` after the one taken before.

    Which mark a ``block`` of time (never shorter than ``every``) takes depends on the one
    taken last before it, so each block first states where it would end for every mark that
    it may start with; these short tables, one row a block, are walked in order, and with
    its start known each block takes its marks. Only a block's distinct times meet in one
    task, and of a part only the tables of its blocks. Null parts are a part; null times
    are left out.
    """
    kind, long_ = marks.schema[part].dataType.simpleString(), max(block, every)
    times = marks.filter(F.col(at).isNotNull()).select(F.col(part).alias("part"), F.col(at).cast("long").alias("at")).distinct()
    dealt = times.withColumn("block", F.floor(F.col("at") / long_).cast("long"))

    def ends(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(rows["at"].to_numpy())
        after, last = _next_of(found, every), found.copy()
        for i in range(len(found) - 1, -1, -1):
            if after[i] < len(found):
                last[i] = last[after[i]]
        starts = min(int(np.searchsorted(found, key[1] * long_ + every)) + 1, len(found))  # marks that may come first
        return pd.DataFrame({"part": rows["part"].iloc[:1].array, "block": [key[1]], "latest": [found[-1]], "first": [found[:starts]], "last": [last[:starts]]})

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, taken, out = rows.sort_values("block"), None, []
        for row in rows.itertuples():
            out.append(row.first[0] if taken is None else taken + every)
            if out[-1] <= row.latest:
                place = int(np.searchsorted(row.first, out[-1]))
                taken = int(row.last[place])
        return rows[["part", "block"]].assign(opens=out)

    def take(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(rows["at"].to_numpy())
        after, place, out = _next_of(found, every), int(np.searchsorted(found, rows["opens"].iloc[0])), []
        while place < len(found):
            out.append(found[place])
            place = after[place]
        return rows[["part"]].head(len(out)).assign(at=out)

    tables = dealt.groupBy("part", "block").applyInPandas(ends, f"part {kind}, block long, latest long, first array<long>, last array<long>")
    opened = tables.groupBy("part").applyInPandas(walk, f"part {kind}, block long, opens long")
    same = dealt["part"].eqNullSafe(opened["part"]) & (dealt["block"] == opened["block"])
    met = dealt.join(opened, same).select(dealt["part"], dealt["block"], dealt["at"], "opens")
    return met.groupBy("part", "block").applyInPandas(take, f"part {kind}, at long").select(F.col("part").alias(part), F.col("at").alias(at))


def halvings(slow: DataFrame, part: str, at: str, *, ceiling: float, recover: float, every: int = 10_000_000) -> DataFrame:
    """When the rate halves and to what: at a slow-down answer, but not within ``every`` microseconds of the last halving.

    The rate climbs by ``recover`` a second up to ``ceiling`` and never falls below one a
    second. A part's halvings are walked in order by one task; they are ``every`` apart, so
    their number is bounded by the time that the log spans (8640 a day), not by its rows.
    """
    taken = spread_out(slow, part, at, every)
    kind = taken.schema[part].dataType.simpleString()

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, rate, before, out = rows.sort_values(at), ceiling, None, []
        for now in rows[at]:
            climbed = ceiling if before is None else min(ceiling, rate + recover * ((now - before) / 1e6))
            rate, before = max(1.0, climbed / 2), now
            out.append(rate)
        return rows.assign(rate=out)

    return taken.groupBy(part).applyInPandas(walk, f"{part} {kind}, {at} long, rate double")


def limited(requests: DataFrame, slow: DataFrame, part: str, at: str, tokens: str, *, ceiling: float, recover: float, tokens_per_second: int, every: int = 10_000_000, bucket: int = 3_600_000_000) -> DataFrame:
    """When the limiter lets each request go: adds ``rate`` (at its coming, after slow-down answers of that moment) and ``slot``.

    After a request the next waits for 1 / rate and for the time that its tokens take, the
    longer of the two, in whole microseconds (half up). So
    slot_i = max over j <= i of (came_j + the waits from j to i - 1), which is a running sum
    and a running maximum, dealt by ``bucket`` of time; the last halving before a request is
    a running maximum too. Requests are ordered by ``at``, then ``request_id``; ``part`` and
    ``at`` must not be null.
    """
    marks = halvings(slow, part, at, ceiling=ceiling, recover=recover, every=every)
    marks = marks.select(part, at, F.struct(F.col(at).alias("at"), "rate").alias("__mark"))
    joined = requests.withColumn("__kind", F.lit(1)).unionByName(marks.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    span = F.floor(F.col(at) / bucket)
    seen = running(joined, part, span, [at, "__kind", "request_id"], F.col("__mark"), "__last", largest=True).filter("__kind = 1")
    climbed = F.least(F.lit(float(ceiling)), F.col("__last.rate") + recover * ((F.col(at) - F.col("__last.at")) / F.lit(1e6)))
    paced = seen.withColumn("rate", F.coalesce(climbed, F.lit(float(ceiling))))
    by_rate = F.floor(F.lit(1e6) / F.col("rate") + 0.5)
    by_tokens = F.floor((F.coalesce(F.col(tokens), F.lit(0)) * F.lit(1e6)) / tokens_per_second + 0.5)
    waits = paced.withColumn("__gap", F.greatest(by_rate, by_tokens)).drop("__mark", "__kind", "__last")
    order_ = [at, "request_id"]
    summed = running(waits, part, span, order_, F.col("__gap"), "__g", before=True)
    held = running(summed, part, span, order_, F.col(at) - F.col("__g"), "__m", largest=True)
    return held.withColumn("slot", F.col("__m") + F.col("__g")).drop("__gap", "__g", "__m")
