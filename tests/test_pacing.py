"""The limiter against a plain replay, one request after the other."""

from __future__ import annotations

import math
import random

import pytest

from tallyloom.operators import pacing

S = 1_000_000


def plain_halvings(times, ceiling, recover, every):
    rate, last, out = ceiling, None, []
    for t in sorted(set(times)):
        if last is None or t - last >= every:
            now = ceiling if last is None else min(ceiling, rate + recover * ((t - last) / 1e6))
            rate, last = max(1.0, now / 2), t
            out.append((t, rate))
    return out


def plain_slots(requests, halved, ceiling, recover, tps):
    free, out = -math.inf, {}
    for t, number, tokens in sorted(requests):
        before = [x for x in halved if x[0] <= t]
        rate = min(ceiling, before[-1][1] + recover * ((t - before[-1][0]) / 1e6)) if before else ceiling
        slot = max(t, free)
        free = slot + max(math.floor(1e6 / rate + 0.5), math.floor(tokens * 1e6 / tps + 0.5))
        out[number] = (rate, slot)
    return out


@pytest.mark.parametrize("spread", [30, 3000, 40_000])
def test_limiter_equals_a_plain_replay(spark, spread):
    draw = random.Random(spread)
    requests = [(p, draw.randrange(spread * S), i, draw.randrange(3000)) for i, p in enumerate(draw.choices("aaab", k=400))]
    slow = [(p, draw.choice([t, t + 10 * S, t // (10 * S) * 10 * S])) for p, t, _, _ in draw.sample(requests, 150)]
    got = pacing.limited(
        spark.createDataFrame(requests, "user string, at long, request_id long, tokens long"), spark.createDataFrame(slow, "user string, at long"),
        "user", "at", "tokens", ceiling=8.0, recover=0.05, tokens_per_second=1000, bucket=60 * S,
    )
    want = {}
    for part in "ab":
        halved = plain_halvings([t for p, t in slow if p == part], 8.0, 0.05, 10 * S)
        want |= plain_slots([r[1:] for r in requests if r[0] == part], halved, 8.0, 0.05, 1000)
    assert {r["request_id"]: (r["rate"], r["slot"]) for r in got.collect()} == want


@pytest.mark.parametrize("block", [10, 11, 600])
def test_marks_taken_do_not_depend_on_blocks(spark, block):
    draw = random.Random(block)
    times = [draw.randrange(-500 * S, 4000 * S) for _ in range(700)] + [0, 0, 10 * S, 20 * S - 1, 20 * S, 30 * S]
    marks = spark.createDataFrame([(None, t) for t in times] + [("x", None), ("y", 5)], "user string, at long")
    got = pacing.spread_out(marks, "user", "at", 10 * S, block * S).collect()
    assert sorted(r["at"] for r in got if r["user"] is None) == [t for t, _ in plain_halvings(times, 1.0, 0.0, 10 * S)]
    assert [(r["user"], r["at"]) for r in got if r["user"]] == [("y", 5)]


def test_no_slow_answers_and_no_requests(spark):
    none = spark.createDataFrame([], "user string, at long")
    one = spark.createDataFrame([("a", 7, 1, None), ("a", 7, 2, 10)], "user string, at long, request_id long, tokens long")
    settings = {"ceiling": 2.0, "recover": 1.0, "tokens_per_second": 10}
    assert sorted((r["request_id"], r["rate"], r["slot"]) for r in pacing.limited(one, none, "user", "at", "tokens", **settings).collect()) == [(1, 2.0, 7), (2, 2.0, 500_007)]
    assert pacing.limited(one.limit(0), none, "user", "at", "tokens", **settings).count() == 0
