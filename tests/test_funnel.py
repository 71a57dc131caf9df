"""Funnels by session and by user against a walk over each user's events; tiers against sorted values."""

from __future__ import annotations

import datetime as dt
import random
from math import ceil

import pytest
from pyspark.sql import functions as F

from revlens.operators import funnel, tiers

STEPS = funnel.FUNNEL_STEPS
SCHEMA = "user_id bigint, event_type string, ts timestamp"
T0 = dt.datetime(2001, 1, 1)


def walked(events, gap):
    """(sessions, users) that reach each step, by walking the events of each user in order."""
    by_user = {}
    for user, kind, ts in events:
        if user is not None and ts is not None:
            by_user.setdefault(user, []).append((ts, STEPS.index(kind) + 1 if kind in STEPS else 0))
    sessions, users = [0] * len(STEPS), [0] * len(STEPS)
    for rows in by_user.values():
        best, state, last = 0, 0, None
        ended = []
        for ts, step in sorted(rows):
            if last is not None and gap is not None and ts - last > gap:
                ended.append(state)
                state = 0
            state, last = (step if step == state + 1 else state), ts
        ended.append(state)
        best = max(ended)
        for k in range(len(STEPS)):
            sessions[k] += sum(s > k for s in ended)
            users[k] += best > k
    return sessions, users


def made_events(seed, n=3000):
    r = random.Random(seed)
    kinds = [*STEPS, "login", None]
    rows = [
        # user 1 holds a third of the rows, within a few days, so that sessions cross slots
        (1 if r.random() < 0.34 else r.randrange(2, 60), r.choice(kinds), T0 + dt.timedelta(minutes=r.randrange(0, 9000 if r.random() < 0.5 else 400)))
        for _ in range(n)
    ]
    return rows + [(None, "view", T0), (3, "view", None)] + rows[:50]


@pytest.mark.parametrize("slot_hours", [1, 24])
def test_sessions_like_a_walk(spark, slot_hours):
    rows = made_events(slot_hours)
    got = sorted(funnel.session_funnel(spark.createDataFrame(rows, SCHEMA), slot_hours=slot_hours).collect())
    sessions, users = walked(rows, dt.timedelta(minutes=30))
    assert [r.sessoes for r in got] == sessions and [r.usuarios for r in got] == users
    assert sessions[2] > users[2] > 0


def test_a_session_across_slots_and_a_gap_of_exactly_the_limit(spark):
    at = [T0 - dt.timedelta(minutes=20), T0 + dt.timedelta(minutes=10), T0 + dt.timedelta(minutes=40)]
    rows = [(1, k, t) for k, t in zip(STEPS, at, strict=True)] + [(2, k, t + dt.timedelta(seconds=i)) for i, (k, t) in enumerate(zip(STEPS, at, strict=True))]
    got = sorted(funnel.session_funnel(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r.sessoes for r in got] == [2, 1, 1]


def test_users_like_a_walk_and_no_events(spark):
    rows = made_events(5)
    got = sorted(funnel.event_funnel(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r.usuarios for r in got] == walked(rows, None)[1]
    empty = spark.createDataFrame([], SCHEMA)
    assert [(r.sessoes, r.usuarios, r.pct_topo) for r in funnel.session_funnel(empty).collect()] == [(0, 0, None)] * 3


@pytest.mark.parametrize("report", [funnel.event_funnel, funnel.session_funnel])
def test_one_scan_and_an_exchange_per_level(spark, small_dir, report):
    plan = report(spark.read.parquet(f"{small_dir}/events.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    # by user and slot, stretches by user, the report's one row
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_quantiles_are_values_of_the_table(spark, bins):
    r = random.Random(bins)
    values = [round(r.lognormvariate(4, 2), 2) for _ in range(500)] + [36.0] * 250 + [0.0, -5.25]
    probs = ("0", "0.01", "0.25", "0.5", "0.75", "1")
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "ltv double")
    wanted = [sorted(values)[max(1, ceil(float(p) * len(values))) - 1] for p in probs]
    assert tiers.exact_quantiles(df, "ltv", probs, bins) == wanted
    assert tiers.exact_quantiles(df.where(F.col("ltv").isNull()), "ltv", probs) == [None] * 6


def test_tiers_keep_the_constants_without_revenue(spark):
    df = spark.createDataFrame([(0.0,), (None,)], "ltv double")
    assert tiers.tier_rules(df) == tiers.DEFAULT_RULES
    assert tiers.tier_rules(spark.createDataFrame([(float(v),) for v in range(0, 101)], "ltv double")).tier_low == 25.0
