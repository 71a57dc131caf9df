"""Ordered funnels over the event log, by user or by session.

A funnel is a state machine: in state k, an event of step k + 1 leads to state k + 1 and any other event changes nothing.
The effect of a stretch of events is therefore a small table, the state after it for each state before it, and
stretches that follow one another are put together from their tables alone. So a user's events are cut into time slots:

1. one exchange by user and slot; inside a slot, windows over the sorted events give its stretches and their tables;
2. one exchange of the stretches by user; windows put them together to sessions.

A user with a third of all events is spread over as many tasks as its events span slots, and the second step sees at
most one stretch per ``gap`` of time, however many events there are. Nothing is collected into a list.

Events without a user or a time are left out. Events at the same time count in the order of the steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from revlens.functions import ratio, round_half_up

FUNNEL_STEPS = ("view", "click", "purchase")
GAP_MINUTES = 30
SLOT_HOURS = 24

_MICROS_A_MINUTE = 60_000_000


def _before(spec: WindowSpec, col: str) -> Column:
    """Whether ``col`` was true in an earlier row."""
    return F.coalesce(F.max(col).over(spec.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))


def _numbered(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], starts: str, ends: str, gap: int, name: str) -> DataFrame:
    """``name``: the number of the stretch a row is in; a new one starts more than ``gap`` after the end of the row before."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    idle = F.col(starts) - F.lag(ends).over(spec)
    fresh = df.withColumn("_new", F.when(idle > gap, 1).otherwise(0))
    return fresh.withColumn(name, F.sum("_new").over(spec.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def _stretches(events: DataFrame, steps: int, gap: int | None, slot: int) -> DataFrame:
    """user_id, slot, part, start, end, and ``to0`` .. : the state after the stretch for each state before it."""
    rows = events.withColumn("slot", F.floor(F.col("at") / slot))
    if gap is None:
        rows = rows.withColumn("part", F.lit(0))
    else:
        rows = _numbered(rows, ("user_id", "slot"), ("at", "step"), "at", "at", gap, "part")
    keys = ("user_id", "slot", "part")
    spec = Window.partitionBy(*keys).orderBy("at", "step")
    # hit{s}_{k}: with state s before the stretch, this event is one of step k and state k - 1 was reached before it
    for s in range(steps):
        rows = rows.withColumn(f"hit{s}_{s + 1}", F.col("step") == s + 1)
    for ahead in range(2, steps + 1):
        for s in range(steps - ahead + 1):
            k = s + ahead
            rows = rows.withColumn(f"hit{s}_{k}", (F.col("step") == k) & _before(spec, f"hit{s}_{k - 1}"))
    after = [
        reduce(lambda n, k: n + F.max(f"hit{s}_{k}").cast("int"), range(s + 1, steps + 1), F.lit(s)).alias(f"to{s}")  # noqa: B023
        for s in range(steps)
    ]
    return rows.groupBy(*keys).agg(F.min("at").alias("start"), F.max("at").alias("end"), *after)


def funnel_states(
    events: DataFrame,
    steps: tuple[str, ...] = FUNNEL_STEPS,
    gap_minutes: int | None = GAP_MINUTES,
    slot_hours: int = SLOT_HOURS,
) -> DataFrame:
    """user_id, session, inicio (micros), fim (micros), etapa: the last step that each session reached in order (0: none).

    A session is a run of a user's events of any type in which no two neighbours are more than ``gap_minutes`` apart.
    With None, all events of a user are one session, and only events of the steps are read.
    """
    step = reduce(lambda c, k: c.when(F.col("event_type") == steps[k], k + 1), range(1, len(steps)), F.when(F.col("event_type") == steps[0], 1))
    known = F.col("user_id").isNotNull() & F.col("ts").isNotNull()
    if gap_minutes is None:
        known &= F.col("event_type").isin(*steps)
    rows = events.where(known).select(
        "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.coalesce(step, F.lit(0)).alias("step")
    )
    gap = None if gap_minutes is None else gap_minutes * _MICROS_A_MINUTE
    parts = _stretches(rows, len(steps), gap, slot_hours * 60 * _MICROS_A_MINUTE)
    if gap is None:
        parts = parts.withColumn("session", F.lit(0))
    else:
        parts = _numbered(parts, ("user_id",), ("start",), "start", "end", gap, "session")
    spec = Window.partitionBy("user_id", "session").orderBy("start")
    for k in range(1, len(steps) + 1):
        ways = [F.col("to0") >= k] + [(F.col(f"to{m}") >= k) & _before(spec, f"got{m}") for m in range(1, k)]
        parts = parts.withColumn(f"got{k}", reduce(Column.__or__, ways))
    reached = reduce(Column.__add__, [F.max(f"got{k}").cast("int") for k in range(1, len(steps) + 1)])
    return parts.groupBy("user_id", "session").agg(F.min("start").alias("inicio"), F.max("end").alias("fim"), reached.alias("etapa"))


def _report(counts: DataFrame, steps: tuple[str, ...], measure: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per step from one row of counts ``{measure}{k}``: shares of the step before and of the first step."""
    rows = []
    for k, step in enumerate(steps):
        n = F.col(f"{measure}{k}")
        of_previous = round_half_up(ratio(n * F.lit(100.0), F.col(f"{measure}{k - 1}")), 2) if k else F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(k + 1).cast("bigint").alias("ordem"),
                F.lit(step).alias("etapa"),
                n.alias(measure),
                *[F.col(f"{e}{k}").alias(e) for e in extra],
                of_previous.alias("pct_etapa_anterior"),
                round_half_up(ratio(n * F.lit(100.0), F.col(f"{measure}0")), 2).alias("pct_topo"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def event_funnel(events: DataFrame, steps: tuple[str, ...] = FUNNEL_STEPS) -> DataFrame:
    """Users reaching each step in order, over all their events.

    A user reaches step k with an event of that type at or after the moment they reached step k - 1. The drop between
    'click' and 'purchase' is the abandonment the roadmap asks about.
    """
    states = funnel_states(events, steps, gap_minutes=None)
    reached = [F.count_if(F.col("etapa") > k).alias(f"usuarios{k}") for k in range(len(steps))]
    return _report(states.agg(*reached), steps, "usuarios")


def session_funnel(
    events: DataFrame, steps: tuple[str, ...] = FUNNEL_STEPS, gap_minutes: int = GAP_MINUTES, slot_hours: int = SLOT_HOURS
) -> DataFrame:
    """Sessions reaching each step in order, and the users who have such a session (``usuarios``).

    The cart abandonment of a visit: a purchase days after the click doesn't count, as it does in :func:`event_funnel`.
    """
    states = funnel_states(events, steps, gap_minutes, slot_hours)
    per_user = states.groupBy("user_id").agg(*[F.count_if(F.col("etapa") > k).alias(f"n{k}") for k in range(len(steps))])
    counts = per_user.agg(
        *[F.coalesce(F.sum(f"n{k}"), F.lit(0)).cast("bigint").alias(f"sessoes{k}") for k in range(len(steps))],
        *[F.count_if(F.col(f"n{k}") > 0).alias(f"usuarios{k}") for k in range(len(steps))],
    )
    return _report(counts, steps, "sessoes", ("usuarios",))
