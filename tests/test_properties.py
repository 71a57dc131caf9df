"""Invariants on the fixture data and randomized checks against brute-force models."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from revlens import config as C
from revlens.functions import title_case, trim_ws
from revlens.functions.text import WORD_DELIMITERS
from revlens.operators import growth, leakage, silver
from revlens.plans.catalog import warehouse

# --- invariants on the served warehouse over the smallest test folder -------


@pytest.fixture(scope="module")
def wh(spark, small_dir):
    return warehouse(spark, small_dir)


def test_dedup_partitions_registrations(wh):
    users = wh.raw.users
    with_email = users.where("email IS NOT NULL").count()
    null_email = users.where("email IS NULL").count()
    survivors = wh.stg_users.count()
    mapped = wh.stg_user_id_mapping.count()
    # every registration with an e-mail either survives or is mapped; NULL e-mails keep one
    assert survivors + mapped == with_email + min(null_email, 1)
    ids = {r.customer_id for r in wh.stg_users.select("customer_id").collect()}
    mapping = wh.stg_user_id_mapping.collect()
    assert not {r.user_id_original for r in mapping} & ids
    assert {r.user_id_canonical for r in mapping} <= ids


def test_view_keeps_order_grain(wh):
    assert wh.vw_sales_analysis.count() == wh.stg_orders.count()
    assert wh.vw_sales_analysis.select("order_id").distinct().count() == wh.stg_orders.count()
    assert wh.dim_customers_gold.count() == wh.stg_users.count()


def test_overview_buckets_add_up(wh):
    got = {r.tipo: r for r in leakage.leakage_overview(wh.vw_sales_analysis).collect()}
    gross = got[C.LEAK_GROSS]
    parts = [got[C.LEAK_REAL], got[C.LEAK_LOST], got[C.LEAK_RISK]]
    assert gross.total_pedidos == sum(p.total_pedidos for p in parts)
    assert gross.receita_total == pytest.approx(sum(p.receita_total or 0 for p in parts), abs=0.05)


def test_shares_sum_to_100(wh):
    for df, col in (
        (leakage.leakage_by_status(wh.vw_sales_analysis), "pct_pedidos"),
        (leakage.leakage_by_channel(wh.vw_sales_analysis), "pct_pedidos_perdidos"),
    ):
        total = sum(r[col] for r in df.collect())
        assert total == pytest.approx(100.0, abs=0.05 * df.count())


def test_growth_summary_counts_match_dimension(wh):
    dim = wh.dim_customers_gold
    got = {r.grupo: r.total_clientes for r in growth.growth_summary(dim).collect()}
    assert got[C.GROWTH_UNCONVERTED] == dim.where(dim.status_cliente == C.SEM_COMPRA).count()
    assert got[C.GROWTH_NEW] == dim.where(dim.status_cliente == C.NOVO).count()


# --- randomized: dedup against a brute-force model ----------------------------

EMAILS = ["a@x.com", " A@x.com", "a@X.COM\t", "b@x.com", "B@x.com ", "", "  ", None]
DAYS = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]


def _brute_dedup(rows):
    """ROW_NUMBER() OVER (PARTITION BY lower(trim(email)) ORDER BY created_at, id) by hand."""

    def key(email):
        return None if email is None else _model_trim(email).lower()

    groups: dict = {}
    for uid, email, created in rows:
        groups.setdefault(key(email), []).append((created, uid))
    survivors, mapping = {}, {}
    for k, members in groups.items():
        members.sort()
        first = members[0][1]
        survivors[first] = k
        if k is not None:
            for _, uid in members[1:]:
                mapping[uid] = first
    return survivors, mapping


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(EMAILS), st.sampled_from(DAYS)), min_size=1, max_size=25
    )
)
def test_dedup_matches_brute_force(spark, regs):
    rows = [(i + 1, email, created) for i, (email, created) in enumerate(regs)]
    users = spark.createDataFrame(
        [(i, "n", "s", e, 30, "F", "c", "c", "t", d) for i, e, d in rows],
        "id long, first_name string, last_name string, email string, age long, gender string, "
        "country string, city string, traffic_source string, created_at timestamp_ntz",
    )
    stg = silver.stg_users(users)
    got_survivors = {r.customer_id: r.email for r in stg.collect()}
    got_mapping = {
        r.user_id_original: r.user_id_canonical
        for r in silver.stg_user_id_mapping(users, stg).collect()
    }
    want_survivors, want_mapping = _brute_dedup(rows)
    assert got_survivors == want_survivors
    assert got_mapping == want_mapping


# --- randomized: TRIM / INITCAP against a character-level model ---------------


def _is_ws(ch: str) -> bool:
    return ch in "\t\n\x0b\x0c\r\x85" or unicodedata.category(ch).startswith("Z")


def _model_trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and _is_ws(s[i]):
        i += 1
    while j > i and _is_ws(s[j - 1]):
        j -= 1
    return s[i:j]


def _model_title(s: str) -> str:
    out, start = [], True
    for ch in _model_trim(s).lower():
        delim = _is_ws(ch) or ch in WORD_DELIMITERS
        out.append(ch.upper() if start and not delim else ch)
        start = delim
    return "".join(out)


ALPHABET = "abcXYZéÉçãõ019'`=" + "\t   " + WORD_DELIMITERS


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=1, max_size=40))
def test_text_functions_match_model(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    got = [(r[0], r[1]) for r in df.select(trim_ws("s"), title_case("s")).collect()]
    assert got == [(_model_trim(s), _model_title(s)) for s in strings]


# --- randomized: monthly status snapshot against a month-by-month recomputation ---

SNAP_AS_OF = dt.date(2001, 6, 15)


def _month_ends(first: dt.date, last: dt.date):
    y, m = first.year, first.month
    while True:
        nxt = dt.date(y + (m == 12), m % 12 + 1, 1)
        end = nxt - dt.timedelta(days=1)
        if end > last:
            return
        yield end
        y, m = nxt.year, nxt.month


def _brute_snapshot(users, items):
    dates = [s for _, s in users if s] + [d for _, _, d in items]
    out = {}
    if not dates:
        return out
    for me in _month_ends(min(dates), SNAP_AS_OF):
        for uid, signup in users:
            mine = [(o, d) for u, o, d in items if u == uid and d <= me]
            if mine:
                days = (me - max(d for _, d in mine)).days
                n = len({o for o, _ in mine})
                status = C.NOVO if days <= 90 and n == 1 else C.ATIVO if days <= 180 else C.CHURN
            elif signup is not None and signup <= me:
                status = C.SEM_COMPRA
            else:
                continue
            key = (me.strftime("%Y-%m"), me, status)
            out[key] = out.get(key, 0) + 1
    return out


DAY0 = dt.date(2000, 1, 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 500)), min_size=1, max_size=6),
    st.lists(st.tuples(st.integers(0, 6), st.integers(1, 8), st.integers(0, 520)), max_size=25),
)
def test_status_snapshot_matches_brute_force(spark, signups, buys):
    from revlens.operators import roadmap

    users = [(i + 1, None if s is None else DAY0 + dt.timedelta(days=s)) for i, s in enumerate(signups)]
    # user 0 does not exist among the customers: its purchases must not count
    items = [(u, o + 100 * u, DAY0 + dt.timedelta(days=d)) for u, o, d in buys]
    stg = spark.createDataFrame(
        [(uid, T_(signup)) for uid, signup in users], "customer_id long, customer_since timestamp_ntz"
    )
    it = spark.createDataFrame(
        [(u, o, dt.datetime.combine(d, dt.time(13))) for u, o, d in items],
        "user_id long, order_id long, created_at timestamp_ntz",
    ).select(
        "user_id", "order_id", "created_at",
        F.lit(1).cast("long").alias("order_item_id"), F.lit(1.0).alias("sale_price"),
        F.lit(1.0).alias("cost"), F.lit(0.0).alias("margem"), F.lit(0.0).alias("margem_pct"),
        F.lit("Complete").alias("status"),
    )
    got = {
        (r.ano_mes, r.data_snapshot, r.status_cliente): r.clientes
        for r in roadmap.status_snapshot(stg, it, SNAP_AS_OF).collect()
    }
    known = {uid for uid, _ in users}
    assert got == _brute_snapshot(users, [x for x in items if x[0] in known])


def T_(day):
    return None if day is None else dt.datetime.combine(day, dt.time(9))


# --- randomized: ordered funnel against a per-user scan ------------------------


def _brute_funnel(events, steps):
    reached = [0] * len(steps)
    for uid in {u for u, _, _ in events}:
        mine = sorted((ts, kind) for u, kind, ts in events if u == uid)
        at = None
        for k, step in enumerate(steps):
            times = [ts for ts, kind in mine if kind == step and (at is None or ts >= at)]
            if not times:
                break
            at = min(times)
            reached[k] += 1
    return reached


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 5), st.sampled_from(["view", "click", "purchase", "error"]), st.integers(0, 50)),
        max_size=40,
    )
)
def test_event_funnel_matches_brute_force(spark, raw_events):
    from revlens.operators import funnel

    events = [(u, kind, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)) for u, kind, m in raw_events]
    df = spark.createDataFrame(events, "user_id long, event_type string, ts timestamp_ntz")
    got = [r.usuarios for r in sorted(funnel.event_funnel(df).collect(), key=lambda r: r.ordem)]
    assert got == _brute_funnel(events, funnel.FUNNEL_STEPS)
