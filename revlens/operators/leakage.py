"""Revenue-leakage reports over the order view.

Every report aggregates the view first. A share of the whole (the
script's ``SUM(...) OVER ()``) divides by a scalar subquery over that
aggregate -- a global sum, combined map-side -- rather than an
unpartitioned window, which would move every group into one task. The
trend's share of its year is a window partitioned by year over the day
aggregate (at most 366 rows per partition).

``COUNT(DISTINCT order_id)`` is kept as written even though the view has
one row per order: it is what the report means, and with one distinct
column Spark plans it without an ``Expand``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions import (
    as_double,
    dsum,
    from_micros,
    money_total,
    ratio,
    round_half_up,
    year_of,
)


ROLLUP_KEYS = ("status_pedido", "country", "traffic_source", "ano", "ano_mes", "data_pedido")


def leakage_rollup(view: DataFrame) -> DataFrame:
    """Orders and revenue by every key of the leakage reports; P9-P13 give the same values from it as from the view.

    A distinct count can't be added up over groups, but almost every order has one row. Those are counted
    (``pedidos``); the rows of an order that has several keep its ``order_id`` and are counted distinctly by each report.
    So the orders are shuffled once, here, by their ids alone (8 bytes and a count, combined map-side), and a
    report shuffles rows whose number is bounded by days x statuses x countries x channels. Bitmaps of order numbers
    would cost 4 KB for each group and 32,768 ids, more than the ids themselves, unless the rows are sorted by order.
    Rows without an order id bring revenue and no order. ``receita_micros`` is the exact sum in micro-units.
    """
    several = view.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    marked = view.select("order_id", *ROLLUP_KEYS, "receita_pedido").join(several, "order_id", "left")
    several_rows = F.col("_rows").isNotNull()
    return marked.groupBy(*ROLLUP_KEYS, F.when(several_rows, F.col("order_id")).alias("order_id")).agg(
        F.count_if(~several_rows & F.col("order_id").isNotNull()).alias("pedidos"), dsum("receita_pedido").alias("receita_micros")
    )


def _orders(rows: DataFrame) -> Column:
    """Distinct orders of a group, of the view or of its rollup."""
    several = F.count_distinct("order_id")
    return F.coalesce(F.sum("pedidos"), F.lit(0)) + several if "pedidos" in rows.columns else several


def _revenue(rows: DataFrame) -> Column:
    """Exact revenue of a group in micro-units, of the view or of its rollup."""
    return F.sum("receita_micros") if "receita_micros" in rows.columns else dsum("receita_pedido")


def _lost(view: DataFrame, rules: Rules) -> DataFrame:
    return view.where(F.col("status_pedido").isin(*rules.lost_statuses))


def _share(part: Column, total: Column) -> Column:
    """ROUND(part * 100.0 / total, 2) in double precision."""
    return round_half_up(ratio(as_double(part) * F.lit(100.0), total), 2)


def _grand_total(groups: DataFrame, col: str) -> Column:
    """SUM(col) over all groups, as a scalar subquery (NULL when there are none)."""
    return groups.agg(F.sum(col).alias("total")).scalar()


def leakage_overview(view: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Orders and revenue for gross / real / lost / at-risk, one row each.

    One scan: a per-status aggregate (a handful of rows) is folded into the
    four buckets with conditional sums, instead of scanning the view once
    per bucket. An order has one status, so per-status distinct counts add
    up to the bucket's distinct count. An empty bucket still yields its row,
    with 0 orders and NULL revenue, as a global aggregate would.
    """
    per_status = view.groupBy("status_pedido").agg(
        _orders(view).alias("_n"), _revenue(view).alias("_r")
    )
    status = F.col("status_pedido")
    buckets = (
        (C.LEAK_GROSS, F.lit(True)),
        (C.LEAK_REAL, status.isin(*rules.valid_statuses)),
        (C.LEAK_LOST, status.isin(*rules.lost_statuses)),
        (C.LEAK_RISK, status == rules.risk_status),
    )
    sums = []
    for i, (_, cond) in enumerate(buckets):
        sums.append(F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0).cast("bigint")).alias(f"n{i}"))
        sums.append(F.sum(F.when(cond, F.col("_r"))).alias(f"r{i}"))
    folded = per_status.agg(*sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("tipo"),
                F.col(f"n{i}").alias("total_pedidos"),
                money_total(F.col(f"r{i}")).alias("receita_total"),
            )
            for i, (label, _) in enumerate(buckets)
        ]
    )
    return folded.select(F.inline(rows))


def leakage_by_status(view: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P10: lost orders and revenue per lost status, with each status' share of orders."""
    g = _lost(view, rules).groupBy("status_pedido").agg(
        _orders(view).alias("total_pedidos"), _revenue(view).alias("_r")
    )
    return g.select(
        "status_pedido",
        "total_pedidos",
        money_total("_r").alias("receita_perdida"),
        _share(F.col("total_pedidos"), _grand_total(g, "total_pedidos")).alias("pct_pedidos"),
    ).orderBy(F.col("receita_perdida").desc_nulls_last(), F.col("status_pedido").asc_nulls_first())


def leakage_by_country(view: DataFrame, rules: Rules = DEFAULT_RULES, n: int | None = None) -> DataFrame:
    """Top countries by lost revenue; the share is of all countries (taken before LIMIT)."""
    n = rules.top_countries if n is None else n
    g = _lost(view, rules).groupBy("country").agg(
        _orders(view).alias("total_pedidos_perdidos"),
        _revenue(view).alias("_r"),
    )
    return (
        g.select(
            "country",
            "total_pedidos_perdidos",
            money_total("_r").alias("receita_perdida"),
            _share(from_micros("_r"), from_micros(_grand_total(g, "_r"))).alias(
                "pct_receita_perdida"
            ),
        )
        .orderBy(F.col("receita_perdida").desc_nulls_last(), F.col("country").asc_nulls_first())
        .limit(n)
    )


def leakage_by_channel(view: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Lost orders and revenue per acquisition channel, with share of lost orders."""
    g = _lost(view, rules).groupBy(F.col("traffic_source").alias("canal")).agg(
        _orders(view).alias("total_pedidos_perdidos"),
        _revenue(view).alias("_r"),
    )
    n = F.col("total_pedidos_perdidos")
    return g.select(
        "canal",
        "total_pedidos_perdidos",
        money_total("_r").alias("receita_perdida"),
        _share(n, _grand_total(g, "total_pedidos_perdidos")).alias("pct_pedidos_perdidos"),
    ).orderBy(F.col("receita_perdida").desc_nulls_last(), F.col("canal").asc_nulls_first())


def leakage_trend(view: DataFrame, rules: Rules = DEFAULT_RULES, n: int | None = None) -> DataFrame:
    """Lost revenue by month label and day, share of its year, latest ``n`` rows.

    The script groups by month *and* day, so a row is a day; ties inside a
    month are broken by the day (latest first) so the cut is repeatable.
    The year window runs over the day aggregate (at most 366 rows a year).
    """
    n = rules.trend_rows if n is None else n
    g = _lost(view, rules).groupBy("ano_mes", "data_pedido").agg(
        _orders(view).alias("pedidos_perdidos"), _revenue(view).alias("_r")
    )
    year = Window.partitionBy(year_of("data_pedido"))
    return (
        g.select(
            "ano_mes",
            "data_pedido",
            "pedidos_perdidos",
            money_total("_r").alias("receita_perdida"),
            _share(from_micros("_r"), from_micros(F.sum("_r").over(year))).alias("pct_perda_no_ano"),
        )
        .orderBy(F.col("ano_mes").desc_nulls_last(), F.col("data_pedido").desc_nulls_last())
        .limit(n)
        .drop("data_pedido")
    )


def leakage_trend_monthly(
    view: DataFrame, rules: Rules = DEFAULT_RULES, n: int | None = None
) -> DataFrame:
    """The month-grain trend the report's title promises: one row per month, every month unless ``n`` is given."""
    g = _lost(view, rules).groupBy("ano", "ano_mes").agg(
        _orders(view).alias("pedidos_perdidos"), _revenue(view).alias("_r")
    )
    year = Window.partitionBy("ano")
    months = g.select(
        "ano_mes",
        "pedidos_perdidos",
        money_total("_r").alias("receita_perdida"),
        _share(from_micros("_r"), from_micros(F.sum("_r").over(year))).alias("pct_perda_no_ano"),
    ).orderBy(F.col("ano_mes").desc_nulls_last())
    return months if n is None else months.limit(n)
