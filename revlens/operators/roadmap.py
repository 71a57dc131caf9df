"""Items the warehouse's roadmap names or whose figures it publishes without a script.

``category_margin``  margin by product category (figures published, no query given)
``status_snapshot``  lifecycle status counts at every month-end (roadmap: churn over time)

The funnels over the event log are in ``funnel``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions import (
    as_of_date,
    davg,
    dsum,
    from_micros,
    money_round,
    money_total,
    ratio,
    round_half_up,
)
from revlens.operators.gold import order_lines


def category_margin(items: DataFrame) -> DataFrame:
    """Margin per category from the item fact, best first.

    No script computes the published ranking, so both readings are given:
    ``margem_pct_total`` = total margin / total revenue (revenue-weighted) and
    ``margem_pct_media`` = mean of the per-item margin %.
    """
    g = items.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_itens"),
        dsum("sale_price").alias("_sale"),
        dsum("margem").alias("_margem"),
        davg("margem_pct").alias("_mpct"),
    )
    return g.select(
        "category",
        "total_itens",
        money_total("_sale").alias("receita"),
        money_total("_margem").alias("margem"),
        round_half_up(ratio(from_micros("_margem"), from_micros("_sale")) * F.lit(100.0), 2).alias(
            "margem_pct_total"
        ),
        money_round("_mpct").alias("margem_pct_media"),
    ).orderBy(F.col("margem_pct_total").desc_nulls_last(), F.col("category").asc_nulls_first())


def peak_month_categories(items: DataFrame, series: DataFrame) -> DataFrame:
    """Items, revenue and margin by category in each year's month of highest revenue (ties: the earlier month).

    ``series`` is the month series, a row per calendar month, so its peak months are broadcast. Over an item fact laid
    out by month, Spark prunes the folders of all other months at run time (dynamic partition pruning).
    """
    best = Window.partitionBy("ano").orderBy(F.col("receita_mensal").desc_nulls_last(), F.col("mes"))
    peaks = series.withColumn("_at", F.row_number().over(best)).where(F.col("_at") == 1).select(F.col("ano_mes").alias("_pico"))
    found = items.join(F.broadcast(peaks), items.ano_mes == peaks._pico)
    g = found.groupBy("ano_mes", "category").agg(
        F.count(F.lit(1)).alias("total_itens"), dsum("sale_price").alias("_sale"), dsum("margem").alias("_margem")
    )
    return g.select("ano_mes", "category", "total_itens", money_total("_sale").alias("receita"), money_total("_margem").alias("margem"))


def _month_end_on_or_before(day: Column) -> Column:
    """The last month-end on or before ``day``."""
    return F.date_sub(F.trunc(F.date_add(day, 1), "MM"), 1)


def status_intervals(users: DataFrame, lines: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """user_id, lo, hi, status: the days on which a customer carries a status (``hi`` NULL: until now).

    The intervals of a customer don't overlap. See :func:`status_snapshot` for the rules and the plan.
    """
    customers = users.select(
        F.col("customer_id").alias("user_id"), F.to_date("customer_since").alias("signup")
    )
    buys = lines.select("user_id", "order_id", F.col("data_pedido").alias("day")).where(
        F.col("user_id").isNotNull() & F.col("day").isNotNull()
    )
    # the purchase days decide whose timeline is kept: one row per user and day is filtered, not every line
    days = buys.select("user_id", "day").distinct().join(customers.select("user_id"), "user_id", "left_semi")
    starts = (
        buys.where(F.col("order_id").isNotNull())
        .groupBy("user_id", "order_id")
        .agg(F.min("day").alias("day"))
        .groupBy("user_id", "day")
        .agg(F.count(F.lit(1)).alias("_new"))
    )
    w = Window.partitionBy("user_id").orderBy("day")
    timeline = days.join(starts, ["user_id", "day"], "left").select(
        "user_id",
        "day",
        F.sum(F.coalesce("_new", F.lit(0).cast("bigint")))
        .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_orders"),
        F.lead("day").over(w).alias("_next"),
    )

    def interval(lo: Column, hi: Column, status: Column) -> Column:
        return F.struct(lo.alias("lo"), hi.alias("hi"), status.alias("status"))

    d, until = F.col("day"), F.date_sub("_next", 1)  # until is NULL for the last purchase
    first = F.when(F.col("_orders") == 1, F.lit(C.NOVO)).otherwise(F.lit(C.ATIVO))
    bought = timeline.select(
        "user_id",
        F.explode(
            F.array(
                interval(d, F.least(F.date_add(d, rules.recent_days), until), first),
                interval(
                    F.date_add(d, rules.recent_days + 1),
                    F.least(F.date_add(d, rules.active_days), until),
                    F.lit(C.ATIVO),
                ),
                interval(F.date_add(d, rules.active_days + 1), until, F.lit(C.CHURN)),
            )
        ).alias("iv"),
    ).select("user_id", "iv.*")
    first_buy = days.groupBy("user_id").agg(F.min("day").alias("_first"))
    waiting = (
        customers.join(first_buy, "user_id", "left")
        .where(F.col("signup").isNotNull())
        .select(
            "user_id",
            F.col("signup").alias("lo"),
            F.date_sub("_first", 1).alias("hi"),
            F.lit(C.SEM_COMPRA).alias("status"),
        )
    )
    return bought.unionByName(waiting).where(F.col("lo").isNotNull())


def status_rows(
    users: DataFrame,
    lines: DataFrame,
    last: _dt.date | str,
    first: _dt.date | str | None = None,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """user_id, status_cliente, data_snapshot, ano_mes: each customer at every month-end from ``first`` to ``last``.

    Months are counted as integers, which costs less for every row than interval arithmetic.
    """
    last_me = _month_end_on_or_before(as_of_date(last))
    iv = status_intervals(users, lines, rules)
    start = F.last_day("lo") if first is None else F.greatest(F.last_day("lo"), F.last_day(as_of_date(first)))
    end = F.coalesce(F.least(_month_end_on_or_before(F.col("hi")), last_me), last_me)
    spans = iv.select("user_id", "status", start.alias("_s"), end.alias("_e")).where(F.col("_s") <= F.col("_e"))
    months = (F.year("_e") - F.year("_s")) * 12 + F.month("_e") - F.month("_s")
    n = F.explode(F.sequence(F.lit(0), months))
    rows = spans.select("user_id", F.col("status").alias("status_cliente"), F.trunc("_s", "MM").alias("_first"), n.alias("_n"))
    rows = rows.select("user_id", "status_cliente", F.last_day(F.add_months("_first", F.col("_n"))).alias("data_snapshot"))
    return rows.select("*", month_label("data_snapshot").alias("ano_mes"))


def month_label(day: str) -> Column:
    """``yyyy-MM`` of a day; for a four-digit year put together from its numbers, without a date pattern for every row."""
    year = F.year(day)
    label = F.concat(year.cast("string"), F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0"))
    return F.when(year.between(1000, 9999), label).otherwise(F.date_format(day, "yyyy-MM"))


def status_snapshot(
    users: DataFrame,
    items: DataFrame | None,
    as_of: _dt.date | str | None = None,
    rules: Rules = DEFAULT_RULES,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Customers per lifecycle status at every month-end up to ``as_of``.

    The label a customer would have carried in the dimension had it been
    built on that month-end: 'Sem Compra' from sign-up to the first purchase
    day, then Novo / Ativo / Churn from the recency of the last purchase day
    and the orders placed so far (same 90/180-day rule). Customers are the
    cleaned ones (``users`` = P1 output), purchases are by their own id.

    Plan, without a customers x months product:

    1. purchase days per customer, from the order lines (items already
       folded per order and day), with the orders first seen that day;
    2. a window per customer over its purchase days -- at most one row per
       calendar day, so even a customer with a third of all items has a
       bounded partition -- gives orders-so-far and the next purchase day;
    3. each purchase day opens up to three status intervals (until +90,
       +180 and the next purchase day); each interval becomes +1 at its
       first month-end and -1 after its last one;
    4. the deltas are summed per (status, month) and accumulated over the
       months: a window over (statuses x months) rows.
    """
    last_me = _month_end_on_or_before(as_of_date(as_of))
    intervals = status_intervals(users, lines if lines is not None else order_lines(items), rules)
    start_me = F.last_day("lo")
    end_me = F.when(F.col("hi").isNull(), last_me).otherwise(
        F.least(_month_end_on_or_before(F.col("hi")), last_me)
    )
    edges = intervals.select("status", start_me.alias("_s"), end_me.alias("_e")).where(
        F.col("_s") <= F.col("_e")
    )
    deltas = (
        edges.select(
            "status",
            F.explode(
                F.array(
                    F.struct(F.col("_s").alias("m"), F.lit(1).alias("d")),
                    F.struct(F.last_day(F.add_months("_e", 1)).alias("m"), F.lit(-1).alias("d")),
                )
            ).alias("e"),
        )
        .select("status", "e.*")
        .where(F.col("m") <= last_me)
        .groupBy("status", "m")
        .agg(F.sum("d").alias("d"))
    )
    months = deltas.groupBy("status").agg(F.min("m").alias("_m0")).select(
        "status",
        F.explode(
            F.sequence(F.trunc("_m0", "MM"), F.trunc(last_me, "MM"), F.expr("INTERVAL 1 MONTH"))
        ).alias("_first_of_month"),
    )
    grid = months.select("status", F.last_day("_first_of_month").alias("m"))
    run = Window.partitionBy("status").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    counted = grid.join(deltas, ["status", "m"], "left").select(
        "status", "m", F.sum(F.coalesce("d", F.lit(0).cast("bigint"))).over(run).alias("clientes")
    )
    return counted.where(F.col("clientes") > 0).select(
        F.date_format("m", "yyyy-MM").alias("ano_mes"),
        F.col("m").alias("data_snapshot"),
        F.col("status").alias("status_cliente"),
        F.col("clientes").cast("bigint").alias("clientes"),
    )
