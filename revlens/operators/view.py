"""P8 ``vw_sales_analysis``: one row per order for the BI layer.

Orders of removed duplicate ids are attributed to the surviving customer:
the dimension is looked up by ``COALESCE(canonical id, order's user id)``.
The lifecycle label falls back, in order, to (1) the customer's label when
it is a real one, (2) the same 90/180-day rule applied to the order's own
user id from its item history, (3) 'Sem Segmento'.

Plan. The script joins the order rows five times (items, raw users,
mapping, dimension, last purchase), four of them on user keys. Here the
user lookups are first resolved at user grain, where every key is unique:

    orders --order_id--> item totals                      (aggregate combines map-side)
           --user_id---> users + dimension by user id     (the mapping is applied to the dimension, the narrow side)
           --user_id---> last buy                         (already lies by user id)

The joins by user id need one shuffle of the orders and one of the users.
An order's user id may have items but no registration, so the last buy is
joined to the order, not to the user. The user joins -- those a hot user id
would skew -- are the last steps, where AQE can split a skewed partition.
Days travel; the calendar columns are made from them at the end.

With a guard each lookup is a join of its own at user grain instead
(``user_context``: a full outer join of the users, with mapping and
dimension, and the purchases), so that each can be reported.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions import as_of_date, calendar_days, day_of
from revlens.operators.gold import (
    calendar_columns,
    customer_metrics,
    lifecycle_status,
    order_lines,
    order_money_columns,
)
from revlens.operators.joins import JoinGuard, many_to_one

VIEW_COLUMNS = (
    "order_id",
    "user_id",
    "data_pedido",
    "ano",
    "mes",
    "ano_mes",
    "status_pedido",
    "dias_para_envio",
    "shipped_at",
    "delivered_at",
    "total_itens",
    "receita_pedido",
    "custo_pedido",
    "margem_pedido",
    "margem_pct_media",
    "ticket_medio_pedido",
    "country",
    "city",
    "age",
    "gender",
    "traffic_source",
    "customer_since",
    "status_cliente",
    "rfm_score",
    "ltv",
    "ticket_medio_cliente",
    "total_pedidos_cliente",
)


def order_financials(items: DataFrame | None, lines: DataFrame | None = None) -> DataFrame:
    """Item totals per order_id (all statuses), from the items or their ``order_lines``."""
    lines = lines if lines is not None else order_lines(items)
    return lines.groupBy("order_id").agg(
        F.sum("n_items").alias("n_items"),
        F.sum("sale_micros").alias("sale_micros"),
        F.sum("cost_micros").alias("cost_micros"),
        F.sum("margem_micros").alias("margem_micros"),
        F.sum("mpct_micros").alias("mpct_micros"),
        F.sum("n_mpct").alias("n_mpct"),
    ).select(
        F.col("order_id").alias("_fid"),
        F.col("n_items").alias("total_itens"),
        *order_money_columns(),
    )


def last_purchase(metrics: DataFrame) -> DataFrame:
    """Per user: day of the last item and number of distinct orders (any status)."""
    return metrics.select(
        F.col("user_id").alias("_lp_uid"),
        day_of("ultima_compra").alias("data_ultima_compra"),
        F.col("total_pedidos").alias("_lp_orders"),
    )


def _registrations(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("_uid"),
        "country",
        "city",
        "age",
        "gender",
        "traffic_source",
        F.col("created_at").alias("customer_since"),
    )


def _mapped(mapping: DataFrame) -> DataFrame:
    return mapping.select(
        F.col("user_id_original").alias("_orig"), F.col("user_id_canonical").alias("_canon")
    ).distinct()


def _customers(dim: DataFrame) -> DataFrame:
    return dim.select(
        F.col("customer_id").alias("_cid"),
        F.col("status_cliente").alias("_d_status"),
        F.col("rfm_score").alias("_d_rfm"),
        F.col("ltv").alias("_d_ltv"),
        F.col("ticket_medio").alias("_d_ticket"),
        F.col("total_pedidos").alias("_d_orders"),
    )


def dim_by_user(mapping: DataFrame, dim: DataFrame) -> DataFrame:
    """The dimension's columns per user id: a removed id (``_key``) has those of the customer that survived.

    What a left join by ``COALESCE(canonical id, user id)`` gives each user, but only the narrow dimension travels,
    not the registrations. A removed id keeps its row even where the dimension lacks the survivor.
    """
    m, d = _mapped(mapping), _customers(dim)
    own = d.join(m.select("_orig"), d._cid == m._orig, "left_anti").withColumnRenamed("_cid", "_key")
    removed = m.join(d, m._canon == d._cid, "left").select(F.col("_orig").alias("_key"), *own.columns[1:])
    return own.unionByName(removed)


def user_context(
    users: DataFrame,
    mapping: DataFrame,
    dim: DataFrame,
    purchases: DataFrame,
    guard: JoinGuard | None = None,
) -> DataFrame:
    """Everything the view needs per user id, resolved at user grain by joins that ``guard`` watches."""
    u, m, d = _registrations(users), _mapped(mapping), _customers(dim)
    resolved = many_to_one(u, m, u._uid == m._orig, "_orig", "mapa", guard)
    resolved = many_to_one(resolved, d, F.coalesce(F.col("_canon"), F.col("_uid")) == d._cid, "_cid", "dimensao", guard)
    who = many_to_one(resolved, purchases, resolved._uid == purchases._lp_uid, "_lp_uid", "ultima_compra", guard, "full")
    return who.select(
        F.coalesce("_uid", "_lp_uid").alias("_who"),
        "country",
        "city",
        "age",
        "gender",
        "traffic_source",
        "customer_since",
        "_d_status",
        "_d_rfm",
        "_d_ltv",
        "_d_ticket",
        "_d_orders",
        "data_ultima_compra",
        "_lp_orders",
    )


def vw_sales_analysis(
    orders: DataFrame,
    items: DataFrame,
    users: DataFrame,
    mapping: DataFrame,
    dim: DataFrame,
    as_of: _dt.date | str | None = None,
    rules: Rules = DEFAULT_RULES,
    metrics: DataFrame | None = None,
    lines: DataFrame | None = None,
    guard: JoinGuard | None = None,
) -> DataFrame:
    """P8 over P2 orders, P3 items, raw users, P4 mapping and the P5 dimension."""
    lines = lines if lines is not None else order_lines(items)
    metrics = metrics if metrics is not None else customer_metrics(None, rules, lines=lines)
    fin = order_financials(None, lines=lines)
    day = day_of("created_at")
    o = orders.select(
        "order_id",
        "user_id",
        day.alias("data_pedido"),
        F.col("status").alias("status_pedido"),
        "dias_para_envio",
        "shipped_at",
        "delivered_at",
    )
    j = many_to_one(o, fin, o.order_id == fin._fid, "_fid", "itens", guard)
    if guard is None:
        u, d, last = _registrations(users), dim_by_user(mapping, dim), last_purchase(metrics)
        j = j.join(u.join(d, u._uid == d._key, "left"), o.user_id == u._uid, "left")
        j = j.join(last, o.user_id == last._lp_uid, "left")
    else:
        who = user_context(users, mapping, dim, last_purchase(metrics), guard)
        j = many_to_one(j, who, o.user_id == who._who, "_who", "usuario", guard)

    d_status = F.col("_d_status")
    fallback_days = calendar_days("data_ultima_compra", as_of_date(as_of))
    status = (
        F.when(d_status.isNotNull() & (d_status != C.SEM_COMPRA), d_status)
        .when(
            F.col("data_ultima_compra").isNotNull(),
            lifecycle_status(fallback_days, F.col("_lp_orders"), rules),
        )
        .otherwise(F.lit(C.SEM_SEGMENTO))
    )
    zero_l = F.lit(0).cast("bigint")
    return j.select(
        "order_id",
        "user_id",
        *calendar_columns(F.col("data_pedido")),
        "status_pedido",
        "dias_para_envio",
        "shipped_at",
        "delivered_at",
        "total_itens",
        "receita_pedido",
        "custo_pedido",
        "margem_pedido",
        "margem_pct_media",
        "ticket_medio_pedido",
        "country",
        "city",
        "age",
        "gender",
        "traffic_source",
        "customer_since",
        status.alias("status_cliente"),
        F.coalesce("_d_rfm", F.lit(C.NO_RFM)).alias("rfm_score"),
        F.coalesce("_d_ltv", F.lit(0.0)).alias("ltv"),
        F.coalesce("_d_ticket", F.lit(0.0)).alias("ticket_medio_cliente"),
        F.coalesce("_d_orders", zero_l).alias("total_pedidos_cliente"),
    )
