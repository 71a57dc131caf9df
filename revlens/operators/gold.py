"""Gold layer: the customer dimension and the two fact tables.

P5  ``dim_customers_gold``      one row per customer: order metrics, RFM, labels
P5a ``customer_metrics``        per-user orders, items, LTV, ticket, first/last buy
P5b ``rfm_scores``              recency days and R, F, M scores 1..3
P5c ``customer_segments``       rfm_score, status_cliente, segmento_rfm, segmento_valor
P6  ``fact_sales_performance``  order grain with monthly series and customer context
P6a ``order_metrics``           item totals per order (and item status / item day)
P6b ``monthly_series``          revenue per month with MoM and YoY growth
P7  ``fact_order_items``        item grain with calendar columns
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions import (
    as_of_date,
    calendar_days,
    davg,
    day_of,
    dsum,
    from_micros,
    iavg,
    money_round,
    money_total,
    month_of,
    ratio,
    round_half_up,
    year_month,
    year_of,
)
from revlens.operators.joins import JoinGuard, many_to_one


def _valid(rules: Rules) -> Column:
    return F.col("status").isin(*rules.valid_statuses)


def order_lines(items: DataFrame) -> DataFrame:
    """Items folded to one row per (order, user, item day, item status).

    Every item-level aggregate of the warehouse (customer metrics, order
    metrics, per-order totals, last purchase, status history) is a
    re-aggregation of these partial results: micro-unit sums and counts
    add up exactly, min/max compose. So the item table -- the largest one --
    is scanned and shuffled once, with a map-side combine (an order or a user
    with a huge share of the items is reduced before the shuffle), and the
    consumers read a table several times smaller.
    """
    return items.groupBy(
        "order_id", "user_id", day_of("created_at").alias("data_pedido"), "status"
    ).agg(
        F.count("order_item_id").alias("n_items"),
        F.count("sale_price").alias("n_priced"),
        dsum("sale_price").alias("sale_micros"),
        dsum("cost").alias("cost_micros"),
        dsum("margem").alias("margem_micros"),
        dsum("margem_pct").alias("mpct_micros"),
        F.count("margem_pct").alias("n_mpct"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def resolve_users(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """Order lines with removed user ids replaced by the ids that survived (a left join; ids are unique in the mapping)."""
    m = mapping.select(F.col("user_id_original").alias("_orig"), F.col("user_id_canonical").alias("_canon")).distinct()
    j = lines.join(m, lines.user_id == m._orig, "left")
    user = F.coalesce("_canon", "user_id").alias("user_id")
    return j.select(*[user if c == "user_id" else c for c in lines.columns])


def customer_metrics(
    items: DataFrame | None, rules: Rules = DEFAULT_RULES, lines: DataFrame | None = None
) -> DataFrame:
    """Purchase history per user (from the items, or their ``order_lines``).

    Counts and dates use every status; LTV and ticket use the valid ones.
    ``count_distinct`` is planned as a two-level aggregate (by user and
    order, then by user), so a user with a huge share of the orders is
    combined map-side at both levels.
    """
    lines = lines if lines is not None else order_lines(items)
    valid = _valid(rules)
    # one sum for both; a user without a priced valid line has LTV 0 if some line isn't valid, else NULL
    spent = F.sum(F.when(valid, F.col("sale_micros")))
    others = F.count(F.when(valid, F.lit(None)).otherwise(F.lit(1)))
    return lines.groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_pedidos"),
        F.sum("n_items").alias("total_itens"),
        money_total(F.coalesce(spent, F.when(others > 0, F.lit(0).cast("decimal(38,0)")))).alias("ltv"),
        money_round(ratio(from_micros(spent), F.sum(F.when(valid, F.col("n_priced"))))).alias("ticket_medio"),
        F.min("first_at").alias("primeira_compra"),
        F.max("last_at").alias("ultima_compra"),
    )


def _score(col: Column, cuts: tuple[tuple[Column, int], ...], default: int) -> Column:
    expr = None
    for cond, score in cuts:
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(default)).cast("bigint")


def rfm_scores(
    metrics: DataFrame, as_of: _dt.date | str | None = None, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Recency in calendar days to ``as_of`` and R, F, M scores (3 = best)."""
    days = calendar_days("ultima_compra", as_of_date(as_of))
    scored = metrics.withColumn("dias_desde_ultima_compra", days)
    d, n, ltv = F.col("dias_desde_ultima_compra"), F.col("total_pedidos"), F.col("ltv")
    return scored.select(
        "*",
        _score(d, ((d <= rules.recent_days, 3), (d <= rules.active_days, 2)), 1).alias("r_score"),
        _score(n, ((n >= rules.freq_high, 3), (n >= rules.freq_mid, 2)), 1).alias("f_score"),
        _score(ltv, ((ltv >= rules.ltv_high, 3), (ltv >= rules.ltv_mid, 2)), 1).alias("m_score"),
    )


def lifecycle_status(days: Column, orders: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Novo / Ativo / Churn from recency days and number of orders."""
    return (
        F.when((days <= rules.recent_days) & (orders == 1), F.lit(C.NOVO))
        .when(days <= rules.active_days, F.lit(C.ATIVO))
        .otherwise(F.lit(C.CHURN))
    )


def customer_segments(scores: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The three labels. CASE arms are ordered; the first match wins."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    ltv = F.col("ltv")
    segmento_rfm = (
        F.when((r == 3) & (f >= 2) & (m == 3), F.lit(C.CLIENTE_PREMIUM))
        .when((f == 3) & (m >= 2), F.lit(C.CLIENTE_FREQUENTE))
        .when((r == 3) & (f == 1) & (m >= 2), F.lit(C.ALTO_VALOR_RECENTE))
        .when((r == 1) & (f >= 2) & (m >= 2), F.lit(C.FREQUENTE_INATIVO))
        .when((r == 1) & (f == 1) & (m == 1), F.lit(C.INATIVO_BAIXO_VALOR))
        .when((r >= 2) & (f >= 2) & (m == 1), F.lit(C.FREQUENTE_BAIXO_VALOR))
        .when((r == 3) & (f == 1) & (m == 1), F.lit(C.PRIMEIRA_COMPRA))
        .otherwise(F.lit(C.OCASIONAL))
    )
    segmento_valor = (
        F.when(ltv == 0, F.lit(C.SEM_RECEITA))
        .when(ltv < rules.tier_low, F.lit(C.BAIXO_VALOR))
        .when(ltv < rules.tier_mid, F.lit(C.MEDIO_VALOR))
        .when(ltv < rules.tier_elite, F.lit(C.ALTO_VALOR))
        .otherwise(F.lit(C.CLIENTE_ELITE))
    )
    return scores.select(
        "*",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_score"),
        lifecycle_status(F.col("dias_desde_ultima_compra"), F.col("total_pedidos"), rules).alias(
            "status_cliente"
        ),
        segmento_rfm.alias("segmento_rfm"),
        segmento_valor.alias("segmento_valor"),
    )


def customer_status(
    items: DataFrame | None,
    as_of: _dt.date | str | None = None,
    rules: Rules = DEFAULT_RULES,
    lines: DataFrame | None = None,
) -> DataFrame:
    """P5a -> P5b -> P5c for every user that has at least one item."""
    return customer_segments(
        rfm_scores(customer_metrics(items, rules, lines=lines), as_of, rules), rules
    )


DIM_COLUMNS = (
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "age",
    "gender",
    "country",
    "city",
    "traffic_source",
    "customer_since",
    "total_pedidos",
    "total_itens",
    "ltv",
    "ticket_medio",
    "primeira_compra",
    "ultima_compra",
    "dias_desde_ultima_compra",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "status_cliente",
    "segmento_rfm",
    "segmento_valor",
)


def dim_customers_gold(
    users: DataFrame,
    items: DataFrame,
    as_of: _dt.date | str | None = None,
    rules: Rules = DEFAULT_RULES,
    status: DataFrame | None = None,
    mapping: DataFrame | None = None,
    guard: JoinGuard | None = None,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """P5: every cleaned customer (``users`` = P1 output) with metrics and labels.

    With ``mapping`` (P4), purchases of removed ids count for the customer
    that survived; without it they count for nobody, as in the script.

    Customers without purchases are kept with zero metrics, recency counted
    from sign-up and the labels 'Sem Compra' / 'Sem Segmento' / 'Sem Receita'.
    Both sides are unique per customer id, so the left join cannot skew.

    Scores and labels are made after the join, so that only the metrics
    travel; ``status`` (P5c output) brings labels that were made before.
    """
    if status is None and metrics is None:
        lines = order_lines(items)
        metrics = customer_metrics(None, rules, lines=lines if mapping is None else resolve_users(lines, mapping))
    s = (metrics if status is None else status).withColumnRenamed("user_id", "_uid")
    j = many_to_one(users, s, users.customer_id == s._uid, "_uid", "status", guard)
    if status is None:
        labelled = customer_segments(rfm_scores(j, as_of, rules), rules)
        made = [c for c in labelled.columns if c not in j.columns]
        # a customer without purchases has no labels, not those of missing metrics
        j = labelled.withColumns({c: F.when(F.col("_uid").isNotNull(), F.col(c)) for c in made})
    zero_l = F.lit(0).cast("bigint")
    return j.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "age",
        "gender",
        "country",
        "city",
        "traffic_source",
        "customer_since",
        F.coalesce("total_pedidos", zero_l).alias("total_pedidos"),
        F.coalesce("total_itens", zero_l).alias("total_itens"),
        F.coalesce("ltv", F.lit(0.0)).alias("ltv"),
        F.coalesce("ticket_medio", F.lit(0.0)).alias("ticket_medio"),
        "primeira_compra",
        "ultima_compra",
        F.coalesce(
            "dias_desde_ultima_compra", calendar_days("customer_since", as_of_date(as_of))
        ).alias("dias_desde_ultima_compra"),
        F.coalesce("r_score", zero_l).alias("r_score"),
        F.coalesce("f_score", zero_l).alias("f_score"),
        F.coalesce("m_score", zero_l).alias("m_score"),
        F.coalesce("rfm_score", F.lit(C.NO_RFM)).alias("rfm_score"),
        F.coalesce("status_cliente", F.lit(C.SEM_COMPRA)).alias("status_cliente"),
        F.coalesce("segmento_rfm", F.lit(C.SEM_SEGMENTO)).alias("segmento_rfm"),
        F.coalesce("segmento_valor", F.lit(C.SEM_RECEITA)).alias("segmento_valor"),
    )


def calendar_columns(day: Column) -> list[Column]:
    """data_pedido, ano, mes, ano_mes from a DATE column."""
    return [
        day.alias("data_pedido"),
        year_of(day).alias("ano"),
        month_of(day).alias("mes"),
        year_month(day).alias("ano_mes"),
    ]


def order_metrics(
    items: DataFrame | None, orders: DataFrame, lines: DataFrame | None = None, guard: JoinGuard | None = None
) -> DataFrame:
    """Item totals per (order, user, item day, item status) plus the order's lead time.

    An order whose items carry two statuses or two dates yields one row per
    combination -- the grouping keys say so.

    Plan: the items are aggregated first (:func:`order_lines`, map-side
    combined), then the order header is left-joined for ``dias_para_envio``.
    ``dias_para_envio`` is a function of ``order_id``, so adding it to the
    keys after the join changes nothing, and the calendar columns are
    functions of the item day, so they are derived after the aggregation
    instead of being carried as keys.
    """
    lines = lines if lines is not None else order_lines(items)
    lead = orders.select(F.col("order_id").alias("_oid"), "dias_para_envio")
    j = many_to_one(lines, lead, lines.order_id == lead._oid, "_oid", "pedido", guard)
    return j.select(
        "order_id",
        "user_id",
        *calendar_columns(F.col("data_pedido")),
        "status",
        "dias_para_envio",
        F.col("n_items").alias("total_itens"),
        *order_money_columns(),
    )


def order_money_columns(
    sale: str = "sale_micros",
    cost: str = "cost_micros",
    margem: str = "margem_micros",
    mpct: str = "mpct_micros",
    n_mpct: str = "n_mpct",
    n_items: str = "n_items",
) -> list[Column]:
    """receita / custo / margem / margem % / ticket of an order from its partial sums."""
    return [
        money_total(sale).alias("receita_pedido"),
        money_total(cost).alias("custo_pedido"),
        money_total(margem).alias("margem_pedido"),
        money_round(ratio(from_micros(mpct), F.col(n_mpct))).alias("margem_pct_media"),
        money_round(ratio(from_micros(sale), F.col(n_items))).alias("ticket_medio_pedido"),
    ]


def _growth(current: Column, previous: Column) -> Column:
    """(cur - prev) / NULLIF(prev, 0) * 100 on micro-unit sums, rounded to 2."""
    return round_half_up(
        ratio(from_micros(current - previous), from_micros(previous)) * F.lit(100.0), 2
    )


def monthly_series(
    metrics: DataFrame, rules: Rules = DEFAULT_RULES, calendar_aligned: bool = False
) -> DataFrame:
    """One row per calendar month of valid orders, with MoM and YoY growth.

    LAG is positional over the months present, as in the warehouse script:
    with a month missing, "12 back" is not the same month a year earlier.
    The unpartitioned window runs on the monthly aggregate (one row per
    month), never on the fact. ``calendar_aligned=True`` compares with the
    month exactly 1 and 12 calendar months earlier instead (NULL when that
    month has no valid order), via a join of the monthly aggregate with
    itself -- a few hundred rows at most.

    Orders and customers are counted by an aggregate of their own each (two
    distinct counts in one would copy every row twice); the three results
    have one row per month.
    """
    month, valid = ("ano", "mes", "ano_mes"), metrics.where(_valid(rules))
    m = valid.groupBy(*month).agg(
        dsum("receita_pedido").alias("_rev"),
        davg("ticket_medio_pedido").alias("_ticket"),
        iavg("dias_para_envio").alias("_lead"),
    )
    for name, of in (("total_pedidos", "order_id"), ("clientes_unicos", "user_id")):
        n = valid.groupBy(F.col("ano_mes").alias("_month")).agg(F.count_distinct(of).alias(name))
        m = m.join(n, m.ano_mes.eqNullSafe(n._month)).drop("_month")
    w = Window.orderBy(F.col("ano").asc_nulls_first(), F.col("mes").asc_nulls_first())
    rev = F.col("_rev")
    if calendar_aligned:
        index = F.col("ano") * 12 + F.col("mes")
        past = m.select(index.alias("_idx"), F.col("_rev").alias("_past"))
        for lag in (1, 12):
            shifted = past.select(
                (F.col("_idx") + lag).alias(f"_idx{lag}"), F.col("_past").alias(f"_rev{lag}")
            )
            m = m.join(shifted, index == F.col(f"_idx{lag}"), "left")
        prev1, prev12 = F.col("_rev1"), F.col("_rev12")
    else:
        prev1, prev12 = F.lag(rev, 1).over(w), F.lag(rev, 12).over(w)
    return m.select(
        "ano",
        "mes",
        "ano_mes",
        "total_pedidos",
        "clientes_unicos",
        money_total(rev).alias("receita_mensal"),
        money_round("_ticket").alias("ticket_medio_mensal"),
        round_half_up("_lead", 1).alias("media_dias_envio"),
        _growth(rev, prev1).alias("crescimento_mom_pct"),
        _growth(rev, prev12).alias("crescimento_yoy_pct"),
    )


def fact_sales_performance(
    items: DataFrame | None,
    orders: DataFrame,
    dim: DataFrame,
    rules: Rules = DEFAULT_RULES,
    lines: DataFrame | None = None,
    metrics: DataFrame | None = None,
    guard: JoinGuard | None = None,
) -> DataFrame:
    """Order metrics + that month's series + the customer's context.

    The customer is looked up by the order's own user id (a removed
    duplicate therefore gets 'Sem Compra' / 'Desconhecido'; only the view
    resolves ids). The monthly series has one row per calendar month, a
    bound set by the calendar and not by the data volume, so it is
    broadcast; the dimension join is a shuffle join on the user id. It comes
    first, and the day's calendar columns are made after it, so that neither
    they nor the series travel. A guard reports the script's order of joins.
    """
    om = metrics if metrics is not None else order_metrics(items, orders, lines=lines)
    series = monthly_series(om, rules).select(
        F.col("ano_mes").alias("_st_mes"),
        "media_dias_envio",
        "receita_mensal",
        F.col("total_pedidos").alias("total_pedidos_mes"),
        F.col("clientes_unicos").alias("clientes_unicos_mes"),
        "ticket_medio_mensal",
        "crescimento_mom_pct",
        "crescimento_yoy_pct",
    )
    d = dim.select(
        F.col("customer_id").alias("_cid"),
        F.col("status_cliente").alias("_status"),
        F.col("rfm_score").alias("_rfm"),
        F.col("ltv").alias("_ltv"),
        F.col("traffic_source").alias("_src"),
        F.col("country").alias("_country"),
    )

    def in_month(df: DataFrame) -> DataFrame:
        return many_to_one(df, F.broadcast(series), df.ano_mes == series._st_mes, "_st_mes", "serie_mensal", guard)

    def of_customer(df: DataFrame) -> DataFrame:
        return many_to_one(df, d, df.user_id == d._cid, "_cid", "cliente", guard)

    if guard is None:
        j = of_customer(om.drop("ano", "mes", "ano_mes"))
        j = in_month(j.select(*[c for c in j.columns if c != "data_pedido"], *calendar_columns(F.col("data_pedido"))))
    else:
        j = of_customer(in_month(om))
    return j.select(
        "order_id",
        "user_id",
        "data_pedido",
        "ano",
        "mes",
        "ano_mes",
        "status",
        "total_itens",
        "dias_para_envio",
        "media_dias_envio",
        "receita_pedido",
        "custo_pedido",
        "margem_pedido",
        "margem_pct_media",
        "ticket_medio_pedido",
        "receita_mensal",
        "total_pedidos_mes",
        "clientes_unicos_mes",
        "ticket_medio_mensal",
        "crescimento_mom_pct",
        "crescimento_yoy_pct",
        F.coalesce("_status", F.lit(C.SEM_COMPRA)).alias("status_cliente"),
        F.coalesce("_rfm", F.lit(C.NO_RFM)).alias("rfm_score"),
        F.coalesce("_ltv", F.lit(0.0)).alias("ltv"),
        F.coalesce("_src", F.lit(C.DESCONHECIDO)).alias("traffic_source"),
        F.coalesce("_country", F.lit(C.DESCONHECIDO)).alias("country"),
    )


def fact_order_items(items: DataFrame) -> DataFrame:
    """Item grain with calendar columns; a missing brand becomes 'Sem Marca'."""
    day = day_of("created_at")
    return items.select(
        "order_item_id",
        "order_id",
        "user_id",
        "category",
        F.coalesce("brand", F.lit(C.SEM_MARCA)).alias("brand"),
        F.col("status").alias("status_item"),
        *calendar_columns(day),
        "sale_price",
        "cost",
        "margem",
        "margem_pct",
    )
