"""Silver layer: cleaned, deduplicated and enriched copies of the raw tables.

P1 ``stg_users``            one row per normalised e-mail, the oldest registration
P2 ``stg_orders``           every order, plus days from creation to shipping
P3 ``stg_order_items``      every item, plus product cost/category/brand and margin
P4 ``stg_user_id_mapping``  each removed duplicate id -> the id that survived
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import (
    calendar_days,
    elapsed_days,
    micros,
    money_total,
    norm_email,
    round_half_up,
    title_case,
)
from revlens.operators.joins import JoinGuard, many_to_one

_USER_FIELDS = (
    "id",
    "first_name",
    "last_name",
    "email",
    "age",
    "gender",
    "country",
    "city",
    "traffic_source",
)


def stg_users(users: DataFrame, keep_null_email: bool = False) -> DataFrame:
    """Keep the oldest registration per LOWER(TRIM(email)), clean the text fields.

    ``keep_null_email=True`` keeps every registration without an e-mail
    instead of one: each id without an e-mail is then a customer of its own.

    "Oldest" is the smallest ``(created_at, id)``: ``id`` breaks ties so the
    survivor never depends on row order, and NULL ``created_at`` sorts first.

    Plan: one aggregation keyed by the e-mail, picking the survivor with
    ``min(struct(created_at, id, ...))``. The aggregate combines map-side, so
    a hot e-mail (blank, NULL, a shared placeholder) collapses to one row per
    input partition before the shuffle instead of landing whole in one task
    as it would under ``row_number() OVER (PARTITION BY email)``. All NULL
    e-mails form one group and keep one survivor, as the ranking would.
    """
    survivor = F.min(F.struct("created_at", *_USER_FIELDS)).alias("_u")
    keys = [norm_email("email").alias("email")]
    if keep_null_email:
        keys.append(F.when(F.col("email").isNull(), F.col("id")).alias("_own"))
    first = users.groupBy(*keys).agg(survivor)
    u = lambda name: F.col(f"_u.{name}")
    return first.select(
        u("id").alias("customer_id"),
        title_case(u("first_name")).alias("first_name"),
        title_case(u("last_name")).alias("last_name"),
        F.col("email"),
        u("age").alias("age"),
        u("gender").alias("gender"),
        title_case(u("country")).alias("country"),
        title_case(u("city")).alias("city"),
        u("traffic_source").alias("traffic_source"),
        u("created_at").alias("customer_since"),
    )


def stg_user_id_mapping(
    users: DataFrame, survivors: DataFrame | None = None, guard: JoinGuard | None = None
) -> DataFrame:
    """``user_id_original -> user_id_canonical`` for every removed duplicate.

    Joins each registration to its e-mail's survivor (from P1, so both
    tables agree on who survived) and keeps the ones that lost. NULL e-mails
    never match, exactly like the equi-join they replace. When P1 is planned
    in the same query, its survivors come out of the aggregation already
    hash-partitioned by e-mail and only the registrations are shuffled. A
    hot e-mail on the registration side is split by AQE's skew-join
    handling: the survivor side has one row per key.

    A raw id that is registered several times maps only if its e-mail's
    survivor is another id: ids 1, 1, 2 of one e-mail give (2, 1), where a
    ranking would also give (1, 1). ``quality.assertions`` reports repeated
    ids.
    """
    if survivors is None:
        survivors = stg_users(users)
    canon = survivors.select(
        F.col("email").alias("_email"), F.col("customer_id").alias("user_id_canonical")
    )
    regs = users.select(F.col("id").alias("user_id_original"), norm_email("email").alias("_email"))
    return (
        many_to_one(regs, canon, "_email", "_email", "email_canonico", guard, "inner")
        .where(F.col("user_id_original") != F.col("user_id_canonical"))
        .select("user_id_original", "user_id_canonical")
    )


def stg_orders(orders: DataFrame, calendar_lead_time: bool = False) -> DataFrame:
    """All orders (no status filter) with ``dias_para_envio``.

    Lead time is whole elapsed days between the two timestamps (NULL when
    not shipped). ``calendar_lead_time=True`` counts calendar-day boundaries
    instead.
    """
    days = calendar_days if calendar_lead_time else elapsed_days
    return orders.select(
        "order_id",
        "user_id",
        "status",
        "created_at",
        "shipped_at",
        "delivered_at",
        "num_of_item",
        days("created_at", "shipped_at").alias("dias_para_envio"),
    )


def stg_order_items(
    order_items: DataFrame,
    products: DataFrame,
    guard: JoinGuard | None = None,
    with_headers: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every item with product cost, category, brand and its margin.

    Left join, so items without a product keep a NULL cost.

    A plain join: the planner and AQE broadcast the products when their
    measured bytes allow it (the items are then not shuffled), and otherwise
    sort-merge with AQE splitting the best-selling products.

    A source that keeps user, status and time in the order's header passes
    ``with_headers``, the join to it, and items without those columns. The
    products are joined first then: fewer columns travel by product, and the
    items come out by order, so their files fold into ``order_lines`` before
    that shuffle (a left join and the inner join commute).
    """
    p = products.select(F.col("id").alias("_pid"), "cost", "category", "brand")
    j = many_to_one(order_items, p, order_items.product_id == p._pid, "_pid", "produto", guard)
    if with_headers is not None:
        j = with_headers(j.drop("_pid"))
    sale, cost = F.col("sale_price"), F.col("cost")
    return j.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "user_id",
        "product_id",
        "sale_price",
        "status",
        "created_at",
        "cost",
        "category",
        "brand",
        money_total(micros(sale) - micros(cost)).alias("margem"),
        round_half_up((sale - cost) / F.nullif(sale, F.lit(0.0)) * F.lit(100.0), 2).alias(
            "margem_pct"
        ),
    )
