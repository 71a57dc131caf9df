"""Refreshing the layers after a change, without reading every item again.

The scripts rebuild every table. ``IncrementalWarehouse`` takes a built warehouse, the raw tables as they are now and the
ids of the orders that changed (new, removed, or with another row in ``orders`` or ``order_items``), and builds the same
layers by replacing rows of changed keys:

- silver orders and items, item lines, order metrics and the item fact: rows of the changed orders;
- customer metrics and the dimension: rows of users that own a line of a changed order, before or after the change;
- the order view: changed orders, and all orders of users whose customer row changed or whose surviving id did;
- the order fact: joined again from the refreshed metrics, since a month's growth moves with the month before.

What is kept of a layer is an anti-join of its stored rows; what is new is computed by the functions of the full build over
semi-joined inputs, so both builds give the same rows. Registrations must be the same; if they changed, or with another
reference date or other rules, build in full.

``order_lines`` are mergeable: ``merge_lines`` adds the lines of new items to stored ones without touching other items.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators import gold, silver, view
from revlens.plans.warehouse import Warehouse
from revlens.sources.raw import RawTables

LINE_KEYS = ("order_id", "user_id", "data_pedido", "status")


def merge_lines(stored: DataFrame, added: DataFrame) -> DataFrame:
    """Order lines of all items, from the stored lines and the lines of items that are new (no item twice).

    Counts and micro-unit sums add up, first and last moments compose; a sum is NULL only if both parts are.
    """
    sums = [c for c in stored.columns if c not in (*LINE_KEYS, "first_at", "last_at")]
    both = stored.unionByName(added).groupBy(*LINE_KEYS).agg(
        *[F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in sums],
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )
    return both.select(*stored.columns)


def changed_orders(before: RawTables, after: RawTables) -> DataFrame:
    """order_id of every order whose rows in ``orders`` or ``order_items`` differ, repeats included.

    For sources without a change log. Two 64-bit hashes of each row are summed per order, those of the old version
    negative: what both versions hold cancels out, whatever its order. All rows meet in one aggregate, combined map-side
    to four numbers an order. A hash is summed in halves, so that sums of up to 2^31 rows stay exact in 64 bits.
    """
    rows = []
    for name in ("orders", "order_items"):
        columns = sorted(getattr(after, name).columns)
        cells = [F.col(f"`{c}`") for c in columns]
        hashes = [F.xxhash64(F.lit(name), F.lit(seed), *cells, *[c.isNull() for c in cells]) for seed in (1, 2)]
        halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
        for sign, raw in ((-1, before), (1, after)):
            rows.append(getattr(raw, name).select("order_id", *[(half * F.lit(sign)).alias(f"_h{i}") for i, half in enumerate(halves)]))
    sums = [f"_h{i}" for i in range(4)]
    net = reduce(DataFrame.unionByName, rows).groupBy("order_id").agg(*[F.sum(c).alias(c) for c in sums])
    return net.where(reduce(Column.__or__, [F.col(c) != 0 for c in sums])).select("order_id")


class IncrementalWarehouse(Warehouse):
    """The layers of ``base`` brought up to date with ``raw`` for the orders in ``changed`` (a column order_id).

    Reference date, rules and options are those of ``base``; ``target`` must be a folder of its own.
    """

    def __init__(self, raw: RawTables, base: Warehouse, changed: DataFrame, target: str | None = None) -> None:
        super().__init__(
            raw, base.as_of, base.rules, target, base.calendar_lead_time, base.materialize_view,
            store_item_fact=base.store_item_fact, keep_null_email=base.keep_null_email, fold_orphans=base.fold_orphans,
            partition_by=base.partition_by, quality_gate=base.quality_gate,
        )
        self.base, self.changed = base, changed

    @cached_property
    def orders_touched(self) -> DataFrame:
        return self._keep("orders_touched", self.changed.select("order_id").distinct())

    def _of_orders(self, df: DataFrame) -> DataFrame:
        return _only(df, "order_id", self.orders_touched)

    def _replaced(self, name: str, fresh: DataFrame, key: str = "order_id", keys: DataFrame | None = None) -> DataFrame:
        """The stored layer without the rows of ``keys``, and the fresh rows."""
        old = getattr(self.base, name)
        return self._keep(name, _without(old, key, self.orders_touched if keys is None else keys).unionByName(fresh.select(*old.columns)))

    # registrations are those of the base
    @cached_property
    def stg_users(self) -> DataFrame:
        return self.base.stg_users

    @cached_property
    def stg_user_id_mapping(self) -> DataFrame:
        return self.base.stg_user_id_mapping

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._replaced("stg_orders", silver.stg_orders(self._of_orders(self.raw.orders), self.calendar_lead_time))

    @cached_property
    def items_touched(self) -> DataFrame:
        """Silver items of the changed orders, read once from the raw items."""
        return self._keep("items_touched", silver.stg_order_items(self._of_orders(self.raw.order_items), self.raw.products))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._replaced("stg_order_items", self.items_touched)

    @cached_property
    def order_lines(self) -> DataFrame:
        return self._replaced("order_lines", gold.order_lines(self.items_touched))

    @cached_property
    def users_touched(self) -> DataFrame:
        """Users of changed orders, before or after; with folded orphans also the ids that survived them."""
        users = self._of_orders(self.base.order_lines).select("user_id").unionByName(self._of_orders(self.order_lines).select("user_id"))
        return self._keep("users_touched", users.distinct())

    @cached_property
    def customers_touched(self) -> DataFrame:
        """Customers whose metrics changed: those users, or the ids that survived them."""
        users = self.users_touched
        if self.fold_orphans:
            users = users.unionByName(self._survivors(users)).distinct()
        return self._keep("customers_touched", users)

    def _survivors(self, users: DataFrame) -> DataFrame:
        """The surviving ids of removed ones among ``users``."""
        m = self.stg_user_id_mapping.select(F.col("user_id_original").alias("user_id"), F.col("user_id_canonical").alias("_to"))
        return _only(m, "user_id", users).select(F.col("_to").alias("user_id"))

    @cached_property
    def customer_metrics(self) -> DataFrame:
        fresh = gold.customer_metrics(None, self.rules, lines=_only(self.order_lines, "user_id", self.users_touched))
        return self._replaced("customer_metrics", fresh, "user_id", self.users_touched)

    @cached_property
    def customer_status(self) -> DataFrame:
        """Of the touched customers only; the dimension takes the others from the base."""
        if self.fold_orphans:
            lines = gold.resolve_users(self.order_lines, self.stg_user_id_mapping)
            metrics = gold.customer_metrics(None, self.rules, lines=_only(lines, "user_id", self.customers_touched))
        else:
            metrics = _only(self.customer_metrics, "user_id", self.customers_touched)
        return gold.customer_segments(gold.rfm_scores(metrics, self.as_of, self.rules), self.rules)

    @cached_property
    def dim_customers_gold(self) -> DataFrame:
        keys = self.customers_touched.withColumnRenamed("user_id", "customer_id")
        users = _only(self.stg_users, "customer_id", keys)
        fresh = gold.dim_customers_gold(users, None, self.as_of, self.rules, status=self.customer_status)
        return self._replaced("dim_customers_gold", fresh, "customer_id", keys)

    @cached_property
    def order_metrics(self) -> DataFrame:
        fresh = gold.order_metrics(None, self._of_orders(self.stg_orders), lines=self._of_orders(self.order_lines))
        return self._replaced("order_metrics", fresh)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        if not self.store_item_fact:
            return gold.fact_order_items(self.stg_order_items)
        return self._replaced("fact_order_items", gold.fact_order_items(self.items_touched))

    @cached_property
    def view_orders_touched(self) -> DataFrame:
        """Orders whose view row may differ: changed ones, and those of users who share a touched customer's row."""
        m = self.stg_user_id_mapping.select("user_id_original", F.col("user_id_canonical").alias("user_id"))
        removed = _only(m, "user_id", self.customers_touched).select(F.col("user_id_original").alias("user_id"))
        users = self.users_touched.unionByName(self.customers_touched).unionByName(removed).distinct()
        orders = _only(self.stg_orders, "user_id", users).select("order_id")
        return self._keep("view_orders_touched", orders.unionByName(self.orders_touched).distinct())

    @cached_property
    def vw_sales_analysis(self) -> DataFrame:
        keys = self.view_orders_touched
        fresh = view.vw_sales_analysis(
            _only(self.stg_orders, "order_id", keys), None, self.raw.users, self.stg_user_id_mapping, self.dim_customers_gold,
            self.as_of, self.rules, metrics=self.customer_metrics, lines=_only(self.order_lines, "order_id", keys),
        )
        if not self.materialize_view:
            return _without(self.base.vw_sales_analysis, "order_id", keys).unionByName(fresh)
        return self._replaced("vw_sales_analysis", fresh, "order_id", keys)


def _only(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is among ``keys``; a NULL key is a key."""
    return df.join(keys.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def _without(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return df.join(keys.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
