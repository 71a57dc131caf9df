"""Adapter from the driver's TPC-H-style test tables to the four raw tables.

The warehouse reads ``users``, ``orders``, ``order_items`` and ``products``.
The test folders hold ``customer``, ``nation``, ``region``, ``orders``,
``lineitem`` and ``part`` instead. This module derives the four raw tables
from them with integer-only rules, so DuckDB (the oracle) derives exactly
the same rows; the SQL twin is in :mod:`revlens.oracle.sql`.

The rules plant the defects the warehouse exists to fix: e-mails that differ
only by case and padding (one registration in six is a duplicate), names
that need trimming and title case, items without a product, products
without a brand, zero-priced items, orders without items and unshipped
orders. The mapping is a fixture contract; keep it in step with the oracle.

The modulo rules assign attributes; they do not sample. Every customer,
order and line item of the folder is used. The one filter (parts with
``p_partkey % 97 == 0`` get no product row) exists to create items whose
product is unknown, which the left join must keep.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = ("region", "nation", "customer", "orders", "lineitem", "part")

# --- fixed values of the fixture mapping ------------------------------------
COPIES_PER_CUSTOMER = 8  # users per customer: uid = c_custkey * 8 + k
DUPLICATE_EVERY = 6  # uid % 6 == 5 shares the e-mail of uid - 1
SIGNUP_EPOCH = "1994-01-01 00:00:00"
STATUS_CYCLE = 20  # st = (o_orderkey div 8) % 20
STATUS_CUTS = ((5, "Complete"), (11, "Shipped"), (15, "Processing"), (18, "Cancelled"))
STATUS_LAST = "Returned"
ORDER_HOUR = 13
PRODUCT_GAP_MOD = 97  # parts with p_partkey % 97 == 0 have no product row
NO_BRAND_MOD, NO_BRAND_REM = 100, 3
# -----------------------------------------------------------------------------


def fixture_money(col: Column) -> Column:
    """Fixture money: a double rounded to cents through a decimal."""
    return F.round(col.cast("decimal(38,6)"), 2).cast("decimal(18,2)").cast("double")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def users_from(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    # nation and region are TPC-H's fixed 25- and 5-row dimensions at every
    # scale factor: a proven bound, so the geography is broadcast explicitly
    # and the customer side is never shuffled for this join.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )
    # A customer becomes eight users, and a file of customers is often a single row group, which one task reads.
    # So customers are dealt over the session's tasks before that, by a number that AQE keeps (the rows are small
    # here, their users are not).
    tasks = int(customer.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cust = (
        customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        .repartition(tasks, "c_custkey")
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            "c_mktsegment",
            "n_name",
            "r_name",
            F.explode(F.sequence(F.lit(0), F.lit(COPIES_PER_CUSTOMER - 1))).alias("k"),
        )
    )
    uid = F.col("c_custkey") * COPIES_PER_CUSTOMER + F.col("k")
    even = F.col("k") % 2 == 0
    cust = cust.withColumn("uid", uid).withColumn(
        "eid",
        F.col("uid")
        - F.when(F.col("uid") % DUPLICATE_EVERY == DUPLICATE_EVERY - 1, F.lit(1)).otherwise(
            F.lit(0)
        ),
    )
    eid = F.col("eid").cast("string")
    return cust.select(
        F.col("uid").alias("id"),
        F.when(even, F.lit("  mArY")).otherwise(F.lit("josé-luis ")).alias("first_name"),
        F.concat(F.lit(" o'NEIL "), F.col("c_custkey").cast("string")).alias("last_name"),
        F.when(even, F.concat(F.lit("USER"), eid, F.lit("@MAIL.TEST")))
        .otherwise(F.concat(F.lit("  user"), eid, F.lit("@Mail.test ")))
        .alias("email"),
        (F.lit(18) + F.col("uid") % 60).alias("age"),
        F.when(F.col("uid") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("n_name").alias("country"),
        F.concat(F.lit(" "), F.lower("r_name"), F.lit(" city")).alias("city"),
        F.col("c_mktsegment").alias("traffic_source"),
        (
            F.to_timestamp_ntz(F.lit(SIGNUP_EPOCH))
            + F.make_dt_interval(days=((F.col("uid") * 7919) % 360).cast("int"))
        ).alias("created_at"),
    )


def order_header(orders: DataFrame, *others: Column | str) -> DataFrame:
    """order_id, user_id, status, created_at, shipped_at, delivered_at per TPC-H order, and ``others`` of the same row.

    All are made from the order's key, customer and day, so a join takes those three and this comes after it.
    """
    key = F.col("o_orderkey")
    st = F.expr("o_orderkey div 8") % STATUS_CYCLE
    status = F.when(st < STATUS_CUTS[0][0], F.lit(STATUS_CUTS[0][1]))
    for cut, label in STATUS_CUTS[1:]:
        status = status.when(st < cut, F.lit(label))
    status = status.otherwise(F.lit(STATUS_LAST))
    lead = F.lit(ORDER_HOUR + 5) + F.lit(17) * (key % 5)
    day = F.col("o_orderdate")
    return orders.select(
        key.alias("order_id"),
        (F.col("o_custkey") * COPIES_PER_CUSTOMER + key % COPIES_PER_CUSTOMER).alias("user_id"),
        status.alias("status"),
        (day + _hours(F.lit(ORDER_HOUR))).alias("created_at"),
        F.when((st < 11) | (st >= 18), day + _hours(lead)).alias("shipped_at"),
        F.when((st < 5) | (st >= 18), day + _hours(lead + 24 * (1 + key % 6))).alias(
            "delivered_at"
        ),
        *others,
    )


def orders_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    counts = lineitem.groupBy(F.col("l_orderkey").alias("_ok")).agg(F.count(F.lit(1)).alias("_n"))
    j = orders.join(counts, orders.o_orderkey == counts._ok, "left")
    return order_header(j, F.coalesce(F.col("_n"), F.lit(0).cast("bigint")).alias("num_of_item"))


def item_rows(lineitem: DataFrame) -> DataFrame:
    """order_id, product_id, sale_price and the line number of every item: what it has without its order's header.

    Priced here, before any join, so that one number travels instead of two.
    """
    price = F.when(F.col("l_quantity") == 1, F.lit(0.0)).otherwise(fixture_money(F.col("l_extendedprice") / 1000))
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        price.alias("sale_price"),
        F.col("l_linenumber").alias("line"),
    )


def with_headers(items: DataFrame, orders: DataFrame) -> DataFrame:
    """``item_rows`` with their id, and user, status and time from the order; items without an order are dropped, other columns stay."""
    known = ("order_id", "product_id", "sale_price", "line")
    j = items.join(orders, items.order_id == orders.o_orderkey)
    return order_header(j, *[c for c in items.columns if c != "order_id"]).select(
        (F.col("order_id") * 10 + F.col("line")).alias("id"),
        "order_id",
        "user_id",
        "product_id",
        "sale_price",
        "status",
        (F.col("created_at") + _hours(F.col("line"))).alias("created_at"),
        *[c for c in items.columns if c not in known],
    )


def order_items_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    return with_headers(item_rows(lineitem), orders)


def products_from(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.where(key % PRODUCT_GAP_MOD != 0).select(
        key.alias("id"),
        fixture_money(F.col("p_retailprice") / 40).alias("cost"),
        F.col("p_type").alias("category"),
        F.when(key % NO_BRAND_MOD == NO_BRAND_REM, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
        .alias("brand"),
    )


class TestDataSource:
    """The four raw tables derived (lazily) from one test-data folder.

    Attributes are built on first use, so a query that needs only users
    never plans the order tables.

    Tables are read plainly: Spark inserts the exchanges a join or an
    aggregate needs, so partial aggregates run before them and AQE can split
    a hot key (it never splits a repartition that a caller asked for). Only
    customers are dealt over tasks before they become users.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._read("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
        )

    @cached_property
    def tpch_orders(self) -> DataFrame:
        return self._read("orders").select("o_orderkey", "o_custkey", "o_orderdate")

    @cached_property
    def users(self) -> DataFrame:
        return users_from(self._read("customer"), self._read("nation"), self._read("region"))

    @cached_property
    def orders(self) -> DataFrame:
        return orders_from(self.tpch_orders, self.lineitem)

    @cached_property
    def order_items(self) -> DataFrame:
        return order_items_from(self.tpch_orders, self.lineitem)

    @cached_property
    def item_rows(self) -> DataFrame:
        """The order items before their headers are joined (see ``with_headers``)."""
        return item_rows(self.lineitem)

    def with_headers(self, items: DataFrame) -> DataFrame:
        return with_headers(items, self.tpch_orders)

    @cached_property
    def products(self) -> DataFrame:
        return products_from(self._read("part"))

    @cached_property
    def events(self) -> DataFrame:
        """The event log, read as it is (event_id, ts, user_id, event_type, value, props)."""
        return self._read("events")


def raw_tables(spark: SparkSession, sf_dir: str) -> TestDataSource:
    """The four raw tables (``users``, ``orders``, ``order_items``, ``products``)."""
    return TestDataSource(spark, sf_dir)
