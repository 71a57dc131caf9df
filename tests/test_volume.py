"""What travels: the order of the joins of the items and of the order view, and the layers whose files are dealt by order."""

import glob
import re

import pytest

from revlens.operators import gold, silver, view
from revlens.plans.warehouse import Warehouse
from revlens.sources import testdata
from revlens.sources.sinks import content, materialize, write_table

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield spark
    spark.conf.set(THRESHOLD, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_items_come_out_of_their_joins_by_order(shuffled, small_dir):
    text = plan(Warehouse(testdata.raw_tables(shuffled, small_dir)).stg_order_items)
    outer = re.search(r"hashpartitioning\((\w+)#", text).group(1)
    assert outer == "order_id", text
    assert len(re.findall(r"hashpartitioning\(", text)) == 4, text  # items by product, products, priced items by order, orders


def test_products_before_headers_give_the_same_items(shuffled):
    orders = shuffled.sql(
        "SELECT o_orderkey, o_custkey, timestamp_ntz'2000-01-01' AS o_orderdate FROM "
        "VALUES (1L, 7L), (1L, 8L), (2L, NULL), (NULL, 9L), (50L, 3L) t(o_orderkey, o_custkey)"
    )
    lineitem = shuffled.sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM VALUES (1L, 1, 5L, 1D, 100D), (1L, 1, 5L, 2D, 23456D), "
        "(1L, 2, NULL, 3D, NULL), (2L, NULL, 6L, NULL, 5005D), (NULL, 1, 5L, 2D, 10D), (99L, 1, 5L, 2D, 10D), (50L, 3, 77L, 2D, 1D) "
        "t(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)"
    )
    products = shuffled.sql(
        "SELECT * FROM VALUES (5L, 1.5D, 'a', 'x'), (5L, 2.5D, 'b', NULL), (6L, NULL, 'c', 'y'), (NULL, 3D, 'd', 'z') t(id, cost, category, brand)"
    )
    first = silver.stg_order_items(testdata.order_items_from(orders, lineitem), products)
    late = silver.stg_order_items(testdata.item_rows(lineitem), products, with_headers=lambda df: testdata.with_headers(df, orders))
    assert late.dtypes == first.dtypes
    assert rows(late) == rows(first)
    assert late.count() == 12  # order 1 and product 5 are there twice


def test_the_dimension_reaches_removed_ids(shuffled):
    """As a left join by COALESCE(canonical id, user id), with repeated and missing keys."""
    users = shuffled.sql("SELECT * FROM VALUES (1L), (2L), (3L), (4L), (4L), (5L), (6L), (NULL) t(id)")
    mapping = shuffled.sql("SELECT * FROM VALUES (2L, 1L), (2L, 1L), (3L, 90L), (4L, 1L), (4L, 5L), (5L, 90L) t(user_id_original, user_id_canonical)")
    dim = shuffled.sql(
        "SELECT id AS customer_id, s AS status_cliente, s AS rfm_score, 1D AS ltv, 2D AS ticket_medio, 3L AS total_pedidos "
        "FROM VALUES (1L, 'a'), (5L, 'b'), (5L, 'c'), (6L, NULL), (NULL, 'd') t(id, s)"
    )
    m = mapping.distinct()
    joined = users.join(m, users.id == m.user_id_original, "left")
    by_coalesce = joined.join(dim, joined.user_id_canonical.isNull() & (joined.id == dim.customer_id) | (joined.user_id_canonical == dim.customer_id), "left")
    d = view.dim_by_user(mapping, dim)
    got = users.join(d, users.id == d._key, "left").select("id", "_d_status", "_d_rfm", "_d_ltv", "_d_ticket", "_d_orders")
    assert [tuple(r) for r in got.orderBy("id", "_d_status").collect()] == [
        tuple(r) for r in by_coalesce.select("id", "status_cliente", "rfm_score", "ltv", "ticket_medio", "total_pedidos").orderBy("id", "status_cliente").collect()
    ]


def test_registrations_travel_once_to_the_view(shuffled, small_dir):
    w = Warehouse(testdata.raw_tables(shuffled, small_dir), "2001-03-31")
    v = view.vw_sales_analysis(w.stg_orders, None, w.raw.users, w.stg_user_id_mapping, w.dim_customers_gold, w.as_of, lines=w.order_lines)
    text = plan(v)
    assert "FullOuter" not in text
    assert not re.search(r"hashpartitioning\(coalesce", text)


def test_layers_are_packed(spark, tmp_path):
    write_table(spark.range(10), str(tmp_path / "t"))
    assert glob.glob(str(tmp_path / "t" / "*.zstd.parquet"))


def test_order_layers_are_read_by_order_without_a_shuffle(shuffled, small_dir, tmp_path):
    raw = testdata.raw_tables(shuffled, small_dir)
    lazy = Warehouse(raw, "2001-03-31")
    for again in (False, True):
        w = Warehouse(raw, "2001-03-31", target=str(tmp_path / "wh"), reuse_stored=again)
        for name in ("stg_orders", "stg_order_items", "order_lines", "order_metrics"):
            assert rows(getattr(w, name)) == rows(getattr(lazy, name)), name
        for df in (gold.order_lines(w.stg_order_items), gold.order_metrics(None, w.stg_orders, w.order_lines)):
            assert "hashpartitioning" not in plan(df)
        per_user = re.findall(r"hashpartitioning\((\w+)#\d+L?, (\w+)", plan(gold.customer_metrics(None, lines=w.order_lines)))
        assert [keys[0] for keys in per_user] == ["user_id"], per_user
        purchases = gold.dim_customers_gold(w.stg_users, None, w.as_of, metrics=w.customer_metrics)
        assert re.findall(r"hashpartitioning\((\w+)#", plan(purchases)) == ["customer_id"]  # only the registrations travel
        assert rows(purchases) == rows(lazy.dim_customers_gold) == rows(w.dim_customers_gold)
        assert rows(w.fact_sales_performance) == rows(lazy.fact_sales_performance)
        fact = gold.fact_sales_performance(None, None, w._undealt("dim_customers_gold"), metrics=w.order_metrics)
        assert {"user_id", "_cid"} <= set(re.findall(r"hashpartitioning\((\w+)#", plan(fact)))  # AQE can split a hot user
    assert w.observed("order_lines")["linhas"] == w.order_lines.count()
    assert not [t.name for t in shuffled.catalog.listTables() if t.name.startswith("revlens_")]


def test_a_file_without_a_bucket_is_read_too(spark, small_dir, tmp_path):
    raw = testdata.raw_tables(spark, small_dir)
    w = Warehouse(raw, "2001-03-31", target=str(tmp_path / "wh"))
    n = w.stg_orders.count()
    w.stg_orders.limit(3).coalesce(1).write.mode("append").parquet(w.path("stg_orders"))
    again = Warehouse(raw, "2001-03-31", target=w.target, reuse_stored=True)
    assert again.path("stg_orders") is None and again.stg_orders.count() == n + 3
    assert again.path("stg_orders") == w.path("stg_orders")


def test_bucketed_rows_with_missing_and_repeated_keys(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1L, 'a', timestamp_ntz'2000-01-01'), (1L, 'a', NULL), (NULL, 'b', NULL), (NULL, NULL, NULL) t(k, s, at)")
    back, seen = materialize(df, str(tmp_path / "b"), buckets=("k", 3))
    assert back.dtypes == df.dtypes and rows(back) == rows(df)
    assert (seen["linhas"], seen["conteudo"], seen["buckets"]) == (*content(back).first(), 3)
    empty, seen = materialize(df.limit(0), str(tmp_path / "e"), buckets=("k", 3))
    assert empty.collect() == [] and seen["linhas"] == 0


def test_labels_and_series_do_not_travel(shuffled, small_dir):
    w = Warehouse(testdata.raw_tables(shuffled, small_dir), "2001-03-31")
    text = plan(w.dim_customers_gold)
    travelling = [line for line in text.splitlines() if "Project [" in line and "Sem Receita" in line]
    joins = text.index("SortMergeJoin")
    assert travelling and all(text.index(line) < joins for line in travelling)  # labels are made above the join
    text = plan(w.fact_sales_performance)
    assert text.index("BroadcastHashJoin") < text.index("SortMergeJoin")  # the series is joined last


def test_labels_after_the_join_are_those_from_before(spark):
    users = spark.sql(
        "SELECT id AS customer_id, 'f' AS first_name, 'l' AS last_name, 'e' AS email, 1L AS age, 'F' AS gender, 'c' AS country, 'y' AS city, "
        "'t' AS traffic_source, since AS customer_since FROM VALUES (1L, timestamp_ntz'2000-01-01'), (2L, timestamp_ntz'2001-03-01'), "
        "(3L, NULL), (NULL, timestamp_ntz'2001-01-01'), (4L, NULL), (4L, NULL) u(id, since)"
    )
    metrics = spark.sql(
        "SELECT * FROM VALUES (1L, 5L, 9L, 700D, 80D, timestamp_ntz'2000-05-01', timestamp_ntz'2001-03-01'), (3L, NULL, NULL, NULL, NULL, NULL, NULL), "
        "(4L, 1L, 1L, 0D, NULL, NULL, timestamp_ntz'2000-01-01'), (4L, 2L, 2L, 60D, 30D, NULL, NULL), (NULL, 1L, 1L, 1D, 1D, NULL, NULL) "
        "m(user_id, total_pedidos, total_itens, ltv, ticket_medio, primeira_compra, ultima_compra)"
    )
    status = gold.customer_segments(gold.rfm_scores(metrics, "2001-03-31"))
    before = gold.dim_customers_gold(users, None, "2001-03-31", status=status)
    after = gold.dim_customers_gold(users, None, "2001-03-31", metrics=metrics)
    assert after.dtypes == before.dtypes and rows(after) == rows(before)
    assert after.where("customer_id = 2").first().rfm_score == before.where("customer_id = 2").first().rfm_score == "000"
