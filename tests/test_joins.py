"""The guard of N:1 joins: counts of the writing job, planted duplicates, null keys, empty sides; the monthly series' plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revlens.operators import gold
from revlens.operators.joins import JoinGuard, many_to_one
from revlens.plans.catalog import joined
from revlens.plans.warehouse import Warehouse
from revlens.sources.raw import RawTables, read_raw
from revlens.sources.sinks import QualityError, write_table
from revlens.sources.testdata import raw_tables

AS_OF = "2001-08-02"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def raw(spark, small_dir, tmp_path_factory):
    home, tables = tmp_path_factory.mktemp("raw"), raw_tables(spark, small_dir)
    for name in ("users", "orders", "order_items", "products"):
        write_table(getattr(tables, name), str(home / name))
    return read_raw(spark, str(home), "parquet")


def watched(spark, left, right, how="left"):
    a = spark.createDataFrame([(k,) for k in left], "k int")
    b = spark.createDataFrame([(k, "x") for k in right], "u int, v string")
    guard = JoinGuard()
    out = many_to_one(a, b, a.k == b.u, "u", "j", guard, how)
    plain = many_to_one(a, b, a.k == b.u, "u", "j", None, how)
    assert rows(out) == rows(plain) and out.columns == plain.columns
    return tuple(guard.counts()["j"].values())


@pytest.mark.parametrize("threshold", ["-1", "10485760"])  # sort-merge, broadcast
@pytest.mark.parametrize(
    ("left", "right", "how", "want"),
    [
        ([1, 1, 2, None], [1, 2, 3], "left", (4, 3, 0, 4)),
        ([1, 1, 2], [1, 1, 1, 2], "left", (3, 4, 1, 7)),  # key 1 repeats: six rows of two
        ([1, None], [1, None, None], "left", (2, 1, 0, 2)),  # rows without a key match nothing and repeat nothing
        ([1, 2], [1, 1, None], "inner", (2, 2, 1, 2)),
        ([1, None], [1, 3, None, None], "full", (2, 2, 0, 5)),
        ([], [1, 1], "left", (0, 2, 1, 0)),
        ([1, 2], [], "left", (2, 0, 0, 2)),
    ],
)
def test_counts(spark, threshold, left, right, how, want):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = watched(spark, left, right, how)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    if left and right:
        assert got == want  # rows_in, unique_side, repeated, rows_out
    else:
        assert got[3] == want[3] and got[2] in (0, want[2])  # Spark leaves out what can't match


def test_a_name_is_one_join(spark):
    df, guard = spark.range(3), JoinGuard()
    guard.join(df, df, "id", "id", "j", "left")
    with pytest.raises(ValueError, match="two joins"):
        guard.join(df, df, "id", "id", "j", "left")


def test_a_guarded_warehouse_holds_the_same_rows(spark, raw, tmp_path):
    w = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"), materialize_view=True, join_guard="refuse")
    plain = Warehouse(raw, AS_OF)
    for name in ("stg_order_items", "stg_user_id_mapping", "dim_customers_gold", "fact_sales_performance", "vw_sales_analysis"):
        assert rows(getattr(w, name)) == rows(getattr(plain, name)), name
    report = {(r.camada, r.juncao): r for r in joined(w).collect()}
    assert len(report) == 11 and all(r.ok for r in report.values())
    left = [r for r in report.values() if r.juncao not in ("email_canonico", "ultima_compra")]
    assert all(r.linhas_entrada == r.linhas_saida for r in left)
    again = Warehouse(raw, AS_OF, target=w.target, materialize_view=True, join_guard="report", reuse_stored=True)
    again.build_all()
    assert again.joins() == w.joins()


def test_a_planted_duplicate_names_its_join(spark, raw, tmp_path):
    twice = RawTables(raw.users, raw.orders, raw.order_items, raw.products.unionByName(raw.products.orderBy("id").limit(1)))
    w = Warehouse(twice, AS_OF, target=str(tmp_path / "wh"), join_guard="report")
    found = w.joins() if w.stg_order_items.columns else {}
    n = found["stg_order_items"]["produto"]
    key = raw.products.agg(F.min("id")).first()[0]
    assert n["repeated"] == 1 and n["rows_out"] - n["rows_in"] == raw.order_items.where(F.col("product_id") == key).count()
    refusing = Warehouse(twice, AS_OF, target=str(tmp_path / "no"), join_guard="refuse")
    with pytest.raises(QualityError, match="stg_order_items.*produto"):
        refusing.stg_order_items  # noqa: B018
    assert refusing.observed("stg_order_items") == {}
    orders = RawTables(raw.users, raw.orders.unionByName(raw.orders.orderBy("order_id").limit(2)), raw.order_items, raw.products)
    w = Warehouse(orders, AS_OF, target=str(tmp_path / "orders"), materialize_view=True, join_guard="report")
    w.build_all()
    assert [(r.camada, r.juncao, r.chaves_repetidas) for r in joined(w).where("NOT ok").collect()] == [("order_metrics", "pedido", 2)]


def test_without_a_guard_the_plan_is_the_plain_join(spark, raw):
    plan = Warehouse(raw, AS_OF).stg_order_items._jdf.queryExecution().optimizedPlan().toString()
    assert "CollectMetrics" not in plan and "Window" not in plan
    with pytest.raises(ValueError, match="join_guard"):
        Warehouse(raw, AS_OF, join_guard="perhaps")


def test_the_monthly_series_copies_no_rows(spark, raw):
    series = gold.monthly_series(Warehouse(raw, AS_OF).order_metrics)
    assert "Expand" not in series._jdf.queryExecution().optimizedPlan().toString()


def test_the_monthly_series_counts_months_without_a_date(spark):
    names = "order_id int, user_id int, ano int, mes int, ano_mes string, status string, receita_pedido double, ticket_medio_pedido double, dias_para_envio bigint"
    data = [(1, 7, None, None, None, "Complete", 1.0, 1.0, 2), (1, 8, None, None, None, "Complete", 2.0, 2.0, 3), (None, 7, 2001, 1, "2001-01", "Complete", 5.0, 5.0, None)]
    got = {r.ano_mes: r for r in gold.monthly_series(spark.createDataFrame(data, names)).collect()}
    assert (got[None].total_pedidos, got[None].clientes_unicos, got[None].receita_mensal) == (1, 2, 3.0)
    assert (got["2001-01"].total_pedidos, got["2001-01"].clientes_unicos) == (0, 1)
