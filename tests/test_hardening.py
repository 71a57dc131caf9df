"""Large totals, one-step rounding, integrity reports, options and hot keys through the adapter."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revlens.functions import dsum, micros, money_total, round_half_up
from revlens.operators import gold, leakage, quality, silver
from revlens.sources.testdata import raw_tables
from test_skew import SKEW_CONF

T = dt.datetime(2000, 1, 1)
USERS = "id bigint, first_name string, last_name string, email string, age bigint, gender string, country string, city string, traffic_source string, created_at timestamp_ntz"


def users(spark, rows):
    return spark.createDataFrame([(i, "a", "b", e, 1, "F", "c", "d", "s", T + dt.timedelta(days=i)) for i, e in rows], USERS)


def test_totals_beyond_a_bigint_of_micro_units(spark):
    df = spark.createDataFrame([(5e12,), (5e12,), (0.25,), (None,)], "x double")
    assert df.select(money_total(dsum("x"))).first()[0] == 10_000_000_000_000.25
    assert df.where("x IS NULL").select(dsum("x")).first()[0] is None
    negative = spark.createDataFrame([(-1.5,), (0.25,), (-7e12,), (-7e12,)], "x double")
    assert negative.select(money_total(dsum("x"))).first()[0] == -14_000_000_000_001.25
    view = spark.createDataFrame([(k, "Complete", 5e12) for k in range(4)], "order_id bigint, status_pedido string, receita_pedido double")
    gross = leakage.leakage_overview(view).first()
    assert (gross.total_pedidos, gross.receita_total) == (4, 2e13)


def test_micros_round_half_away(spark):
    df = spark.createDataFrame([(0.0000005,), (-0.0000005,), (12.34,), (-12.34,), (0.0,)], "x double")
    assert [r[0] for r in df.select(micros("x")).collect()] == [1, -1, 12_340_000, -12_340_000, 0]


def test_rounding_is_one_step(spark):
    items = spark.createDataFrame([(1, 1, 1, 7, 1265.73, "Complete", T)], "id bigint, order_id bigint, user_id bigint, product_id bigint, sale_price double, status string, created_at timestamp_ntz")
    products = spark.createDataFrame([(7, 333.33, "c", "b")], "id bigint, cost double, category string, brand string")
    row = silver.stg_order_items(items, products).first()
    assert row.margem_pct == 73.66 and row.margem == 932.4
    df = spark.createDataFrame([(2.675,), (-2.675,), (73.664999644,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [2.68, -2.68, 73.66]


def test_null_email_option(spark):
    df = users(spark, [(1, None), (2, None), (3, "a@x"), (4, "A@x ")])
    assert sorted(r[0] for r in silver.stg_users(df).select("customer_id").collect()) == [1, 3]
    assert sorted(r[0] for r in silver.stg_users(df, keep_null_email=True).select("customer_id").collect()) == [1, 2, 3]


def test_orphans_with_and_without_mapping(spark):
    df = users(spark, [(1, "a@x"), (2, "a@x"), (3, None), (4, None)])
    customers = silver.stg_users(df)
    mapping = silver.stg_user_id_mapping(df, customers)
    # 2 is mapped to 1; 4 was dropped without a mapping; 99 was never registered
    view = spark.createDataFrame([(10, 1, 5.0), (11, 2, 7.0), (12, 4, 11.0), (13, 99, 13.0), (14, 99, 1.0)], "order_id bigint, user_id bigint, receita_pedido double")
    row = quality.orphan_report(view, customers, mapping).first()
    assert (row.ids_orfaos, row.pedidos_orfaos, row.receita_orfaos) == (3, 4, 32.0)
    assert (row.ids_mapeados, row.pedidos_mapeados, row.ids_sem_mapa, row.pedidos_sem_mapa) == (1, 1, 2, 3)


def test_purchases_of_removed_ids_can_be_folded(spark):
    df = users(spark, [(1, "a@x"), (2, "a@x")])
    customers = silver.stg_users(df)
    mapping = silver.stg_user_id_mapping(df, customers)
    items = spark.createDataFrame(
        [(k, k, u, 20.0, 5.0, "Complete", T, 15.0, 75.0) for k, u in enumerate([1, 2, 2])],
        "order_item_id bigint, order_id bigint, user_id bigint, sale_price double, cost double, status string, created_at timestamp_ntz, margem double, margem_pct double",
    )
    assert gold.dim_customers_gold(customers, items, "2000-02-01").first().ltv == 20.0
    row = gold.dim_customers_gold(customers, items, "2000-02-01", mapping=mapping).first()
    assert (row.customer_id, row.ltv, row.total_pedidos) == (1, 60.0, 3)


def test_assertions_report_broken_rules(spark):
    table = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k bigint")
    grain = quality.grain_report({"t": table}, {"t": ("k",)})
    parity = quality.parity_report({"t": table, "u": table.limit(3)}, (("t", "u"), ("t", "t")))
    got = {(r.tabela, r.regra): (r.violacoes, r.ok) for r in quality.assertions(grain, parity).collect()}
    assert got == {
        ("t", "chave_unica"): (2, False),
        ("t", "chave_nao_nula"): (1, False),
        ("t", "linhas_de_u"): (1, False),
        ("t", "linhas_de_t"): (0, True),
    }
    with pytest.raises(AssertionError, match="grain violated"):
        quality.assert_grain({"t": table}, {"t": ("k",)})


def test_hot_order_is_split_through_the_adapter(spark, small_dir, tmp_path):
    lines = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    hot = lines.selectExpr("if(l_linenumber <= 3, 1, l_orderkey) AS l_orderkey", "* EXCEPT (l_orderkey)").repartition(6)
    hot.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{small_dir}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        items = raw_tables(spark, str(tmp_path)).order_items
        rows = items.collect()
        assert "skew=true" in items._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == hot.count()
    assert items.select(F.count("id")).first()[0] == len(rows)
