"""The leakage rollup gives every report the values of the view, and the reports read no order rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revlens.operators import leakage, quality
from revlens.plans.catalog import warehouse

REPORTS = (
    leakage.leakage_overview,
    leakage.leakage_by_status,
    leakage.leakage_by_country,
    leakage.leakage_by_channel,
    leakage.leakage_trend,
    leakage.leakage_trend_monthly,
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def messy(spark, small_dir):
    """The order view with orders of several rows: copies, other days, other statuses, and rows without an order id."""
    vw = warehouse(spark, small_dir).vw_sales_analysis
    again = vw.where("order_id % 5 = 0")
    other_day = vw.where("order_id % 7 = 0").withColumn("data_pedido", F.date_add("data_pedido", 1))
    other_status = vw.where("order_id % 11 = 0").withColumn("status_pedido", F.lit("Returned"))
    nameless = vw.where("order_id % 3 = 0").withColumn("order_id", F.lit(None).cast("bigint"))
    return again.unionAll(other_day).unionAll(other_status).unionAll(nameless).unionAll(vw)


@pytest.fixture(scope="module")
def rollup(spark, messy, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "t")
    leakage.leakage_rollup(messy).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("report", REPORTS)
def test_same_values_as_from_the_view(messy, rollup, report):
    got, wanted = report(rollup), report(messy)
    assert got.schema.simpleString() == wanted.schema.simpleString()
    assert got.collect() == wanted.collect()


def test_no_rows(spark, messy):
    none = leakage.leakage_rollup(messy.where("false"))
    assert leakage.leakage_overview(none).collect() == leakage.leakage_overview(messy.where("false")).collect()
    assert leakage.leakage_by_status(none).count() == 0


def test_orders_with_one_row_are_not_kept(spark, small_dir):
    w = warehouse(spark, small_dir)
    rolled = w.leakage_rollup
    assert rolled.where("order_id IS NOT NULL").count() == 0
    assert rolled.agg(F.sum("pedidos")).first()[0] == w.vw_sales_analysis.count()


def test_orders_are_shuffled_by_id_once(spark, small_dir):
    text = plan(leakage.leakage_rollup(warehouse(spark, small_dir).vw_sales_analysis))
    assert "Expand" not in text and "Window" not in text
    assert "partial_count(1)" in text


def test_orphans_are_folded_to_users_without_expand(spark, small_dir):
    w = warehouse(spark, small_dir)
    text = plan(quality.orphan_report(w.vw_sales_analysis, w.stg_users, w.stg_user_id_mapping))
    assert "Expand" not in text
