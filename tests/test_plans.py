"""Plan checks: the physical plans a report compiles to.

Run on the lazy warehouse (every layer planned from the raw scans), which
is the largest plan each report can have.
"""

from __future__ import annotations

import pytest

from revlens.config import FIXTURE_AS_OF
from revlens.operators import growth, leakage, quality, roadmap
from revlens.plans.warehouse import Warehouse
from revlens.sources.testdata import raw_tables

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def lazy(spark, small_dir):
    return Warehouse(raw_tables(spark, small_dir), FIXTURE_AS_OF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def reports(w):
    yield "stg_users", w.stg_users
    yield "stg_user_id_mapping", w.stg_user_id_mapping
    yield "dim_customers_gold", w.dim_customers_gold
    yield "fact_sales_performance", w.fact_sales_performance
    yield "fact_order_items", w.fact_order_items
    yield "vw_sales_analysis", w.vw_sales_analysis
    for fn in (
        leakage.leakage_overview,
        leakage.leakage_by_status,
        leakage.leakage_by_country,
        leakage.leakage_by_channel,
        leakage.leakage_trend,
    ):
        yield fn.__name__, fn(w.vw_sales_analysis)
    for fn in (
        growth.growth_unconverted,
        growth.growth_reactivation,
        growth.growth_premium_upgrade,
        growth.growth_new_window,
        growth.growth_summary,
    ):
        yield fn.__name__, fn(w.dim_customers_gold)
    yield "orphan_report", quality.orphan_report(w.vw_sales_analysis, w.stg_users, w.stg_user_id_mapping)
    yield "category_margin", roadmap.category_margin(w.fact_order_items)


def test_no_cross_join_and_no_python(lazy):
    for name, df in reports(lazy):
        text = plan(df)
        for node in FORBIDDEN:
            assert node not in text, f"{name} plans {node}"


def test_dedup_is_an_aggregate_not_a_window(lazy):
    text = plan(lazy.stg_users)
    assert "Window" not in text
    assert "Aggregate" in text


def test_status_filter_reaches_the_scan(spark, lazy, tmp_path):
    lazy.vw_sales_analysis.write.parquet(str(tmp_path / "vw"))
    vw = spark.read.parquet(str(tmp_path / "vw"))
    text = vw._jdf.queryExecution().executedPlan().toString()
    lost = plan(leakage.leakage_by_status(vw))
    assert "PushedFilters: [In(status_pedido" in lost or "PushedFilters: [IsNotNull(status_pedido), In(status_pedido" in lost
    # column pruning: the report reads 3 of the view's 27 columns
    assert "ReadSchema: struct<order_id:bigint,status_pedido:string,receita_pedido:double>" in lost
    assert "ReadSchema" in text


def test_shares_of_total_use_no_single_partition_window(lazy):
    for fn in (leakage.leakage_by_status, leakage.leakage_by_country, leakage.leakage_by_channel):
        text = plan(fn(lazy.vw_sales_analysis))
        assert "Window" not in text, fn.__name__
        assert "Subquery" in text, fn.__name__


def test_growth_constants_are_scalar_subqueries(lazy):
    text = plan(growth.growth_new_window(lazy.dim_customers_gold))
    assert "Subquery" in text


def test_monthly_window_runs_on_the_monthly_aggregate(lazy):
    text = plan(lazy.fact_sales_performance)
    # the unpartitioned LAG window sits above the month aggregate, not the fact
    window_at = text.index("Window")
    assert "HashAggregate" in text[window_at:]


def test_no_job_runs_while_items_are_planned(spark, small_dir):
    from revlens.operators import silver

    raw = raw_tables(spark, small_dir)
    tracker, group = spark.sparkContext.statusTracker(), "plan-only"
    spark.sparkContext.setJobGroup(group, group)
    items, products = raw.order_items, raw.products
    before = len(tracker.getJobIdsForGroup(group))
    text = plan(silver.stg_order_items(items, products))
    assert len(tracker.getJobIdsForGroup(group)) == before
    assert "broadcast" not in text.lower() or "BroadcastHashJoin" in text
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_line_counts_combine_before_the_shuffle(spark, small_dir):
    text = plan(raw_tables(spark, small_dir).orders)
    assert "partial_count(1)" in text and "REPARTITION" not in text
