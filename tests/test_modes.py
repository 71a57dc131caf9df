"""The lazy warehouse (one plan from the raw scans) and the served one (stored
layers) produce the same rows."""

from __future__ import annotations

from revlens.config import FIXTURE_AS_OF
from revlens.operators import growth, leakage, roadmap
from revlens.plans.catalog import warehouse
from revlens.plans.warehouse import Warehouse
from revlens.sources.testdata import raw_tables


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lazy_and_served_agree(spark, small_dir):
    lazy = Warehouse(raw_tables(spark, small_dir), FIXTURE_AS_OF)
    served = warehouse(spark, small_dir)
    for name in (
        "stg_users",
        "stg_user_id_mapping",
        "dim_customers_gold",
        "fact_sales_performance",
        "vw_sales_analysis",
    ):
        assert _rows(getattr(lazy, name)) == _rows(getattr(served, name)), name
    for fn in (leakage.leakage_overview, leakage.leakage_trend):
        assert _rows(fn(lazy.vw_sales_analysis)) == _rows(fn(served.vw_sales_analysis))
    assert _rows(growth.growth_summary(lazy.dim_customers_gold)) == _rows(
        growth.growth_summary(served.dim_customers_gold)
    )
    assert _rows(
        roadmap.status_snapshot(lazy.stg_users, lazy.stg_order_items, lazy.as_of)
    ) == _rows(roadmap.status_snapshot(served.stg_users, None, served.as_of, lines=served.order_lines))
