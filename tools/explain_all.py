"""Print the physical plan of every registered query, as it would run from raw tables.

    python tools/explain_all.py [--sf-dir DIR] [--no-broadcast] [name ...]

Uses the lazy warehouse (no stored layers), so each plan shows the whole
path from the raw scans to the report. ``--no-broadcast`` disables
size-based broadcast joins, which shows the strategy Spark falls back to
when the dimension tables are large (the 100 TB case); the explicit,
bounded broadcasts remain.
"""

from __future__ import annotations

import argparse
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from revlens.config import FIXTURE_AS_OF
    from revlens.operators import funnel, growth, leakage, quality, roadmap
    from revlens.plans.warehouse import Warehouse
    from revlens.session import local_session, tune_session
    from revlens.sources.testdata import raw_tables

    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if args.no_broadcast else {}
    spark = tune_session(local_session(8, extra=extra))
    w = Warehouse(raw_tables(spark, args.sf_dir), FIXTURE_AS_OF)
    vw, dim = w.vw_sales_analysis, w.dim_customers_gold
    frames = {
        "stg_users": lambda: w.stg_users,
        "stg_orders": lambda: w.stg_orders,
        "stg_order_items": lambda: w.stg_order_items,
        "stg_user_id_mapping": lambda: w.stg_user_id_mapping,
        "order_lines": lambda: w.order_lines,
        "customer_metrics": lambda: w.customer_metrics,
        "dim_customers_gold": lambda: dim,
        "order_metrics": lambda: w.order_metrics,
        "monthly_series": lambda: w.monthly_series,
        "fact_sales_performance": lambda: w.fact_sales_performance,
        "fact_order_items": lambda: w.fact_order_items,
        "vw_sales_analysis": lambda: vw,
        "leakage_overview": lambda: leakage.leakage_overview(vw),
        "leakage_by_status": lambda: leakage.leakage_by_status(vw),
        "leakage_by_country": lambda: leakage.leakage_by_country(vw),
        "leakage_by_channel": lambda: leakage.leakage_by_channel(vw),
        "leakage_trend": lambda: leakage.leakage_trend(vw),
        "growth_unconverted": lambda: growth.growth_unconverted(dim),
        "growth_summary": lambda: growth.growth_summary(dim),
        "orphan_report": lambda: quality.orphan_report(vw, w.stg_users, w.stg_user_id_mapping),
        "status_snapshot": lambda: roadmap.status_snapshot(
            w.stg_users, None, w.as_of, lines=w.order_lines
        ),
        "event_funnel": lambda: funnel.event_funnel(w.raw.events),
        "session_funnel": lambda: funnel.session_funnel(w.raw.events),
    }
    for name in args.names or list(frames):
        print(f"\n{'=' * 30} {name} {'=' * 30}")
        frames[name]().explain(args.mode)
    return 0


if __name__ == "__main__":
    sys.exit(main())
