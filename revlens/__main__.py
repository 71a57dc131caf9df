"""Command line: build the warehouse, run a report.

    python -m revlens build  --raw DIR --target DIR [--as-of YYYY-MM-DD] [--format parquet]
    python -m revlens report NAME --raw DIR --target DIR [--as-of YYYY-MM-DD] [--out DIR]
    python -m revlens sql "SELECT ... FROM crm_analytics.dim_customers_gold" --raw DIR --target DIR
    python -m revlens list

``--raw`` holds one folder per raw table (users, orders, order_items,
products; any format Spark reads). ``build`` writes every layer under
``--target`` and prints the row count of each (the validation step of the
warehouse runbook). ``report`` reuses the layers stored under ``--target`` if
they were built from the same raw files, date and options, and builds the
others. ``--out`` writes the whole result; without it, a preview is printed.
``sql`` registers the layers under the warehouse's names (``crm_staging.*``,
``crm_analytics.*``) and runs one Spark SQL statement over them.
"""

from __future__ import annotations

import argparse
import sys

from revlens.operators import funnel, growth, leakage, quality, roadmap
from revlens.plans.warehouse import Warehouse
from revlens.session import tune_session

REPORTS = {
    "leakage_overview": lambda w: leakage.leakage_overview(w.leakage_rollup, w.rules),
    "leakage_by_status": lambda w: leakage.leakage_by_status(w.leakage_rollup, w.rules),
    "leakage_by_country": lambda w: leakage.leakage_by_country(w.leakage_rollup, w.rules),
    "leakage_by_channel": lambda w: leakage.leakage_by_channel(w.leakage_rollup, w.rules),
    "leakage_trend": lambda w: leakage.leakage_trend(w.leakage_rollup, w.rules),
    "leakage_trend_monthly": lambda w: leakage.leakage_trend_monthly(w.leakage_rollup, w.rules),
    "growth_unconverted": lambda w: growth.growth_unconverted(w.dim_customers_gold, w.rules),
    "growth_reactivation": lambda w: growth.growth_reactivation(w.dim_customers_gold, w.rules),
    "growth_premium_upgrade": lambda w: growth.growth_premium_upgrade(w.dim_customers_gold, w.rules),
    "growth_new_window": lambda w: growth.growth_new_window(w.dim_customers_gold, w.rules),
    "growth_summary": lambda w: growth.growth_summary(w.dim_customers_gold, w.rules),
    "orphan_report": lambda w: quality.orphan_report(w.vw_sales_analysis, w.stg_users, w.stg_user_id_mapping),
    "grain_report": lambda w: quality.grain_report(w.build_all()),
    "row_count_report": lambda w: quality.row_count_report(w.build_all()),
    "parity_report": lambda w: quality.parity_report(_counted(w)),
    "assertions": lambda w: quality.assertions(quality.grain_report(w.build_all()), quality.parity_report(_counted(w))),
    "category_margin": lambda w: roadmap.category_margin(w.fact_order_items),
    "status_snapshot": lambda w: roadmap.status_snapshot(
        w.stg_users, None, w.as_of, w.rules, lines=w.order_lines
    ),
}


def _counted(w):
    raw = {"order_items": w.raw.order_items, "orders": w.raw.orders}
    return w.build_all() | raw | {"order_metrics": w.order_metrics}


# Reports over the event log (``--events``), not over the warehouse layers.
EVENT_REPORTS = {"event_funnel": funnel.event_funnel, "session_funnel": funnel.session_funnel}


def _warehouse(spark, args) -> Warehouse:
    from revlens.sources.raw import read_raw

    return Warehouse(
        read_raw(spark, args.raw, args.format),
        args.as_of,
        target=args.target,
        materialize_view=True,
        reuse_stored=True,
        store_item_fact=not args.item_fact_view,
    )


def _deliver(df, args) -> None:
    """The whole result as Parquet with ``--out``; otherwise a printed preview of ``--preview`` rows."""
    if args.out:
        df.write.mode("errorifexists").parquet(args.out)
    else:
        df.show(args.preview, truncate=False)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="revlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("build", "report", "sql"):
        p = sub.add_parser(name)
        if name == "report":
            p.add_argument("name", choices=sorted({*REPORTS, *EVENT_REPORTS}))
            p.add_argument("--events", help="event log (parquet) for event_funnel")
        if name == "sql":
            p.add_argument("query")
        if name != "build":
            p.add_argument("--out", help="folder to write the whole result to")
            p.add_argument("--preview", type=int, default=50, help="rows to print when there is no --out")
        p.add_argument("--raw", required=True)
        p.add_argument("--target", required=True)
        p.add_argument("--as-of", default=None, help="reference date (default: today)")
        p.add_argument("--format", default="parquet")
        p.add_argument(
            "--item-fact-view",
            action="store_true",
            help="keep fact_order_items as a view over the stored items instead of writing it",
        )
    sub.add_parser("list")
    args = ap.parse_args(argv)
    if args.cmd == "list":
        print("\n".join(sorted({*REPORTS, *EVENT_REPORTS})))
        return 0

    from pyspark.sql import SparkSession

    spark = tune_session(SparkSession.builder.appName("revlens").getOrCreate())
    w = _warehouse(spark, args)
    if args.cmd == "build":
        if not args.target:
            raise SystemExit("--target is required")
        w.reuse_stored = False  # a build always rewrites every layer
        quality.row_count_report(w.build_all()).show(truncate=False)
    elif args.cmd == "sql":
        w.register()
        _deliver(spark.sql(args.query), args)
    elif args.name in EVENT_REPORTS:
        if not args.events:
            raise SystemExit(f"{args.name} needs --events PATH")
        _deliver(EVENT_REPORTS[args.name](spark.read.parquet(args.events)), args)
    else:
        _deliver(REPORTS[args.name](w), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
