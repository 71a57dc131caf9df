"""The command line: build from raw folders, then report from the stored layers."""

from __future__ import annotations

import os

from revlens.__main__ import main
from revlens.sources import write_table
from revlens.sources.testdata import raw_tables


def test_build_then_report(spark, small_dir, tmp_path, capsys):
    raw = raw_tables(spark, small_dir)
    for name in ("users", "orders", "order_items", "products"):
        write_table(getattr(raw, name), str(tmp_path / "raw" / name))
    common = ["--raw", str(tmp_path / "raw"), "--target", str(tmp_path / "wh"), "--as-of", "2001-08-02"]
    assert main(["build", *common]) == 0
    out = capsys.readouterr().out
    assert "dim_customers_gold" in out and "stg_user_id_mapping" in out
    assert "vw_sales_analysis" in out and "fact_order_items" in out
    versions = os.listdir(tmp_path / "wh" / "dim_customers_gold")
    assert len(versions) == 1
    assert main(["report", "growth_summary", *common]) == 0
    out = capsys.readouterr().out
    assert "Cadastros Sem Compra" in out
    # the report reused the stored dimension instead of rewriting it
    assert os.listdir(tmp_path / "wh" / "dim_customers_gold") == versions
    assert main(["report", "parity_report", *common, "--out", str(tmp_path / "parity")]) == 0
    assert {r.ok for r in spark.read.parquet(str(tmp_path / "parity")).collect()} == {True}


def test_sql_over_registered_layers(spark, small_dir, tmp_path, capsys):
    raw = raw_tables(spark, small_dir)
    for name in ("users", "orders", "order_items", "products"):
        write_table(getattr(raw, name), str(tmp_path / "raw" / name))
    common = ["--raw", str(tmp_path / "raw"), "--target", str(tmp_path / "wh"), "--as-of", "2001-08-02"]
    query = (
        "SELECT status_pedido, COUNT(DISTINCT order_id) AS total_pedidos "
        "FROM crm_analytics.vw_sales_analysis v "
        "JOIN crm_analytics.dim_customers_gold d ON d.customer_id = v.user_id "
        "WHERE status_pedido IN ('Cancelled', 'Returned') GROUP BY status_pedido"
    )
    assert main(["sql", query, *common]) == 0
    out = capsys.readouterr().out
    assert "Cancelled" in out and "Returned" in out
    assert spark.catalog.tableExists("crm_staging.stg_users")
    assert spark.table("crm_staging.stg_user_id_mapping").count() > 0


def test_event_funnel_report(spark, small_dir, tmp_path, capsys):
    raw = raw_tables(spark, small_dir)
    for name in ("users", "orders", "order_items", "products"):
        write_table(getattr(raw, name), str(tmp_path / "raw" / name))
    args = ["report", "event_funnel", "--raw", str(tmp_path / "raw"), "--target", str(tmp_path / "wh"),
            "--events", f"{small_dir}/events.parquet"]
    assert main(args) == 0
    out = capsys.readouterr().out
    assert "view" in out and "purchase" in out
