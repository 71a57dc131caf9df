"""Written layers: versions, the manifest, reuse only of what was built alike."""

from __future__ import annotations

import datetime as dt

import pytest

from revlens.plans.warehouse import Warehouse
from revlens.sources import write_table
from revlens.sources.raw import read_raw
from revlens.sources.sinks import Manifest, content, materialize
from revlens.sources.testdata import raw_tables


@pytest.fixture
def raw(spark, small_dir, tmp_path):
    tables = raw_tables(spark, small_dir)
    for name in ("users", "orders", "order_items", "products"):
        write_table(getattr(tables, name), str(tmp_path / "raw" / name))
    return read_raw(spark, str(tmp_path / "raw"), "parquet")


def test_manifest_serves_the_newest_version_of_equal_origin(spark, tmp_path):
    m = Manifest(spark, str(tmp_path))
    assert m.served("t") is None
    m.add("t", "p1", "a")
    m.add("t", "p2", "b")
    m.add("other", "p3", "a")
    assert m.served("t")["path"] == "p2" and m.served("t", "b")["path"] == "p2" and m.served("t", "a") is None


def test_sorted_write_keeps_rows_and_order_of_columns(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    back, seen = materialize(df, str(tmp_path / "s"), sort_within=("k", "id"))
    assert seen["linhas"] == 100 and seen["conteudo"] == content(back).first().conteudo
    assert back.columns == ["k", "id"]
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_another_date_on_one_target_equals_a_fresh_build(raw, tmp_path):
    target = str(tmp_path / "wh")
    first = Warehouse(raw, "2001-01-31", target=target, reuse_stored=True)
    first.build_all()
    silver = first.path("stg_users")
    second = Warehouse(raw, "2001-08-02", target=target, reuse_stored=True)
    fresh = Warehouse(raw, "2001-08-02")
    assert sorted(second.dim_customers_gold.collect(), key=str) == sorted(fresh.dim_customers_gold.collect(), key=str)
    assert second.path("stg_users") == silver  # does not depend on the date
    again = Warehouse(raw, "2001-08-02", target=target, reuse_stored=True)
    assert again.dim_customers_gold.count() and again.path("dim_customers_gold") == second.path("dim_customers_gold")
    # readers of the replaced version are not disturbed
    assert first.dim_customers_gold.count() == second.dim_customers_gold.count()
    second.drop()
    assert Manifest(raw.users.sparkSession, target).records() == {}


def test_no_date_means_today(raw):
    today = Warehouse(raw, dt.date.today()).dim_customers_gold
    assert sorted(Warehouse(raw, None).dim_customers_gold.collect(), key=str) == sorted(today.collect(), key=str)


def test_register_leaves_foreign_tables_alone(spark, raw, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS foreign_staging")
    spark.sql("DROP TABLE IF EXISTS foreign_staging.stg_users")
    spark.range(7).write.saveAsTable("foreign_staging.stg_users")
    w = Warehouse(raw, "2001-08-02", target=str(tmp_path / "wh"), materialize_view=True)
    with pytest.raises(ValueError, match="left alone"):
        w.register(staging_db="foreign_staging", analytics_db="own_analytics")
    assert spark.table("foreign_staging.stg_users").count() == 7
    spark.sql("DROP TABLE foreign_staging.stg_users")
    names = w.register(staging_db="own_staging", analytics_db="own_analytics")
    assert names["vw_sales_analysis"] == "own_analytics.vw_sales_analysis"
    again = Warehouse(raw, "2001-01-31", target=str(tmp_path / "wh"), materialize_view=True)
    again.register(staging_db="own_staging", analytics_db="own_analytics")  # replaces its own tables
    assert spark.table("own_analytics.fact_order_items").count() == raw.order_items.count()
