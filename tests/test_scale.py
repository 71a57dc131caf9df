"""Work per task: what one task holds or shuffles doesn't grow with one file or with the months of a history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from revlens.operators import roadmap
from revlens.plans.incremental import changed_orders
from revlens.sources.raw import RawTables
from revlens.sources.testdata import users_from


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_customers_of_one_file_become_users_in_many_tasks(spark):
    customer = spark.range(400).selectExpr("id AS c_custkey", "0 AS c_nationkey", "'A' AS c_mktsegment").coalesce(1)
    nation = spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string")
    users = users_from(customer, nation, region)
    per_task = [r["count"] for r in users.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 3200 and max(per_task) < 1600
    assert users.select("id").distinct().count() == 3200


def test_partitioned_write_has_no_sort_by_folder(spark, tmp_path):
    spark.sql(f"CREATE TABLE no_sort_by_folder (v BIGINT, k BOOLEAN) USING parquet PARTITIONED BY (k) LOCATION '{tmp_path}/t'")
    try:
        plan = spark.sql("EXPLAIN INSERT OVERWRITE no_sort_by_folder PARTITION (k) SELECT id, id % 2 = 0 FROM range(10)").first()[0]
        assert "Sort [" not in plan
    finally:
        spark.sql("DROP TABLE no_sort_by_folder")


def test_changed_orders_is_one_aggregate(spark):
    orders = "order_id bigint, status string"
    items = "id bigint, order_id bigint, sale_price double"

    def raw(o, i):
        return RawTables(None, spark.createDataFrame(o, orders), spark.createDataFrame(i, items), None)

    before = raw(
        [(1, "a"), (2, "a"), (3, "a"), (4, None), (5, "a"), (5, "a"), (7, "a"), (None, "a")],
        [(10, 1, 1.0), (20, 2, 2.0), (30, 3, 3.0), (40, 4, None), (70, 7, 7.0), (71, 7, 7.5), (80, 8, 1.0)],
    )
    after = raw(
        [(2, "a"), (1, "a"), (3, "b"), (4, None), (5, "a"), (6, "a"), (7, "a"), (None, "b")],
        [(71, 7, 7.5), (70, 7, 7.0), (10, 1, 1.0), (20, 2, 2.5), (30, 3, 3.0), (40, 4, None), (80, 9, 1.0)],
    )
    changed = changed_orders(before, after)
    # 2 and 3: another value, 5: a repeated row less, 6: new, 8 and 9: an item that moved, NULL: another status
    assert sorted((r[0] for r in changed.collect()), key=lambda x: (x is None, x)) == [2, 3, 5, 6, 8, 9, None]
    assert plan_of(changed).count("Exchange hashpartitioning") == 1
    assert changed_orders(before, before).count() == 0


def test_status_rows_count_months_as_integers(spark):
    users = spark.createDataFrame([(1, dt.datetime(1999, 11, 15)), (2, dt.datetime(999, 12, 31))], "customer_id bigint, customer_since timestamp_ntz")
    lines = spark.createDataFrame([(1, 10, dt.date(2000, 1, 31)), (2, 20, dt.date(1000, 2, 1))], "user_id bigint, order_id bigint, data_pedido date")
    rows = roadmap.status_rows(users, lines, "2000-09-15")
    assert "INTERVAL" not in plan_of(rows).upper()
    got = sorted((r.ano_mes, str(r.data_snapshot), r.status_cliente) for r in rows.where("user_id = 1").collect())
    assert got == [
        ("1999-11", "1999-11-30", "Sem Compra"),
        ("1999-12", "1999-12-31", "Sem Compra"),
        ("2000-01", "2000-01-31", "Novo"),
        ("2000-02", "2000-02-29", "Novo"),
        ("2000-03", "2000-03-31", "Novo"),
        ("2000-04", "2000-04-30", "Novo"),
        ("2000-05", "2000-05-31", "Ativo"),
        ("2000-06", "2000-06-30", "Ativo"),
        ("2000-07", "2000-07-31", "Churn"),
        ("2000-08", "2000-08-31", "Churn"),
    ]
    early = rows.where("user_id = 2 AND data_snapshot <= DATE'1000-02-28'").orderBy("data_snapshot").collect()
    assert [(r.ano_mes, r.status_cliente) for r in early] == [("0999-12", "Sem Compra"), ("1000-01", "Sem Compra"), ("1000-02", "Novo")]
    assert rows.where("user_id = 2").count() == (2000 - 1000) * 12 + 9
