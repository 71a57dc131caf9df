"""Content hashes and quality gates of the writing job, the live catalog view, monthly facts, history and refreshes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import gold, roadmap
from revlens.plans.catalog import stored_content
from revlens.plans.history import StatusHistory, status_counts
from revlens.plans.incremental import IncrementalWarehouse, changed_orders, merge_lines
from revlens.plans.warehouse import MONTHLY, Warehouse
from revlens.sources.raw import RawTables, read_raw
from revlens.sources.sinks import Gate, Manifest, QualityError, content, materialize, quarantined, write_table
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


# -- content ------------------------------------------------------------------
def test_content_hash_ignores_order_and_sees_cells_places_and_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (2, None)], "x int, y string")
    base = content(df).first()
    assert content(df.repartition(3)).first() == base
    for other in ([(1, "a"), (2, None), (None, "b")], [(1, "a"), (2, None), (None, "b"), (1, "a")], [(1, "a"), (2, None), (None, "c"), (2, None)]):
        assert content(spark.createDataFrame(other, "x int, y string")).first() != base
    swapped = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert content(swapped.limit(1)).first().conteudo != content(swapped.where("y IS NULL")).first().conteudo
    assert tuple(content(df.limit(0)).first()) == (0, "")


def test_a_changed_cell_in_a_stored_layer_is_caught(spark, raw, tmp_path):
    w = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"))
    seen = {t: (getattr(w, t), w.observed(t)) for t in ("stg_users", "stg_orders")}
    report = {r.tabela: r for r in stored_content({t: s[0] for t, s in seen.items()}, {t: s[1] for t, s in seen.items()}).collect()}
    assert all(r.conteudo_igual for r in report.values()) and report["stg_users"].linhas == w.stg_users.count()
    one = w.stg_users.agg(F.min("customer_id")).first()[0]
    edited = w.stg_users.withColumn("city", F.when(F.col("customer_id") == one, "elsewhere").otherwise(F.col("city")))
    edited.write.parquet(str(tmp_path / "edited"))
    found = stored_content({"stg_users": spark.read.parquet(str(tmp_path / "edited"))}, {"stg_users": seen["stg_users"][1]}).first()
    assert found.linhas == report["stg_users"].linhas and not found.conteudo_igual


# -- gate ---------------------------------------------------------------------
def planted(spark, raw):
    item = raw.order_items.limit(1)
    bad = item.withColumn("id", F.lit(None).cast("bigint")).unionByName(item.withColumn("sale_price", F.lit(-5.0)).withColumn("id", F.lit(-1).cast("bigint")))
    return RawTables(raw.users, raw.orders, raw.order_items.unionByName(bad), raw.products)


def test_planted_rows_are_quarantined_with_their_reasons(spark, raw, tmp_path):
    w = Warehouse(planted(spark, raw), AS_OF, target=str(tmp_path / "wh"), quality_gate=True)
    assert rows(w.stg_order_items) == rows(Warehouse(raw, AS_OF).stg_order_items)
    assert [r.motivos for r in w.quarantined("stg_order_items").orderBy("id" if "id" in w.quarantined("stg_order_items").columns else "order_item_id").collect()] == [["id_nulo"], ["preco_negativo"]]
    found = w.gate_report["stg_order_items"]
    assert (found["id_nulo"], found["preco_negativo"], found["quarentena"]) == (1, 1, 2)
    assert found["linhas"] == raw.order_items.count() + 2
    assert w.stg_users.count() and w.quarantined("stg_users") is None
    again = Warehouse(w.raw, AS_OF, target=w.target, quality_gate=True, reuse_stored=True)
    assert rows(again.stg_order_items) == rows(w.stg_order_items)


def test_a_refused_version_is_not_committed(spark, raw, tmp_path):
    target = str(tmp_path / "wh")
    good = Warehouse(raw, AS_OF, target=target, quality_gate=True)
    served = good.path("dim_customers_gold") or (good.dim_customers_gold, good.path("dim_customers_gold"))[1]
    users = raw.users.unionByName(raw.users.limit(1).withColumn("id", F.lit(None).cast("bigint")).withColumn("email", F.lit("new@x")))
    bad = Warehouse(RawTables(users, raw.orders, raw.order_items, raw.products), AS_OF, target=target, quality_gate=True)
    assert bad.quarantined("stg_users") is None if bad.path("stg_users") else True
    gate = Gate({}, {"sem_id": "customer_id IS NULL"}, {})
    with pytest.raises(QualityError, match="sem_id"):
        materialize(bad.stg_users.unionByName(bad.stg_users.limit(1).withColumn("customer_id", F.lit(None).cast("bigint"))), f"{target}/x", gate=gate)
    assert Manifest(spark, target).served("dim_customers_gold")["path"] == served
    assert "x" not in Manifest(spark, target).records()


def test_gate_adds_no_scan_and_no_exchange(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "id % 5 AS k")
    out, seen = materialize(df, str(tmp_path / "g"), gate=Gate({"grande": "id >= 48", "k4": "k = 4"}, {}, {"par": "id % 2 = 0"}))
    assert (seen["linhas"], seen["grande"], seen["k4"], seen["quarentena"], seen["par"]) == (50, 2, 10, 11, 25)
    assert out.count() == 39 and out.columns == ["id", "k"]
    aside = quarantined(spark, str(tmp_path / "g"))
    assert sorted(aside.where("id = 49").first().motivos) == ["grande", "k4"]
    observed = df.observe("seen", F.count(F.lit(1)).alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in observed and observed.count("Range") == 1
    nothing, seen = materialize(df, str(tmp_path / "all"), gate=Gate({"todas": "id >= 0"}, {}, {}))
    assert nothing.count() == 0 and nothing.schema == df.schema and seen["quarentena"] == 50


def test_vacuum_keeps_the_newest_versions(spark, raw, tmp_path):
    paths = []
    for _ in range(3):
        w = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"))
        w.stg_users  # noqa: B018  writes a version
        paths.append(w.path("stg_users"))
    assert w.vacuum(keep=2) == paths[:1]
    assert [r["path"] for r in Manifest(spark, w.target).records()["stg_users"]] == paths[1:]
    assert spark.read.parquet(paths[2]).count() == w.stg_users.count() and w.vacuum(keep=2) == []


def test_layers_of_other_code_or_files_are_not_reused(raw, tmp_path, monkeypatch):
    from revlens.plans import warehouse as W

    first = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"), reuse_stored=True)
    first.stg_users  # noqa: B018
    same = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"), reuse_stored=True)
    assert same.stg_users.count() and same.path("stg_users") == first.path("stg_users")
    monkeypatch.setattr(W, "code_digest", lambda: "other")
    other = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"), reuse_stored=True)
    assert other.stg_users.count() and other.path("stg_users") != first.path("stg_users")
    assert first.is_current()
    raw.users.limit(1).write.mode("append").parquet(raw.users.inputFiles()[0].rpartition("/")[0])
    assert not first.is_current()


# -- live view ----------------------------------------------------------------
def test_live_view_equals_the_built_view_and_shows_new_rows_without_a_rebuild(spark, small_dir, tmp_path):
    raw = raw_tables(spark, small_dir)
    w = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"))
    names = w.register("live_staging", "live_analytics", live_view=True)
    view = spark.table(names["vw_sales_analysis"])
    assert view.dtypes == w.vw_sales_analysis.dtypes
    assert rows(view) == rows(w.vw_sales_analysis)
    before = view.count()
    spark.sql("INSERT INTO live_staging.stg_orders SELECT -7 AS order_id, user_id, status, created_at, shipped_at, delivered_at, num_of_item, dias_para_envio FROM live_staging.stg_orders LIMIT 1")
    spark.sql("INSERT INTO live_staging.stg_order_items SELECT -7, -7, user_id, product_id, 12.5, status, created_at, 2.5, category, brand, 10.0, 80.0 FROM live_staging.stg_order_items LIMIT 1")
    new = spark.table(names["vw_sales_analysis"])
    assert new.count() == before + 1
    row = new.where("order_id = -7").first()
    assert (row.total_itens, row.receita_pedido, row.margem_pct_media) == (1, 12.5, 80.0)
    w.register("live_staging", "live_analytics")  # its own view gives way to a table or view again
    foreign = Warehouse(raw, AS_OF, target=str(tmp_path / "other"))
    spark.sql("CREATE OR REPLACE VIEW live_analytics.vw_sales_analysis AS SELECT 1 AS x")
    with pytest.raises(ValueError, match="left alone"):
        foreign.register("foreign_staging2", "live_analytics", live_view=True)


# -- facts by month -------------------------------------------------------------
def test_monthly_facts_hold_the_same_rows_and_prune_folders(spark, raw, tmp_path):
    plain = Warehouse(raw, AS_OF)
    w = Warehouse(raw, AS_OF, target=str(tmp_path / "wh"), partition_by=MONTHLY)
    assert w.fact_order_items.dtypes == plain.fact_order_items.dtypes
    assert rows(w.fact_order_items) == rows(plain.fact_order_items)
    static = w.fact_order_items.where("ano_mes >= '1997-01' AND ano_mes < '1997-04'")
    assert "PartitionFilters: [isnotnull(ano_mes" in static._jdf.queryExecution().executedPlan().toString()
    read = {f.split("ano_mes=")[1][:7] for f in static.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert read == {"1997-01", "1997-02", "1997-03"}
    dynamic = roadmap.peak_month_categories(w.fact_order_items, w.monthly_series)
    assert "dynamicpruning" in dynamic._jdf.queryExecution().executedPlan().toString()
    assert rows(dynamic) == rows(roadmap.peak_month_categories(plain.fact_order_items, plain.monthly_series))


# -- history ------------------------------------------------------------------
def test_a_rerun_replaces_its_months_alone(spark, raw, tmp_path):
    w = Warehouse(raw, AS_OF)
    h = StatusHistory(spark, str(tmp_path / "history"))
    h.record(w.stg_users, w.order_lines, "2000-12-31")
    h.record(w.stg_users, w.order_lines, AS_OF, "2001-01-31")  # a later run appends
    snapshot = roadmap.status_snapshot(w.stg_users, None, AS_OF, lines=w.order_lines)
    assert rows(status_counts(h.read())) == rows(snapshot)
    whole = rows(h.read())
    files = lambda: {f for f in h.read().select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    before = files()
    fewer = w.stg_users.where("customer_id % 2 = 0")  # late corrections of one month
    h.record(fewer, w.order_lines, "1999-05-31", "1999-05-31")
    other = {f for f in before if "ano_mes=1999-05" not in f}
    assert other < files() and other == {f for f in files() if "ano_mes=1999-05" not in f}
    now = h.read()
    assert now.where("ano_mes = '1999-05' AND user_id % 2 = 1").count() == 0
    assert [r for r in rows(now) if r[3] != "1999-05"] == [r for r in whole if r[3] != "1999-05"]
    h.record(w.stg_users, w.order_lines, "1999-05-31", "1999-05-31")
    assert rows(h.read()) == whole


# -- refresh --------------------------------------------------------------------
def test_merged_lines_equal_lines_of_all_items(spark, raw):
    items = Warehouse(raw, AS_OF).stg_order_items
    old, new = items.where("order_item_id % 3 <> 0"), items.where("order_item_id % 3 = 0")
    merged = merge_lines(gold.order_lines(old), gold.order_lines(new))
    assert merged.dtypes == gold.order_lines(items).dtypes
    assert rows(merged) == rows(gold.order_lines(items))


LAYERS = ("stg_orders", "stg_order_items", "order_lines", "customer_metrics", "dim_customers_gold", "order_metrics", "fact_order_items", "fact_sales_performance", "vw_sales_analysis")


@pytest.mark.parametrize("fold_orphans", [False, True])
def test_a_refresh_equals_a_full_build_row_for_row(spark, small_dir, tmp_path, fold_orphans):
    rng = random.Random(fold_orphans)
    now = raw_tables(spark, small_dir)
    at = dt.datetime(2001, 7, 30)
    gone, moved, other = ([rng.randrange(6000) for _ in range(40)] for _ in range(3))
    items = now.order_items.where(~F.col("order_id").isin(gone)).withColumn("status", F.when(F.col("order_id").isin(moved), "Returned").otherwise(F.col("status")))
    items = items.withColumn("user_id", F.when(F.col("order_id").isin(other), F.col("user_id") + 1).otherwise(F.col("user_id")))
    orders = now.orders.where(~F.col("order_id").isin(gone)).withColumn("status", F.when(F.col("order_id").isin(moved), "Returned").otherwise(F.col("status")))
    extra = items.limit(3).withColumn("id", F.col("id") + 10**9).withColumn("order_id", F.lit(None).cast("bigint")).withColumn("created_at", F.lit(at))
    after = RawTables(now.users, orders, items.unionByName(extra), now.products)
    base = Warehouse(now, AS_OF, target=str(tmp_path / "base"), materialize_view=True, fold_orphans=fold_orphans)
    fresh = IncrementalWarehouse(after, base, changed_orders(now, after), str(tmp_path / "now"))
    full = Warehouse(after, AS_OF, fold_orphans=fold_orphans)
    for name in LAYERS:
        assert getattr(fresh, name).dtypes == getattr(full, name).dtypes, name
        assert rows(getattr(fresh, name)) == rows(getattr(full, name)), name


def test_flow_counts_every_move_and_sorts_narrow_rows(spark):
    from revlens.plans.history import status_flow

    rows = [(u, s, f"{m}-28", m) for u, m, s in [
        (1, "2000-01", "Sem Compra"), (1, "2000-02", "Novo"), (1, "2000-04", "Churn"), (2, "2000-02", "Pausa"), (2, "2000-03", "Outro"),
        (2, "2000-04", "Ativo"), (3, "2000-03", None), (3, "2000-04", "Churn"), (4, "1969-11", "Novo"), (4, "1969-12", "Novo"),
        (None, "2000-01", "Sem Compra"), (None, "2000-01", "Sem Compra"), (5, "2000-04", "Churn"),
    ]]
    history = spark.createDataFrame(rows, "user_id bigint, status_cliente string, d string, ano_mes string")
    history = history.selectExpr("user_id", "status_cliente", "cast(d as date) AS data_snapshot", "ano_mes")
    flow = status_flow(history)
    got = {tuple(r)[:3]: r["clientes"] for r in flow.collect()}
    assert got == {
        ("2000-01", None, "Sem Compra"): 2, ("2000-01", "Sem Compra", "Sem Compra"): 1, ("2000-02", "Sem Compra", "Novo"): 1,
        ("2000-04", "Novo", "Churn"): 1, ("2000-02", None, "Pausa"): 1, ("2000-03", "Pausa", "Outro"): 1, ("2000-04", "Outro", "Ativo"): 1,
        ("2000-03", None, None): 1, ("2000-04", None, "Churn"): 2, ("1969-11", None, "Novo"): 1, ("1969-12", "Novo", "Novo"): 1,
    }
    plan = flow._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window" in line)
    assert "ano_mes" not in window and "status_cliente" not in window and "ORDER BY" not in window
    assert "data_snapshot" not in window  # rows are sorted by one number


def test_a_task_of_the_flow_stays_bounded(spark, monkeypatch):
    from revlens.plans import history as H

    ids = spark.range(400).selectExpr("id % 100 AS user_id", "if(id < 200, 'Novo', 'Churn') AS status_cliente", "last_day(add_months(date'2000-01-15', cast(id div 100 as int))) AS data_snapshot")
    months = ids.withColumn("ano_mes", F.date_format("data_snapshot", "yyyy-MM"))
    monkeypatch.setattr(H, "FLOW_ROWS", 32)
    dealt = H.status_flow(months, months.count())
    assert "RepartitionByExpression [user_id" in (plan := dealt._jdf.queryExecution().optimizedPlan().toString()) and ", 13" in plan
    assert rows(dealt) == rows(H.status_flow(months)) and sum(r["clientes"] for r in dealt.collect()) == 400
