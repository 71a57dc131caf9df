"""Published facts about the mapped sf0.01 data (FIXTURES.md section 4), computed by Spark.

These counts were observed independently of this library; matching them is
the fixture's equivalent of the warehouse runbook's expected row counts.
"""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from revlens import config as C
from revlens.plans.catalog import warehouse
from revlens.operators import quality

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def wh(spark):
    if not os.path.isdir(SF001):
        pytest.skip("sf0.01 test data not available")
    return warehouse(spark, SF001)


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_table_sizes(wh):
    assert wh.raw.users.count() == 12_000
    assert wh.stg_users.count() == 10_000
    assert wh.dim_customers_gold.count() == 10_000
    assert wh.stg_orders.count() == 15_000
    assert wh.stg_order_items.count() == 60_000
    assert wh.vw_sales_analysis.count() == 15_000
    assert wh.fact_sales_performance.count() == 14_743  # 257 orders have no item


def test_labels(wh):
    dim = wh.dim_customers_gold
    assert counts(dim, "status_cliente") == {
        C.CHURN: 6_205, C.SEM_COMPRA: 2_938, C.ATIVO: 727, C.NOVO: 130,
    }
    assert counts(dim, "segmento_rfm") == {
        C.SEM_SEGMENTO: 2_938, C.OCASIONAL: 2_479, C.INATIVO_BAIXO_VALOR: 2_438,
        C.FREQUENTE_INATIVO: 1_684, C.FREQUENTE_BAIXO_VALOR: 207, C.PRIMEIRA_COMPRA: 101,
        C.CLIENTE_PREMIUM: 75, C.CLIENTE_FREQUENTE: 49, C.ALTO_VALOR_RECENTE: 29,
    }
    assert counts(dim, "segmento_valor") == {
        C.SEM_RECEITA: 5_092, C.ALTO_VALOR: 3_062, C.MEDIO_VALOR: 1_040, C.CLIENTE_ELITE: 680,
        C.BAIXO_VALOR: 126,
    }
    # all 27 RFM cells occur
    assert dim.where(F.col("rfm_score") != C.NO_RFM).select("rfm_score").distinct().count() == 27


def test_orders_items_and_orphans(wh):
    assert counts(wh.stg_orders, "status") == {
        "Complete": 3_760, "Shipped": 4_512, "Processing": 3_008, "Cancelled": 2_232, "Returned": 1_488,
    }
    items = wh.stg_order_items
    assert items.where(F.col("cost").isNull()).count() == 646
    assert items.where(F.col("sale_price") == 0).count() == 1_150
    orphan = quality.orphan_report(wh.vw_sales_analysis, wh.stg_users, wh.stg_user_id_mapping).first()
    assert (orphan.pedidos_orfaos, orphan.ids_orfaos) == (2_501, 1_445)
    assert wh.vw_sales_analysis.select("ano_mes").distinct().count() == 80


def test_lead_time_rules(wh):
    got = {
        (r[0], r[1]): r[2]
        for r in wh.stg_orders.groupBy(
            "dias_para_envio",
            F.datediff(F.to_date("shipped_at"), F.to_date("created_at")).cast("bigint"),
        ).count().collect()
    }
    assert got == {(0, 0): 1_971, (0, 1): 1_971, (1, 2): 1_971, (2, 2): 1_877, (3, 3): 1_970, (None, None): 5_240}
