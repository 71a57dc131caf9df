"""Column names, order and types of every published table."""

from __future__ import annotations

import pytest

from revlens.operators.gold import DIM_COLUMNS
from revlens.operators.view import VIEW_COLUMNS
from revlens.plans.catalog import warehouse

CONTRACT = {
    "stg_users": (
        "customer_id first_name last_name email age gender country city traffic_source customer_since"
    ).split(),
    "stg_orders": (
        "order_id user_id status created_at shipped_at delivered_at num_of_item dias_para_envio"
    ).split(),
    "stg_order_items": (
        "order_item_id order_id user_id product_id sale_price status created_at cost category brand "
        "margem margem_pct"
    ).split(),
    "stg_user_id_mapping": ["user_id_original", "user_id_canonical"],
    "dim_customers_gold": list(DIM_COLUMNS),
    "fact_sales_performance": (
        "order_id user_id data_pedido ano mes ano_mes status total_itens dias_para_envio "
        "media_dias_envio receita_pedido custo_pedido margem_pedido margem_pct_media "
        "ticket_medio_pedido receita_mensal total_pedidos_mes clientes_unicos_mes "
        "ticket_medio_mensal crescimento_mom_pct crescimento_yoy_pct status_cliente rfm_score ltv "
        "traffic_source country"
    ).split(),
    "fact_order_items": (
        "order_item_id order_id user_id category brand status_item data_pedido ano mes ano_mes "
        "sale_price cost margem margem_pct"
    ).split(),
    "vw_sales_analysis": list(VIEW_COLUMNS),
}

INTEGER = {"age", "num_of_item", "dias_para_envio", "ano", "mes", "total_itens", "total_pedidos",
           "r_score", "f_score", "m_score", "dias_desde_ultima_compra", "total_pedidos_mes",
           "clientes_unicos_mes", "total_pedidos_cliente"}


MONEY = {"sale_price", "cost", "margem", "margem_pct", "ltv", "ticket_medio", "receita_pedido",
         "custo_pedido", "margem_pedido", "margem_pct_media", "ticket_medio_pedido", "receita_mensal",
         "ticket_medio_mensal", "crescimento_mom_pct", "crescimento_yoy_pct", "media_dias_envio",
         "ticket_medio_cliente"}


@pytest.mark.parametrize("table", sorted(CONTRACT))
def test_columns_and_types(spark, small_dir, table):
    df = getattr(warehouse(spark, small_dir), table)
    assert df.columns == CONTRACT[table]
    types = dict(df.dtypes)
    for col in CONTRACT[table]:
        if col in INTEGER or col.endswith("_id") or col == "customer_id":
            assert types[col] == "bigint", (table, col, types[col])
        if col in MONEY:
            assert types[col] == "double", (table, col, types[col])
