"""Hand-made frames for cases the mapped test data does not contain."""

from __future__ import annotations

import datetime as dt

from revlens import config as C
from revlens.functions import title_case, trim_ws
from revlens.operators import gold, growth, leakage, silver, view
from revlens.sources.raw import RawTables

AS_OF = dt.date(2001, 8, 2)
T = dt.datetime

USERS = (
    "id long, first_name string, last_name string, email string, age long, gender string, "
    "country string, city string, traffic_source string, created_at timestamp_ntz"
)
ORDERS = (
    "order_id long, user_id long, status string, created_at timestamp_ntz, "
    "shipped_at timestamp_ntz, delivered_at timestamp_ntz, num_of_item long"
)
ITEMS = (
    "id long, order_id long, user_id long, product_id long, sale_price double, status string, "
    "created_at timestamp_ntz"
)
PRODUCTS = "id long, cost double, category string, brand string"


def user(i, email, created, name="ana", country="brasil", city="são paulo", source="Search"):
    return (i, name, "silva", email, 30, "F", country, city, source, created)


def test_title_case_and_trim(spark):
    df = spark.createDataFrame(
        [("  mArY",), ("josé-luis ",), (" o'NEIL 12",), ("\tsaint-denis ",), ("são_joão",), (None,)],
        "s string",
    )
    got = [tuple(r) for r in df.select(trim_ws("s"), title_case("s")).collect()]
    assert got == [
        ("mArY", "Mary"),
        ("josé-luis", "José-Luis"),
        ("o'NEIL 12", "O'neil 12"),
        ("saint-denis", "Saint-Denis"),
        ("são_joão", "São_João"),
        (None, None),
    ]


def test_dedup_ties_nulls_and_whitespace(spark):
    same = T(2020, 1, 1)
    users = spark.createDataFrame(
        [
            user(5, "A@X.COM", same),  # tie on created_at: smallest id wins
            user(3, " a@x.com\t", same),
            user(9, "a@x.com ", T(2019, 1, 1)),  # oldest of the group -> survivor
            user(7, None, T(2021, 1, 1)),
            user(6, None, T(2020, 6, 1)),  # NULL e-mails: one survivor, never mapped
            user(8, "b@x.com", same),
        ],
        USERS,
    )
    stg = silver.stg_users(users)
    survivors = {r.customer_id: r.email for r in stg.collect()}
    assert survivors == {9: "a@x.com", 6: None, 8: "b@x.com"}
    mapping = {
        r.user_id_original: r.user_id_canonical
        for r in silver.stg_user_id_mapping(users, stg).collect()
    }
    assert mapping == {5: 9, 3: 9}


def test_tie_on_created_at_picks_smallest_id(spark):
    same = T(2020, 1, 1)
    users = spark.createDataFrame([user(5, "a@x.com", same), user(3, "A@x.com ", same)], USERS)
    assert [r.customer_id for r in silver.stg_users(users).collect()] == [3]
    assert [tuple(r) for r in silver.stg_user_id_mapping(users).collect()] == [(5, 3)]


def test_negative_and_missing_lead_time(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, "Shipped", T(2020, 1, 2, 10), T(2020, 1, 1, 9), None, 1),
            (2, 1, "Processing", T(2020, 1, 2, 10), None, None, 1),
            (3, 1, "Shipped", T(2020, 1, 1, 23), T(2020, 1, 3, 1), None, 1),
        ],
        ORDERS,
    )
    got = {r.order_id: r.dias_para_envio for r in silver.stg_orders(orders).collect()}
    assert got == {1: -1, 2: None, 3: 1}
    cal = {r.order_id: r.dias_para_envio for r in silver.stg_orders(orders, calendar_lead_time=True).collect()}
    assert cal == {1: -1, 2: None, 3: 2}


def _items(spark, rows):
    items = spark.createDataFrame(rows, ITEMS)
    products = spark.createDataFrame([(10, 4.0, "Tops", None), (11, 1.0, "Socks", "Acme")], PRODUCTS)
    return silver.stg_order_items(items, products)


def test_margin_without_product_and_zero_price(spark):
    soi = _items(
        spark,
        [
            (1, 1, 1, 10, 10.0, "Complete", T(2020, 1, 1)),
            (2, 1, 1, 99, 5.0, "Complete", T(2020, 1, 1)),  # no product row
            (3, 1, 1, 11, 0.0, "Complete", T(2020, 1, 1)),  # zero price
        ],
    )
    got = {r.order_item_id: (r.cost, r.margem, r.margem_pct) for r in soi.collect()}
    assert got == {1: (4.0, 6.0, 60.0), 2: (None, None, None), 3: (1.0, -1.0, None)}
    brands = {r.order_item_id: r.brand for r in gold.fact_order_items(soi).collect()}
    assert brands == {1: C.SEM_MARCA, 2: C.SEM_MARCA, 3: "Acme"}


def test_order_with_mixed_items(spark):
    soi = _items(
        spark,
        [
            (1, 1, 1, 10, 10.0, "Complete", T(2020, 1, 1)),
            (2, 1, 1, 10, 20.0, "Returned", T(2020, 1, 1)),
            (3, 1, 1, 10, 30.0, "Complete", T(2020, 1, 2)),
        ],
    )
    orders = silver.stg_orders(
        spark.createDataFrame([(1, 1, "Complete", T(2020, 1, 1), T(2020, 1, 3), None, 3)], ORDERS)
    )
    om = gold.order_metrics(soi, orders).collect()
    assert sorted((str(r.data_pedido), r.status, r.receita_pedido) for r in om) == [
        ("2020-01-01", "Complete", 10.0),
        ("2020-01-01", "Returned", 20.0),
        ("2020-01-02", "Complete", 30.0),
    ]
    assert {r.dias_para_envio for r in om} == {2}
    fin = view.order_financials(soi).collect()
    assert [(r.total_itens, r.receita_pedido, r.ticket_medio_pedido) for r in fin] == [(3, 60.0, 20.0)]


def test_lag_is_positional_over_present_months(spark):
    rows = []
    for oid, (y, m, status, rev) in enumerate(
        [(2020, 1, "Complete", 100.0), (2020, 2, "Cancelled", 999.0), (2020, 3, "Shipped", 150.0)]
    ):
        rows.append((oid, 1, y, m, f"{y}-{m:02d}", status, rev, rev, 1))
    om = spark.createDataFrame(
        rows,
        "order_id long, user_id long, ano long, mes long, ano_mes string, status string, "
        "receita_pedido double, ticket_medio_pedido double, dias_para_envio long",
    )
    got = {r.ano_mes: (r.receita_mensal, r.crescimento_mom_pct) for r in gold.monthly_series(om).collect()}
    # February has only a cancelled order, so it is not a row; March's "previous" is January
    assert got == {"2020-01": (100.0, None), "2020-03": (150.0, 50.0)}
    aligned = {
        r.ano_mes: (r.receita_mensal, r.crescimento_mom_pct)
        for r in gold.monthly_series(om, calendar_aligned=True).collect()
    }
    # aligned to the calendar, March has no February to compare with
    assert aligned == {"2020-01": (100.0, None), "2020-03": (150.0, None)}


def test_calendar_aligned_year_over_year(spark):
    rows = [
        (i, 1, y, m, f"{y}-{m:02d}", "Complete", rev, rev, 1)
        for i, (y, m, rev) in enumerate([(2019, 3, 80.0), (2019, 12, 50.0), (2020, 3, 100.0)])
    ]
    om = spark.createDataFrame(
        rows,
        "order_id long, user_id long, ano long, mes long, ano_mes string, status string, "
        "receita_pedido double, ticket_medio_pedido double, dias_para_envio long",
    )
    yoy = {r.ano_mes: r.crescimento_yoy_pct for r in gold.monthly_series(om, calendar_aligned=True).collect()}
    assert yoy == {"2019-03": None, "2019-12": None, "2020-03": 25.0}
    positional = {r.ano_mes: r.crescimento_yoy_pct for r in gold.monthly_series(om).collect()}
    assert positional["2020-03"] is None  # only 2 months before it: LAG(12) finds nothing


def _dim_row(i, status, segment, ltv, days=10, source="Search", country="Brasil"):
    return (i, source, country, status, segment, ltv, days)


DIM = (
    "customer_id long, traffic_source string, country string, status_cliente string, "
    "segmento_rfm string, ltv double, dias_desde_ultima_compra long"
)


def test_empty_reference_classes_keep_rows(spark):
    dim = spark.createDataFrame(
        [
            _dim_row(1, C.SEM_COMPRA, C.SEM_SEGMENTO, 0.0),
            _dim_row(2, C.CHURN, C.ALTO_VALOR_RECENTE, 300.0),
            _dim_row(3, C.NOVO, C.PRIMEIRA_COMPRA, 50.0, days=30),
        ],
        DIM,
    )
    un = growth.growth_unconverted(dim).collect()
    assert [(r.canal, r.cadastros_sem_compra, r.receita_potencial) for r in un] == [("Search", 1, None)]
    up = growth.growth_premium_upgrade(dim).collect()
    assert [(r.total_alto_valor_recente, r.ltv_medio_premium, r.gap_para_premium) for r in up] == [
        (1, None, None)
    ]
    summary = {r.grupo: (r.total_clientes, r.ltv_medio_atual, r.potencial_conservador_10pct) for r in growth.growth_summary(dim).collect()}
    assert summary == {
        C.GROWTH_UNCONVERTED: (1, 0.0, None),
        C.GROWTH_REACTIVATE: (0, None, None),
        C.GROWTH_UPGRADE: (1, 300.0, None),
        C.GROWTH_NEW: (1, 50.0, None),
    }
    new = growth.growth_new_window(dim).collect()
    assert [(r.pais, r.total_novos, r.dias_restantes_janela) for r in new] == [("Brasil", 1, 60.0)]


def test_overview_empty_bucket(spark):
    vw = spark.createDataFrame(
        [(1, "Complete", 10.0), (2, "Cancelled", 5.0), (3, "Cancelled", None)],
        "order_id long, status_pedido string, receita_pedido double",
    )
    got = {r.tipo: (r.total_pedidos, r.receita_total) for r in leakage.leakage_overview(vw).collect()}
    assert got == {
        C.LEAK_GROSS: (3, 15.0),
        C.LEAK_REAL: (1, 10.0),
        C.LEAK_LOST: (2, 5.0),
        C.LEAK_RISK: (0, None),
    }


def test_view_resolves_orphans_and_falls_back(spark):
    users = spark.createDataFrame(
        [
            user(1, "a@x.com", T(2000, 1, 1), country="brasil"),
            user(2, "A@X.com", T(2000, 6, 1), country="spain"),  # removed duplicate of 1
            user(3, "c@x.com", T(2000, 1, 1)),
        ],
        USERS,
    )
    orders = silver.stg_orders(
        spark.createDataFrame(
            [
                (10, 2, "Complete", T(2001, 7, 1, 13), None, None, 1),  # orphan id 2 -> customer 1
                (11, 3, "Complete", T(2001, 7, 1, 13), None, None, 1),
                (12, 99, "Cancelled", T(2001, 7, 1, 13), None, None, 0),  # unknown id, no items
            ],
            ORDERS,
        )
    )
    soi = _items(
        spark,
        [
            (1, 10, 2, 10, 10.0, "Complete", T(2001, 7, 1, 14)),
            (2, 11, 3, 10, 20.0, "Complete", T(2001, 7, 1, 14)),
        ],
    )
    stg = silver.stg_users(users)
    mapping = silver.stg_user_id_mapping(users, stg)
    dim = gold.dim_customers_gold(stg, soi, AS_OF)
    dim_status = {r.customer_id: r.status_cliente for r in dim.collect()}
    # customer 1 never bought under its own id: the dimension says 'Sem Compra'
    assert dim_status == {1: C.SEM_COMPRA, 3: C.NOVO}
    vw = view.vw_sales_analysis(orders, soi, users, mapping, dim, AS_OF)
    got = {r.order_id: (r.status_cliente, r.country, r.total_itens, r.rfm_score) for r in vw.collect()}
    assert got == {
        # dimension label is 'Sem Compra', so the order's own id history decides
        10: (C.NOVO, "spain", 1, C.NO_RFM),
        11: (C.NOVO, "brasil", 1, "311"),
        12: (C.SEM_SEGMENTO, None, None, C.NO_RFM),
    }
    assert vw.count() == orders.count()


def test_raw_tables_round_trip(spark, tmp_path):
    from revlens.sources import read_raw, write_table

    users = spark.createDataFrame([user(1, "a@x.com", T(2000, 1, 1))], USERS)
    orders = spark.createDataFrame([(1, 1, "Complete", T(2001, 1, 1), None, None, 0)], ORDERS)
    items = spark.createDataFrame([], ITEMS)
    products = spark.createDataFrame([], PRODUCTS)
    for name, df in {"users": users, "orders": orders, "order_items": items, "products": products}.items():
        write_table(df, str(tmp_path / name))
    raw = read_raw(spark, str(tmp_path))
    assert isinstance(raw, RawTables)
    assert raw.users.count() == 1 and raw.order_items.count() == 0
