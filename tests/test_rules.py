"""Truth tables and boundaries of the RFM scores and labels."""

from __future__ import annotations

import datetime as dt

import pytest

from revlens import config as C
from revlens.operators import gold

AS_OF = dt.date(2001, 8, 2)

# segmento_rfm for every (R, F, M) cell; CASE arms are ordered, first match wins.
EXPECTED_SEGMENT = {
    C.CLIENTE_PREMIUM: ["323", "333"],
    C.CLIENTE_FREQUENTE: ["132", "133", "232", "233", "332"],
    C.ALTO_VALOR_RECENTE: ["312", "313"],
    C.FREQUENTE_INATIVO: ["122", "123"],
    C.INATIVO_BAIXO_VALOR: ["111"],
    C.FREQUENTE_BAIXO_VALOR: ["221", "231", "321", "331"],
    C.PRIMEIRA_COMPRA: ["311"],
    C.OCASIONAL: ["112", "113", "121", "131", "211", "212", "213", "222", "223", "322"],
}


def test_all_27_cells(spark):
    cells = [(r, f, m) for r in (1, 2, 3) for f in (1, 2, 3) for m in (1, 2, 3)]
    df = spark.createDataFrame(
        [(i, r, f, m, 100.0, 10, 3) for i, (r, f, m) in enumerate(cells)],
        "user_id long, r_score long, f_score long, m_score long, ltv double, "
        "dias_desde_ultima_compra long, total_pedidos long",
    )
    got = {row.rfm_score: row.segmento_rfm for row in gold.customer_segments(df).collect()}
    want = {cell: label for label, cs in EXPECTED_SEGMENT.items() for cell in cs}
    assert len(want) == 27
    assert got == want


@pytest.mark.parametrize(
    "days,orders,status",
    [(90, 1, C.NOVO), (90, 2, C.ATIVO), (91, 1, C.ATIVO), (180, 3, C.ATIVO), (181, 1, C.CHURN)],
)
def test_lifecycle_boundaries(spark, days, orders, status):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, 0.0, days, orders)],
        "user_id long, r_score long, f_score long, m_score long, ltv double, "
        "dias_desde_ultima_compra long, total_pedidos long",
    )
    assert gold.customer_segments(df).first().status_cliente == status


@pytest.mark.parametrize(
    "ltv,label",
    [
        (0.0, C.SEM_RECEITA),
        (35.99, C.BAIXO_VALOR),
        (36.0, C.MEDIO_VALOR),
        (147.99, C.MEDIO_VALOR),
        (148.0, C.ALTO_VALOR),
        (499.99, C.ALTO_VALOR),
        (500.0, C.CLIENTE_ELITE),
        (None, C.CLIENTE_ELITE),  # a buyer whose LTV is NULL falls to the ELSE arm
    ],
)
def test_value_tiers(spark, ltv, label):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, ltv, 10, 1)],
        "user_id long, r_score long, f_score long, m_score long, ltv double, "
        "dias_desde_ultima_compra long, total_pedidos long",
    )
    assert gold.customer_segments(df).first().segmento_valor == label


def test_score_boundaries(spark):
    rows = [
        # user, days before as_of, orders, ltv, expected (r, f, m)
        (1, 90, 1, 199.99, (3, 1, 1)),
        (2, 91, 2, 200.0, (2, 2, 2)),
        (3, 180, 4, 499.99, (2, 2, 2)),
        (4, 181, 5, 500.0, (1, 3, 3)),
    ]
    df = spark.createDataFrame(
        [
            (u, orders, orders, ltv, ltv, dt.datetime(2001, 1, 1), dt.datetime.combine(AS_OF - dt.timedelta(days=d), dt.time(23, 59)))
            for u, d, orders, ltv, _ in rows
        ],
        "user_id long, total_pedidos long, total_itens long, ltv double, ticket_medio double, "
        "primeira_compra timestamp_ntz, ultima_compra timestamp_ntz",
    )
    got = {
        r.user_id: (r.r_score, r.f_score, r.m_score, r.dias_desde_ultima_compra)
        for r in gold.rfm_scores(df, AS_OF).collect()
    }
    for u, d, _, _, want in rows:
        assert got[u] == (*want, d)
