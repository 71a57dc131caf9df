"""Business constants and default labels.

Every threshold is a keyword default so a caller can change a rule without
editing a query. The labels are the data contract of the published tables
(Portuguese, as delivered to the BI layer) and must not be translated.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    # --- fixed values: order statuses -------------------------------------
    valid_statuses: tuple[str, ...] = ("Complete", "Shipped")
    lost_statuses: tuple[str, ...] = ("Cancelled", "Returned")
    risk_status: str = "Processing"
    # --- fixed values: recency windows in days ----------------------------
    recent_days: int = 90
    active_days: int = 180
    # --- fixed values: RFM score cuts ------------------------------------
    freq_high: int = 5
    freq_mid: int = 2
    ltv_high: float = 500.0
    ltv_mid: float = 200.0
    # --- fixed values: value tiers (said to be p25 / p75 / elite) ---------
    tier_low: float = 36.0
    tier_mid: float = 148.0
    tier_elite: float = 500.0
    # --- fixed values: conversion assumptions -----------------------------
    conv_unconverted: float = 0.10
    conv_reactivate: float = 0.20
    conv_upgrade: float = 0.30
    # --- fixed values: report sizes --------------------------------------
    top_countries: int = 10
    trend_rows: int = 24
    top_new: int = 20


DEFAULT_RULES = Rules()

# The date the test fixtures are evaluated against (CURRENT_DATE in the
# warehouse scripts is not repeatable).
FIXTURE_AS_OF = _dt.date(2001, 8, 2)

# --- fixed values: labels ---------------------------------------------------
NOVO = "Novo"
ATIVO = "Ativo"
CHURN = "Churn"
SEM_COMPRA = "Sem Compra"
SEM_SEGMENTO = "Sem Segmento"
SEM_RECEITA = "Sem Receita"
SEM_MARCA = "Sem Marca"
DESCONHECIDO = "Desconhecido"
NO_RFM = "000"

CLIENTE_PREMIUM = "Cliente Premium"
CLIENTE_FREQUENTE = "Cliente Frequente"
ALTO_VALOR_RECENTE = "Alto Valor Recente"
FREQUENTE_INATIVO = "Frequente Inativo"
INATIVO_BAIXO_VALOR = "Inativo Baixo Valor"
FREQUENTE_BAIXO_VALOR = "Frequente Baixo Valor"
PRIMEIRA_COMPRA = "Primeira Compra"
OCASIONAL = "Ocasional"

BAIXO_VALOR = "Baixo Valor"
MEDIO_VALOR = "Médio Valor"
ALTO_VALOR = "Alto Valor"
CLIENTE_ELITE = "Cliente Elite"

LEAK_GROSS = "Receita Bruta"
LEAK_REAL = "Receita Real (Complete + Shipped)"
LEAK_LOST = "Receita Perdida (Cancelled + Returned)"
LEAK_RISK = "Receita em Risco (Processing)"

GROWTH_UNCONVERTED = "Cadastros Sem Compra"
GROWTH_REACTIVATE = "Frequente Inativo — Reativar 20%"
GROWTH_UPGRADE = "Alto Valor Recente — Upgrade Premium"
GROWTH_NEW = "Clientes Novos — Converter em Ativos"
# ---------------------------------------------------------------------------
