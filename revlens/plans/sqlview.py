"""The order view as SQL text over catalog tables, so that every query evaluates it anew.

The warehouse keeps ``vw_sales_analysis`` as a view. ``view_sql`` writes that view over the registered silver tables and
the dimension; it holds no rows, so new silver rows show at the next query. It gives the same rows and types as
:func:`revlens.operators.view.vw_sales_analysis`, which tests compare.
"""

from __future__ import annotations

import datetime as _dt

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions.numeric import FIXED, MICROS


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _micro_sum(col: str) -> str:
    """Exact SUM of a money column in micro-units, as ``functions.dsum``."""
    scaled = f"{col} * {float(MICROS)}D"
    m = f"(CASE WHEN {scaled} < 0 THEN -FLOOR(0.5D - {scaled}) ELSE FLOOR({scaled} + 0.5D) END)"
    return f"CAST(SUM({m} div {MICROS}) AS DECIMAL(20,0)) * {MICROS} + CAST(SUM(CAST({m} % {MICROS} AS BIGINT)) AS DECIMAL(20,0))"


def _total(micro: str) -> str:
    return f"CAST(ROUND(CAST({micro} AS DECIMAL(38,0)) * 0.000001BD, 2) AS DOUBLE)"


def _mean(micro: str, n: str) -> str:
    value = f"CAST({micro} AS DOUBLE) / {float(MICROS)}D / NULLIF(CAST({n} AS DOUBLE), 0D)"
    return f"CAST(ROUND(CAST({value} AS {FIXED}), 2) AS DOUBLE)"


def view_sql(staging: str, analytics: str, as_of: _dt.date | str | None = None, rules: Rules = DEFAULT_RULES) -> str:
    """SELECT text of the order view; no ``as_of`` means the day of the query."""
    day = "current_date()" if as_of is None else f"DATE {_text(str(as_of))}"
    idle = f"CAST(datediff({day}, p.data_ultima_compra) AS BIGINT)"
    fallback = (
        f"CASE WHEN {idle} <= {rules.recent_days} AND p.pedidos = 1 THEN {_text(C.NOVO)} "
        f"WHEN {idle} <= {rules.active_days} THEN {_text(C.ATIVO)} ELSE {_text(C.CHURN)} END"
    )
    return f"""
WITH totals AS (
  SELECT order_id, COUNT(order_item_id) AS itens, COUNT(margem_pct) AS com_margem,
         {_micro_sum("sale_price")} AS receita, {_micro_sum("cost")} AS custo,
         {_micro_sum("margem")} AS margem, {_micro_sum("margem_pct")} AS margem_pct
  FROM {staging}.stg_order_items GROUP BY order_id),
purchases AS (
  SELECT user_id, to_date(MAX(created_at)) AS data_ultima_compra, COUNT(DISTINCT order_id) AS pedidos
  FROM {staging}.stg_order_items GROUP BY user_id),
survivors AS (SELECT DISTINCT user_id_original, user_id_canonical FROM {staging}.stg_user_id_mapping),
registered AS (
  SELECT u.id, u.country, u.city, u.age, u.gender, u.traffic_source, u.created_at AS customer_since,
         d.status_cliente, d.rfm_score, d.ltv, d.ticket_medio, d.total_pedidos
  FROM {staging}.src_users u
  LEFT JOIN survivors m ON u.id = m.user_id_original
  LEFT JOIN {analytics}.dim_customers_gold d ON coalesce(m.user_id_canonical, u.id) = d.customer_id),
people AS (
  SELECT coalesce(r.id, p.user_id) AS person, r.country, r.city, r.age, r.gender, r.traffic_source, r.customer_since, r.ltv,
         r.rfm_score, r.ticket_medio, r.total_pedidos,
         CASE WHEN r.status_cliente <> {_text(C.SEM_COMPRA)} THEN r.status_cliente
              WHEN p.data_ultima_compra IS NOT NULL THEN {fallback}
              ELSE {_text(C.SEM_SEGMENTO)} END AS status_cliente
  FROM registered r FULL JOIN purchases p ON r.id = p.user_id)
SELECT o.order_id, o.user_id, to_date(o.created_at) AS data_pedido, CAST(year(o.created_at) AS BIGINT) AS ano,
       CAST(month(o.created_at) AS BIGINT) AS mes, date_format(to_date(o.created_at), 'yyyy-MM') AS ano_mes,
       o.status AS status_pedido, o.dias_para_envio, o.shipped_at, o.delivered_at, t.itens AS total_itens,
       {_total("t.receita")} AS receita_pedido, {_total("t.custo")} AS custo_pedido, {_total("t.margem")} AS margem_pedido,
       {_mean("t.margem_pct", "t.com_margem")} AS margem_pct_media, {_mean("t.receita", "t.itens")} AS ticket_medio_pedido,
       w.country, w.city, w.age, w.gender, w.traffic_source, w.customer_since,
       coalesce(w.status_cliente, {_text(C.SEM_SEGMENTO)}) AS status_cliente,
       coalesce(w.rfm_score, {_text(C.NO_RFM)}) AS rfm_score, coalesce(w.ltv, 0D) AS ltv,
       coalesce(w.ticket_medio, 0D) AS ticket_medio_cliente, coalesce(w.total_pedidos, 0L) AS total_pedidos_cliente
FROM {staging}.stg_orders o
LEFT JOIN totals t ON o.order_id = t.order_id
LEFT JOIN people w ON o.user_id = w.person"""
