"""Growth-opportunity reports over the customer dimension.

The scripts repeat two uncorrelated scalar subqueries -- mean LTV of
'Ativo' customers and of 'Cliente Premium' customers -- nine times. Here
each is one ``DataFrame.scalar()`` (a ``ScalarSubquery``): computed once
per query, no join, and NULL rather than a dropped row when the class is
empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions import (
    davg,
    dsum,
    from_micros,
    iavg,
    money_round,
    money_total,
    ratio,
    round_half_up,
)


def _is_status(label: str) -> Column:
    return F.col("status_cliente") == label


def _is_segment(label: str) -> Column:
    return F.col("segmento_rfm") == label


def class_mean_ltv(dim: DataFrame, cond: Column) -> Column:
    """AVG(ltv) over the customers matching ``cond``, as a scalar subquery."""
    return dim.where(cond).agg(davg("ltv").alias("avg_ltv")).scalar()


def _count() -> Column:
    return F.count(F.lit(1))


def growth_unconverted(dim: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Sign-ups without a purchase per channel, valued at the mean 'Ativo' LTV."""
    ativo = class_mean_ltv(dim, _is_status(C.ATIVO))
    g = (
        dim.where(_is_status(C.SEM_COMPRA))
        .groupBy(F.col("traffic_source").alias("canal"))
        .agg(_count().alias("cadastros_sem_compra"))
    )
    n = F.col("cadastros_sem_compra")
    return g.select(
        "canal",
        "cadastros_sem_compra",
        money_round(n * ativo).alias("receita_potencial"),
        money_round(n * F.lit(rules.conv_unconverted) * ativo).alias("receita_potencial_10pct"),
    ).orderBy(n.desc(), F.col("canal").asc_nulls_first())


def growth_reactivation(dim: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P15: 'Frequente Inativo' customers per channel and the value of reactivating 20 %."""
    g = (
        dim.where(_is_segment(C.FREQUENTE_INATIVO))
        .groupBy(F.col("traffic_source").alias("canal"))
        .agg(
            _count().alias("total_frequente_inativo"),
            davg("ltv").alias("_avg"),
            dsum("ltv").alias("_sum"),
            iavg("dias_desde_ultima_compra").alias("_days"),
        )
    )
    n = F.col("total_frequente_inativo")
    return g.select(
        "canal",
        "total_frequente_inativo",
        money_round("_avg").alias("ltv_medio_atual"),
        money_total("_sum").alias("ltv_total_historico"),
        round_half_up("_days", 0).alias("dias_medio_inativo"),
        money_round(n * F.lit(rules.conv_reactivate) * F.col("_avg")).alias(
            "receita_potencial_reativacao_20pct"
        ),
    ).orderBy(n.desc(), F.col("canal").asc_nulls_first())


def growth_premium_upgrade(dim: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P16: 'Alto Valor Recente' per channel, gap to the mean premium LTV."""
    premium = class_mean_ltv(dim, _is_segment(C.CLIENTE_PREMIUM))
    g = (
        dim.where(_is_segment(C.ALTO_VALOR_RECENTE))
        .groupBy(F.col("traffic_source").alias("canal"))
        .agg(_count().alias("total_alto_valor_recente"), davg("ltv").alias("_avg"))
    )
    n, avg = F.col("total_alto_valor_recente"), F.col("_avg")
    return g.select(
        "canal",
        "total_alto_valor_recente",
        money_round(avg).alias("ltv_medio_atual"),
        money_round(premium).alias("ltv_medio_premium"),
        money_round(premium - avg).alias("gap_para_premium"),
        money_round(n * (premium - avg)).alias("potencial_total_upgrade"),
    ).orderBy(n.desc(), F.col("canal").asc_nulls_first())


def growth_new_window(
    dim: DataFrame, rules: Rules = DEFAULT_RULES, n: int | None = None
) -> DataFrame:
    """P17: 'Novo' customers per country and channel still inside the 90-day window."""
    n = rules.top_new if n is None else n
    ativo = class_mean_ltv(dim, _is_status(C.ATIVO))
    g = (
        dim.where(_is_status(C.NOVO))
        .groupBy(F.col("country").alias("pais"), F.col("traffic_source").alias("canal"))
        .agg(
            _count().alias("total_novos"),
            davg("ltv").alias("_avg"),
            iavg("dias_desde_ultima_compra").alias("_days"),
        )
    )
    total = F.col("total_novos")
    left = round_half_up(F.lit(float(rules.recent_days)) - F.col("_days"), 0)
    return (
        g.select(
            "pais",
            "canal",
            "total_novos",
            money_round("_avg").alias("ltv_medio_atual"),
            round_half_up("_days", 0).alias("dias_medio_desde_compra"),
            left.alias("dias_restantes_janela"),
            money_round(total * ativo).alias("potencial_se_ativos"),
        )
        .where(F.col("dias_restantes_janela") > 0)
        .orderBy(total.desc(), F.col("pais").asc_nulls_first(), F.col("canal").asc_nulls_first())
        .limit(n)
    )


def growth_summary(dim: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The four opportunities in one table, largest potential first.

    One scan of the dimension: a single global aggregate with conditional
    counts and exact sums for the four groups and for the two reference
    classes ('Ativo', 'Cliente Premium'), then the four rows are unpacked
    from that one row. (The column keeps its published name even though it
    holds 10 %, 20 %, 30 % and 100 % values.)
    """
    classes = {
        "u": _is_status(C.SEM_COMPRA),
        "r": _is_segment(C.FREQUENTE_INATIVO),
        "p": _is_segment(C.ALTO_VALOR_RECENTE),
        "n": _is_status(C.NOVO),
        "a": _is_status(C.ATIVO),
        "c": _is_segment(C.CLIENTE_PREMIUM),
    }
    aggs = []
    for key, cond in classes.items():
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"n_{key}"))
        aggs.append(dsum(F.when(cond, F.col("ltv"))).alias(f"s_{key}"))
        aggs.append(F.count(F.when(cond, F.col("ltv"))).alias(f"c_{key}"))
    one = dim.agg(*aggs)
    avg = {key: ratio(from_micros(f"s_{key}"), F.col(f"c_{key}")) for key in classes}
    cnt = {key: F.col(f"n_{key}") for key in classes}

    def row(label: str, key: str, mean: Column, potential: Column) -> Column:
        return F.struct(
            F.lit(label).alias("grupo"),
            cnt[key].alias("total_clientes"),
            mean.alias("ltv_medio_atual"),
            money_round(potential).alias("potencial_conservador_10pct"),
        )

    rows = F.array(
        row(
            C.GROWTH_UNCONVERTED,
            "u",
            F.lit(0.0),
            cnt["u"] * F.lit(rules.conv_unconverted) * avg["a"],
        ),
        row(
            C.GROWTH_REACTIVATE,
            "r",
            money_round(avg["r"]),
            cnt["r"] * F.lit(rules.conv_reactivate) * avg["r"],
        ),
        row(
            C.GROWTH_UPGRADE,
            "p",
            money_round(avg["p"]),
            cnt["p"] * F.lit(rules.conv_upgrade) * (avg["c"] - avg["p"]),
        ),
        row(C.GROWTH_NEW, "n", money_round(avg["n"]), cnt["n"] * avg["a"]),
    )
    return one.select(F.inline(rows)).orderBy(F.col("potencial_conservador_10pct").desc_nulls_last())
