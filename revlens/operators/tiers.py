"""Value tiers whose cuts come from the data instead of the published constants.

The published cuts are the 25th and 75th percentile of an older state of the base. ``tier_rules`` takes them from the
customer metrics as they are; ``value_tiers`` reports the tiers. The constants stay the default everywhere else.
"""

from __future__ import annotations

from dataclasses import replace
from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.functions import money_total
from revlens.functions.numeric import MICROS, dsum, micros

BINS = 4096


def exact_quantiles(df: DataFrame, col: str, probs: tuple[str, ...], bins: int = BINS) -> list[float | None]:
    """The discrete quantiles of a money column: for each p the smallest value with at least p of the rows at or below it.

    Exact, without a sort: counts per bin of the range locate each wanted rank, the next round divides only its bin,
    until a bin is one value (a millionth wide). A round is an aggregate with at most ``bins`` rows per quantile, and
    their number grows with the digits of the range, not with the rows. Nulls are left out; None for no values.
    Probabilities are decimals in text, so that ranks are exact.
    """
    values = df.select(micros(col).cast("bigint").alias("v")).where(F.col("v").isNotNull())
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(probs)
    found = {p: (low, high, max(1, ceil(Fraction(p) * n))) for p in probs}  # range and rank within it
    while open_ := sorted({(a, b) for a, b, _ in found.values() if a < b}):
        places = []
        for i, (a, b) in enumerate(open_):
            width = -(-(b - a + 1) // bins)
            at = F.call_function("div", F.col("v") - F.lit(a), F.lit(width))
            places.append(F.when(F.col("v").between(a, b), F.struct(F.lit(i).alias("i"), at.alias("bin"))))
        hit = values.select(F.explode(F.array_compact(F.array(*places))).alias("p"))
        counts = sorted((r["i"], r["bin"], r["count"]) for r in hit.groupBy("p.i", "p.bin").count().collect())
        for p, (a, b, rank) in found.items():
            if a == b:
                continue
            i, width = open_.index((a, b)), -(-(b - a + 1) // bins)
            for j, place, count in counts:
                if j != i:
                    continue
                if rank <= count:
                    found[p] = (a + place * width, min(b, a + (place + 1) * width - 1), rank)
                    break
                rank -= count
    return [found[p][0] / MICROS for p in probs]


def tier_rules(metrics: DataFrame, rules: Rules = DEFAULT_RULES) -> Rules:
    """``rules`` with the low and mid cut at the 25th and 75th percentile of the LTV of customers with revenue."""
    low, mid = exact_quantiles(metrics.where(F.col("ltv") > 0), "ltv", ("0.25", "0.75"))
    return rules if low is None else replace(rules, tier_low=low, tier_mid=mid)


def value_tiers(customers: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Customers and revenue by value tier, with the LTV from which a tier starts (0 for no revenue and the lowest)."""
    starts = {C.SEM_RECEITA: 0.0, C.BAIXO_VALOR: 0.0, C.MEDIO_VALOR: rules.tier_low, C.ALTO_VALOR: rules.tier_mid, C.CLIENTE_ELITE: rules.tier_elite}
    start = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("segmento_valor"))
    g = customers.groupBy("segmento_valor").agg(F.count(F.lit(1)).alias("clientes"), dsum("ltv").alias("_ltv"))
    return g.select("segmento_valor", start.alias("ltv_minimo"), "clientes", money_total("_ltv").alias("receita"))
