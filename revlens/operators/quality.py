"""Row counts, grain checks and the orphan-id measurement (P19, SURVEY 2.13).

Each check is an aggregate that returns a small table; nothing is collected
by the library. ``assert_grain`` is the only helper that acts on a result,
and it brings back one row per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import dsum, money_total

# Documented grain of each published table.
GRAIN_KEYS: dict[str, tuple[str, ...]] = {
    "stg_users": ("customer_id",),
    "stg_orders": ("order_id",),
    "stg_order_items": ("order_item_id",),
    "stg_user_id_mapping": ("user_id_original",),
    "dim_customers_gold": ("customer_id",),
    "fact_sales_performance": ("order_id",),
    "fact_order_items": ("order_item_id",),
    "vw_sales_analysis": ("order_id",),
}


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(tabela, linhas)`` for every table given, in the order given."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def grain_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows, distinct keys, rows whose key repeats and rows with a NULL in the key, per table.

    Each table is grouped by its key (map-side combined, so one hot key is
    reduced before the shuffle) and the groups are summed to one row.
    """
    keys = GRAIN_KEYS if keys is None else keys
    zero = F.lit(0).cast("bigint")
    parts = []
    for name, df in tables.items():
        key = list(keys[name])
        some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), zero).alias("linhas"),
                F.count(F.lit(1)).alias("chaves_distintas"),
                F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), zero).alias("linhas_com_chave_repetida"),
                F.coalesce(F.sum(F.when(some_null, F.col("_n"))), zero).alias("linhas_com_chave_nula"),
            ).select(
                F.lit(name).alias("tabela"),
                F.lit(",".join(key)).alias("chave"),
                "linhas",
                "chaves_distintas",
                "linhas_com_chave_repetida",
                "linhas_com_chave_nula",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def assert_grain(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> None:
    """Raise if any table has a repeated or NULL key (one small row per table comes back)."""
    broken = "linhas_com_chave_repetida > 0 OR linhas_com_chave_nula > 0"
    bad = [
        (r["tabela"], r["linhas_com_chave_repetida"], r["linhas_com_chave_nula"])
        for r in grain_report(tables, keys).where(broken).collect()
    ]
    if bad:
        raise AssertionError(f"grain violated (table, repeated, null): {bad}")


# Tables that must have equally many rows: a copy, a view of one, or an N:1 join that may not multiply rows.
PARITY = (
    ("dim_customers_gold", "stg_users"),
    ("vw_sales_analysis", "stg_orders"),
    ("fact_sales_performance", "order_metrics"),
    ("fact_order_items", "stg_order_items"),
    ("stg_order_items", "order_items"),
    ("stg_orders", "orders"),
)


def parity_report(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str]] = PARITY) -> DataFrame:
    """Rows on both sides of each pair, and whether they are equal. Each table is counted once."""
    names = dict.fromkeys(n for pair in pairs for n in pair)
    counts = row_count_report({n: tables[n] for n in names})
    one = counts.agg(*[F.max(F.when(F.col("tabela") == n, F.col("linhas"))).alias(n) for n in names])
    rows = [
        F.struct(
            F.lit(a).alias("tabela"),
            F.lit(b).alias("referencia"),
            F.col(a).alias("linhas"),
            F.col(b).alias("linhas_referencia"),
            (F.col(a) == F.col(b)).alias("ok"),
        )
        for a, b in pairs
    ]
    return one.select(F.inline(F.array(*rows)))


def assertions(grain: DataFrame, parity: DataFrame) -> DataFrame:
    """One pass/fail row per rule, from a ``grain_report`` and a ``parity_report``."""
    rules = F.array(
        F.struct(F.lit("chave_unica").alias("regra"), F.col("linhas_com_chave_repetida").alias("violacoes")),
        F.struct(F.lit("chave_nao_nula").alias("regra"), F.col("linhas_com_chave_nula").alias("violacoes")),
    )
    keys = grain.select("tabela", F.inline(rules))
    rows = parity.select(
        "tabela",
        F.concat(F.lit("linhas_de_"), F.col("referencia")).alias("regra"),
        F.abs(F.col("linhas") - F.col("linhas_referencia")).alias("violacoes"),
    )
    return keys.unionByName(rows).withColumn("ok", F.col("violacoes") == 0)


def orphan_report(view: DataFrame, customers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Orders whose user is not a cleaned customer: ids, orders, revenue, and which ids the mapping resolves.

    Orders are folded to users first; a left-anti join of those against ``stg_users``, so an id that
    the dedup dropped without a mapping (no e-mail) and an id that was never
    registered count too; then a left join to the mapping (one row per id).
    """
    known = customers.select(F.col("customer_id").alias("_cid"))
    removed = mapping.select(F.col("user_id_original").alias("_orig")).distinct()
    users = view.groupBy("user_id").agg(F.count("order_id").alias("_n"), dsum("receita_pedido").alias("_r"))
    orphans = users.join(known, users.user_id == known._cid, "left_anti")
    marked = orphans.join(removed, orphans.user_id == removed._orig, "left")
    resolved = F.col("_orig").isNotNull()

    def orders(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("_n"))), F.lit(0)).cast("bigint")

    return marked.agg(
        F.count("user_id").alias("ids_orfaos"),
        orders(F.lit(True)).alias("pedidos_orfaos"),
        money_total(F.sum("_r")).alias("receita_orfaos"),
        F.count("_orig").alias("ids_mapeados"),
        orders(resolved).alias("pedidos_mapeados"),
        F.count(F.when(~resolved, F.col("user_id"))).alias("ids_sem_mapa"),
        orders(~resolved).alias("pedidos_sem_mapa"),
    )
