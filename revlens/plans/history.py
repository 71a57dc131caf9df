"""Monthly history of the customer status: an append-only table, a folder per month.

The roadmap asks for the status of every customer month by month. A month's rows are what the dimension would have said
on its last day. ``StatusHistory.record`` computes any range of months from the silver layers and writes it with dynamic
partition overwrite: the months written are replaced, all others stay as they are. So a month can be run again after
late data, and a missed run is made up by a longer range. A month that has no customer writes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens import config as C
from revlens.config import DEFAULT_RULES, Rules
from revlens.operators import roadmap

SCHEMA = "user_id bigint, status_cliente string, data_snapshot date, ano_mes string"


class StatusHistory:
    """The stored history under ``path``: user_id, status_cliente, data_snapshot, by ano_mes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def record(
        self,
        users: DataFrame,
        lines: DataFrame,
        last: _dt.date | str,
        first: _dt.date | str | None = None,
        rules: Rules = DEFAULT_RULES,
    ) -> None:
        """Write the months that end from ``first`` to ``last`` (no ``first``: from the earliest), replacing them alone.

        ``users`` is P1, ``lines`` the order lines. A customer is in a month from sign-up or the first purchase on.
        """
        rows = roadmap.status_rows(users, lines, last, first, rules)
        # a month's rows meet in few files; rebalancing splits a large month. Rows travel and are sorted by the day alone
        # (a number), and get their label after that, so a file follows the other without a sort by folder name
        rows = rows.select("user_id", "status_cliente", "data_snapshot").hint("rebalance", "data_snapshot")
        rows = rows.sortWithinPartitions("data_snapshot").withColumn("ano_mes", roadmap.month_label("data_snapshot"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ano_mes").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)


def status_counts(history: DataFrame) -> DataFrame:
    """Customers per month and status; equal to ``status_snapshot`` over the same months."""
    counts = history.groupBy("ano_mes", "data_snapshot", "status_cliente").agg(F.count(F.lit(1)).alias("clientes"))
    return counts.select("ano_mes", "data_snapshot", "status_cliente", "clientes")


FLOW_ROWS = 1 << 21  # rows of the history in a task of status_flow
_STATUSES = (C.NOVO, C.ATIVO, C.CHURN, C.SEM_COMPRA)
_NONE, _OTHER = len(_STATUSES), len(_STATUSES) + 1  # codes of no status, and of one that is spelt out


def _code(status: str) -> Column:
    code = F.when(F.col(status).isNull(), F.lit(_NONE))
    for i, known in enumerate(_STATUSES):
        code = code.when(F.col(status) == known, F.lit(i))
    return code.otherwise(F.lit(_OTHER)).cast("bigint")


def _status(code: Column, other: str) -> Column:
    named = F.when(code == _OTHER, F.col(other))
    for i, known in enumerate(_STATUSES):
        named = named.when(code == i, F.lit(known))
    return named


def status_flow(history: DataFrame, rows: int | None = None) -> DataFrame:
    """Customers per month by the status of the month before (NULL: not a customer yet) and the new one.

    A window per customer over its months, so a partition has a row per calendar month at most. What travels and is sorted
    for each of the history's rows is the customer and one number: the day and, in its last three bits, a code of the status
    (a status that ``config`` doesn't know keeps its text). Months and statuses are spelt after the count; the month is
    the day's label, as ``record`` writes it. With ``rows``, the history's row count, customers are dealt over as many tasks as
    keep ``FLOW_ROWS`` rows in each, so that a task's sort doesn't grow with the history.
    """
    code = _code("status_cliente")
    states = history.select(
        "user_id",
        (F.unix_date("data_snapshot") * F.lit(8).cast("bigint") + code).alias("_at"),
        F.when(code == _OTHER, F.col("status_cliente")).alias("_now"),
    )
    tasks = -(-(rows or 0) // FLOW_ROWS)
    if tasks > 1:
        states = states.repartition(tasks, "user_id")
    w = Window.partitionBy("user_id").orderBy("_at")
    before = F.coalesce(F.lag("_at").over(w).bitwiseAND(F.lit(7)), F.lit(_NONE))
    moves = states.select((F.col("_at") * 8 + before).alias("_move"), F.lag("_now").over(w).alias("_was"), "_now")
    moves = moves.withColumn("_was", F.when(F.col("_move").bitwiseAND(F.lit(7)) == _OTHER, F.col("_was")))
    counts = moves.groupBy("_move", "_was", "_now").agg(F.count(F.lit(1)).alias("clientes"))
    named = counts.select(
        F.date_from_unix_date(F.shiftright("_move", 6).cast("int")).alias("_day"),
        _status(F.col("_move").bitwiseAND(F.lit(7)), "_was").alias("status_anterior"),
        _status(F.shiftright("_move", 3).bitwiseAND(F.lit(7)), "_now").alias("status_cliente"),
        "clientes",
    )
    return named.select(roadmap.month_label("_day").alias("ano_mes"), "status_anterior", "status_cliente", "clientes")


def churn_rate(flow: DataFrame) -> DataFrame:
    """Per month: customers that were active, those of them lost to churn, those won back, and the churn share in %."""
    was_active = F.col("status_anterior").isin(C.NOVO, C.ATIVO)
    is_active = F.col("status_cliente").isin(C.NOVO, C.ATIVO)
    n = F.col("clientes")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0).cast("bigint"))

    months = flow.groupBy("ano_mes").agg(
        total(was_active).alias("ativos_antes"),
        total(was_active & (F.col("status_cliente") == C.CHURN)).alias("perdidos"),
        total((F.col("status_anterior") == C.CHURN) & is_active).alias("recuperados"),
    )
    share = roadmap.round_half_up(roadmap.ratio(F.col("perdidos") * F.lit(100.0), F.col("ativos_antes")), 2)
    return months.withColumn("pct_churn", share)


def stored_history(w) -> DataFrame:
    """The whole history of a written warehouse up to its reference date, under its target."""
    spark = w.raw.users.sparkSession
    history = StatusHistory(spark, f"{w.target}/status_history/{w.as_of}")
    history.record(w.stg_users, w.order_lines, w.as_of, rules=w.rules)
    return history.read()
