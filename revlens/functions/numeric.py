"""Money arithmetic and rounding.

Policy (decided once, used everywhere, mirrored by the DuckDB oracle):

* **Sums are exact and have no ceiling in practice.** A money value is a whole
  number of micro-units (``bigint``, up to 9.2e12 currency units for one
  value). Its sum is carried as two ``bigint`` sums, of the whole units and of
  the millionths left over, so the hash aggregate stays on primitive longs;
  the two are put together as one ``decimal`` when the group is finished. A
  total may reach 9.2e18 currency units. An integer sum does not depend on
  the order rows arrive in, so the result is the same on 8 threads and on
  1000 executors.
* **Divisions are doubles.** ``sum / count`` and percentages are evaluated
  in IEEE double from the exact sum, so Spark and the oracle see the same
  bits.
* **Rounding is half away from zero, in one step.** A money total is rounded
  from its exact integer. A double is fixed at 12 decimals, which is below
  the precision of the ratios rounded here, and then rounded; fixing it at 6
  first would turn 73.664999644 into 73.67.

Everything returned to callers is ``double`` (or ``bigint`` for counts).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

FIXED = "decimal(38,12)"  # how a double is held for rounding
MICROS = 1_000_000  # fixed value: money is summed in millionths


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros(col: Column | str) -> Column:
    """A money value as a whole number of millionths (bigint), half away from zero."""
    scaled = _c(col) * F.lit(float(MICROS))
    return F.when(scaled < 0, -F.floor(F.lit(0.5) - scaled)).otherwise(F.floor(scaled + F.lit(0.5)))


def micro_sum(micro: Column | str) -> Column:
    """Exact SUM of micro-units as a decimal (NULL when all inputs are NULL)."""
    m = _c(micro)
    rest = (m % F.lit(MICROS)).cast("bigint")
    whole = F.call_function("div", m, F.lit(MICROS))
    return F.sum(whole).cast("decimal(20,0)") * F.lit(MICROS) + F.sum(rest).cast("decimal(20,0)")


def dsum(col: Column | str) -> Column:
    """Exact SUM of money values, in micro-units (NULL when all inputs are NULL)."""
    return micro_sum(micros(col))


def from_micros(col: Column | str) -> Column:
    """Micro-units back to a double money value."""
    return _c(col).cast("double") / F.lit(float(MICROS))


def as_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0) in double precision."""
    return as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def davg(col: Column | str) -> Column:
    """AVG of money values: exact sum divided by the count of non-NULL values."""
    return ratio(from_micros(dsum(col)), F.count(_c(col)))


def iavg(col: Column | str) -> Column:
    """AVG of an integer column (exact integer sum / count, as double)."""
    c = _c(col)
    return ratio(F.sum(c), F.count(c))


def round_half_up(col: Column | str, scale: int = 2) -> Column:
    """ROUND(x, scale) with ties away from zero, returned as double."""
    return F.round(_c(col).cast(FIXED), scale).cast("double")


def money_round(col: Column | str) -> Column:
    """ROUND(x, 2) for a double money value."""
    return round_half_up(col, 2)


def money_total(micro_sum: Column | str) -> Column:
    """ROUND(SUM(x), 2) from a micro-unit sum, without passing through a double."""
    return F.round(_c(micro_sum).cast("decimal(38,0)") * F.lit(Decimal("0.000001")), 2).cast("double")
