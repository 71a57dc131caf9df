"""Date and time expressions with warehouse semantics.

All integer results are cast to ``bigint``: Spark's ``year``, ``month`` and
``datediff`` return ``int`` while the warehouse (and the oracle) use 64-bit
integers. Times are read as ``timestamp_ntz`` and the session runs in UTC,
so DATE() / EXTRACT() / FORMAT_DATE() never shift a row across midnight.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of(ts: Column | str) -> Column:
    """DATE(ts)."""
    return F.to_date(_c(ts))


def year_of(ts: Column | str) -> Column:
    """EXTRACT(YEAR FROM ts) as bigint."""
    return F.year(_c(ts)).cast("bigint")


def month_of(ts: Column | str) -> Column:
    """EXTRACT(MONTH FROM ts) as bigint."""
    return F.month(_c(ts)).cast("bigint")


def year_month(ts: Column | str) -> Column:
    """FORMAT_DATE('%Y-%m', DATE(ts))."""
    return F.date_format(F.to_date(_c(ts)), "yyyy-MM")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour periods from ``start`` to ``end`` (timestamp difference)."""
    return F.timestamp_diff("DAY", _c(start), _c(end)).cast("bigint")


def calendar_days(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (DATE_DIFF on dates)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def as_of_date(as_of: _dt.date | str | None) -> Column:
    """The reference date; ``None`` means today's date (not repeatable)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)
