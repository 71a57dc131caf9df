"""Built-in-expression helpers shared by every operator."""

from revlens.functions.calendar import (
    as_of_date,
    calendar_days,
    day_of,
    elapsed_days,
    month_of,
    year_month,
    year_of,
)
from revlens.functions.numeric import (
    as_double,
    davg,
    dsum,
    from_micros,
    iavg,
    micro_sum,
    micros,
    money_round,
    money_total,
    ratio,
    round_half_up,
)
from revlens.functions.text import norm_email, title_case, trim_ws

__all__ = [
    "as_double",
    "as_of_date",
    "calendar_days",
    "davg",
    "day_of",
    "dsum",
    "elapsed_days",
    "from_micros",
    "iavg",
    "micro_sum",
    "micros",
    "money_round",
    "money_total",
    "month_of",
    "norm_email",
    "ratio",
    "round_half_up",
    "title_case",
    "trim_ws",
    "year_month",
    "year_of",
]
