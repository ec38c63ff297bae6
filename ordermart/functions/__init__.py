"""Column expressions: exact money arithmetic, calendar, text."""

from .calendar import (as_of_date, days_since, hour_of, is_weekend, local_load_time,
                       meal_period, month_label, now_ts)
from .money import avg_int, avg_money, half_up_ratio, pct, sum_money, units, units_to_double
from .text import normalise_city

__all__ = [
    "as_of_date", "avg_int", "avg_money", "days_since", "half_up_ratio", "hour_of",
    "is_weekend", "local_load_time", "meal_period", "month_label", "normalise_city",
    "now_ts", "pct", "sum_money", "units", "units_to_double",
]
