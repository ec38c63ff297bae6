"""Date and time expressions (all built-in, JVM-side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_weekend(date_col: Column | str) -> Column:
    """True on Saturday/Sunday; NULL date gives False (CASE falls to ELSE)."""
    return F.when(F.dayofweek(_c(date_col)).isin(*rules.WEEKEND_DAYS), F.lit(True)) \
        .otherwise(F.lit(False))


def month_label(date_col: Column | str) -> Column:
    """``yyyy-MM`` label of a date."""
    return F.date_format(_c(date_col), rules.MONTH_FORMAT)


def hour_of(ts_col: Column | str) -> Column:
    return F.hour(_c(ts_col))


def as_of_date(as_of: dt.date | str | None) -> Column:
    """Reference date for recency: a literal when given, else ``current_date()``."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def days_since(as_of: dt.date | str | None, date_col: Column | str) -> Column:
    return F.datediff(as_of_date(as_of), _c(date_col))


def now_ts(now: dt.datetime | str | None) -> Column:
    """Current instant; injectable for reproducible runs."""
    if now is None:
        return F.current_timestamp()
    return F.lit(str(now)).cast("timestamp")


def local_load_time(now: dt.datetime | str | None = None) -> Column:
    """UTC instant shifted to the load-time zone's wall clock."""
    return F.from_utc_timestamp(now_ts(now), rules.LOAD_TIME_ZONE)


def meal_period(ts_col: Column | str) -> Column:
    h = hour_of(ts_col)
    expr = None
    for lo, hi, label in rules.MEAL_PERIODS:
        cond = (h >= lo) & (h <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rules.MEAL_OTHERWISE))
