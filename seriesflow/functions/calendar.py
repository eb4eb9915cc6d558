"""Calendar features (F1-F9) as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesflow.functions.numeric import col_

# Cycle lengths of the seasonal encodings (month 12, quarter 4,
# day of week 7, day of year always 365) and the year-progress divisor 365.0.
MONTH_CYCLE = 12
QUARTER_CYCLE = 4
DOW_CYCLE = 7
DOY_CYCLE = 365
YEAR_DAYS = 365.0

CALENDAR_COLUMNS = [
    "month", "month_sin", "month_cos",
    "quarter", "quarter_sin", "quarter_cos",
    "day_of_week", "dow_sin", "dow_cos",
    "day_of_year", "doy_sin", "doy_cos",
    "year_progress", "is_weekend",
]


def _cyc(x: Column, n: int, fn) -> Column:
    return fn(F.lit(2 * math.pi) * x / F.lit(n))


def day_of_week(d) -> Column:
    """Monday = 0 ... Sunday = 6 (Spark ``dayofweek`` is Sunday = 1, so use ``weekday``)."""
    return F.weekday(col_(d))


def calendar_exprs(d, only: list[str] | None = None) -> dict[str, Column]:
    """All calendar columns for date column ``d``."""
    d = col_(d)
    m, q, w, y = F.month(d), F.quarter(d), day_of_week(d), F.dayofyear(d)
    out = {
        "month": m,
        "month_sin": _cyc(m, MONTH_CYCLE, F.sin),
        "month_cos": _cyc(m, MONTH_CYCLE, F.cos),
        "quarter": q,
        "quarter_sin": _cyc(q, QUARTER_CYCLE, F.sin),
        "quarter_cos": _cyc(q, QUARTER_CYCLE, F.cos),
        "day_of_week": w,
        "dow_sin": _cyc(w, DOW_CYCLE, F.sin),
        "dow_cos": _cyc(w, DOW_CYCLE, F.cos),
        "day_of_year": y,
        "doy_sin": _cyc(y, DOY_CYCLE, F.sin),
        "doy_cos": _cyc(y, DOY_CYCLE, F.cos),
        "year_progress": y / F.lit(YEAR_DAYS),
        "is_weekend": (w >= 5).cast("int"),
    }
    if only is not None:
        out = {k: v for k, v in out.items() if k in only}
    return out


def add_calendar(df, date_col: str = "d", only: list[str] | None = None):
    """(re-)stamp calendar columns from ``date_col`` in one projection."""
    return df.withColumns(calendar_exprs(date_col, only))


def horizon_dates(start, n_days: int) -> Column:
    """``array<date>`` of ``n_days`` dates starting at ``start``."""
    if n_days <= 0:
        raise ValueError("horizon must be a positive number of days")
    s = col_(start)
    return F.sequence(s, F.date_add(s, n_days - 1))


def format_day(d) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(col_(d), "yyyy-MM-dd")


def format_ts(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col_(ts), "yyyy-MM-dd HH:mm:ss")


def parse_day(s, fmt: str = "yyyy-MM-dd") -> Column:
    """A3: parse a date string; a malformed value becomes NULL instead of failing."""
    return F.to_date(F.try_to_timestamp(col_(s), F.lit(fmt)))
