"""Row filters and slices."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import month_of, period_start, year_of

# Payment descriptions kept by the fare-percentile models, as written there.
# 'Credit Card' (capital C) never matches the 'Credit card' the payment text
# helper emits, so by default only cash trips pass; callers may pass their own.
VALID_PAYMENTS = ("Cash", "Credit Card")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(_c(col).isNotNull())


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    elif isinstance(value, str) and len(value) == 10:
        value = value + " 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def month_bounds(month: str) -> tuple[str, str]:
    """'2020-04' → ('2020-04-01 00:00:00', '2020-05-01 00:00:00')."""
    y, m = (int(p) for p in month.split("-")[:2])
    ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
    return f"{y:04d}-{m:02d}-01 00:00:00", f"{ny:04d}-{nm:02d}-01 00:00:00"


def in_year(c, year: int) -> Column:
    """``extract(year) = y`` as a half-open range, so partition pruning applies."""
    return (_c(c) >= _ts(f"{year:04d}-01-01")) & (_c(c) < _ts(f"{year + 1:04d}-01-01"))


def year_filter(df: DataFrame, col: str, year: int) -> DataFrame:
    return df.where(in_year(col, year))


def known_zones(zones: DataFrame) -> DataFrame:
    """Zones with a known borough (a null borough is dropped as well)."""
    return zones.where(F.col("borough") != "Unknown")


def valid_trips(df: DataFrame, payments=VALID_PAYMENTS) -> DataFrame:
    return df.where((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)
                    & F.col("payment_type_description").isin(list(payments)))


def month_slice(df: DataFrame, month: str, col: str = "pickup_datetime") -> DataFrame:
    """Rows whose ``col`` falls in the month 'YYYY-MM' (half-open range)."""
    lo, hi = month_bounds(month)
    return df.where((_c(col) >= _ts(lo)) & (_c(col) < _ts(hi)))


def zone_month_slice(df: DataFrame, zones, month: str, zone_col: str = "pickup_zone",
                     col: str = "pickup_datetime") -> DataFrame:
    """Zone ``IN`` list plus year and month equality on the truncated pickup."""
    y, m = (int(p) for p in month.split("-")[:2])
    out = month_slice(df, month, col)
    if zones is not None:
        out = out.where(_c(zone_col).isin(list(zones)))
    return out.where((period_start(col, "year") == _ts(f"{y:04d}-01-01"))
                     & (period_start(col, "month") == _ts(f"{y:04d}-{m:02d}-01")))


def between_dates(df: DataFrame, lo, hi, col: str = "pickup_datetime") -> DataFrame:
    """``BETWEEN lo AND hi`` on a timestamp; a date upper bound means midnight."""
    return df.where(_c(col).between(_ts(lo), _ts(hi)))


def recent_trips(df: DataFrame, days_back: int | None = None, as_of=None,
                 col: str = "pickup_datetime", env_var: str = "DAYS_BACK",
                 default_days: int = 30) -> DataFrame:
    """Trips within ``days_back`` days of ``as_of``.

    The window comes from the argument, else the environment variable, else 30.
    ``as_of`` defaults to the current date; pass it for repeatable results.
    """
    import os
    n = days_back if days_back is not None else int(os.environ.get(env_var, default_days))
    ref = F.current_date() if as_of is None else _ts(as_of).cast("date")
    return df.where(_c(col) >= F.date_sub(ref, n).cast("timestamp_ntz"))


def year_month_equals(df: DataFrame, year: int, month: int, year_col: str, month_col: str) -> DataFrame:
    """``extract(year from a) = y and extract(month from b) = m``."""
    return df.where((year_of(year_col) == year) & (month_of(month_col) == month))
