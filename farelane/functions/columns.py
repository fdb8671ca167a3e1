"""Scalar building blocks as Column expressions (all JVM-side, no UDFs).

Each helper returns a ``Column`` so Catalyst can fold, push down and
code-generate it together with the surrounding plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "SURROGATE_NULL_TOKEN", "PAYMENT_DESCRIPTIONS", "ISO_UTC_PATTERN",
    "surrogate_key", "row_hash", "row_key", "safe_cast", "strict_cast",
    "payment_description", "payment_default", "period_start", "year_of",
    "quarter_of", "month_of", "iso_utc", "trip_seconds", "year_quarter",
    "service_zone_label", "pct_growth", "round2", "number_text",
    "growth_statement",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the modelled project's output.
#   * null placeholder of the surrogate-key macro package
#   * payment code descriptions, codes 1 to 6, anything else 'EMPTY'
#   * ISO timestamp text with a literal +00:00 offset
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
PAYMENT_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_ELSE = "EMPTY"
ISO_UTC_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """MD5 hex of the columns as text joined by '-', nulls as a placeholder."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def row_hash(*cols, sep: str = "") -> Column:
    """MD5 hex of the columns as text, nulls as '' and no separator by default.

    With ``sep=""`` different rows can give the same text ("1"+"12" vs
    "11"+"2"); pass a separator to avoid that when compatibility is not needed.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def row_key(*cols, sep: str = "") -> Column:
    """Binary 16-byte content key (``unhex`` of :func:`row_hash`)."""
    return F.unhex(row_hash(*cols, sep=sep))


def safe_cast(c, dtype: str = "bigint", round_fraction: bool = False) -> Column:
    """Cast that yields null for a value that does not convert.

    ``round_fraction`` rounds a fractional number half away from zero before an
    integer cast (Spark alone would truncate 2.5 to 2).
    """
    c = _col(c)
    if round_fraction:
        c = F.round(c)
    return c.try_cast(dtype)


def strict_cast(c, dtype: str) -> Column:
    """Cast that fails the job on a bad value (ANSI mode)."""
    return _col(c).cast(dtype)


def payment_description(c) -> Column:
    """Payment code → text; unknown or null codes → 'EMPTY'."""
    code = _col(c).try_cast("int")
    expr = None
    for k, label in PAYMENT_DESCRIPTIONS.items():
        expr = (F.when(code == k, F.lit(label)) if expr is None
                else expr.when(code == k, F.lit(label)))
    return expr.otherwise(F.lit(PAYMENT_ELSE))


def payment_default(c, default: int = 0) -> Column:
    return F.coalesce(_col(c), F.lit(default))


_TRUNC_UNITS = {"year": "year", "quarter": "quarter", "month": "month"}


def period_start(c, unit: str) -> Column:
    """Start of the year/quarter/month as TIMESTAMP_NTZ (zone independent)."""
    return F.trunc(_col(c), _TRUNC_UNITS[unit]).cast("timestamp_ntz")


def year_of(c) -> Column:
    return F.year(_col(c)).cast("bigint")


def quarter_of(c) -> Column:
    return F.quarter(_col(c)).cast("bigint")


def month_of(c) -> Column:
    return F.month(_col(c)).cast("bigint")


def iso_utc(c) -> Column:
    return F.date_format(_col(c), ISO_UTC_PATTERN)


def trip_seconds(start, end) -> Column:
    """Whole seconds from start to end, truncated toward zero; may be negative."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def year_quarter(c) -> Column:
    return F.concat(year_of(c).cast("string"), F.lit("/Q"), quarter_of(c).cast("string"))


def service_zone_label(c) -> Column:
    return F.replace(_col(c), F.lit("Boro"), F.lit("Green"))


def pct_growth(current, previous) -> Column:
    """(current - previous) / previous * 100 as a double; null when previous is 0."""
    cur = _col(current).cast("double")
    prev = _col(previous).cast("double")
    return F.try_divide(cur - prev, prev) * F.lit(100.0)


def round2(c) -> Column:
    return F.round(_col(c).cast("double"), 2)


def number_text(c) -> Column:
    """Shortest text of a double, without a trailing '.0' (-70.6, -56)."""
    return F.regexp_replace(_col(c).cast("double").cast("string"), r"\.0$", "")


def growth_statement(year_quarter_col, service_type, growth, quarter, previous_year) -> Column:
    """'In 2020/Q1, Green Taxi had -12.34% revenue growth compared to 2019/Q1'."""
    g = _col(growth)
    rounded = number_text(round2(g))
    prev = F.concat(F.lit(f"{previous_year}/Q"), _col(quarter).cast("string"))
    head = F.concat(F.lit("In "), _col(year_quarter_col), F.lit(", "), _col(service_type), F.lit(" Taxi had "))
    tail = F.concat(F.lit("% revenue growth compared to "), prev)
    return (F.when(g >= 0, F.concat(head, F.lit("+"), rounded, tail))
             .otherwise(F.concat(head, rounded, tail)))
