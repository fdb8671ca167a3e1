"""The scalar helpers as catalog functions, for use from SQL text.

``register_functions(spark)`` defines them for the session; with ``schema`` they are stored in the catalog for
every session.  Each body is a SQL expression that Catalyst inlines, so a call costs what the Column form costs.
Text arguments that may be null go in as one array, e.g. ``trip_key(array(a, CAST(b AS STRING)))``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from farelane.functions.columns import (ISO_UTC_PATTERN, PAYMENT_DESCRIPTIONS, PAYMENT_ELSE,
                                        SURROGATE_NULL_TOKEN)


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bodies() -> dict[str, tuple[str, str, str]]:
    """name → (arguments, result type, expression)."""
    payments = " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in PAYMENT_DESCRIPTIONS.items())
    return {
        "trip_key": ("parts ARRAY<STRING>", "STRING", f"md5(array_join(parts, '-', {_text(SURROGATE_NULL_TOKEN)}))"),
        "safe_bigint": ("v STRING", "BIGINT", "try_cast(v AS BIGINT)"),
        "safe_whole": ("v DECIMAL(38,9)", "BIGINT", "try_cast(round(v) AS BIGINT)"),
        "payment_description": ("code STRING", "STRING",
                                f"CASE try_cast(code AS INT) {payments} ELSE {_text(PAYMENT_ELSE)} END"),
        "month_start": ("at TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "CAST(trunc(at, 'month') AS TIMESTAMP_NTZ)"),
        "iso_utc": ("at TIMESTAMP_NTZ", "STRING", f"date_format(at, {_text(ISO_UTC_PATTERN)})"),
        "trip_seconds": ("started TIMESTAMP_NTZ, ended TIMESTAMP_NTZ", "BIGINT", "timestampdiff(SECOND, started, ended)"),
        "year_quarter": ("at TIMESTAMP_NTZ", "STRING", "concat(CAST(year(at) AS STRING), '/Q', CAST(quarter(at) AS STRING))"),
    }


def register_functions(spark: SparkSession, schema: str | None = None) -> list[str]:
    """Create or replace the functions, for the session or in ``schema``; returns the names to call them by."""
    names = []
    for name, (args, result, body) in _bodies().items():
        full = name if schema is None else f"{schema}.{name}"
        kind = "TEMPORARY FUNCTION" if schema is None else "FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {full}({args}) RETURNS {result} RETURN {body}")
        names.append(full)
    return names
