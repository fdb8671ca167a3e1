"""Data tests as operators that return failing rows.

The single checks return failing rows: ``unique`` and ``accepted_values`` are
partial/final hash aggregates, ``relationships`` is a left-anti join against
the parent keys.  ``run_tables`` counts the failures of a whole suite with at
most two scans per table: one aggregate over the rows, one group-by per
unique key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Keys that occur more than once (nulls are not tested)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-null child values with no matching parent key."""
    keys = parent.select(F.col(parent_col).alias("_parent_key")).distinct()
    values = child.where(F.col(col).isNotNull()).select(F.col(col).alias("from_field"))
    return values.join(keys, values["from_field"] == keys["_parent_key"], "left_anti")


def check_accepted(df: DataFrame, col: str, values) -> DataFrame:
    """Values outside the accepted list, with their row counts (nulls pass)."""
    return (df.groupBy(F.col(col).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("value_field").isNotNull() & ~F.col("value_field").isin(list(values))))


@dataclass
class CheckSpec:
    name: str
    failing: DataFrame          # failing-rows DataFrame of one check
    severity: str = "error"     # 'warn' reports, 'error' fails the run
    meta: dict = field(default_factory=dict)


def run_checks(specs: list[CheckSpec]) -> DataFrame:
    """One row per check: (check, failures, severity, status)."""
    rows = []
    for s in specs:
        if s.severity not in ("warn", "error"):
            raise ValueError(f"severity must be warn or error, not {s.severity!r}")
        n = s.failing.agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        rows.append(n.select(
            F.lit(s.name).alias("check"), F.col("failures"), F.lit(s.severity).alias("severity"),
            F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit(s.severity)).alias("status")))
    return reduce(lambda a, b: a.unionByName(b), rows)


class DataTestError(RuntimeError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Raise if any check with severity 'error' failed; return the report.

    The report holds one row per check, so collecting it is bounded.
    """
    bad = report.where(F.col("status") == "error").select("check", "failures").collect()
    if bad:
        raise DataTestError("failed checks: " + ", ".join(f"{r.check} ({r.failures})" for r in bad))
    return report


@dataclass
class TableTests:
    """The tests declared on one table: each entry is a column, what it needs, and the severity."""
    name: str
    df: DataFrame
    unique: list = field(default_factory=list)          # (column, severity)
    not_null: list = field(default_factory=list)        # (column, severity)
    relationships: list = field(default_factory=list)   # (column, parent, parent column, severity)
    accepted: list = field(default_factory=list)        # (column, values, severity)


def _judged(check, failures, severity):
    status = F.when(failures == 0, F.lit("pass")).otherwise(severity)
    return [check.alias("check"), failures.alias("failures"), severity.alias("severity"), status.alias("status")]


def run_table(t: TableTests) -> list[DataFrame]:
    """(check, failures, severity, status) of one table's tests, as one or two parts."""
    df, counts, labels = t.df, [], []

    def add(col, kind, severity, failures):
        if severity not in ("warn", "error"):
            raise ValueError(f"severity must be warn or error, not {severity!r}")
        labels.append((f"{t.name}.{col}.{kind}", severity))
        counts.append(failures.cast("bigint").alias(f"_n{len(counts)}"))

    for col, severity in t.not_null:
        add(col, "not_null", severity, F.count_if(F.col(col).isNull()))
    for i, (col, parent, parent_col, severity) in enumerate(t.relationships):
        keys = parent.select(F.col(parent_col).alias(f"_key{i}")).distinct()
        df = df.join(keys, df[col] == F.col(f"_key{i}"), "left")
        add(col, "relationships", severity, F.count_if(F.col(col).isNotNull() & F.col(f"_key{i}").isNull()))
    for col, values, severity in t.accepted:  # as many failures as there are values outside the list
        add(col, "accepted_values", severity,
            F.count_distinct(F.when(~F.col(col).isin(list(values)), F.col(col))))
    parts = []
    if counts:
        rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"_n{i}").alias("failures"), F.lit(s).alias("severity"))
                         for i, (n, s) in enumerate(labels)])
        one = df.agg(*counts).select(F.explode(rows).alias("r"))
        parts.append(one.select(*_judged(F.col("r.check"), F.col("r.failures"), F.col("r.severity"))))
    for col, severity in t.unique:
        n = check_unique(t.df, col).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        parts.append(n.select(*_judged(F.lit(f"{t.name}.{col}.unique"), F.col("failures"), F.lit(severity))))
    return parts


def run_tables(suite: list[TableTests]) -> DataFrame:
    """One row per declared test of every table in ``suite``."""
    return reduce(DataFrame.unionByName, [part for t in suite for part in run_table(t)])


def warehouse_suite(stg_green_df: DataFrame, stg_yellow_df: DataFrame, stg_fhv_df: DataFrame,
                    monthly_revenue: DataFrame, zone_seed: DataFrame,
                    payment_values=(1, 2, 3, 4, 5, 6)) -> list[TableTests]:
    """The declared data tests with their severities.

    Taxi staging: tripid unique and not null, pickup and dropoff zone ids present in the seed, payment
    type in the accepted codes.  FHV staging: both zone ids.  Monthly mart: the revenue is not null.  All
    are warnings but the green dropoff relationship, which keeps the default severity (error).
    """
    def zones(dropoff="warn"):
        return [("pickup_locationid", zone_seed, "locationid", "warn"),
                ("dropoff_locationid", zone_seed, "locationid", dropoff)]

    def taxi(name, df, dropoff):
        return TableTests(name, df, unique=[("tripid", "warn")], not_null=[("tripid", "warn")],
                          relationships=zones(dropoff), accepted=[("payment_type", payment_values, "warn")])
    return [taxi("stg_green", stg_green_df, "error"), taxi("stg_yellow", stg_yellow_df, "warn"),
            TableTests("stg_fhv", stg_fhv_df, relationships=zones()),
            TableTests("dim_monthly_zone_revenue", monthly_revenue,
                       not_null=[("revenue_monthly_total_amount", "warn")])]
