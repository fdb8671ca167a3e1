"""Revenue marts, percentile marts and counts (A1-A10).

All of these are hash aggregations: Spark computes a partial aggregate in each
map task and shuffles only one row per group and task, so a hot group never
moves as raw rows.  Exact percentiles come from a (group, value) histogram and
range-sliced prefix sums, so no task holds a group; ``approx=True`` switches to a
bounded-memory sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import (iso_utc, month_of, period_start, quarter_of, year_of,
                                        year_quarter)
from farelane.operators.filters import month_slice
from farelane.operators.joins import union_services
from farelane.schemas import MONEY_COLUMNS

DEFAULT_FARE_PERCENTILES = (0.97, 0.95, 0.90)

_MONEY_SUFFIX = {"fare_amount": "fare", "extra": "extra", "mta_tax": "mta_tax",
                 "tip_amount": "tip_amount", "tolls_amount": "tolls_amount",
                 "ehail_fee": "ehail_fee", "improvement_surcharge": "improvement_surcharge",
                 "total_amount": "total_amount"}


def _revenue_aggs(period: str) -> list[Column]:
    aggs = [F.sum(c).alias(f"revenue_{period}_{_MONEY_SUFFIX[c]}") for c in MONEY_COLUMNS]
    aggs += [
        F.count("tripid").alias(f"total_{period}_trips"),
        F.avg("passenger_count").cast("double").alias(f"avg_{period}_passenger_count"),
        F.avg("trip_distance").cast("double").alias(f"avg_{period}_trip_distance"),
    ]
    return aggs


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per pickup zone (by name), calendar month and service."""
    return (fact.groupBy(F.col("pickup_zone").alias("revenue_zone"),
                         period_start("pickup_datetime", "month").alias("revenue_month"),
                         F.col("service_type"))
                .agg(*_revenue_aggs("monthly")))


def quarterly_revenue_detail(fact: DataFrame) -> DataFrame:
    """Quarterly revenue mart as modelled: its keys include the per-second pickup text."""
    p = F.col("pickup_datetime")
    return (fact.groupBy(F.col("pickup_zone").alias("revenue_zone"),
                         iso_utc(p).alias("formatted_pickup_datetime"),
                         period_start(p, "quarter").alias("revenue_quarter"),
                         F.col("service_type"),
                         year_of(p).alias("year"),
                         quarter_of(p).alias("quarter"),
                         year_quarter(p).alias("year_quarter"),
                         month_of(p).alias("month"))
                .agg(*_revenue_aggs("quarterly")))


def quarterly_revenue(detail: DataFrame) -> DataFrame:
    """One row per year-quarter and service from the quarterly mart."""
    return (detail.groupBy("year_quarter", "year", "quarter", "service_type")
                  .agg(F.sum("revenue_quarterly_total_amount").alias("agg_total_amount")))


def quarterly_revenue_from_fact(fact: DataFrame) -> DataFrame:
    """Same sums straight from the fact table (skips the per-second grain)."""
    p = F.col("pickup_datetime")
    return (fact.groupBy(year_quarter(p).alias("year_quarter"), year_of(p).alias("year"),
                         quarter_of(p).alias("quarter"), F.col("service_type"))
                .agg(F.sum("total_amount").alias("agg_total_amount")))


def percentile_name(col: str, p: float) -> str:
    return f"{col}_p{round(p * 100):d}"


# How exact percentiles are computed by default:
#   "distributed" — histogram + range-sliced prefix sums; no task ever holds a
#                   whole group, however many distinct values it has;
#   "map"         — Spark's percentile straight on the rows (partial maps);
#   "approx"      — percentile_approx sketch (bounded memory, approximate).
PERCENTILE_METHOD = "distributed"


def group_percentiles(df: DataFrame, col: str, ps, keys, approx: bool = False,
                      accuracy: int = 100_000, method: str | None = None) -> DataFrame:
    """Continuous percentiles of ``col`` per group (see ``PERCENTILE_METHOD``)."""
    method = "approx" if approx else (method or PERCENTILE_METHOD)
    if method == "distributed":
        from farelane.operators.windows import distributed_percentiles
        return distributed_percentiles(df, col, ps, keys)
    approx = method == "approx"
    ps = [float(p) for p in ps]
    value = F.col(col).cast("double")
    arr = (F.percentile_approx(value, ps, accuracy) if approx else F.percentile(value, ps))
    out = df.groupBy(*keys).agg(arr.alias("_ps"))
    return out.select(*[F.col(k) if isinstance(k, str) else k for k in out.columns[:-1]],
                      *[F.col("_ps")[i].cast("double").alias(percentile_name(col, p))
                        for i, p in enumerate(ps)])


def fare_percentiles(trips: DataFrame, ps=DEFAULT_FARE_PERCENTILES, month: str | None = None,
                     approx: bool = False) -> DataFrame:
    """Fare percentiles per service, year and month (optionally one month)."""
    if month is not None:
        trips = month_slice(trips, month)
    keyed = trips.select("service_type", "fare_amount",
                         period_start("pickup_datetime", "year").alias("year"),
                         period_start("pickup_datetime", "month").alias("month"))
    return group_percentiles(keyed, "fare_amount", ps, ["service_type", "year", "month"], approx)


def trips_by_service(facts, year: int, month: int) -> DataFrame:
    """Trip count per service for one month; the facts are counted then stacked."""
    parts = [month_slice(f, f"{year:04d}-{month:02d}")
             .groupBy("service_type").agg(F.count(F.lit(1)).alias("total_records"))
             for f in facts]
    return union_services(*parts)


def trips_per_month(facts) -> DataFrame:
    """Trips per service and calendar month over all facts."""
    u = union_services(*[f.select("service_type", "pickup_datetime") for f in facts])
    return (u.groupBy("service_type", period_start("pickup_datetime", "month").alias("pickup_month"))
             .agg(F.count(F.lit(1)).alias("total_trips")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
