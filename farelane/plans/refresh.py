"""Monthly marts kept up to date: only the months that a load touched are computed again.

The state is one row per pickup zone, month and service with sums and counts, from which any longer period merges;
averages are divided at the end.  It is stored by ``revenue_month``.  De-duplication in staging is per vendor and pickup
time, so a month's facts depend on that month's trips alone: a refresh reads the targets' pickup dates of the
touched months only (partition pruning) and overwrites these months' folders, no others.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.columns import period_start, quarter_of, year_of, year_quarter
from farelane.operators.aggregates import _MONEY_SUFFIX
from farelane.plans.ingest import BATCH, PARTITION, read_index, target_trips
from farelane.plans.keyindex import NO_DATE
from farelane.plans.models import fact_trips
from farelane.schemas import MONEY_COLUMNS

MONTH = "revenue_month"
NO_MONTH = datetime.date.fromisoformat(NO_DATE)
_MEANS = ["passenger_count", "trip_distance"]


def month_state(fact: DataFrame) -> DataFrame:
    """Mergeable sums and counts per pickup zone, month and service."""
    aggs = [F.sum(c).alias(f"sum_{c}") for c in MONEY_COLUMNS + _MEANS]
    aggs += [F.count(c).alias(f"n_{c}") for c in _MEANS] + [F.count("tripid").alias("trips")]
    month = F.trunc("pickup_datetime", "month").alias(MONTH)
    return fact.groupBy(F.col("pickup_zone").alias("revenue_zone"), F.col("service_type"), month).agg(*aggs)


def _means(period: str) -> list[Column]:
    return [F.try_divide(F.sum(f"sum_{c}").cast("double"), F.sum(f"n_{c}").cast("double")).alias(f"avg_{period}_{c}") for c in _MEANS]


def monthly_zone_revenue(state: DataFrame) -> DataFrame:
    """The monthly mart, from the state alone."""
    sums = [F.sum(f"sum_{c}").alias(f"revenue_monthly_{_MONEY_SUFFIX[c]}") for c in MONEY_COLUMNS]
    return (state.groupBy("revenue_zone", F.col(MONTH).cast("timestamp_ntz").alias(MONTH), "service_type")
            .agg(*sums, F.sum("trips").alias("total_monthly_trips"), *_means("monthly")))


def quarterly_revenue(state: DataFrame) -> DataFrame:
    """Revenue per quarter and service, merged from the months."""
    m = F.col(MONTH)
    return (state.groupBy(year_quarter(m).alias("year_quarter"), year_of(m).alias("year"), quarter_of(m).alias("quarter"), "service_type")
            .agg(F.sum("sum_total_amount").alias("agg_total_amount")))


def yearly_zone_revenue(state: DataFrame) -> DataFrame:
    """Revenue, trips and averages per zone, year and service, merged from the months."""
    sums = [F.sum(f"sum_{c}").alias(f"revenue_yearly_{_MONEY_SUFFIX[c]}") for c in MONEY_COLUMNS]
    return (state.groupBy("revenue_zone", period_start(F.col(MONTH), "year").alias("revenue_year"), "service_type")
            .agg(*sums, F.sum("trips").alias("total_yearly_trips"), *_means("yearly")))


def touched_months(spark: SparkSession, targets: dict[str, str], loads: list[str] | None = None) -> list:
    """First days of the months that some loads added trips to (None: months of every load); bounded by the calendar.

    The key index knows the dates of every load, so no trip is read.
    """
    found = set()
    for path in targets.values():
        index = read_index(spark, path)
        if loads is not None:
            index = index.where(F.col(BATCH).isin(loads))
        found |= {None if r[0] == NO_MONTH else r[0] for r in index.select(F.trunc("index_date", "month")).distinct().collect()}
    return sorted(found, key=lambda d: (d is not None, d))


def _in_months(trips: DataFrame, months: list) -> DataFrame:
    """Trips of some months, as a filter on the partition column."""
    cond = F.lit(False)
    for m in (m for m in months if m is not None):
        first = F.lit(m)
        cond = cond | ((F.col(PARTITION) >= first) & (F.col(PARTITION) < F.add_months(first, 1)))
    if None in months:
        cond = cond | F.col(PARTITION).isNull()
    return trips.where(cond).drop(PARTITION)


def refresh_months(spark: SparkSession, targets: dict[str, str], zones: DataFrame, state_path: str, months: list) -> None:
    """Compute the state of ``months`` from the green and yellow targets and replace just their folders."""
    if not months:
        return
    green, yellow = (_in_months(target_trips(spark, targets[s], s), months) for s in ("green", "yellow"))
    state = month_state(fact_trips(green, yellow, zones))
    (state.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(MONTH).parquet(state_path))


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    kinds = [f"sum_{c} decimal(38,9)" for c in MONEY_COLUMNS] + ["sum_passenger_count long", "sum_trip_distance decimal(38,9)"]
    kinds += [f"n_{c} long" for c in _MEANS] + ["trips long"]
    return spark.read.schema(f"revenue_zone string, service_type string, {', '.join(kinds)}, {MONTH} date").parquet(state_path)
