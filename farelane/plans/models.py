"""End-to-end models (M1-M12): compositions of the operators.

Every function takes DataFrames (raw trips, zone seed) and returns a lazy
DataFrame; Catalyst sees the whole chain at once, so filters reach the scans
and unused columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import iso_utc, month_of, quarter_of, trip_seconds, year_of
from farelane.operators import aggregates as A
from farelane.operators import reports as R
from farelane.operators.filters import not_null, valid_trips, VALID_PAYMENTS, zone_month_slice
from farelane.operators.joins import union_services, with_zones
from farelane.operators.staging import (dim_zones, stg_fhv, stg_fhv_dedup, stg_green, stg_yellow,
                                        with_service)
from farelane.operators.windows import ordered_ranks, with_group_percentiles
from farelane.schemas import FACT_FHV_COLUMNS, FACT_TRIPS_COLUMNS


def trips_unioned(green_raw: DataFrame, yellow_raw: DataFrame, test_run: bool = False) -> DataFrame:
    g = with_service(stg_green(green_raw, test_run), "Green")
    y = with_service(stg_yellow(yellow_raw, test_run), "Yellow")
    return union_services(g, y)


def fact_trips(green_raw: DataFrame, yellow_raw: DataFrame, zone_seed: DataFrame,
               test_run: bool = False) -> DataFrame:
    """Green ∪ yellow staging joined to known pickup and dropoff zones."""
    u = trips_unioned(green_raw, yellow_raw, test_run)
    return with_zones(u, dim_zones(zone_seed)).select(*FACT_TRIPS_COLUMNS)


def fact_fhv_trips(fhv_raw: DataFrame, zone_seed: DataFrame, year: int | None = 2019,
                   service_name: str = "Fhv", test_run: bool = False) -> DataFrame:
    """FHV staging joined to zones; null dispatch ids are kept."""
    s = with_service(stg_fhv(fhv_raw, year, test_run), service_name)
    return with_zones(s, dim_zones(zone_seed)).select(*FACT_FHV_COLUMNS)


def fact_fhv_trips_dedup(fhv_raw: DataFrame, zone_seed: DataFrame, test_run: bool = False) -> DataFrame:
    """Draft FHV fact over the de-duplicated staging variant (no service tag)."""
    s = stg_fhv_dedup(fhv_raw, test_run)
    return with_zones(s, dim_zones(zone_seed)).select(
        "fhvtripid", "dispatchid", "affliationid", "pickup_datetime", "pickup_locationid",
        "pickup_borough", "pickup_zone", "dropoff_datetime", "dropoff_locationid",
        "dropoff_borough", "dropoff_zone", "sr_flag")


DIM_FHV_COLUMNS = [
    "dispatchid", "service_type", "pickup_datetime", "formatted_pickup_datetime", "year",
    "quarter", "month", "pickup_locationid", "pickup_borough", "pickup_zone", "dropoff_datetime",
    "formatted_dropoff_datetime", "dropoff_locationid", "dropoff_borough", "dropoff_zone", "sr_flag",
]


def dim_fhv_trips(fhv_raw: DataFrame, zone_seed: DataFrame, year: int | None = 2019,
                  test_run: bool = False) -> DataFrame:
    """FHV trips with a dispatch id, zones, calendar parts and ISO text.

    The calendar year is the positive pickup year (the stated intent).
    """
    return fhv_dimension(fact_fhv_trips(fhv_raw, zone_seed, year, "Fhv", test_run))


def fhv_dimension(fact: DataFrame) -> DataFrame:
    """The same from FHV trips that have their zones already."""
    z = not_null(fact, "dispatchid")
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return z.select(
        "dispatchid", "service_type", "pickup_datetime",
        iso_utc(p).alias("formatted_pickup_datetime"),
        year_of(p).alias("year"), quarter_of(p).alias("quarter"), month_of(p).alias("month"),
        "pickup_locationid", "pickup_borough", "pickup_zone", "dropoff_datetime",
        iso_utc(d).alias("formatted_dropoff_datetime"),
        "dropoff_locationid", "dropoff_borough", "dropoff_zone", "sr_flag").select(*DIM_FHV_COLUMNS)


def zoned_valid_trips(green_raw, yellow_raw, zone_seed, payments=VALID_PAYMENTS,
                      test_run: bool = False) -> DataFrame:
    """Valid green/yellow trips joined to known zones (input of the fare marts)."""
    u = valid_trips(trips_unioned(green_raw, yellow_raw, test_run), payments)
    return with_zones(u, dim_zones(zone_seed))


def fare_percentiles_monthly(green_raw, yellow_raw, zone_seed, ps=A.DEFAULT_FARE_PERCENTILES,
                             month: str | None = None, payments=VALID_PAYMENTS,
                             approx: bool = False) -> DataFrame:
    """P97/P95/P90 of fare per service and month (one month if ``month`` given)."""
    z = zoned_valid_trips(green_raw, yellow_raw, zone_seed, payments)
    return A.fare_percentiles(z, ps, month=month, approx=approx)


def fare_percentile_rows(green_raw, yellow_raw, zone_seed, ps=A.DEFAULT_FARE_PERCENTILES,
                         payments=VALID_PAYMENTS) -> DataFrame:
    """Row-level percentile columns (the window form), one row per trip."""
    z = zoned_valid_trips(green_raw, yellow_raw, zone_seed, payments).select(
        "service_type", "pickup_datetime", "dropoff_datetime",
        iso_utc("pickup_datetime").alias("formatted_pickup_datetime"),
        iso_utc("dropoff_datetime").alias("formatted_dropoff_datetime"),
        A.period_start("pickup_datetime", "year").alias("year"),
        A.period_start("pickup_datetime", "month").alias("month"), "fare_amount")
    return with_group_percentiles(z, "fare_amount", ps, ["service_type", "year", "month"])


def fhv_durations(dim_fhv: DataFrame) -> DataFrame:
    return dim_fhv.withColumn("trip_duration", trip_seconds("pickup_datetime", "dropoff_datetime"))


def traveltime_p90_rows(dim_fhv: DataFrame, zones=None, month: str | None = None) -> DataFrame:
    """P90 trip duration per (year, month, pickup id, dropoff id) on every trip.

    The zone/month slice is applied *before* the percentile: the month is part
    of the percentile key and the zone name depends only on the pickup id, so
    filtering first drops whole groups and never changes a kept group.
    """
    t = fhv_durations(dim_fhv).select(
        "pickup_datetime", "formatted_pickup_datetime", "formatted_dropoff_datetime",
        "dropoff_datetime", A.period_start("pickup_datetime", "year").alias("year"),
        A.period_start("pickup_datetime", "month").alias("month"),
        "pickup_locationid", "pickup_zone", "dropoff_locationid", "dropoff_zone", "trip_duration")
    if month is not None or zones is not None:
        t = zone_month_slice(t, zones, month) if month is not None else t.where(
            F.col("pickup_zone").isin(list(zones)))
    out = with_group_percentiles(t, "trip_duration", [0.90],
                                 ["year", "month", "pickup_locationid", "dropoff_locationid"])
    return out


TRAVELTIME_COLUMNS = ["pickup_datetime", "formatted_pickup_datetime", "formatted_dropoff_datetime",
                      "pickup_zone", "dropoff_zone", "year", "month", "row_num", "dense_rnk",
                      "trip_duration_p90"]

# Order of trips inside a pickup zone: P90 descending, then the group keys and
# trip times so ties are broken the same way every run.
def traveltime_order():
    return [F.col("trip_duration_p90").desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in ("year", "month", "pickup_locationid",
                                             "dropoff_locationid", "pickup_datetime",
                                             "dropoff_datetime")]


def traveltime_p90(dim_fhv: DataFrame, zones=None, month: str | None = None,
                   with_row_num: bool = True) -> DataFrame:
    """Trips ranked per pickup zone by the P90 of their zone pair and month."""
    rows = traveltime_p90_rows(dim_fhv, zones, month)
    ranked = ordered_ranks(rows, ["pickup_zone"], traveltime_order(), "row_num" if with_row_num else None,
                           "dense_rnk", "trip_duration_p90")
    return ranked.select(*[c for c in TRAVELTIME_COLUMNS if with_row_num or c != "row_num"])


def yoy_report(fact: DataFrame, year: int = 2020, previous_year: int = 2019,
               from_detail: bool = False) -> DataFrame:
    q = (A.quarterly_revenue(A.quarterly_revenue_detail(fact)) if from_detail
         else A.quarterly_revenue_from_fact(fact))
    return R.yoy_statement(R.yoy_growth(q, year, previous_year), previous_year)


def best_worst_report(fact: DataFrame, year: int = 2020, previous_year: int = 2019) -> DataFrame:
    q = A.quarterly_revenue_from_fact(fact)
    return R.best_worst_quarters(R.yoy_growth(q, year, previous_year))


def fare_percentiles_report(monthly: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of the monthly percentile mart for one year and month."""
    cols = [c for c in monthly.columns if c.startswith("fare_amount_p")]
    return (monthly.where((year_of("year") == year) & (month_of("month") == month))
                   .select("service_type", *cols))
