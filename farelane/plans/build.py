"""Build every model in dependency order, the way a warehouse build runs them.

Staging models are lazy views; core models and marts are stored as Parquet
tables under ``target`` (a shared folder).  Marts read the *stored* fact
tables, so the staging work (scan, dedup shuffle, zone joins) runs once per
fact and every mart scans only the columns it needs.  The declared data tests
run last over the stored staging copies; ``fail_on_error`` raises when a test
with severity ``error`` fails.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators import aggregates as A
from farelane.operators import quality as D
from farelane.operators import reports as R
from farelane.operators.filters import VALID_PAYMENTS, month_slice, valid_trips
from farelane.operators.joins import union_services, with_zones
from farelane.operators.staging import dim_zones, stg_fhv, stg_green, stg_yellow
from farelane.plans import models as M
from farelane.sources.sinks import store


@dataclass
class BuildParams:
    fhv_year: int | None = 2019
    year: int = 2020
    previous_year: int = 2019
    fare_month: str | None = "2020-04"
    tt_zones: list = field(default_factory=lambda: ["Newark Airport", "SoHo", "Yorkville East"])
    tt_month: str | None = "2019-11"
    payments: tuple = VALID_PAYMENTS
    payment_values: tuple = (1, 2, 3, 4, 5, 6)
    test_run: bool = False


def build_warehouse(spark: SparkSession, green_raw: DataFrame, yellow_raw: DataFrame,
                    fhv_raw: DataFrame, zone_seed: DataFrame, target: str,
                    params: BuildParams | None = None, fail_on_error: bool = False) -> dict:
    """Build all models; return {model name: DataFrame over the stored table}."""
    p = params or BuildParams()
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        out[name] = store(df, os.path.join(target, name))
        return out[name]

    # Staging (views) -------------------------------------------------------
    g = stg_green(green_raw, p.test_run)
    y = stg_yellow(yellow_raw, p.test_run)
    f = stg_fhv(fhv_raw, p.fhv_year, p.test_run)
    for name, df in (("stg_green_tripdata", g), ("stg_yellow_tripdata", y), ("stg_fhv_tripdata", f)):
        df.createOrReplaceTempView(name)

    # Core tables -----------------------------------------------------------
    zones = keep("dim_zones", dim_zones(zone_seed))
    sg = keep("stg_green_snapshot", g)
    sy = keep("stg_yellow_snapshot", y)
    unioned = union_services(sg.withColumn("service_type", F.lit("Green")),
                             sy.withColumn("service_type", F.lit("Yellow")))
    fact = keep("fact_trips", with_zones(unioned, zones).select(*M.FACT_TRIPS_COLUMNS))
    fhv_fact = keep("fact_fhv_trips", with_zones(f.withColumn("service_type", F.lit("Fhv")), zones)
                    .select(*M.FACT_FHV_COLUMNS))
    dim_fhv = keep("dim_fhv_trips", M.fhv_dimension(fhv_fact))

    # Marts -----------------------------------------------------------------
    monthly = keep("dim_monthly_zone_revenue", A.monthly_zone_revenue(fact))
    quarterly = keep("fct_taxi_trips_quarterly_revenue", A.quarterly_revenue_detail(fact))
    zoned_valid = with_zones(valid_trips(unioned, p.payments), zones)
    fares = keep("fct_taxi_trips_monthly_fare_p95", A.fare_percentiles(zoned_valid))
    if p.fare_month:
        keep("fct_taxi_trips_monthly_fare_p", month_slice(fares, p.fare_month, "month"))
    keep("fct_fhv_monthly_zone_traveltime_p90", M.traveltime_p90(dim_fhv, p.tt_zones, p.tt_month))

    # Reports ---------------------------------------------------------------
    yoy = R.yoy_growth(A.quarterly_revenue(quarterly), p.year, p.previous_year)
    keep("yoy_statement", R.yoy_statement(yoy, p.previous_year))
    keep("best_worst_quarters", R.best_worst_quarters(yoy))

    # Data tests --------------------------------------------------------------
    report = keep("data_tests", D.run_tables(D.warehouse_suite(sg, sy, f, monthly, zones, p.payment_values)))
    if fail_on_error:
        D.enforce(report)
    return out


def model_counts(models: dict) -> DataFrame:
    """(model, rows) for every stored model: one small count job per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("model"), "rows")
             for name, df in models.items()]
    return union_services(*parts)


# What stands for the content of a stored model: a sum over its numbers, and the columns whose text is hashed.
# Both are plain SQL, so that another engine can compute them over the same model.
_D = "CAST(sum({}) AS DOUBLE)".format
_STAGED = (" + ".join(map(_D, ["total_amount", "fare_amount", "tip_amount", "trip_distance", "passenger_count"])),
           "tripid, CAST(CAST(pickup_datetime AS DATE) AS {text}), payment_type_description")
MODEL_CONTENT = {
    "dim_zones": (_D("locationid"), "borough, zone, service_zone"),
    "stg_green_snapshot": _STAGED,
    "stg_yellow_snapshot": _STAGED,
    "fact_trips": (_STAGED[0], _STAGED[1] + ", service_type, pickup_zone, dropoff_zone"),
    "fact_fhv_trips": (_D("pickup_locationid + 100 * dropoff_locationid"), "dispatchid, service_type, pickup_zone, dropoff_zone"),
    "dim_fhv_trips": (_D("10 * year + quarter + month"), "formatted_pickup_datetime, formatted_dropoff_datetime, pickup_zone, dropoff_zone"),
    "dim_monthly_zone_revenue": (f"{_D('revenue_monthly_total_amount')} + {_D('total_monthly_trips')}",
                                 "revenue_zone, service_type, CAST(CAST(revenue_month AS DATE) AS {text})"),
    "fct_taxi_trips_quarterly_revenue": (f"{_D('revenue_quarterly_total_amount')} + {_D('total_quarterly_trips')}",
                                         "revenue_zone, formatted_pickup_datetime, service_type, year_quarter"),
    "fct_taxi_trips_monthly_fare_p95": (f"{_D('fare_amount_p97')} + {_D('fare_amount_p95')} + {_D('fare_amount_p90')}",
                                        "service_type, CAST(CAST(month AS DATE) AS {text})"),
    "fct_taxi_trips_monthly_fare_p": (f"{_D('fare_amount_p97')} + {_D('fare_amount_p95')} + {_D('fare_amount_p90')}",
                                      "service_type, CAST(CAST(month AS DATE) AS {text})"),
    "fct_fhv_monthly_zone_traveltime_p90": (f"{_D('trip_duration_p90')} + {_D('row_num')} + {_D('dense_rnk')}",
                                            "formatted_pickup_datetime, formatted_dropoff_datetime, pickup_zone, dropoff_zone"),
    "yoy_statement": (_D("YoY_Growth"), "year_quarter, service_type, growth_statement"),
    "best_worst_quarters": (f"{_D('best_YoY_Growth')} + {_D('worst_YoY_Growth')}", "service_type, best_quarter, worst_quarter"),
    "data_tests": (_D("failures"), '{check}, severity, status'),
}


def model_contents(models: dict) -> DataFrame:
    """(model, rows, total, text_hash) for every stored model: one aggregate per table.

    ``total`` sums the model's numbers (rounded to cents), ``text_hash`` the leading 28 bits of the MD5 of every
    row's texts, so a changed, lost or repeated row shows.
    """
    parts = []
    for name, df in models.items():
        total, texts = MODEL_CONTENT[name]
        texts = texts.format(text="STRING", check="`check`")
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"round({total}, 2)").alias("total"), F.expr(
            f"sum(CAST(conv(substr(md5(concat_ws('|', {texts})), 1, 7), 16, 10) AS BIGINT))").alias("text_hash"))
            .select(F.lit(name).alias("model"), "rows", "total", "text_hash"))
    return union_services(*parts)
