"""Staging models: rename, cast, de-duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions.columns import (payment_default, payment_description, safe_cast,
                                        service_zone_label, surrogate_key)
from farelane.operators.filters import in_year
from farelane.schemas import NUMERIC, STAGING_COLUMNS


def total_order(df: DataFrame, exclude=()) -> list[Column]:
    """Ascending, nulls-first order over every column: a total order on rows."""
    return [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in exclude]


def dedup(df: DataFrame, keys, order=None) -> DataFrame:
    """Keep the first row per key by ``order`` (default: all other columns).

    ``row_number() == 1`` is planned as a WindowGroupLimit both before and after
    the shuffle, so a hot key is cut to one row per map task before it moves.
    """
    keys = list(keys)
    order = order if order is not None else total_order(df, exclude=keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


def sample_if_test(df: DataFrame, test_run: bool = False, n: int = 100, order_by=None) -> DataFrame:
    """Development sample of ``n`` rows; ``order_by`` makes it repeatable.

    With an order this is a top-k (TakeOrderedAndProject), not a full sort.
    """
    if not test_run:
        return df
    if order_by is not None:
        order_by = order_by if isinstance(order_by, (list, tuple)) else [order_by]
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)


def whole(raw: DataFrame, name: str) -> Column:
    """Safe integer cast; a fractional number is rounded half away from zero first."""
    kind = raw.schema[name].dataType
    return safe_cast(name, round_fraction=isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)))


def _taxi_staging(raw: DataFrame, pickup: str, dropoff: str, trip_type: Column,
                  ehail: Column) -> DataFrame:
    kept = dedup(raw.where(F.col("VendorID").isNotNull()), ["VendorID", pickup])
    return kept.select(
        surrogate_key("VendorID", pickup).alias("tripid"),
        whole(raw, "VendorID").alias("vendorid"),
        whole(raw, "RatecodeID").alias("ratecodeid"),
        whole(raw, "PULocationID").alias("pickup_locationid"),
        whole(raw, "DOLocationID").alias("dropoff_locationid"),
        F.col(pickup).cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(dropoff).cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col("store_and_fwd_flag"),
        whole(raw, "passenger_count").alias("passenger_count"),
        F.col("trip_distance").cast(NUMERIC).alias("trip_distance"),
        trip_type.alias("trip_type"),
        F.col("fare_amount").cast(NUMERIC).alias("fare_amount"),
        F.col("extra").cast(NUMERIC).alias("extra"),
        F.col("mta_tax").cast(NUMERIC).alias("mta_tax"),
        F.col("tip_amount").cast(NUMERIC).alias("tip_amount"),
        F.col("tolls_amount").cast(NUMERIC).alias("tolls_amount"),
        ehail.alias("ehail_fee"),
        F.col("improvement_surcharge").cast(NUMERIC).alias("improvement_surcharge"),
        F.col("total_amount").cast(NUMERIC).alias("total_amount"),
        payment_default(whole(raw, "payment_type")).alias("payment_type"),
        payment_description("payment_type").alias("payment_type_description"),
    ).select(*STAGING_COLUMNS)


def stg_green(raw: DataFrame, test_run: bool = False) -> DataFrame:
    """Green staging: non-null vendor, one row per (vendor, pickup), typed."""
    df = _taxi_staging(raw, "lpep_pickup_datetime", "lpep_dropoff_datetime",
                       whole(raw, "trip_type"), F.col("ehail_fee").cast(NUMERIC))
    return sample_if_test(df, test_run, order_by="tripid")


def stg_yellow(raw: DataFrame, test_run: bool = False) -> DataFrame:
    """Yellow staging: same layout; street-hail trip type 1 and no e-hail fee."""
    df = _taxi_staging(raw, "tpep_pickup_datetime", "tpep_dropoff_datetime",
                       F.lit(1).cast("bigint"), F.lit(0).cast(NUMERIC))
    return sample_if_test(df, test_run, order_by="tripid")


def stg_fhv(raw: DataFrame, year: int | None = 2019, test_run: bool = False) -> DataFrame:
    """FHV staging: typed projection of one pickup year, no de-duplication."""
    df = raw
    if year is not None:
        df = df.where(in_year("pickup_datetime", year))
        if "pickup_date" in raw.columns:  # an ingested target: prune its partitions too
            df = df.where(F.col("pickup_date").between(F.make_date(F.lit(year), F.lit(1), F.lit(1)),
                                                       F.make_date(F.lit(year), F.lit(12), F.lit(31))))
    out = df.select(
        F.col("dispatching_base_num").cast("string").alias("dispatchid"),
        whole(raw, "PUlocationID").alias("pickup_locationid"),
        whole(raw, "DOlocationID").alias("dropoff_locationid"),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropOff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        whole(raw, "SR_Flag").alias("sr_flag"),
    )
    return sample_if_test(out, test_run, order_by=[F.col(c).asc_nulls_first() for c in out.columns])


def stg_fhv_dedup(raw: DataFrame, test_run: bool = False) -> DataFrame:
    """FHV staging variant: surrogate key, affiliated base, one row per (base, pickup)."""
    kept = dedup(raw, ["dispatching_base_num", "pickup_datetime"])
    out = kept.select(
        surrogate_key("dispatching_base_num", "pickup_datetime").alias("fhvtripid"),
        F.col("dispatching_base_num").cast("string").alias("dispatchid"),
        F.col("Affiliated_base_number").cast("string").alias("affliationid"),
        whole(raw, "PUlocationID").alias("pickup_locationid"),
        whole(raw, "DOlocationID").alias("dropoff_locationid"),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropOff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        whole(raw, "SR_Flag").alias("sr_flag"),
    )
    return sample_if_test(out, test_run, order_by="fhvtripid")


def stg_green_initial(raw: DataFrame) -> DataFrame:
    """Early green staging: surrogate key, raw columns, payment text; no casts."""
    return raw.select(
        surrogate_key("VendorID", "lpep_pickup_datetime").alias("trip_id"),
        F.col("VendorID").alias("vendorid"),
        "lpep_pickup_datetime", "lpep_dropoff_datetime", "store_and_fwd_flag",
        F.col("RatecodeID").alias("ratecodeid"),
        F.col("PULocationID").alias("pulocationid"),
        F.col("DOLocationID").alias("dolocationid"),
        "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
        "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
        "total_amount", "payment_type",
        payment_description("payment_type").alias("payment_type_desc"),
        "trip_type", "congestion_surcharge",
    )


def dim_zones(seed: DataFrame) -> DataFrame:
    """Zone dimension: service zone 'Boro …' relabelled 'Green …'."""
    return seed.select("locationid", "borough", "zone",
                       service_zone_label("service_zone").alias("service_zone"))


def with_service(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("service_type", F.lit(name))


__all__ = ["dedup", "total_order", "sample_if_test", "stg_green", "stg_yellow", "stg_fhv",
           "stg_fhv_dedup", "stg_green_initial", "dim_zones", "with_service"]
