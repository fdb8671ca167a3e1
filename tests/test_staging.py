"""Staging, filters and joins on hand-made rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from farelane.operators import filters as Fl
from farelane.operators.joins import with_zones, join_pickup_zone
from farelane.operators.staging import dedup, dim_zones, sample_if_test, stg_green, stg_yellow
from farelane.plans import models as M
from farelane.schemas import GREEN_RAW, YELLOW_RAW, FHV_RAW, ZONE_SEED

T0 = dt.datetime(2019, 1, 1, 10, 0, 0)
D = Decimal


def green_row(vendor, pickup=T0, pu="1", do="1", fare="10.00", dist="1.00", pay=1, tip="0.00"):
    return (vendor, pickup, pickup + dt.timedelta(minutes=10), "N", "1", pu, do, 1, D(dist), D(fare),
            D("0"), D("0.5"), D(tip), D("0"), None, D("0.3"), D(fare), pay, "1", D("0"))


def zones(spark):
    rows = [(1, "EWR", "Newark Airport", "EWR"), (2, "Queens", "Jamaica Bay", "Boro Zone"),
            (264, "Unknown", "NV", "N/A"), (265, "Unknown", "NA", "N/A"), (7, None, "Nowhere", "Boro Zone")]
    return spark.createDataFrame(rows, ZONE_SEED)


def test_dedup_keeps_first_by_declared_order_and_drops_null_vendor(spark):
    raw = spark.createDataFrame([green_row("1", tip="2.00"), green_row("1", tip="1.00"),
                                 green_row(None)], GREEN_RAW)
    out = stg_green(raw).collect()
    assert len(out) == 1
    assert out[0].vendorid == 1 and out[0].tip_amount == D("1.000000000")
    assert out[0].payment_type_description == "Credit card"


def test_dedup_generic_order(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (2, 5)], "k int, v int")
    got = sorted(tuple(r) for r in dedup(df, ["k"], [F.col("v").desc()]).collect())
    assert got == [(1, 3), (2, 5)]


def test_yellow_constants(spark):
    row = ("2", T0, T0, 1, D("1.2"), "1", "N", "1", "2", None, D("5"), D("0"), D("0.5"), D("0"),
           D("0"), D("0.3"), D("5.8"), D("2.5"))
    out = stg_yellow(spark.createDataFrame([row], YELLOW_RAW)).first()
    assert out.trip_type == 1 and out.ehail_fee == D("0E-9")
    assert out.payment_type == 0 and out.payment_type_description == "EMPTY"


def test_valid_trips_case_quirk(spark):
    df = spark.createDataFrame(
        [("Cash", 1.0, 1.0), ("Credit card", 1.0, 1.0), ("Credit Card", 1.0, 1.0),
         ("Cash", 0.0, 1.0), ("Cash", 1.0, 0.0)],
        "payment_type_description string, fare_amount double, trip_distance double")
    kept = [r[0] for r in Fl.valid_trips(df).collect()]
    assert kept == ["Cash", "Credit Card"]
    assert len(Fl.valid_trips(df, ("Cash", "Credit card")).collect()) == 2


def test_zone_joins_drop_unknown_null_and_missing(spark):
    trips = spark.createDataFrame([(1, 1), (264, 1), (265, 1), (None, 1), (999, 1), (7, 1), (2, 2)],
                                  "pickup_locationid bigint, dropoff_locationid bigint")
    z = dim_zones(zones(spark))
    both = with_zones(trips, z).collect()
    assert sorted((r.pickup_locationid, r.dropoff_locationid) for r in both) == [(1, 1), (2, 2)]
    assert {r.pickup_zone for r in both} == {"Newark Airport", "Jamaica Bay"}
    one = join_pickup_zone(trips, z).collect()
    assert sorted(r.pickup_locationid for r in one) == [1, 2]
    assert z.where("locationid = 2").first().service_zone == "Green Zone"


def test_between_loses_last_day_after_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 7, 31, 0, 0),), (dt.datetime(2019, 7, 31, 10, 0),)],
                               "pickup_datetime timestamp_ntz")
    kept = Fl.between_dates(df, "2019-07-01", "2019-07-31").collect()
    assert [r[0] for r in kept] == [dt.datetime(2019, 7, 31, 0, 0)]


def test_recent_trips_argument_env_default(spark, monkeypatch):
    base = dt.datetime(2020, 1, 31)
    df = spark.createDataFrame([(base - dt.timedelta(days=d),) for d in (0, 5, 20, 40)],
                               "pickup_datetime timestamp_ntz")
    assert Fl.recent_trips(df, 10, as_of="2020-01-31").count() == 2
    monkeypatch.setenv("DAYS_BACK", "25")
    assert Fl.recent_trips(df, as_of="2020-01-31").count() == 3
    monkeypatch.delenv("DAYS_BACK")
    assert Fl.recent_trips(df, as_of="2020-01-31").count() == 3


def test_month_slice_and_year_filter(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 3, 31, 23, 59),), (dt.datetime(2020, 4, 1),),
                                (dt.datetime(2020, 4, 30, 23, 59),), (dt.datetime(2020, 5, 1),)],
                               "pickup_datetime timestamp_ntz")
    assert Fl.month_slice(df, "2020-04").count() == 2
    assert Fl.year_filter(df, "pickup_datetime", 2020).count() == 4
    assert Fl.year_filter(df, "pickup_datetime", 2019).count() == 0


def test_dim_fhv_year_is_positive_and_null_dispatch_dropped(spark):
    raw = spark.createDataFrame(
        [("B1", dt.datetime(2019, 3, 5, 8), dt.datetime(2019, 3, 5, 9), 1, 2, None, None),
         (None, dt.datetime(2019, 3, 5, 8), dt.datetime(2019, 3, 5, 9), 1, 2, None, None),
         ("B1", dt.datetime(2018, 3, 5, 8), dt.datetime(2018, 3, 5, 9), 1, 2, None, None)], FHV_RAW)
    out = M.dim_fhv_trips(raw, zones(spark), 2019).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.year, r.quarter, r.month) == (2019, 1, 3)
    assert r.formatted_pickup_datetime == "2019-03-05T08:00:00+00:00"
    assert M.fact_fhv_trips(raw, zones(spark), 2019).count() == 2


def test_sample_if_test(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    assert sample_if_test(df, False).count() == 500
    got = [r.k for r in sample_if_test(df, True, 100, order_by="k").collect()]
    assert got == list(range(100))
