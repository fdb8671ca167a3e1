"""Readers, landing and the insert-only incremental load."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from farelane.plans import ingest as I
from farelane.sources.readers import drop_null_rows, read_trips, read_zones, read_inferred
from farelane.schemas import FHV_RAW


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


FHV_HEADER = "dispatching_base_num,pickup_datetime,dropOff_datetime,PUlocationID,DOlocationID,SR_Flag,Affiliated_base_number\n"


def test_typed_csv_ignores_extra_field_and_nulls_bad_integer(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "fhv.csv")
    _write(p, FHV_HEADER + "B1,2019-01-01 00:30:00,2019-01-01 01:00:00,1,2,,B9,EXTRA\n"
                           "B2,2019-01-01 00:40:00,2019-01-01 01:00:00,x,2,1,B9\n")
    rows = read_trips(spark, p, "fhv").orderBy("dispatching_base_num").collect()
    assert len(rows) == 2
    assert rows[0].PUlocationID == 1 and rows[0].Affiliated_base_number == "B9"
    assert rows[0].pickup_datetime == dt.datetime(2019, 1, 1, 0, 30)
    assert rows[1].PUlocationID is None and rows[1].SR_Flag == 1


def test_inferred_read_lowercases_names(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "fhv.csv")
    _write(p, FHV_HEADER + "B1,2019-01-01 00:30:00,2019-01-01 01:00:00,1,2,,B9\n")
    df = read_inferred(spark, p)
    assert df.columns[3] == "pulocationid"
    assert dict(df.dtypes)["pulocationid"] == "int"


def test_zone_dropna_drops_null_markers(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "zones.csv")
    _write(p, '"LocationID","Borough","Zone","service_zone"\n'
              '263,"Manhattan","Yorkville West","Yellow Zone"\n'
              '264,"Unknown","NV","N/A"\n'
              '265,"Unknown","NA","N/A"\n')
    z = read_zones(spark, p)
    assert z.count() == 3 and dict(z.dtypes)["locationid"] == "bigint"
    assert [r.locationid for r in drop_null_rows(z).collect()] == [263]


def _fhv(spark, rows):
    return spark.createDataFrame(
        [(b, dt.datetime(2019, 1, d, 1), dt.datetime(2019, 1, d, 2), 1, 2, None, None) for b, d in rows], FHV_RAW)


def test_insert_new_adds_only_unseen_keys(spark):
    target = I.stamp_rows(_fhv(spark, [("a", 1), ("b", 2)]), "fhv", "t.csv")
    source = I.stamp_rows(_fhv(spark, [("b", 2), ("c", 3), ("c", 3)]), "fhv", "s.csv")
    new = I.insert_new(target, source).collect()
    assert sorted(r.dispatching_base_num for r in new) == ["c", "c"]


def test_merge_into_path_is_idempotent(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "target")
    I.merge_into(spark, target, I.stamp_rows(_fhv(spark, [("a", 1), ("b", 2)]), "fhv", "m1.csv"), "fhv")
    src = I.stamp_rows(_fhv(spark, [("b", 2), ("c", 3), ("c", 3)]), "fhv", "m2.csv")
    I.merge_into(spark, target, src, "fhv")
    I.merge_into(spark, target, src, "fhv")  # replay
    got = sorted(r.dispatching_base_num for r in I.read_target(spark, target, "fhv").collect())
    assert got == ["a", "b", "c", "c"]


def test_first_load_rows_matches_month_by_month_merges(spark):
    rows = [("a", 1, "f1"), ("a", 1, "f2"), ("b", 2, "f2"), ("b", 2, "f2")]
    df = spark.createDataFrame(
        [(k, dt.datetime(2019, 1, d), f) for k, d, f in rows], "unique_row_id string, t timestamp_ntz, filename string")
    got = sorted((r.unique_row_id, r.filename) for r in I.first_load_rows(df).collect())
    assert got == [("a", "f1"), ("b", "f2"), ("b", "f2")]


def test_stream_ingest_replay_adds_nothing(spark, tmpdir_path):
    from farelane.sources.landing import land_monthly_csv
    from farelane.streaming.ingest_stream import ingest_stream
    raw = _fhv(spark, [("a", 1), ("b", 2), ("b", 2)])
    landing = land_monthly_csv(raw, "fhv", os.path.join(tmpdir_path, "landing"))
    target = os.path.join(tmpdir_path, "target")
    ingest_stream(spark, "fhv", landing, target, os.path.join(tmpdir_path, "ck1"))
    first = I.read_target(spark, target, "fhv").count()
    ingest_stream(spark, "fhv", landing, target, os.path.join(tmpdir_path, "ck2"))
    t = I.read_target(spark, target, "fhv")
    assert first == 3 and t.count() == 3
    assert {r.filename for r in t.select("filename").collect()} == {"fhv_tripdata_2019-01.csv"}


def test_missing_periods(spark):
    df = spark.createDataFrame([("green", dt.datetime(2019, m, 1)) for m in range(1, 13) if m != 5]
                               + [("yellow", dt.datetime(2019, m, 1)) for m in range(1, 13)],
                               "service string, pickup_datetime timestamp_ntz")
    got = [tuple(r) for r in I.missing_periods(df, ["green", "yellow"]).collect()]
    assert got == [("green", 2019, 5)]


def test_load_audit(spark):
    df = spark.createDataFrame([("f1",), ("f1",), ("f2",)], "filename string")
    assert sorted(tuple(r) for r in I.load_audit(df).collect()) == [("f1", 2), ("f2", 1)]


def test_drop_null_rows_drops_nan_and_tokens(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, 2.0, "NA"), (4, None, "c")],
                               "id int, x double, s string")
    assert [r.id for r in drop_null_rows(df).collect()] == [1]
    assert sorted(r.id for r in drop_null_rows(df, null_tokens=[]).collect()) == [1, 3]


def test_stream_ingest_keeps_rows_repeated_inside_a_month(spark, tmpdir_path):
    from farelane.sources.landing import land_monthly_csv
    from farelane.streaming.ingest_stream import ingest_stream
    raw = spark.createDataFrame(
        [(b, dt.datetime(2019, m, 1, 1), dt.datetime(2019, m, 1, 2), 1, 2, None, None)
         for b, m in [("a", 1), ("b", 2), ("c", 3), ("c", 3)]], FHV_RAW)
    landing = land_monthly_csv(raw.repartition(3), "fhv", os.path.join(tmpdir_path, "landing"))
    target = os.path.join(tmpdir_path, "target")
    ingest_stream(spark, "fhv", landing, target, os.path.join(tmpdir_path, "ck"))
    t = I.read_target(spark, target, "fhv")
    assert sorted(r.dispatching_base_num for r in t.collect()) == ["a", "b", "c", "c"]
    assert sorted({r.filename for r in t.collect()}) == [
        "fhv_tripdata_2019-01.csv", "fhv_tripdata_2019-02.csv", "fhv_tripdata_2019-03.csv"]


def test_replay_with_a_null_pickup_adds_nothing(spark, tmpdir_path):
    raw = spark.createDataFrame([("a", None, None, 1, 2, None, None),
                                 ("b", dt.datetime(2019, 1, 1, 1), None, 1, 2, None, None)], FHV_RAW)
    target = os.path.join(tmpdir_path, "null-target")
    for _ in range(3):
        I.merge_into(spark, target, I.stamp_rows(raw, "fhv", "fhv_tripdata_2019-01.csv"), "fhv")
    assert sorted(r.dispatching_base_num for r in I.read_target(spark, target, "fhv").collect()) == ["a", "b"]


def test_ingest_month_stamps_and_merges_one_file(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "fhv_tripdata_2019-01.csv")
    _write(p, FHV_HEADER + "B1,2019-01-01 00:30:00,2019-01-01 01:00:00,1,2,,B9\n")
    target = os.path.join(tmpdir_path, "month-target")
    I.ingest_month(spark, "fhv", p, target)
    I.ingest_month(spark, "fhv", p, target)
    rows = I.read_target(spark, target, "fhv").collect()
    assert [r.filename for r in rows] == ["fhv_tripdata_2019-01.csv"]


def test_expected_years_without_data_are_missing(spark):
    present = spark.createDataFrame([("fhv", dt.datetime(2020, m, 1)) for m in range(1, 13)],
                                    "service string, pickup_datetime timestamp_ntz")
    assert I.missing_periods(present, ["fhv"]).count() == 0
    gone = I.missing_periods(present, ["fhv"], years=[2019, 2020]).collect()
    assert sorted((r.year, r.month) for r in gone) == [(2019, m) for m in range(1, 13)]


def test_growth_keeps_parts_of_a_cent(spark):
    from farelane.operators.reports import yoy_growth
    q = spark.createDataFrame([("2020/Q1", 2020, 1, "Green", Decimal("0.004")), ("2019/Q1", 2019, 1, "Green", Decimal("0.002"))],
                              "year_quarter string, year int, quarter int, service_type string, agg_total_amount decimal(38,9)")
    row = yoy_growth(q).first()
    assert (row.revenue_2020, row.revenue_2019, row.YoY_Growth) == (0.004, 0.002, 100.0)


def test_fractions_are_rounded_before_the_integer_cast(spark):
    from farelane.operators.staging import whole
    df = spark.createDataFrame([(2.5, Decimal("1.5"), "3")], "x double, d decimal(4,1), s string")
    assert tuple(df.select(whole(df, "x"), whole(df, "d"), whole(df, "s")).first()) == (3, 2, 3)


def test_unset_shared_folder_is_an_error_on_a_cluster():
    import pytest
    from farelane.session import ensure_checkpoint_dir

    class Stub:
        master = "spark://host:7077"
        sparkContext = conf = property(lambda self: self)

        def getCheckpointDir(self):
            return None

        def get(self, *_):
            return None
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Stub())


def test_models_over_a_target_read_only_the_dates_of_their_year(spark, tmpdir_path):
    from farelane.operators.staging import stg_fhv
    raw = spark.createDataFrame([(b, dt.datetime(y, 5, 1, 1), None, 1, 2, None, None)
                                 for b, y in [("a", 2018), ("b", 2019), ("c", 2020)]], FHV_RAW)
    target = os.path.join(tmpdir_path, "year-target")
    I.merge_into(spark, target, I.stamp_rows(raw, "fhv", "x.csv"), "fhv")
    staged = stg_fhv(I.target_trips(spark, target, "fhv"), 2019)
    assert [r.dispatchid for r in staged.collect()] == ["b"]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
