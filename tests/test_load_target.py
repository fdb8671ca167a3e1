"""Key index, commit, checked and aligned loads, and the refresh of touched months."""

import datetime as dt
import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from farelane.operators import aggregates as A
from farelane.plans import ingest as I
from farelane.plans import models as M
from farelane.plans import refresh as R
from farelane.plans.keyindex import build_filters, possible_keys
from farelane.schemas import FHV_FLOW, FHV_RAW, GREEN_RAW, YELLOW_RAW
from farelane.sources import checked as C
from farelane.sources.checked import read_checked, split_rejects


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text.encode()
    with open(path, "wb") as f:
        f.write(gzip.compress(data) if path.endswith(".gz") else data)


def _fhv(spark, rows):
    """Rows (base, day); a day of None has no pickup time."""
    return spark.createDataFrame([(b, d and dt.datetime(2019, 1, d, 1), None, 1, 2, None, None) for b, d in rows], FHV_RAW)


def _stamped(spark, rows, name="m.csv"):
    return I.stamp_rows(_fhv(spark, rows), "fhv", name)


def _bases(spark, target):
    return sorted(r.dispatching_base_num for r in I.read_target(spark, target, "fhv").collect())


# ------------------------------------------------------------------ key index
def test_index_finds_every_key_and_few_others(spark):
    date = "CASE WHEN id % 3 = 0 THEN date'2020-01-01' WHEN id % 50 = 1 THEN null ELSE date_add(date'2020-02-01', CAST(id % 20 AS int)) END"
    keys = lambda lo, hi: spark.range(lo, hi).select(F.expr(date).alias("d"), F.unhex(F.md5(F.col("id").cast("string"))).alias("k"))
    filters = build_filters(keys(0, 30000), "d", "k").withColumn("load", F.lit("a")).unionByName(
        build_filters(keys(30000, 31000), "d", "k").withColumn("load", F.lit("b")))
    assert filters.where("index_date = date'2020-01-01' AND load = 'a'").count() > 1  # the large date has several bitmaps
    held = possible_keys(keys(0, 31000), filters, "d", "k", "load")
    assert held.count() == 31000 and held.where("d IS NULL").count() == keys(0, 31000).where("d IS NULL").count()
    assert possible_keys(keys(100000, 130000), filters, "d", "k", "load").count() < 600  # 2 %
    assert possible_keys(keys(0, 0), filters, "d", "k", "load").count() == 0
    # A known key under another date is another matter.
    moved = keys(0, 1000).withColumn("d", F.lit("1999-01-01").cast("date"))
    assert possible_keys(moved, filters, "d", "k", "load").count() == 0


def test_target_is_read_only_on_the_dates_of_possible_keys(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "target")
    I.merge_into(spark, target, _stamped(spark, [("a", 1), ("b", 2), ("c", 3), ("n", None)]), "fhv")

    def plan(rows):
        batch = I.with_partition(_stamped(spark, rows), "fhv")
        return I.unknown_rows(spark, target, batch, batch, "fhv", os.path.join(tmpdir_path, f"hits{len(rows)}"))
    fresh = plan([("x", 1), ("y", 2)])
    assert target not in "".join(fresh.inputFiles()) and fresh.count() == 2
    overlap = plan([("x", 1), ("b", 2), ("n", None)])
    text = overlap._jdf.queryExecution().executedPlan().toString()
    assert "2019-01-02" in text and "2019-01-01" not in text and "2019-01-03" not in text
    assert [r.dispatching_base_num for r in overlap.collect()] == ["x"]


# ------------------------------------------------------------------ commit
def test_load_that_dies_midway_is_not_seen_and_its_replay_is_whole(spark, tmpdir_path, monkeypatch):
    target = os.path.join(tmpdir_path, "target")
    I.merge_into(spark, target, _stamped(spark, [("a", 1)]), "fhv", batch_id="one")
    batch = _stamped(spark, [("a", 1), ("b", 2), ("b", 2), ("c", 3)])
    real = I.files.mark

    def dies(s, path):
        if "_commits" in path:
            raise RuntimeError("driver lost")
        real(s, path)
    monkeypatch.setattr(I.files, "mark", dies)
    with pytest.raises(RuntimeError):
        I.merge_into(spark, target, batch, "fhv", batch_id="two")
    monkeypatch.undo()
    # A date that only the dead attempt wrote must not survive either.
    extra = os.path.join(target, "batch_id=two", "pickup_date=2019-01-09")
    _stamped(spark, [("ghost", 9)]).write.parquet(extra)
    assert I.pending_loads(spark, target) == ["two"] and _bases(spark, target) == ["a"]
    I.merge_into(spark, target, batch, "fhv", batch_id="two")
    assert _bases(spark, target) == ["a", "b", "b", "c"] and I.pending_loads(spark, target) == []
    I.merge_into(spark, target, _stamped(spark, [("late", 5)]), "fhv", batch_id="two")  # committed: done once
    assert _bases(spark, target) == ["a", "b", "b", "c"]


def test_load_with_a_failing_task_leaves_nothing_behind(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "target")
    bad = _stamped(spark, [("a", 1), ("b", 2)]).withColumn("dispatching_base_num", F.when(
        F.col("dispatching_base_num") == "b", F.raise_error(F.lit("torn"))).otherwise(F.col("dispatching_base_num")))
    with pytest.raises(Exception, match="torn"):
        I.merge_into(spark, target, bad, "fhv", batch_id="x")
    I.merge_into(spark, target, _stamped(spark, [("a", 1), ("b", 2)]), "fhv", batch_id="x")
    assert _bases(spark, target) == ["a", "b"]


def test_stream_batch_is_named_after_its_query(spark, tmpdir_path):
    from farelane.sources.landing import land_monthly_csv
    from farelane.streaming.ingest_stream import ingest_stream
    landing = land_monthly_csv(_fhv(spark, [("a", 1)]), "fhv", os.path.join(tmpdir_path, "landing"))
    target, ckpt = (os.path.join(tmpdir_path, n) for n in ("target", "ckpt"))
    ingest_stream(spark, "fhv", landing, target, ckpt)
    import json
    with open(os.path.join(ckpt, "metadata")) as f:
        assert f"{json.load(f)['id']}-0" in I.files.names(spark, f"{target}/_commits")


def test_large_dates_are_written_in_parts(spark):
    rows = I.with_partition(_stamped(spark, [(f"b{i}", 1 + (i % 10 == 0)) for i in range(400)]), "fhv")
    parts = I.dealt_by_date(rows, file_rows=50).groupBy(F.spark_partition_id(), I.PARTITION).count()
    assert parts.where("pickup_date = date'2019-01-01'").count() > 2
    assert I.dealt_by_date(rows).groupBy(F.spark_partition_id(), I.PARTITION).count().count() == 2


# ------------------------------------------------------------------ checked, aligned
HEADER = "dispatching_base_num,pickup_datetime,dropOff_datetime,PUlocationID,DOlocationID,SR_Flag,Affiliated_base_number\n"


@pytest.fixture
def landed(tmpdir_path):
    root = os.path.join(tmpdir_path, "in")
    _write(f"{root}/fhv_tripdata_2019-01.csv", HEADER + "B1,2019-01-01 00:30:00,2019-01-01 01:00:00,1,2,,B9,EXTRA\n"
           "B2,2019-01-01 00:40:00,2019-01-01 01:00:00,x,2,1.5,B9\nB3,soon,,3.0,4,1,\nB4,2019-01-02 00:00:00\n")
    _write(f"{root}/fhv_tripdata_2019-02.csv.gz", 'sr_flag,"DOLocationID",PULocationID,note,Pickup_Datetime,dispatching_base_num\n'
           '1,5,6,"a, b",2019-02-03 00:00:00,B5\n,,,,,B6\n')
    _write(f"{root}/fhv_tripdata_2019-03.csv", HEADER)
    return root


def test_layouts_are_aligned_and_bad_fields_named(spark, landed):
    rows = {r.dispatching_base_num: r for r in read_checked(spark, f"{landed}/*", "fhv").collect()}
    assert set(rows) == {"B1", "B2", "B3", "B4", "B5", "B6"}
    assert {b: r.bad_fields for b, r in rows.items()} == {
        "B1": [], "B2": ["PUlocationID", "SR_Flag"], "B3": ["pickup_datetime"], "B4": [C.SHORT], "B5": [], "B6": []}
    assert rows["B3"].PUlocationID == 3 and rows["B1"].Affiliated_base_number == "B9"
    b5 = rows["B5"]
    assert (b5.PUlocationID, b5.DOlocationID, b5.SR_Flag, b5.dropOff_datetime, b5.filename) == (6, 5, 1, None, "fhv_tripdata_2019-02.csv.gz")
    assert b5.pickup_datetime == dt.datetime(2019, 2, 3)
    flow = {r.dispatching_base_num: r for r in read_checked(spark, f"{landed}/*", "fhv", FHV_FLOW).collect()}
    assert flow["B2"].PUlocationID == "x" and flow["B2"].bad_fields == [] and flow["B3"].PUlocationID == "3.0"
    good, rejects = split_rejects(read_checked(spark, f"{landed}/*", "fhv"))
    assert good.count() == 3 and {(r.filename, r.record.split(",")[0]) for r in rejects.collect()} == {
        ("fhv_tripdata_2019-01.csv", b) for b in ("B2", "B3", "B4")}
    with pytest.raises(FileNotFoundError):
        read_checked(spark, f"{landed}/none*", "fhv")


def test_months_load_into_a_described_table_with_audit_and_rejects(spark, landed, tmpdir_path):
    target = os.path.join(tmpdir_path, "target")
    table = f"fhv_{os.path.basename(tmpdir_path).replace('-', '_')}".lower()
    first = I.load_months(spark, "fhv", ["2019-01"], landed, target, table=table, batch_id="jan")
    assert [tuple(r) for r in first.drop("batch_id").collect()] == [("fhv_tripdata_2019-01.csv", 4, 1, 3, 4)]
    both = I.load_months(spark, "fhv", ["2019-01", "2019-02", "2019-03"], landed, target, table=table)  # backfill over a replayed month
    assert sorted((r.filename, r.rows_read, r.rows_rejected) for r in both.collect()) == [
        ("fhv_tripdata_2019-01.csv", 4, 3), ("fhv_tripdata_2019-02.csv.gz", 2, 0)]
    I.load_months(spark, "fhv", ["2019-01"], landed, target, table=table, batch_id="jan")  # the same load again
    assert _bases(spark, target) == ["B1", "B5", "B6"]
    assert sorted(r.dispatching_base_num for r in spark.table(table).collect()) == ["B1", "B5", "B6"]
    notes = {c.name: c.description for c in spark.catalog.listColumns(table)}
    assert notes["unique_row_id"].startswith("Hash") and notes["pickup_datetime"] == "Pickup time"
    assert {(r.batch_id == "jan", r.record.split(",")[0]) for r in I.read_rejects(spark, target).collect()} == {
        (x, b) for x in (True, False) for b in ("B2", "B3", "B4")}
    spark.sql(f"DROP TABLE {table}")


# ------------------------------------------------------------------ refresh
def _taxi(spark, schema, rows):
    def value(f, r):
        return {"VendorID": str(r[0]), "PULocationID": "1", "DOLocationID": "2", "payment_type": 1, "passenger_count": r[0]}.get(
            f.name, r[1] if "pickup" in f.name else r[1] if "dropoff" in f.name else r[2] if f.name in ("total_amount", "trip_distance") else None)
    return spark.createDataFrame([tuple(value(f, r) for f in schema.fields) for r in rows], schema)


def test_refresh_rewrites_touched_months_only_and_equals_a_full_build(spark, tmpdir_path):
    from decimal import Decimal
    day = lambda m, d: dt.datetime(2019, m, d, 8)
    zones = spark.createDataFrame([(1, "Queens", "Z1", "Boro Zone"), (2, "Bronx", "Z2", "Boro Zone")],
                                  "locationid long, borough string, zone string, service_zone string")
    targets = {s: os.path.join(tmpdir_path, s) for s in ("green", "yellow")}
    schemas, state = {"green": GREEN_RAW, "yellow": YELLOW_RAW}, os.path.join(tmpdir_path, "state")

    def load(service, rows):
        df = _taxi(spark, schemas[service], [(v, t, Decimal(a)) for v, t, a in rows])
        return I.merge_into(spark, targets[service], I.stamp_rows(df, service, "f.csv"), service)

    def stored(path):
        return {d: sorted((f, os.path.getmtime(os.path.join(path, d, f))) for f in os.listdir(os.path.join(path, d)))
                for d in os.listdir(path) if d.startswith("revenue_month=")}
    load("green", [(1, day(m, d), "1.25") for m in (1, 2, 3) for d in (1, 2)])
    load("yellow", [(2, day(m, 5), "4.10") for m in (1, 2)])
    R.refresh_months(spark, targets, zones, state, R.touched_months(spark, targets))
    before = stored(state)
    assert sorted(before) == [f"revenue_month=2019-0{m}-01" for m in (1, 2, 3)]
    # A later load: more of February (one trip that staging drops as a copy), and a new month.
    loads = [load("yellow", [(3, day(2, 9), "7.00"), (3, day(4, 9), "9.00")]), load("green", [(1, day(2, 1), "99.00")])]
    months = R.touched_months(spark, targets, loads)
    assert months == [dt.date(2019, 2, 1), dt.date(2019, 4, 1)]
    R.refresh_months(spark, targets, zones, state, months)
    after = stored(state)
    assert {d for d in after if after[d] != before.get(d)} == {"revenue_month=2019-02-01", "revenue_month=2019-04-01"}

    fact = M.fact_trips(*[I.target_trips(spark, targets[s], s).drop("pickup_date") for s in ("green", "yellow")], zones)
    got, want = R.read_state(spark, state), fact
    key = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
    assert key(R.monthly_zone_revenue(got)) == key(A.monthly_zone_revenue(want))
    assert key(R.quarterly_revenue(got)) == key(A.quarterly_revenue_from_fact(want))
    assert sum(r.total_yearly_trips for r in R.yearly_zone_revenue(got).collect()) == fact.count()
    R.refresh_months(spark, targets, zones, state, [])  # nothing touched, nothing done
    assert stored(state) == after


# ------------------------------------------------------------------ file names
def test_folder_name_takes_linear_time_in_the_path(spark):
    deep = "file:///" + "x" * 30000
    cases = [("file:///t/_file=green_tripdata_1996-01.csv/part-0.csv", "green_tripdata_1996-01.csv"), ("file:///t/a=b=c.csv/p.csv", "c.csv"),
             ("s3://b/plain/p.csv", "plain"), ("file:///t/x=/p.csv", ""), ("/p.csv", ""), (f"{deep}/_file=m.csv.gz/p.csv", "m.csv.gz")]
    began = time.time()
    rows = spark.createDataFrame(cases * 20, "path string, want string").select(C.folder_name(F.col("path")).alias("got"), "want").collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert time.time() - began < 15  # a pattern tried at every character takes minutes


def test_whole_rows_move_once_in_a_merge(spark, tmpdir_path, monkeypatch):
    target, kept = os.path.join(tmpdir_path, "target"), []
    real = I.files.remove
    monkeypatch.setattr(I.files, "remove", lambda s, path: kept.append(path) if "/merge-" in path else real(s, path))
    early = _stamped(spark, [("a", 1), ("b", 2), ("b", 2), ("n", None)], "1.csv")
    I.merge_into(spark, target, early.unionByName(_stamped(spark, [("b", 2), ("c", 3)], "2.csv")), "fhv")
    assert _bases(spark, target) == ["a", "b", "b", "c", "n"]
    late = _stamped(spark, [("a", 1), ("d", 1), ("d", 1), ("n", None), ("e", None)], "3.csv")
    for _ in range(2):  # the second adds nothing
        I.merge_into(spark, target, late, "fhv")
        assert _bases(spark, target) == ["a", "b", "b", "c", "d", "d", "e", "n"]
    assert len(kept) == 3
    for work in kept:  # beside the stored batch, only what decides about a row is stored
        assert spark.read.parquet(f"{work}/new").columns == [I.KEY, I.PARTITION, "filename"]
        real(spark, work)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_move_once_to_their_dates_and_keys_are_aggregated_by_hashing(spark):
    rows = I.with_partition(_stamped(spark, [("a", 1), ("b", 2)], "1.csv").unionByName(_stamped(spark, [("b", 2)], "2.csv")), "fhv")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # tables too large for a broadcast by size
        assert "SortMergeJoin" not in _plan(I.dealt_by_date(rows))
        assert "SortAggregate" not in _plan(I.repeated_keys(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [(r._first, r._k) for r in I.repeated_keys(rows).collect()] == [
        ("1.csv", r[0]) for r in rows.where("dispatching_base_num = 'b'").select(I.KEY).distinct().collect()]


def test_bitmaps_are_sorted_by_one_number_and_keep_their_dates(spark):
    dates = "CASE id % 4 WHEN 0 THEN date'1900-02-28' WHEN 1 THEN date'1970-01-01' WHEN 2 THEN null ELSE date'2400-12-31' END"
    rows = spark.range(40000).select(F.expr(dates).alias("d"), F.unhex(F.md5(F.col("id").cast("string"))).alias("k"))
    filters = build_filters(rows, "d", "k")
    assert "[slot" in _plan(filters).split("SortAggregate(")[1]
    got = {str(r.index_date): (r.bitmaps, r.n) for r in filters.groupBy("index_date", "bitmaps").agg(
        F.count_distinct("bitmap").alias("n")).collect()}
    assert got == {d: (5, 5) for d in ("1900-02-28", "1970-01-01", "0001-01-01", "2400-12-31")}
    held = possible_keys(rows, filters.withColumn("load", F.lit("a")), "d", "k", "load")
    assert held.exceptAll(rows).count() == 0 and held.count() == 40000


def test_a_load_without_known_or_repeated_keys_stores_no_decision(spark, tmpdir_path, monkeypatch):
    kept = []
    monkeypatch.setattr(I.files, "remove", lambda s, path: kept.append(path) if "/merge-" in path else None)
    target = os.path.join(tmpdir_path, "target")
    I.merge_into(spark, target, _stamped(spark, [("a", 1), ("a", 1), ("n", None)]), "fhv", batch_id="one")
    assert _bases(spark, target) == ["a", "a", "n"]
    assert "new" not in os.listdir(kept[0].removeprefix("file:"))


def test_months_are_stored_once_with_the_records_of_rejected_rows_alone(spark, landed, tmpdir_path, monkeypatch):
    kept, real = {}, I.files.remove

    def keeps(s, path):
        kind = next((k for k in ("merge", "load") if f"/{k}-" in path), None)
        real(s, path) if kind is None else kept.update({kind: path})
    monkeypatch.setattr(I.files, "remove", keeps)
    target = os.path.join(tmpdir_path, "target")
    I.load_months(spark, "fhv", ["2019-01", "2019-02"], landed, target)
    assert "batch" not in os.listdir(kept["merge"].removeprefix("file:"))  # the checked rows are the batch
    checked = {r.dispatching_base_num: r.record for r in spark.read.parquet(f"{kept['load']}/checked").collect()}
    assert {b for b, record in checked.items() if record is not None} == {"B2", "B3", "B4"}
    assert {r.record for r in I.read_rejects(spark, target).collect()} == {checked[b] for b in ("B2", "B3", "B4")}
    assert all(r.record is not None for r in read_checked(spark, f"{landed}/*", "fhv").collect())
    assert _bases(spark, target) == ["B1", "B5", "B6"]
