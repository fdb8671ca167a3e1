"""Mergeable quantiles against exact ranks; catalog functions against their Column forms."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from farelane.functions import columns as C
from farelane.functions.catalog import register_functions
from farelane.plans import quantiles as Q
from farelane.session import scratch_path

PS = (0.97, 0.95, 0.5)


def trips_of(spark, n, seed=1):
    """A hot service with two thirds of the rows, ties, nulls and a service of nulls alone."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "b"]), dt.datetime(1996, rng.randrange(1, 13), 3),
             rng.choice([None, 5.0, float(int(rng.lognormvariate(3, 1) * 100)) / 100])) for _ in range(n)]
    rows += [("nulls", dt.datetime(1996, 1, 1), None), ("b", None, 4.0)]
    return spark.createDataFrame(rows, "service_type string, pickup_datetime timestamp_ntz, fare double")


def test_merged_sketches_keep_the_rank_bound(spark):
    trips = trips_of(spark, 30_000).cache()
    state = Q.month_sketches(trips, "fare", ["service_type"], k=400)
    got = Q.period_quantiles(state, ["service_type"], PS)
    errors = Q.rank_errors(trips, "fare", got, ["service_type"], PS)
    rows = errors.collect()
    assert {r.period for r in rows} == {"month", "quarter", "year"} and max(r.rank_error for r in rows) <= 0.03
    counts = {(r.service_type, r.period, r.period_start): r.n_values for r in got.collect()}
    assert counts[("hot", "year", dt.datetime(1996, 1, 1))] == trips.where("service_type = 'hot'").select(
        F.count("fare")).first()[0]
    assert counts[("nulls", "month", dt.datetime(1996, 1, 1))] == 0
    assert got.where("service_type = 'nulls'").first().quantiles is None
    trips.unpersist()


def test_small_groups_are_exact_and_empty_input_is_empty(spark):
    trips = spark.createDataFrame([("a", dt.datetime(1996, m, 1), float(m)) for m in range(1, 11)],
                                  "service_type string, pickup_datetime timestamp_ntz, fare double")
    state = Q.month_sketches(trips, "fare", ["service_type"])
    year = Q.period_quantiles(state, ["service_type"], (0.5, 1.0), ["year"]).first()
    assert year.n_values == 10 and year.quantiles == [5.0, 10.0]
    assert Q.period_quantiles(Q.month_sketches(trips.limit(0), "fare", ["service_type"]), ["service_type"], PS).collect() == []


def test_a_load_replaces_only_its_month(spark):
    path = scratch_path(spark, "sketches")
    trips = trips_of(spark, 2000)
    Q.store_months(Q.month_sketches(trips, "fare", ["service_type"]), path)

    def files():
        return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path.removeprefix("file:"))
                for f in names if f.endswith(".parquet")}
    before = files()
    late = spark.createDataFrame([("hot", dt.datetime(1996, 5, 9), 1e6)], trips.schema)
    may = trips.unionByName(late).where("month(pickup_datetime) = 5")
    Q.store_months(Q.month_sketches(may, "fare", ["service_type"]), path)
    changed = before ^ files()
    assert changed and all("month=1996-05-01" in f for f in changed)
    top = {(r.service_type, r.period_start): r.quantiles[0] for r in Q.period_quantiles(
        spark.read.parquet(path), ["service_type"], (1.0,), ["quarter"]).collect() if r.quantiles}
    assert top[("hot", dt.datetime(1996, 4, 1))] == 1e6 and top[("hot", dt.datetime(1996, 1, 1))] < 1e6


@pytest.mark.parametrize("schema", [None, "default"])
def test_catalog_functions_equal_their_column_forms(spark, schema):
    names = dict(zip(("trip_key", "safe_bigint", "safe_whole", "payment_description", "month_start", "iso_utc",
                      "trip_seconds", "year_quarter"), register_functions(spark, schema)))
    t = dt.datetime(1996, 5, 17, 23, 59, 59)
    rows = [("a", None, "12", "2.5", "1", t, t + dt.timedelta(seconds=61)), (None, None, "x", "-2.5", "9", None, t),
            ("a", "", "", None, None, t, None), ("'", "\\", "99999999999999999999", "0.49", "6.0", t, t - dt.timedelta(days=2)),
            ("", "-", " 7 ", "7", "bad", t, t)]
    df = (spark.createDataFrame(rows, "a string, b string, v string, d string, code string, s timestamp_ntz, e timestamp_ntz")
          .withColumn("d", F.col("d").cast("decimal(38,9)")))
    sql = spark.sql(f"""SELECT {names['trip_key']}(array(a, b)) AS k, {names['safe_bigint']}(v) AS v, {names['safe_whole']}(d) AS d,
        {names['payment_description']}(code) AS p, {names['month_start']}(s) AS m, {names['iso_utc']}(s) AS i,
        {names['trip_seconds']}(s, e) AS n, {names['year_quarter']}(s) AS q FROM {{df}}""", df=df)
    twin = df.select(C.surrogate_key("a", "b").alias("k"), C.safe_cast("v").alias("v"),
                     C.safe_cast("d", round_fraction=True).alias("d"), C.payment_description("code").alias("p"),
                     C.period_start("s", "month").alias("m"), C.iso_utc("s").alias("i"),
                     C.trip_seconds("s", "e").alias("n"), C.year_quarter("s").alias("q"))
    assert sql.columns == twin.columns and list(map(tuple, sql.collect())) == list(map(tuple, twin.collect()))
    if schema is not None:
        for name in names.values():
            spark.sql(f"DROP FUNCTION {name}")
