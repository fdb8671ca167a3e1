"""Operators stay exact when one key holds most of the rows."""

import datetime as dt

from pyspark.sql import functions as F

from farelane.operators.aggregates import group_percentiles
from farelane.operators.staging import dedup
from farelane.plans.ingest import first_load_rows


def test_dedup_with_a_hot_key(spark):
    hot = spark.range(0, 6000).select(F.lit(1).alias("k"), (F.col("id") % 997).alias("v"), "id")
    cold = spark.range(0, 300).select((F.col("id") + 2).alias("k"), F.lit(5).alias("v"), "id")
    df = hot.unionByName(cold).repartition(16)
    out = {r.k: (r.v, r.id) for r in dedup(df, ["k"], [F.col("v").asc(), F.col("id").asc()]).collect()}
    assert len(out) == 301
    assert out[1] == (0, 0)


def test_first_load_rows_with_a_hot_key(spark):
    rows = [("hot", f"f{m}") for m in (3, 1, 2) for _ in range(500)] + [("x", "f2")]
    df = spark.createDataFrame(rows, "unique_row_id string, filename string").repartition(8)
    kept = first_load_rows(df).groupBy("unique_row_id", "filename").count().collect()
    assert sorted(tuple(r) for r in kept) == [("hot", "f1", 500), ("x", "f2", 1)]


def test_percentile_of_a_hot_group(spark):
    df = (spark.range(0, 20000).select(F.when(F.col("id") < 15000, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
                                       (F.col("id") % 1000).cast("double").alias("v")))
    exact = {r.g: r.v_p90 for r in group_percentiles(df, "v", [0.9], ["g"], method="map").collect()}
    dist = {r.g: r.v_p90 for r in group_percentiles(df, "v", [0.9], ["g"], method="distributed").collect()}
    assert exact == dist
