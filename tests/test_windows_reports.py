"""Window operators against Spark's own window functions, and reports."""

import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from farelane.operators import reports as R
from farelane.operators.aggregates import group_percentiles
from farelane.operators.windows import dense_rank_by, ordered_ranks, ordered_row_number, with_group_percentiles


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_percentile_cont_matches_reference_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 10.0)], "k string, v double")
    out = group_percentiles(df, "v", [0.9], ["k"]).first()
    assert abs(out.v_p90 - 8.4) < 1e-12


def test_group_percentiles_equal_window_form(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), rnd.choice([None, 1, 2]), float(rnd.randint(0, 50))) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, k2 int, v double")
    w = Window.partitionBy("k", "k2")
    want = rows_of(df.select("k", "k2", "v", F.percentile("v", 0.9).over(w).alias("v_p90")))
    got = rows_of(with_group_percentiles(df, "v", [0.9], ["k", "k2"]))
    assert got == want


def test_dense_rank_by_matches_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["z1", "z2", None]), float(rnd.randint(0, 6))) for _ in range(300)]
    df = spark.createDataFrame(rows, "z string, p double")
    want = rows_of(df.select(
        "z", "p", F.dense_rank().over(Window.partitionBy("z").orderBy(F.col("p").desc())).alias("dense_rnk")))
    got = rows_of(dense_rank_by(df, ["z"], "p"))
    assert got == want


def test_ordered_row_number_matches_window_with_hot_partition(spark):
    rnd = random.Random(11)
    # One partition holds most rows, as a skewed zone would.
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c"]), rnd.randint(0, 40), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "z string, v int, id int")
    order = [F.col("v").desc(), F.col("id").asc()]
    want = sorted(tuple(r) for r in df.select(
        "z", "v", "id", F.row_number().over(Window.partitionBy("z").orderBy(*order)).alias("rn")).collect())
    got = sorted(tuple(r) for r in ordered_row_number(df, ["z"], order, "rn", slices=16)
                 .select("z", "v", "id", "rn").collect())
    assert got == want


def test_nth_longest_keeps_ties(spark):
    rows = [("SoHo", d, p) for d, p in [("A", 300.0), ("B", 200.0), ("C", 200.0), ("D", 100.0)]]
    df = spark.createDataFrame(rows, "pickup_zone string, dropoff_zone string, trip_duration_p90 double")
    ranked = dense_rank_by(df, ["pickup_zone"], "trip_duration_p90")
    got = sorted((r.dropoff_zone, r.trip_duration_p90) for r in R.nth_longest(ranked, 2).collect())
    assert got == [("B", 200.0), ("C", 200.0)]


def _quarterly(spark):
    rows = []
    for svc, base19, base20 in [("Green", 100.0, 40.0), ("Yellow", 200.0, 150.0)]:
        for q in range(1, 5):
            rows.append((f"2019/Q{q}", 2019, q, svc, Decimal(str(base19 * q))))
            rows.append((f"2020/Q{q}", 2020, q, svc, Decimal(str(base20 * q + (q == 1) * 30))))
    return spark.createDataFrame(rows, "year_quarter string, year bigint, quarter bigint, service_type string, agg_total_amount decimal(38,9)")


def test_yoy_growth_statement_and_best_worst(spark):
    yoy = R.yoy_growth(_quarterly(spark), 2020, 2019)
    got = {(r.year_quarter, r.service_type): r.YoY_Growth for r in yoy.collect()}
    assert abs(got[("2020/Q1", "Green")] - (-30.0)) < 1e-9
    assert abs(got[("2020/Q2", "Green")] - (-60.0)) < 1e-9
    st = R.yoy_statement(yoy, 2019).collect()
    assert [r.year_quarter for r in st] == sorted(r.year_quarter for r in st)
    assert st[0].growth_statement == "In 2020/Q1, Green Taxi had -30% revenue growth compared to 2019/Q1"
    bw = {r.service_type: r for r in R.best_worst_quarters(yoy).collect()}
    assert bw["Green"].best_quarter == "2020/Q1" and bw["Green"].best_YoY_Growth == -30.0
    assert bw["Green"].worst_quarter == "2020/Q2"
    assert bw["Yellow"].best_quarter == "2020/Q1"


def test_percentile_methods_agree_exactly(spark):
    from farelane.operators.windows import distributed_percentiles
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice("abcd"), rnd.choice([1, 2, None]),
             None if rnd.random() < 0.05 else float(rnd.randint(0, 300)) / 4) for _ in range(5000)]
    rows += [("allnull", 1, None), ("one", 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, k2 int, v double")
    ps = [0.97, 0.95, 0.9, 0.5, 0.0, 1.0]
    want = rows_of(group_percentiles(df, "v", ps, ["k", "k2"], method="map"))
    assert rows_of(distributed_percentiles(df, "v", ps, ["k", "k2"], )) == want
    assert rows_of(group_percentiles(df, "v", ps, ["k", "k2"])) == want


def test_dense_rank_matches_window(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["z1", "z2", "hot", "hot", "hot", None]), float(rnd.randint(0, 60))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "z string, p double")
    w = Window.partitionBy("z").orderBy(F.col("p").desc_nulls_last())
    want = rows_of(df.withColumn("dense_rnk", F.dense_rank().over(w)))
    got = rows_of(dense_rank_by(df, ["z"], "p"))
    assert got == want


def test_approx_percentile_close_to_exact(spark):
    df = spark.range(0, 10001).selectExpr("'g' AS k", "CAST(id AS DOUBLE) AS v")
    exact = group_percentiles(df, "v", [0.9], ["k"], method="map").first().v_p90
    approx = group_percentiles(df, "v", [0.9], ["k"], approx=True).first().v_p90
    assert exact == 9000.0 and abs(approx - exact) <= 10


def test_ordered_ranks_match_windows_over_any_slices(spark):
    """One pass for both ranks: ties over several slices, nulls, a null partition, a hot partition."""
    rng = random.Random(5)
    rows = [(rng.choice(["a"] * 6 + ["b", None]), rng.choice([None, 1.0, 2.0, 2.0, 2.0, 3.5]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "z string, p double, i long")
    for first in (F.col("p").desc_nulls_last(), F.col("p").asc_nulls_first()):
        w = Window.partitionBy("z")
        want = sorted(map(tuple, df.select("i", F.row_number().over(w.orderBy(first, "i")),
                                           F.dense_rank().over(w.orderBy(first))).collect()))
        for slices in (1, 7, 40):
            got = ordered_ranks(df, ["z"], [first, F.col("i")], "rn", "dr", "p", slices=slices)
            assert sorted(map(tuple, got.select("i", "rn", "dr").collect())) == want
        dense = ordered_ranks(df, ["z"], [first, F.col("i")], dense_rank="dr", value="p", slices=7)
        assert sorted((r.i, r.dr) for r in dense.collect()) == [(i, d) for i, _, d in want]
    assert ordered_ranks(df.limit(0), ["z"], [F.col("p"), F.col("i")], "rn", "dr", "p").collect() == []
