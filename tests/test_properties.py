"""Properties of the models on the sf0.001 benchmark tables."""

from pyspark.sql import functions as F

from farelane.operators import aggregates as A
from farelane.operators.staging import stg_green
from farelane.plans import models as M
from farelane.sources import bridge as B

from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quarterly_from_detail_equals_from_fact(spark):
    t = B.Tables(spark, SF_SMALL)
    fact = M.fact_trips(B.green_raw(t), B.yellow_raw(t), B.zone_seed(t))
    a = A.quarterly_revenue(A.quarterly_revenue_detail(fact))
    b = A.quarterly_revenue_from_fact(fact)
    assert _rows(a) == _rows(b.select(*a.columns))


def test_percentile_mart_equals_distinct_of_window_form(spark):
    t = B.Tables(spark, SF_SMALL)
    g, y, z = B.green_raw(t), B.yellow_raw(t), B.zone_seed(t)
    mart = M.fare_percentiles_monthly(g, y, z)
    rows = M.fare_percentile_rows(g, y, z).select(*mart.columns).distinct()
    assert _rows(mart) == _rows(rows)


def test_dedup_leaves_unique_keys_and_joins_do_not_fan_out(spark):
    t = B.Tables(spark, SF_SMALL)
    s = stg_green(B.green_raw(t))
    assert s.groupBy("vendorid", "pickup_datetime").count().where("count > 1").count() == 0
    fact = M.fact_trips(B.green_raw(t), B.yellow_raw(t), B.zone_seed(t))
    assert fact.count() <= s.count() + M.stg_yellow(B.yellow_raw(t)).count()


def test_traveltime_row_numbers_are_a_permutation(spark):
    t = B.Tables(spark, SF_SMALL)
    dim = M.dim_fhv_trips(B.fhv_raw(t), B.zone_seed(t), 1996)
    ranked = M.traveltime_p90(dim)
    per_zone = ranked.groupBy("pickup_zone").agg(F.count(F.lit(1)).alias("n"), F.min("row_num").alias("lo"),
                                                 F.max("row_num").alias("hi"),
                                                 F.countDistinct("row_num").alias("d"))
    for r in per_zone.collect():
        assert r.lo == 1 and r.hi == r.n == r.d
