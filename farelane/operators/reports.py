"""Year-over-year and ranking reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions.columns import growth_statement, pct_growth, round2


def money_double(c):
    """Money held as DECIMAL → the nearest double, with every decimal place."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def yoy_growth(quarterly: DataFrame, year: int = 2020, previous_year: int = 2019) -> DataFrame:
    """Self-join of quarterly revenue: same quarter and service, two fixed years."""
    cur = quarterly.where(F.col("year") == year).alias("cur")
    prev = quarterly.where(F.col("year") == previous_year).alias("prev")
    j = cur.join(prev, (F.col("cur.quarter") == F.col("prev.quarter"))
                 & (F.col("cur.service_type") == F.col("prev.service_type")), "inner")
    return j.select(
        F.col("cur.year_quarter").alias("year_quarter"),
        F.col("cur.service_type").alias("service_type"),
        F.col("cur.quarter").alias("quarter"),
        money_double("cur.agg_total_amount").alias(f"revenue_{year}"),
        money_double("prev.agg_total_amount").alias(f"revenue_{previous_year}"),
        pct_growth(money_double("cur.agg_total_amount"),
                   money_double("prev.agg_total_amount")).alias("YoY_Growth"),
    )


def yoy_statement(yoy: DataFrame, previous_year: int = 2019) -> DataFrame:
    """Rounded growth and a sentence per quarter and service, sorted."""
    return (yoy.select("year_quarter", "service_type",
                       round2("YoY_Growth").alias("YoY_Growth"),
                       growth_statement("year_quarter", "service_type", "YoY_Growth",
                                        "quarter", previous_year).alias("growth_statement"))
               .orderBy("year_quarter", "service_type"))


def yoy_ranked(yoy: DataFrame) -> DataFrame:
    """Best (descending) and worst (ascending) row numbers per service.

    Ties are broken by year_quarter so the result is repeatable.  The input is
    one row per quarter and service, so each window partition is tiny.
    """
    best = Window.partitionBy("service_type").orderBy(F.col("YoY_Growth").desc_nulls_last(), "year_quarter")
    worst = Window.partitionBy("service_type").orderBy(F.col("YoY_Growth").asc_nulls_last(), "year_quarter")
    return yoy.select("service_type", "year_quarter", "YoY_Growth",
                      F.row_number().over(best).alias("rn_best"),
                      F.row_number().over(worst).alias("rn_worst"))


def best_worst_quarters(yoy: DataFrame) -> DataFrame:
    """Best and worst quarter with growth per service (conditional max pivot)."""
    r = yoy_ranked(yoy)
    return r.groupBy("service_type").agg(
        F.max(F.when(F.col("rn_best") == 1, F.col("year_quarter"))).alias("best_quarter"),
        F.max(F.when(F.col("rn_best") == 1, round2("YoY_Growth"))).alias("best_YoY_Growth"),
        F.max(F.when(F.col("rn_worst") == 1, F.col("year_quarter"))).alias("worst_quarter"),
        F.max(F.when(F.col("rn_worst") == 1, round2("YoY_Growth"))).alias("worst_YoY_Growth"),
    )


def nth_longest(ranked: DataFrame, n: int = 2) -> DataFrame:
    """Zone pairs whose P90 has dense rank ``n`` in their pickup zone (ties kept)."""
    return (ranked.where(F.col("dense_rnk") == n)
                  .select("pickup_zone", "dropoff_zone", "dense_rnk", "trip_duration_p90")
                  .distinct()
                  .orderBy(F.col("trip_duration_p90").desc(), "pickup_zone", "dropoff_zone"))
