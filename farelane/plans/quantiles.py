"""Mergeable quantiles of fares and travel times (A5, W2, W3, M6, M8): one sketch a key and month, merged into any period.

A KLL sketch holds a bounded sample of ranks (``SKETCH_K`` sets its size), is built by a partial aggregate and merges without
going back to the trips.  ``period_quantiles`` serves months, quarters and years from one scan of the stored sketches.  Exact
percentiles stay the library's default; a sketch's quantile is a value of the data whose rank is within
``RANK_ERROR`` of the one asked for, and exact as long as a group has no more values than the sketch holds.

Null values are not counted; a group of nulls alone has count 0 and null quantiles; trips without a month keep a null month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.columns import period_start

SKETCH_K = 2000
RANK_ERROR = 0.01  # about five times the error that a sketch of SKETCH_K states at 99 % confidence
PERIODS = ("month", "quarter", "year")


def month_sketches(trips: DataFrame, col: str, keys, k: int = SKETCH_K) -> DataFrame:
    """Per key and pickup month: sketch of ``col`` and the number of values in it."""
    value = F.col(col).cast("double")
    return (trips.groupBy(*keys, F.trunc("pickup_datetime", "month").alias("month"))
            .agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"), F.count(value).alias("n_values")))


def store_months(sketches: DataFrame, path: str) -> None:
    """Write sketches by month; months that ``sketches`` holds replace their folders, others stay as they are."""
    (sketches.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(path))


def in_periods(df: DataFrame, at: Column, periods=PERIODS) -> DataFrame:
    """Every row once for each kind of period: ``period`` and ``period_start``."""
    starts = F.array(*[F.struct(F.lit(p).alias("period"), period_start(at, p).alias("period_start")) for p in periods])
    return df.withColumn("_p", F.explode(starts)).select("*", "_p.period", "_p.period_start").drop("_p")


def period_quantiles(sketches: DataFrame, keys, ps, periods=PERIODS) -> DataFrame:
    """Keys, period, period_start, n_values and ``quantiles`` (array in the order of ``ps``), merged from the months."""
    merged = (in_periods(sketches, F.col("month"), periods).groupBy(*keys, "period", "period_start")
              .agg(F.kll_merge_agg_double(F.when(F.col("n_values") > 0, F.col("sketch"))).alias("sketch"),
                   F.sum("n_values").alias("n_values")))
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in ps])
    return merged.select(*keys, "period", "period_start", "n_values",
                         F.when(F.col("n_values") > 0, quantiles).alias("quantiles"))


def rank_errors(trips: DataFrame, col: str, quantiles: DataFrame, keys, ps, periods=PERIODS) -> DataFrame:
    """How far each quantile's true rank lies from the one asked for: keys, period, period_start, p, n_values, rank_error.

    A value that repeats covers a range of ranks; the error is the distance to that range.
    """
    on = [*keys, "period", "period_start"]
    rows = in_periods(trips.select(*keys, F.col("pickup_datetime"), F.col(col).cast("double").alias("_v")),
                      F.col("pickup_datetime"), periods).where("_v is not null")
    at = [F.col("quantiles")[i] for i in range(len(ps))]
    counts = [F.count_if(F.col("_v") < a).alias(f"_below{i}") for i, a in enumerate(at)]
    counts += [F.count_if(F.col("_v") <= a).alias(f"_upto{i}") for i, a in enumerate(at)]
    counted = rows.join(quantiles.drop("n_values"), on).groupBy(*on).agg(F.count(F.lit(1)).alias("n_values"), *counts)
    errors = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.greatest(
        F.col(f"_below{i}") / F.col("n_values") - p, p - F.col(f"_upto{i}") / F.col("n_values"), F.lit(0.0)).alias("rank_error"))
        for i, p in enumerate(ps)])
    return counted.select(*on, "n_values", F.explode(errors).alias("e")).select(*on, "n_values", "e.p", "e.rank_error")
