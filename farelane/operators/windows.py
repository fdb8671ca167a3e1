"""Window-style operators written so no single task holds a whole group.

* ``with_group_percentiles`` (W2/W3): a percentile "over (partition by k)" is
  computed as a grouped aggregate (partial + final) and joined back on the
  keys.  The aggregate has one row per group; it is broadcast where its measured
  bytes allow, else it is a shuffle join (AQE splits a skewed key).  A plain window would buffer each whole partition in one task.
* ``dense_rank_by`` (W5): dense rank of a value that is constant within
  groups, ranked on the distinct (partition, value) pairs and joined back the
  same way; the ranks come from a distributed prefix count.
* ``weighted_prefix`` / ``distributed_percentiles``: running sums in a global
  order without a per-partition window, and exact percentiles from a value
  histogram on top of them (no task holds a whole group).
* ``ordered_ranks`` (W4, W5): row number and dense rank in one pass over a
  partition that may hold a third of the data.  Rows are range-partitioned on
  (partition, order), so a hot partition spreads over many tasks, and stored
  once with their slice; windows run inside a slice, and a small table of
  per-slice counts gives the offsets.  ``ordered_row_number`` is its row number alone.

Rows that two later steps read are stored once under the shared checkpoint folder, so
the work before them runs once and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.operators.aggregates import group_percentiles, percentile_name
from farelane.session import scratch_path
from farelane.sources.sinks import store


def _null_safe_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "inner").drop(*[f"_r_{k}" for k in keys])


def with_group_percentiles(df: DataFrame, col: str, ps, keys, approx: bool = False) -> DataFrame:
    """Add ``<col>_pNN`` columns: the continuous percentile of ``col`` within ``keys``."""
    keys = list(keys)
    df = store(df, scratch_path(df.sparkSession, "percentile-rows"))
    per_group = group_percentiles(df.select(*keys, col), col, ps, keys, approx)
    return _null_safe_join(df, per_group, keys)


def dense_rank_by(df: DataFrame, partition, value: str, descending: bool = True,
                  name: str = "dense_rnk") -> DataFrame:
    """Dense rank of ``value`` within ``partition`` (ties share a rank).

    The rank is the number of distinct values ahead plus one, from a distributed prefix sum over the
    distinct (partition, value) pairs, joined back.
    """
    partition = list(partition)
    pairs = df.select(*partition, value).distinct().withColumn("_one", F.lit(1))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    ranked = (weighted_prefix(pairs, partition, [order], "_one")
              .select(*partition, value, (F.col("_before") + 1).cast("int").alias(name)))
    return _null_safe_join(df, ranked, partition + [value])


def ordered_ranks(df: DataFrame, partition, order: list[Column], row_number: str | None = None,
                  dense_rank: str | None = None, value: str | None = None, slices: int | None = None) -> DataFrame:
    """Row number over ``order`` and dense rank over ``value`` per partition, spread over many tasks.

    ``order`` must be a total order on the rows that matter (rows tied on it are interchangeable) and, where a
    dense rank is asked for, begin with ``value``.  A slice's offset is the number of rows (of values) in the
    slices before it; a value that goes on from one slice into the next counts once.
    """
    partition = list(partition)
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _range_slices(df, partition, order, n)
    inside = Window.partitionBy(*partition, "_slice").orderBy(*order)
    before = Window.partitionBy(*partition).orderBy("_slice")
    counted = [F.count(F.lit(1)).alias("_n")]
    out, picks = ranged, []
    if row_number:
        out = out.withColumn("_row", F.row_number().over(inside))
        picks.append(F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                     .alias("_rows_before"))
    if dense_rank:
        # One slice is sorted on the value, so its smallest and largest value are its ends.
        start = F.struct(F.col(value).isNull().alias("null"), F.col(value).alias("value"))
        counted += [(F.count_distinct(value) + F.max(F.col(value).isNull().cast("long"))).alias("_values"),
                    F.min(start).alias("_low"), F.max(start).alias("_high")]
        by_value = Window.partitionBy(*partition, "_slice").orderBy(order[0])
        out = out.withColumn("_rank", F.dense_rank().over(by_value))
    stats = ranged.groupBy(*partition, "_slice").agg(*counted)
    if dense_rank:
        # Descending or ascending, two neighbouring slices share a value exactly if an end of one is an end of the other.
        low, high = F.lag("_low").over(before), F.lag("_high").over(before)
        shared = low.isNotNull() & (low.eqNullSafe(F.col("_low")) | low.eqNullSafe(F.col("_high"))
                                    | high.eqNullSafe(F.col("_low")) | high.eqNullSafe(F.col("_high")))
        stats = stats.withColumn("_shared", shared.cast("long"))
        picks.append((F.coalesce(F.sum("_values").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                      - F.sum("_shared").over(before.rowsBetween(Window.unboundedPreceding, 0))).alias("_values_before"))
    offsets = stats.select(*partition, "_slice", *picks)
    out = _null_safe_join(out, offsets, partition + ["_slice"])
    if row_number:
        out = out.withColumn(row_number, (F.col("_rows_before") + F.col("_row")).cast("int"))
    if dense_rank:
        out = out.withColumn(dense_rank, (F.col("_values_before") + F.col("_rank")).cast("int"))
    return out.drop("_slice", "_row", "_rank", "_rows_before", "_values_before")


def ordered_row_number(df: DataFrame, partition, order: list[Column], name: str = "row_num",
                       slices: int | None = None) -> DataFrame:
    """``row_number() over (partition by … order by …)`` spread over many tasks."""
    return ordered_ranks(df, partition, order, row_number=name, slices=slices)


def _range_slices(df: DataFrame, partition, order, n: int) -> DataFrame:
    """Range-partition on (partition, order) and store the rows once with their slice, which so stays fixed."""
    keys = [F.col(c).asc_nulls_first() for c in partition] + list(order)
    tagged = df.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id())
    return store(tagged, scratch_path(df.sparkSession, "slices"))


def weighted_prefix(df: DataFrame, partition, order: list[Column], weight: str,
                    name: str = "_before", slices: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over rows before this one in its partition.

    Distributed like :func:`ordered_row_number`: slice totals give each slice
    its offset, and a window over (partition, slice) — bounded by one slice —
    gives the running sum inside it.
    """
    spark = df.sparkSession
    partition = list(partition)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _range_slices(df, partition, order, n)
    totals = ranged.groupBy(*partition, "_slice").agg(F.sum(weight).alias("_w"))
    before_slice = Window.partitionBy(*partition).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*partition, "_slice",
                            F.coalesce(F.sum("_w").over(before_slice), F.lit(0)).alias("_slice_off"))
    inside = Window.partitionBy(*partition, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    out = _null_safe_join(local, offsets, partition + ["_slice"])
    return out.withColumn(name, F.col("_slice_off") + F.col("_inside")).drop("_slice", "_inside", "_slice_off")


def distributed_percentiles(df: DataFrame, col: str, ps, keys) -> DataFrame:
    """Exact continuous percentiles per group with no task holding a whole group.

    1. histogram: count per (group, value) — a partial/final aggregate, so a
       hot group is spread over its values;
    2. weighted prefix sums over the histogram in value order (range slices);
    3. each histogram row knows the ranks it covers; the rows holding the lower
       and upper rank of every requested percentile are picked in one more
       aggregate, and interpolated as Spark's ``percentile`` does.
    Nulls are ignored; a group with no values gets nulls.
    """
    keys = list(keys)
    hist = df.groupBy(*keys, F.col(col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return percentiles_from_histogram(hist, col, ps, keys)


def percentiles_from_histogram(hist: DataFrame, col: str, ps, keys) -> DataFrame:
    """Distributed exact percentiles from a (keys, _v, _c) value histogram."""
    keys = list(keys)
    ps = [float(p) for p in ps]
    pre = weighted_prefix(hist, keys, [F.col("_v").asc_nulls_last()], "_c")
    sizes = pre.groupBy(*keys).agg(  # from the stored rows, so the upstream runs once
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("_n"))
    j = _null_safe_join(pre, sizes, keys)
    aggs = [F.max("_n").alias("_n")]
    for i, p in enumerate(ps):
        pos = (F.col("_n") - 1) * F.lit(p)
        for tag, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c")) & F.col("_v").isNotNull()
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{tag}{i}"))
    picked = j.groupBy(*keys).agg(*aggs)
    outs = []
    for i, p in enumerate(ps):
        pos = (F.col("_n") - 1) * F.lit(p)
        lo, hi = F.floor(pos), F.ceil(pos)
        val = (F.when(F.col("_n") == 0, F.lit(None).cast("double"))
                .when(hi == lo, F.col(f"_lo{i}"))
                .otherwise((hi - pos) * F.col(f"_lo{i}") + (pos - lo) * F.col(f"_hi{i}")))
        outs.append(val.cast("double").alias(percentile_name(col, p)))
    return picked.select(*keys, *outs)


__all__ = ["with_group_percentiles", "dense_rank_by", "ordered_ranks", "ordered_row_number", "percentile_name",
           "weighted_prefix", "distributed_percentiles", "percentiles_from_histogram"]
