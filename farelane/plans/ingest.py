"""Incremental load: content key, insert-only merge, commit, key index, audit, completeness.

The target is a Parquet folder partitioned by load (``batch_id``) and ``pickup_date``.  A load never
updates or deletes: it adds source rows whose content key is not already in the target.  Rows of one load
that share a key with an *earlier month* of the same load are skipped too, which reproduces month-by-month
merges in a single job (no driver loop over months).

Beside the data lie ``_keys`` (one Bloom filter per pickup date and load, see ``keyindex``) and two folders of
empty marker files.  ``_pending/<batch_id>`` stands while a load writes, ``_commits/<batch_id>`` once it is whole.  Readers leave
pending loads out, so a load that died midway is not seen; the next attempt under the same id overwrites
the folder it left, and an attempt after the commit does nothing.  One writer per target is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.functions.columns import row_key, year_of, month_of
from farelane.plans.keyindex import build_filters, possible_keys
from farelane.schemas import DO_COL, DROPOFF_COL, PICKUP_COL, PU_COL, RAW_SCHEMAS, VENDOR_COL
from farelane.session import scratch_path
from farelane.sources import files
from farelane.sources.checked import logical_file_name

KEY = "unique_row_id"
PARTITION = "pickup_date"
BATCH = "batch_id"
FILE_ROWS = 5_000_000  # rows of one pickup date that one task writes
INDEX_SCHEMA = f"index_date date, bitmaps int, bitmap int, bits binary, {BATCH} string"


def key_columns(service: str) -> list[str]:
    """Columns hashed into the content key of one service's rows."""
    return [VENDOR_COL[service], PICKUP_COL[service], DROPOFF_COL[service],
            PU_COL[service], DO_COL[service]]


def month_file_name(service: str, pickup) -> Column:
    """'<service>_tripdata_YYYY-MM.csv' for the month of ``pickup``."""
    p = F.col(pickup) if isinstance(pickup, str) else pickup
    return F.concat(F.lit(f"{service}_tripdata_"), F.date_format(p, "yyyy-MM"), F.lit(".csv"))


def stamp_rows(df: DataFrame, service: str, filename=None) -> DataFrame:
    """Prefix ``unique_row_id`` (16-byte MD5 of the key columns) and ``filename``.

    ``filename`` may be a string, a Column, or None for the scanned file's name.
    """
    if filename is None:
        fname = F.col("_metadata.file_name")
    elif isinstance(filename, str):
        fname = F.lit(filename)
    else:
        fname = filename
    data_cols = [c for c in df.columns if c not in (KEY, "filename")]
    return df.select(row_key(*key_columns(service)).alias(KEY), fname.alias("filename"), *data_cols)


def with_partition(df: DataFrame, service: str) -> DataFrame:
    return df.withColumn(PARTITION, F.to_date(F.col(PICKUP_COL[service])))


def insert_new(target: DataFrame, source: DataFrame, key: str = KEY) -> DataFrame:
    """Source rows whose key is absent from the target (MERGE … WHEN NOT MATCHED)."""
    keys = target.select(F.col(key).alias("_tkey")).distinct()  # a repeated target key is one row
    return source.join(keys, source[key] == keys["_tkey"], "left_anti")


def repeated_keys(source: DataFrame, key: str = KEY, unit: str = "filename") -> DataFrame:
    """(_k, _first): the keys that several units of a load hold, with the first of these units.

    The units (the files of a load) are numbered in their order, so that the keys are aggregated by hashing: the least
    and greatest of names would have every row sorted by its key.
    """
    units = (source.select(F.col(unit).alias("_name")).where(F.col("_name").isNotNull()).distinct()
             .withColumn("_n", F.row_number().over(Window.orderBy("_name"))))
    numbered = source.where(F.col(key).isNotNull()).join(F.broadcast(units), F.col(unit) == F.col("_name"))
    first = (numbered.groupBy(F.col(key).alias("_k")).agg(F.min("_n").alias("_n"), F.max("_n").alias("_last"))
             .where(F.col("_n") < F.col("_last")).drop("_last"))  # keys of one unit alone need no join
    return first.join(F.broadcast(units), "_n").select("_k", F.col("_name").alias("_first"))


def first_load_rows(source: DataFrame, key: str = KEY, unit: str = "filename", repeated: DataFrame | None = None) -> DataFrame:
    """Drop rows whose key already appeared in an earlier ``unit`` of this load.

    Equivalent to merging the units one after another in ``unit`` order; rows
    repeated inside one unit are all kept, as a single MERGE would insert them.
    ``repeated`` has the :func:`repeated_keys` of the load, if they are stored.
    """
    repeated = repeated_keys(source, key, unit) if repeated is None else repeated
    j = source.where(F.col(key).isNotNull() & F.col(unit).isNotNull()).join(repeated, F.col(key) == F.col("_k"), "left")
    return j.where(F.col("_k").isNull() | (F.col(unit) == F.col("_first"))).drop("_k", "_first")


def pending_loads(spark: SparkSession, path: str) -> list[str]:
    """Loads that began and did not finish."""
    return [n for n in files.names(spark, f"{path}/_pending") if not files.exists(spark, f"{path}/_commits/{n}")]


def _finished(df: DataFrame, pending: list[str]) -> DataFrame:
    return df.where(~F.col(BATCH).isin(pending)) if pending else df


def read_loads(spark: SparkSession, path: str, service: str, schema=None) -> DataFrame:
    """Rows of all finished loads, with the load they came by."""
    cols = [f"`{KEY}` binary", "filename string"] + [f"`{f.name}` {f.dataType.simpleString()}"
                                                     for f in (schema or RAW_SCHEMAS[service]).fields]
    cols += [f"{BATCH} string", f"{PARTITION} date"]
    return _finished(spark.read.schema(", ".join(cols)).parquet(path), pending_loads(spark, path))


def read_target(spark: SparkSession, path: str, service: str, schema=None) -> DataFrame:
    return read_loads(spark, path, service, schema).drop(BATCH)


def target_trips(spark: SparkSession, path: str, service: str) -> DataFrame:
    """The loaded trips in the raw layout, with ``pickup_date`` for pruning, as input of the models."""
    return read_target(spark, path, service).drop(KEY, "filename")


def merge_into(spark: SparkSession, target_path: str, stamped: DataFrame, service: str,
               unit: str = "filename", batch_id: str | None = None, stored: bool = False) -> str:
    """Add the new rows of ``stamped`` to the target as one load; returns its id.

    The batch is stored once on the shared folder, so its files are parsed once and a lost executor re-reads; ``stored``
    says that ``stamped`` is read from such a copy already.  Under a given ``batch_id`` the load happens once: after its
    commit a repeat does nothing.
    """
    batch_id = batch_id or uuid.uuid4().hex
    pending, commit = f"{target_path}/_pending/{batch_id}", f"{target_path}/_commits/{batch_id}"
    if files.exists(spark, commit):
        files.remove(spark, pending)
        return batch_id
    known = files.exists(spark, f"{target_path}/_keys")
    files.mark(spark, pending)  # what an earlier attempt under this id left is overwritten below
    work = scratch_path(spark, "merge")
    try:
        batch = with_partition(stamped, service)
        if not stored:
            batch = _stored(batch, f"{work}/batch")
        names = batch.select(KEY, PARTITION, unit)  # what decides about a row; whole rows move once, to their dates
        repeated = _stored(repeated_keys(names, KEY, unit), f"{work}/repeated")
        held = known_keys(spark, target_path, names, service, f"{work}/hits") if known else None
        if held is not None:
            held = _stored(held, f"{work}/held")
        rows, new = (_without(first_load_rows(r, KEY, unit, repeated), held) for r in (batch, names))
        if not (repeated.isEmpty() and (held is None or held.isEmpty())):
            new = _stored(new, f"{work}/new")
            if new.isEmpty():
                rows = batch.where(F.lit(False))
        write_index(new, target_path, batch_id)
        (dealt_by_date(rows, sizes=new).write.mode("overwrite").partitionBy(PARTITION)
         .parquet(f"{target_path}/{BATCH}={batch_id}"))
        files.mark(spark, commit)
        files.remove(spark, pending)
    finally:
        files.remove(spark, work)
    return batch_id


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt_by_date(rows: DataFrame, file_rows: int = FILE_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Rows dealt so that a pickup date is written by one task, or by one per ``file_rows`` of a larger date.

    The dates are spread over all shuffle partitions whatever their size: a load of few rows and many dates is
    many files, which one task would write one after another.  ``sizes`` has the dates of the same rows, if that is less to read.
    """
    spark = rows.sparkSession
    sizes = rows if sizes is None else sizes
    large = (sizes.groupBy(F.col(PARTITION).alias("_date")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > file_rows)
             .select("_date", F.ceil(F.col("n") / file_rows).alias("_files")))
    # Broadcast: one row per ``file_rows`` rows at most.  Joined by a shuffle, every row would move a second time.
    dealt = rows.join(F.broadcast(large), rows[PARTITION].eqNullSafe(F.col("_date")), "left").withColumn(
        "_part", F.pmod(F.xxhash64(KEY), F.coalesce("_files", F.lit(1))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, PARTITION, "_part").drop("_date", "_files", "_part")


def write_index(rows: DataFrame, target_path: str, batch_id: str) -> None:
    """Filters of one load's keys, beside the data."""
    build_filters(rows, PARTITION, KEY).write.mode("overwrite").parquet(f"{target_path}/_keys/{BATCH}={batch_id}")


def read_index(spark: SparkSession, target_path: str) -> DataFrame:
    """Filters of all finished loads."""
    return _finished(spark.read.schema(INDEX_SCHEMA).parquet(f"{target_path}/_keys"), pending_loads(spark, target_path))


def known_keys(spark: SparkSession, target_path: str, batch: DataFrame, service: str, hits_path: str) -> DataFrame | None:
    """(_tkey, _tdate) of ``batch`` that the target has; None if the index holds none of them.

    The key index is asked first.  Only the keys it may hold are joined with the target, which is read on their pickup dates
    alone (bounded by the calendar); without such keys the target is not read at all.
    """
    possible_keys(batch, read_index(spark, target_path), PARTITION, KEY, BATCH).write.mode("overwrite").parquet(hits_path)
    hits = spark.read.parquet(hits_path)
    dates = [r[0] for r in hits.select(PARTITION).distinct().collect()]
    if not dates:
        return None
    there = F.col(PARTITION).isin([d for d in dates if d is not None])
    if None in dates:  # rows without a pickup time have a partition of their own
        there = there | F.col(PARTITION).isNull()
    target = (read_target(spark, target_path, service).where(there)
              .select(F.col(KEY).alias("_tkey"), F.col(PARTITION).alias("_tdate")))
    same = (F.col(KEY) == F.col("_tkey")) & F.col(PARTITION).eqNullSafe(F.col("_tdate"))
    return hits.join(target, same, "left_semi").select(F.col(KEY).alias("_tkey"), F.col(PARTITION).alias("_tdate"))


def _without(rows: DataFrame, held: DataFrame | None) -> DataFrame:
    if held is None:
        return rows
    return rows.join(held, (F.col(KEY) == F.col("_tkey")) & F.col(PARTITION).eqNullSafe(F.col("_tdate")), "left_anti")


def unknown_rows(spark: SparkSession, target_path: str, batch: DataFrame, rows: DataFrame, service: str, hits_path: str) -> DataFrame:
    """``rows`` without those whose key the target has (see :func:`known_keys`)."""
    return _without(rows, known_keys(spark, target_path, batch, service, hits_path))


def ingest_month(spark: SparkSession, service: str, path: str, target_path: str) -> None:
    """Typed scan → stamp → insert-only merge of one month's file(s)."""
    from farelane.sources.readers import read_trips
    raw = read_trips(spark, path, service)
    merge_into(spark, target_path, stamp_rows(raw, service, filename=logical_file_name()), service)


def month_files(landing: str, service: str, months) -> list[str]:
    """Globs of the landed files or folders of some months ('YYYY-MM'), compressed or not, plain or in partition folders."""
    return [f"{landing}/{prefix}{service}_tripdata_{m}.csv*" for m in months for prefix in ("", "_file=")]


def load_months(spark: SparkSession, service: str, months, landing: str, target_path: str, schema=None,
                table: str | None = None, batch_id: str | None = None) -> DataFrame:
    """Load one month, or backfill several as one load; returns the audit per file.

    Files are aligned by header name and checked (``sources.checked``); rows with a bad field go to ``_rejects`` beside
    the data instead of the target.  ``table`` names a described catalog table over the target: it is
    declared with column comments before the load and learns the load's partitions after its commit.
    """
    from farelane.sources.checked import FILE, checked_audit, read_checked, split_rejects
    schema = schema or RAW_SCHEMAS[service]
    batch_id = batch_id or uuid.uuid4().hex
    if table:
        declare_target(spark, table, service, target_path, schema)
    work = scratch_path(spark, "load")
    try:
        read = read_checked(spark, month_files(landing, service, months), service, schema, rejected_records_only=True)
        # Stamped before they are stored: the good rows among them are the batch of the merge, which stores no second copy.
        checked = _stored(stamp_rows(read, service, filename=F.col(FILE)), f"{work}/checked")
        good, rejects = split_rejects(checked)
        merge_into(spark, target_path, good, service, batch_id=batch_id, stored=True)
        rejects.write.mode("overwrite").parquet(f"{target_path}/_rejects/{BATCH}={batch_id}")
        checked_audit(checked).withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").parquet(f"{target_path}/_audit/load={batch_id}")
    finally:
        files.remove(spark, work)
    if table:
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    return spark.read.parquet(f"{target_path}/_audit/load={batch_id}")


def read_rejects(spark: SparkSession, target_path: str) -> DataFrame:
    """Rejected rows of every load: filename, record, bad_fields, batch_id."""
    return spark.read.schema(f"filename string, record string, bad_fields array<string>, {BATCH} string").parquet(f"{target_path}/_rejects")


def declare_target(spark: SparkSession, table: str, service: str, target_path: str, schema=None) -> None:
    """CREATE TABLE IF NOT EXISTS over the target, with the description of every column."""
    from pyspark.sql import types as T
    from farelane.sources.sinks import ensure_table
    note = lambda name, kind, text: T.StructField(name, kind, True, {"comment": text})
    fields = [note(KEY, T.BinaryType(), "Hash of the attributes that identify a trip"),
              note("filename", T.StringType(), "Monthly file the trip was loaded from"), *(schema or RAW_SCHEMAS[service]).fields,
              note(BATCH, T.StringType(), "Load that added the trip (partition)"), note(PARTITION, T.DateType(), "Pickup date (partition)")]
    ensure_table(spark, table, T.StructType(fields), [BATCH, PARTITION], target_path)


def load_audit(df: DataFrame, file_col: str = "filename") -> DataFrame:
    """Rows loaded per source file."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows_loaded"))


def missing_periods(present: DataFrame, services, service_col: str = "service",
                    ts_col: str = "pickup_datetime", years=None) -> DataFrame:
    """Expected (service, year, month) with no rows, over ``years`` or else the years the data spans.

    The expected grid is built by exploding sequences on one row (years × 12 ×
    services), not by a cross join, and compared with the distinct periods
    present in the data (a partial/final aggregate).
    """
    have = present.select(F.col(service_col).alias("service"), year_of(ts_col).alias("year"),
                          month_of(ts_col).alias("month")).distinct()
    bounds = have.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    expected = F.sequence("lo", "hi") if years is None else F.array(*[F.lit(int(y)) for y in years])
    grid = (bounds.select(F.explode(expected).alias("year"))
                  .select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
                  .select(F.explode(F.array(*[F.lit(s) for s in services])).alias("service"),
                          F.col("year").cast("bigint").alias("year"),
                          F.col("month").cast("bigint").alias("month")))
    return grid.join(have, ["service", "year", "month"], "left_anti")
