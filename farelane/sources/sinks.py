"""Table creation and materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _ddl_columns(schema: T.StructType) -> str:
    parts = []
    for f in schema.fields:
        comment = f.metadata.get("comment") if f.metadata else None
        col = f"`{f.name}` {f.dataType.simpleString()}"
        if comment:
            col += " COMMENT '" + comment.replace("'", "\\'") + "'"
        parts.append(col)
    return ", ".join(parts)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: str | list[str],
                 location: str) -> None:
    """CREATE TABLE IF NOT EXISTS, Parquet, partitioned, with column comments.

    The partition columns must be the last fields of ``schema``.
    """
    parts = [partition_by] if isinstance(partition_by, str) else partition_by
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(schema)}) USING parquet "
        f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) LOCATION '{location}'")


def append_to_table(df: DataFrame, name: str) -> None:
    """Append by column name (reordered to the table's layout).

    For a partitioned table the rows are rebalanced on the partition columns
    first (AQE sizes the tasks), so each partition gets a few files rather
    than one per writing task.
    """
    spark = df.sparkSession
    target_cols = spark.table(name).columns
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    out = df.select(*target_cols)
    if parts:
        out = out.hint("rebalance", *parts)
    out.write.insertInto(name)


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Expose a model as a lazy view or a stored table and return it."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown materialisation {kind!r}")
    return spark.table(name)


def store(df: DataFrame, path: str, partition_by=None) -> DataFrame:
    """Write ``df`` as Parquet under ``path`` (a shared folder) and read it back.

    Used to materialise a model once before several jobs read it (data tests,
    marts): each later job scans only the columns it needs, and the stored copy
    cuts the lineage, so a lost executor does not recompute the model.
    """
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        w = df.hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols)
    else:
        w = df.write.mode("overwrite")
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
