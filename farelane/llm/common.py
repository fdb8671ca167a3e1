"""Helpers shared by the training-data operators: stored cuts, sizes, kernels' settings.

Intermediate results that are read more than once are written as Parquet
under the shared checkpoint folder (``cut``), so a lost executor costs a
re-read and never the work behind it.  Every cut is removed by the operator
that made it as soon as nothing reads it any more (``Scratch.drop``).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Rows per Arrow batch handed to Python: texts can be long, so keep batches small.
ARROW_ROWS = 1000
ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Frees the shuffle files of a finished write at once instead of at the driver's next GC.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character is left as it is."""
    return F.translate(c, UPPER, LOWER)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of a text batch for the Python stages of this session."""
    if int(spark.conf.get(ARROW_KEY)) > ARROW_ROWS:
        spark.conf.set(ARROW_KEY, str(ARROW_ROWS))


@contextmanager
def _freed_shuffles(spark: SparkSession):
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


class Scratch:
    """Tables that one operator call writes under the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.n = 0
        self.live: list[DataFrame] = []

    def cut(self, df: DataFrame, compression: str = "zstd") -> DataFrame:
        """Write ``df`` and read it back: lineage ends at the stored files."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        with _freed_shuffles(self.spark):
            df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._cut_path = path
        self.live.append(out)
        return out

    def finish(self, df: DataFrame) -> DataFrame:
        """Cut the operator's result and remove every earlier cut that is left."""
        out = self.cut(df)
        for old in self.live[:-1]:
            self.drop(old)
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove the files of a cut that nothing reads any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._cut_path)
        conf = self.spark._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)
        self.live = [x for x in self.live if x is not df]


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one aggregate over the column)."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)))).first()
    return int(row[0] or 0)


def buckets_for(spark: SparkSession, total_bytes: int, bytes_each: int = 12 << 20) -> int:
    """Number of hash buckets so that one holds about ``bytes_each``, whatever the input."""
    return max(shuffle_parts(spark), -(-total_bytes // bytes_each))


def doc_key(doc_id: Column, text: Column) -> Column:
    """128-bit key of a row's (doc_id, text): equal rows share it, so it survives recomputation."""
    t = F.coalesce(text, F.lit("\x00null"))
    return F.struct(F.xxhash64(doc_id, t).alias("a"), F.xxhash64(t, F.lit(7), doc_id).alias("b"))
