"""Incremental file ingest with Structured Streaming.

A file source watches the landing folder; ``trigger(availableNow=True)``
processes whatever has arrived and stops, so the same job serves the monthly
schedule and a backfill.  Each micro-batch is stamped and merged insert-only
into the partitioned target (``merge_into``): a key already in the target is
never inserted again, so a replay — even with a fresh checkpoint — adds
nothing; a batch that died midway is written anew, one that was committed is skipped.  Inside one micro-batch, files are merged in name (= month) order,
and rows repeated inside one month are all kept, as a single merge of that
month would insert them.  One pass takes all that has landed as one batch, so
the part files of a month are never merged apart from each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.plans.ingest import logical_file_name, merge_into, stamp_rows
from farelane.schemas import RAW_SCHEMAS


def ingest_stream(spark: SparkSession, service: str, landing: str, target_path: str,
                  checkpoint: str) -> None:
    """Run one availableNow pass over ``landing`` (a folder or glob)."""
    reader = (spark.readStream.schema(RAW_SCHEMAS[service]).option("header", True)
              .option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", True)
              .option("timestampNTZFormat", "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSS]"))
    stream = reader.csv(landing)
    stamped = stamp_rows(stream.withColumn("_file", logical_file_name()), service,
                         filename=F.col("_file")).drop("_file")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # The query's id lives in its checkpoint: a batch that is run again after a crash has the same name.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_into(batch.sparkSession, target_path, batch, service, batch_id=f"{query}-{batch_id}" if query else None)

    q = (stamped.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
