"""Write raw trip rows as monthly CSV files, the way trip files arrive.

One folder per month named ``<service>_tripdata_YYYY-MM.csv`` (written in
parallel by partitioning on that name).  Readers use ``recursiveFileLookup``
so the folder name is not turned into a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from farelane.plans.ingest import month_file_name
from farelane.schemas import PICKUP_COL

CSV_TS = "yyyy-MM-dd HH:mm:ss"


def land_monthly_csv(df: DataFrame, service: str, root: str, compression: str | None = None) -> str:
    w = (df.withColumn("_file", month_file_name(service, PICKUP_COL[service]))
           .hint("rebalance", "_file")
           .write.mode("overwrite").partitionBy("_file")
           .option("header", True).option("timestampNTZFormat", CSV_TS))
    if compression:
        w = w.option("compression", compression)
    w.csv(root)
    return root


def land_csv(df: DataFrame, path: str, compression: str | None = None) -> str:
    w = df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", CSV_TS)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path
