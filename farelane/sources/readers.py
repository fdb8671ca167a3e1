"""File readers for raw trip files and the zone seed.

CSV input is read with a declared schema in PERMISSIVE mode: a header line is
skipped, an unparsable field becomes null and extra trailing fields are
ignored.  Gzip files are read natively but do not split, so callers that read
``.csv.gz`` at scale should repartition after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.schemas import DROPOFF_COL, PICKUP_COL, RAW_SCHEMAS, ZONE_SEED


TS_NTZ_FORMAT = "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSS]"


def read_trips(spark: SparkSession, path, service: str, with_file: bool = False,
               recursive: bool = False) -> DataFrame:
    """Typed CSV scan of one service's files (a path, a glob or a list)."""
    reader = (spark.read.schema(RAW_SCHEMAS[service])
              .option("header", True)
              .option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", recursive)
              .option("timestampNTZFormat", TS_NTZ_FORMAT))
    df = reader.csv(path)
    if with_file:
        df = df.withColumn("filename", F.col("_metadata.file_name"))
    return df


def read_inferred(spark: SparkSession, path, ntz_timestamps: bool = True,
                  recursive: bool = False) -> DataFrame:
    """Exploration load with inferred types; column names lower-cased.

    Inference costs an extra pass over the input, so it is not for production
    loads.  Inferred timestamps are wall-clock values, kept as TIMESTAMP_NTZ.
    """
    df = (spark.read.option("header", True).option("inferSchema", True)
          .option("recursiveFileLookup", recursive).csv(path))
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if ntz_timestamps and isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name.lower()))
    return df.select(*cols)


def read_text_typed(spark: SparkSession, path, service: str, recursive: bool = False) -> DataFrame:
    """Load where datetimes arrive as text: parse them, then enforce the schema."""
    schema = RAW_SCHEMAS[service]
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    df = (spark.read.schema(as_text).option("header", True)
          .option("recursiveFileLookup", recursive).csv(path))
    dt_cols = {PICKUP_COL[service], DROPOFF_COL[service]}
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name in dt_cols:
            c = F.to_timestamp_ntz(c)
        out.append(c.try_cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*out)


def read_zones(spark: SparkSession, path) -> DataFrame:
    """Zone seed with its declared types (id as bigint so it joins trip ids)."""
    return (spark.read.schema(ZONE_SEED).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


# Text a pandas CSV load treats as null by default.
PANDAS_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                      "n/a", "nan", "null"]


def drop_null_rows(df: DataFrame, null_tokens=None) -> DataFrame:
    """Drop every row holding a null or a null marker in any column."""
    tokens = PANDAS_NULL_TOKENS if null_tokens is None else list(null_tokens)
    conds = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cond = c.isNull()
        if isinstance(f.dataType, T.StringType) and tokens:
            cond = cond | c.isin(tokens)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cond = cond | F.isnan(c)
        conds.append(cond)
    bad = conds[0]
    for c in conds[1:]:
        bad = bad | c
    return df.where(~bad)
