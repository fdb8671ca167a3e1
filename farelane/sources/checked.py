"""Checked CSV load: columns aligned by header name, every field that does not convert accounted for.

Monthly files of one service do not all have the same layout: columns move, come and go, and ids arrive as numbers or
as text.  Files are grouped by their header line; every group is one scan whose columns are picked by name
(regardless of case), and the groups are united under the declared schema.  A declared column that a file lacks
is null, a column that is not declared is ignored.

All fields are read as text once and converted here, so a field that has text but no value of its declared type is told apart from
an empty one.  ``read_checked`` returns every row with the names of its bad fields; ``split_rejects``
divides them into rows to load and rows for the rejects table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.schemas import NUMERIC, RAW_SCHEMAS
from farelane.sources.files import data_files, header_of

BAD, RECORD, FILE = "bad_fields", "record", "filename"
SHORT = "(short row)"  # stands among the bad fields of a row with too few fields
_CORRUPT = "_corrupt"


def convert(text: Column, kind: T.DataType) -> Column:
    """Text as a value of ``kind``, null if it has none; whole numbers may be written with a zero fraction."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        number = F.trim(text).try_cast(NUMERIC)
        return F.when(number == F.floor(number), number).try_cast(kind)
    return F.trim(text).try_cast(kind)


def folder_name(path: Column) -> Column:
    """Name of the folder a file lies in, without the column name of a partition folder.

    Cut from the right: an unanchored pattern is tried at every character of the path, for every row.
    """
    return F.substring_index(F.substring_index(F.substring_index(path, "/", -2), "/", 1), "=", -1)


def logical_file_name() -> Column:
    """Name of the monthly file a row came from: the file, or the folder that a month was landed in."""
    parent = folder_name(F.col("_metadata.file_path"))
    return F.when(parent.rlike(r"\.csv(\.gz)?$"), parent).otherwise(F.col("_metadata.file_name"))


def layouts(spark: SparkSession, paths) -> dict[tuple[str, ...], list[str]]:
    """Header line → files.  One line per file is read, on the driver."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in data_files(spark, paths):
        groups.setdefault(header_of(spark, f), []).append(f)
    return groups


def _scan(spark: SparkSession, header: tuple[str, ...], files: list[str], schema: T.StructType, rejected_only: bool = False) -> DataFrame:
    slots = [f"_c{i}" for i in range(len(header))]  # a header may repeat a name
    text = T.StructType([T.StructField(s, T.StringType(), True) for s in [*slots, _CORRUPT]])
    # Without pruning in the parser: it must see every field to notice that a row is short.
    df = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
          .option("columnNameOfCorruptRecord", _CORRUPT).csv(files))
    at = {}
    for i, name in enumerate(header):
        at.setdefault(name.lower(), slots[i])
    cols, bad = [], []
    for f in schema.fields:
        slot = at.get(f.name.lower())
        raw = F.col(slot) if slot else F.lit(None).cast("string")
        value = convert(raw, f.dataType)
        cols.append(value.alias(f.name, metadata=f.metadata))
        if slot and not isinstance(f.dataType, T.StringType):
            bad.append(F.when((F.trim(raw) != "") & value.isNull(), F.lit(f.name)))
    # More fields than names are ignored, fewer are not: count what is left between separators outside quotes.
    fields = F.size(F.split(F.regexp_replace(F.col(_CORRUPT), '"[^"]*"', ""), ","))
    bad.append(F.when(F.col(_CORRUPT).isNotNull() & (fields < len(header)), F.lit(SHORT)))
    bad, record = F.array_compact(F.array(*bad)), F.to_csv(F.struct(*[F.col(s) for s in slots]))
    if rejected_only:
        record = F.when(F.size(bad) > 0, record)
    return df.select(*cols, bad.alias(BAD), record.alias(RECORD), logical_file_name().alias(FILE))


def read_checked(spark: SparkSession, paths, service: str, schema: T.StructType | None = None,
                 rejected_records_only: bool = False) -> DataFrame:
    """Rows of all files under the declared schema, with ``bad_fields``, the ``record`` as CSV text and ``filename``.

    With ``rejected_records_only`` the record is written out for rows with a bad field alone.
    """
    schema = schema or RAW_SCHEMAS[service]
    out = None
    for header, files in sorted(layouts(spark, paths).items()):
        part = _scan(spark, header, files, schema, rejected_records_only)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"no data files under {paths}")
    return out


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without a bad field, with their ``filename``; rejected rows as filename, record, bad_fields)."""
    good = checked.where(F.size(BAD) == 0).drop(BAD, RECORD)
    return good, checked.where(F.size(BAD) > 0).select(FILE, RECORD, BAD)


def checked_audit(checked: DataFrame) -> DataFrame:
    """Per file: rows read, to load and rejected, and bad fields; one partial aggregate over the scan."""
    rejected = F.when(F.size(BAD) > 0, 1).otherwise(0)
    return checked.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows_read"), F.sum(1 - rejected).alias("rows_loaded"),
                                     F.sum(rejected).alias("rows_rejected"), F.sum(F.size(BAD)).alias("bad_fields"))
