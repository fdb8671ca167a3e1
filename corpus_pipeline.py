"""Corpus pipeline: language ID, line dedup, near dedup, substring dedup, packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``, works on every
document its predecessor kept and returns a DataFrame, which is written as Parquet and reread
as the next one's ``docs``.  All but the last return the columns of ``documents``; ``n_chars``
follows the text.  Null, empty and repeated rows are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import language_id, line_dedup, near_dedup, packing, substring_dedup
from farelane.llm.common import Scratch

# Near-duplicate stage: 5-word shingles at a similarity of 0.8; a pair at 0.8 shares none of
# 40 bands of 5 minima with probability 1e-7.
NEAR_PERCENT, NEAR_BANDS = 80, 40

ORACLE_SQL = None  # language ID and the near copies of lines have no SQL form; tests/llm compares with brute force


def _sized(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no learned language: without a letter, or mostly of 3-grams that none of them uses."""
    model = language_id.train(docs)
    # Names of their own, so that no column can clash with the answer's.
    names = {c: "text" if c == "text" else f"column{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[docs[c].alias(n) for c, n in names.items()])
    judged = language_id.predict(named, model, carry=names.values())
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("unfamiliar") <= (model.limit if model else 1.0)))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one occurrence of every line and its near-identical variants."""
    return _sized(line_dedup.remove_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every near-duplicate component."""
    return near_dedup.one_per_component(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 13 words or more that an earlier document has."""
    return _sized(substring_dedup.remove_substrings(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of what is left."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_passages),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
