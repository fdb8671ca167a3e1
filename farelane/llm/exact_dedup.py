"""Exact dedup by skew-safe combining (operator 3).

Method: copies are combined where they lie first (partial aggregate of each
map task), then the survivors of every (digest, salt) group are merged, then
the salt winners of a digest are merged globally.  The normalised text itself
is part of the grouping key at all three stages, so two texts are never
merged on a digest alone.  A group that holds a third of all rows reaches a
reducer as one row per map task, spread over the salts.

Defined cases: a null text counts as empty; empty texts are equal to each
other; a null ``doc_id`` is smaller than any id (a group without any id keeps
its null row); rows that repeat both id and text get the same answer each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import Scratch, ascii_lower

SALTS = 16


def sha_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _normalised(docs: DataFrame, digest) -> DataFrame:
    norm = ascii_lower(F.coalesce(docs["text"], F.lit("")))
    return docs.select(docs["doc_id"].alias("doc_id"), norm.alias("norm")).withColumn("dig", digest(F.col("norm")))


def duplicate_groups(docs: DataFrame, salts: int = SALTS, digest=sha_digest) -> DataFrame:
    """One row per distinct normalised text: dig, norm, keep_id, group_size."""
    rows = _normalised(docs, digest)
    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
              .groupBy("dig", "salt", "norm")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # Dealt by digest alone, so the per-digest step below needs no second exchange.
    return (salted.repartition("dig").groupBy("dig", "norm")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))


def exact_dedup(docs: DataFrame, salts: int = SALTS, digest=sha_digest) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Members learn their group through the digest.  Where different texts share
    one digest (``variants`` over 1), they are matched on the full text instead.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    groups = duplicate_groups(docs, salts, digest)
    groups = groups.withColumn("variants", F.count(F.lit(1)).over(Window.partitionBy("dig")))
    groups = scratch.cut(groups.withColumn("norm", F.when(F.col("variants") > 1, F.col("norm"))))

    members = _normalised(docs, digest)
    sha = F.sha2("norm", 256).alias("text_sha256")
    alone = groups.where("variants = 1").select("dig", "keep_id", "group_size")
    out = members.select("doc_id", "dig", sha).join(alone, "dig")
    clashing = groups.where("variants > 1").select("dig", "norm", "keep_id", "group_size")
    if clashing.limit(1).count():
        exact = members.join(clashing, ["dig", "norm"]).select(
            "dig", "doc_id", sha, "keep_id", "group_size")
        out = out.unionByName(exact)
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, one per distinct text, with their own columns."""
    marks = exact_dedup(docs, **options).where("kept").select("doc_id", "text_sha256").distinct()
    keyed = docs.withColumn("__sha", F.sha2(ascii_lower(F.coalesce(docs["text"], F.lit(""))), 256))
    marks = marks.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__mark"))
    kept = keyed.join(marks, keyed["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__mark")),
                      "left_semi")
    return kept.dropDuplicates(["doc_id", "__sha"]).select(*docs.columns)
