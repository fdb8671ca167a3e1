"""Packing into optimal length buckets (operator 7).

Method: the histogram of lengths over all documents goes through a dynamic
programme that chooses the bucket boundaries with the least padding; inside a
bucket, documents in length order are cut into batches that hold at most
``token_budget`` tokens after padding to the bucket's boundary.

The histogram is one aggregate over exact lengths.  D different lengths need at least D * D / 2 words in all, so
10**13 words bound it by 4.5 million rows.  Batch numbers come from counts: documents of one length are dealt
over ``CHUNKS`` hashed id classes, the counts per (length, class) are summed up, and
only inside one class is a row number taken, so a length that a third of all
documents share is numbered by many tasks.

Defined cases: a null or empty text has length 0; a null ``doc_id`` belongs to
class -1; a document longer than the budget is a batch of its own; rows that
repeat id and length are placed one after another; very long texts keep their exact length; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 8
TOKEN_BUDGET = 16384
CHUNKS = 1021
# Prime and factor of the id hash.
PRIME, STEP = 2147483647, 48271


def word_length(text: Column) -> Column:
    """Length of a text in words, null → 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_class(doc_id: Column, chunks: int) -> Column:
    """Class of an id: a multiplicative step modulo a prime, so ids with a common divisor spread; null → -1."""
    return F.coalesce(F.pmod(F.pmod(doc_id, F.lit(PRIME)) * STEP % PRIME, F.lit(chunks)), F.lit(-1)).cast("int")


def optimal_boundaries(lengths, counts, buckets: int) -> list[int]:
    """Upper ends (inclusive) of at most ``buckets`` buckets with the least total padding.

    best[k][j]: least padding of the first j lengths in k buckets.  The cost of a bucket obeys the
    quadrangle inequality, so the best last cut moves right with j and each layer is found by
    divide and conquer, all midpoints of one depth at once.  Of equal cuts the leftmost is taken.
    """
    order = np.argsort(np.asarray(lengths))
    length = np.asarray(lengths, np.int64)[order]
    count = np.asarray(counts, np.int64)[order]
    n = len(length)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(count)])
    mass = np.concatenate([[0], np.cumsum(count * length)])

    def cost(i, j):  # lengths i..j-1 padded to length[j-1]
        return length[j - 1] * (total[j] - total[i]) - (mass[j] - mass[i])

    k = min(buckets, n)
    best = np.array([0] + [cost(0, j) for j in range(1, n + 1)], np.int64)
    cuts = [np.zeros(n + 1, np.int64)]
    for layer in range(1, k):
        nxt, cut = np.full(n + 1, np.iinfo(np.int64).max // 4, np.int64), np.zeros(n + 1, np.int64)
        lo, hi = np.array([layer + 1]), np.array([n])
        left, right = np.array([layer]), np.array([n - 1])
        while len(lo):
            j = (lo + hi) // 2
            width = np.minimum(right, j - 1) - left + 1
            first = np.cumsum(width) - width
            i = np.arange(int(width.sum())) - np.repeat(first - left, width)
            c = best[i] + cost(i, np.repeat(j, width))
            least = np.minimum.reduceat(c, first)
            hits = np.flatnonzero(c == np.repeat(least, width))
            at = i[hits[np.searchsorted(hits, first)]]
            nxt[j], cut[j] = least, at
            lo, hi, left, right = (np.concatenate(x) for x in (
                (lo, j + 1), (j - 1, hi), (left, at), (at, right)))
            open_ = lo <= hi
            lo, hi, left, right = lo[open_], hi[open_], left[open_], right[open_]
        best, _ = nxt, cuts.append(cut)
    ends, j = [], n
    for layer in range(k - 1, -1, -1):
        ends.append(int(length[j - 1]))
        j = int(cuts[layer][j])
    return ends[::-1]


def length_histogram(rows: DataFrame) -> DataFrame:
    return rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, chunks: int = CHUNKS,
         length=word_length) -> DataFrame:
    """Per document: doc_id, n_tokens, bucket, boundary, batch, padding.

    ``batch`` counts from 0 inside a bucket, in order of length, then id class, then id.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    rows = docs.select(docs["doc_id"].alias("doc_id"), length(docs["text"]).alias("n_tokens"))
    rows = scratch.cut(rows)
    hist = length_histogram(rows).toPandas()  # different lengths only, see the module's head
    ends = optimal_boundaries(hist["n_tokens"], hist["n_docs"], buckets)
    if not ends:
        ends = [0]
    bounds = F.array(*[F.lit(e).cast("bigint") for e in ends])
    bucket = F.size(F.filter(bounds, lambda e: e < F.col("n_tokens")))
    rows = (rows.withColumn("bucket", bucket)
            .withColumn("boundary", F.element_at(bounds, F.col("bucket") + 1))
            .withColumn("class", id_class(F.col("doc_id"), chunks)))

    # Documents of the bucket that come before a (length, class): two sums over counts.
    per_class = rows.groupBy("bucket", "n_tokens", "class").agg(F.count(F.lit(1)).alias("n"))
    per_class = scratch.cut(per_class)
    per_length = per_class.groupBy("bucket", "n_tokens").agg(F.sum("n").alias("n"))
    before_length = per_length.select("bucket", "n_tokens", (F.sum("n").over(
        Window.partitionBy("bucket").orderBy("n_tokens")) - F.col("n")).alias("shorter"))
    before_class = per_class.select("bucket", "n_tokens", "class", (F.sum("n").over(
        Window.partitionBy("bucket", "n_tokens").orderBy("class")) - F.col("n")).alias("earlier"))
    own = F.row_number().over(Window.partitionBy("bucket", "n_tokens", "class").orderBy("doc_id")) - 1
    ranked = (rows.withColumn("own", own)
              .join(before_class, ["bucket", "n_tokens", "class"])
              .join(before_length, ["bucket", "n_tokens"]))
    per_batch = F.greatest(F.floor(F.lit(token_budget) / F.greatest("boundary", F.lit(1))), F.lit(1))
    rank = F.col("shorter") + F.col("earlier") + F.col("own")
    return ranked.select("doc_id", "n_tokens", "bucket", "boundary",
                         F.floor(rank / per_batch).cast("bigint").alias("batch"),
                         (F.col("boundary") - F.col("n_tokens")).alias("padding"))
