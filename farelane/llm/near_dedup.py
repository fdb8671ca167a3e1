"""MinHash near-duplicate detection (operator 5).

Method: many universal hash minima per shingle set, banded into buckets;
candidates are verified on their signatures, then on their full sets; the
components of the links come from alternating large-star and small-star.

Documents with the same shingle set are one node, so exact copies cost one
row each.  Links inside buckets are found by ``linkage`` (leader first, then
only across components), which keeps every component exact without all pairs.
With 26 bands of 5 minima a pair at similarity 0.85 shares no band with
probability 2e-7; the signature check drops a true link with probability 3e-7.

Defined cases: a null, empty or blank text has no shingles and is linked with
nothing; fewer than k words make one shingle; a null ``doc_id`` counts as larger than any id (a
component of such rows only has a null id, and its rows are kept); repeated rows
share their set and component; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm import linkage
from farelane.llm.common import Scratch, small_batches
from farelane.llm.shingles import MinHasher, band_keys, set_hash, shingle_sets

SHINGLE, BANDS, ROWS = 5, 26, 5
PERCENT = 85
NO_ID = (1 << 63) - 1
COLUMN_CHUNK = 4096
TILE_ROWS = 1024


def _sketch(k: int, hasher: MinHasher, rows: int):
    def run(batches):
        for b in batches:
            node, size, keys, sig = [], [], [], []
            for s in shingle_sets(b.column("text"), k):
                size.append(len(s))
                node.append(set_hash(s) if len(s) else None)
                signature = hasher.signature(s) if len(s) else None
                sig.append(signature.tobytes() if len(s) else None)
                keys.append(band_keys(signature, rows).view(np.int64).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("tkey"), pa.array(node, pa.binary()), pa.array(size, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                ["id", "tkey", "node", "n_shingles", "keys", "sig"])
    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            sets = [s.tobytes() for s in shingle_sets(b.column("text"), k)]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], ["node", "payload"])
    return run


def _similar(percent: int):
    def check(x: bytes, y: bytes) -> bool:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= percent * (len(a) + len(b) - both)
    return check


def _links_between(percent: int, tile: int = TILE_ROWS):
    """Exact intersections of anchors with all rows of a group, tile by tile, by products of 0/1 matrices over
    the shingles that both tiles have."""
    def run(payloads, comps, anchor):
        sets = [np.frombuffer(p, np.uint64) for p in payloads]
        size = np.array([len(s) for s in sets], np.int64)
        label = np.unique([c.hex() for c in comps], return_inverse=True)[1]

        def entries(rows):
            """(shingle, place in the tile) of a tile's rows, sorted by shingle."""
            shingle = np.concatenate([sets[r] for r in rows])
            order = np.argsort(shingle)
            return shingle[order], np.repeat(np.arange(len(rows)), size[rows])[order]

        def matrix(shingle, place, shared, n):
            m = np.zeros((n, len(shared)), np.float32)
            i, j = np.searchsorted(shingle, shared[0]), np.searchsorted(shingle, shared[-1], "right")
            col = np.searchsorted(shared, shingle[i:j])
            own = shared[col] == shingle[i:j]
            m[place[i:j][own], col[own]] = 1
            return m

        anchors, everything = np.flatnonzero(anchor), np.arange(len(sets))
        members = [everything[lo:lo + tile] for lo in range(0, len(sets), tile)]
        sides = [entries(rows) for rows in members]
        for lo in range(0, len(anchors), tile):
            one = anchors[lo:lo + tile]
            left = entries(one)
            for two, right in zip(members, sides):
                shared = np.intersect1d(left[0], right[0])
                both = np.zeros((len(one), len(two)), np.float32)
                for c in range(0, len(shared), COLUMN_CHUNK):
                    part = shared[c:c + COLUMN_CHUNK]
                    both += matrix(*left, part, len(one)) @ matrix(*right, part, len(two)).T
                both = both.astype(np.int64)
                linked = 100 * both >= percent * (size[one][:, None] + size[two][None, :] - both)
                linked &= label[one][:, None] != label[two][None, :]
                # A pair of anchors is met twice.
                linked &= ~anchor[two][None, :] | (one[:, None] < two[None, :])
                for i, j in zip(*np.nonzero(linked)):
                    yield int(one[i]), int(two[j])
    return run


def near_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """Per document: doc_id, tkey (hash of the text), n_shingles, component_id, keep_key (tkey of the one that stays)."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "near-dedup")
    hasher = MinHasher(bands * rows)
    base = docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(docs["text"]).alias("tkey"), docs["text"].alias("text"))
    sketch = scratch.cut(base.mapInArrow(
        _sketch(k, hasher, rows),
        "id long, tkey long, node binary, n_shingles long, keys array<long>, sig binary"), "none")
    nodes = scratch.cut(sketch.where("n_shingles > 0").groupBy("node").agg(
        F.min(F.struct("id", "tkey")).alias("carrier"), F.first("keys").alias("keys"), F.first("sig").alias("sig")),
        "none")
    buckets = scratch.cut(linkage.led_buckets(nodes.select("node", F.explode("keys").alias("key"))))

    # Full sets of the nodes that share a bucket with another: read again from one carrier text each.
    carriers = (buckets.select("node").distinct().join(nodes.select("node", "carrier"), "node")
                .select("node", "carrier.id", "carrier.tkey"))
    texts = base.join(carriers, ["id", "tkey"]).select("node", "text")
    sets = scratch.cut(texts.mapInArrow(_sets(k), "node binary, payload binary")
                       .groupBy("node").agg(F.first("payload").alias("payload")), "none")

    # Five standard deviations under the threshold, for this many minima.
    p = percent / 100
    least = p - 5 * (p * (1 - p) / (bands * rows)) ** 0.5

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([(np.frombuffer(i, np.uint32) == np.frombuffer(j, np.uint32)).mean() >= least
                          for i, j in zip(x, y)], dtype=bool)

    def signatures_agree(pairs):
        one = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
        two = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
        return pairs.join(one, "a").join(two, "b").where(close("sa", "sb")).select("a", "b")

    comps = linkage.link_nodes(buckets, sets, _similar(percent), _links_between(percent), scratch,
                               prefilter=signatures_agree)
    named = nodes.select("node", "carrier").join(comps, "node", "left")
    named = named.select("node", "carrier", F.coalesce("comp", "node").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("carrier").alias("least"))
    of_node = named.join(smallest, "comp").select("node", F.col("least.id").alias("component"),
                                                  F.col("least.tkey").alias("keep_key"))
    out = sketch.select("id", "tkey", "node", "n_shingles").join(of_node, "node", "left")
    back = lambda c: F.when(c != NO_ID, c)
    return scratch.finish(out.select(back(F.col("id")).alias("doc_id"), "tkey", "n_shingles",
                                     back(F.coalesce("component", "id")).alias("component_id"),
                                     F.coalesce("keep_key", "tkey").alias("keep_key")))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    return near_components(docs, **options).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_per_component(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay: the one with the smallest (id, hash of the text) of every component, own columns.

    A text that repeats under the same id stays once.  Documents without words are linked with nothing and stay.
    """
    kept = (near_components(docs, **options)
            .where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tkey") == F.col("keep_key")))
            .select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct())
    keyed = docs.withColumn("__tkey", F.xxhash64(docs["text"]))
    out = keyed.join(kept, keyed["doc_id"].cast("bigint").eqNullSafe(F.col("__id"))
                     & (F.col("__tkey") == F.col("__key")), "left_semi")
    return out.dropDuplicates(["doc_id", "__tkey"]).select(*docs.columns)
