"""Linking nodes that share buckets, without emitting all pairs of a bucket.

``link_nodes`` gets buckets (key, node) and payloads (node, payload) and a
check on payloads, and returns links whose connected components are those of
*all* checked pairs that share a bucket:

1. every node is checked against its bucket's leader (the smallest node);
2. the links' components are computed by alternating large-star / small-star;
3. in a bucket that still holds several components, every node outside the
   bucket's largest component is checked against all nodes of the bucket that
   belong to other components.  Pairs inside one component need no check, so a
   hot bucket whose nodes are alike costs one check per node.

Buckets are compared in chunk pairs of bounded bytes and rows, so neither a hot bucket
nor a large payload meets one task; from a chunk pair only a spanning set of links comes back.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import Scratch

CHUNK_BYTES = 4 << 20
CHUNK_ROWS = 2000
EDGES_PER_TASK = 200_000


# ------------------------------------------------------------------ components
def _stars_of_task(batches):
    """The components of a task's own links, each as a star around its smallest node."""
    parent: dict = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, find(x)) for x in list(parent)]
    yield pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["a", "b"])


def _are_stars(edges: DataFrame) -> bool:
    """Does every child have one parent, and is no parent a child?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    ends = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return not ends.where("child > 1 or child + parent > 1").limit(1).count()


def components(edges: DataFrame, scratch: Scratch, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(a, b) links → (node, comp): comp is the smallest node of the component; only linked nodes.

    Each round first joins what lies in one task (``edges_per_task`` links at most, whatever the
    input), then alternates large star and small star between the tasks, until only stars are left.
    """
    both = lambda df: df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct())
    while n := edges.count():
        local = scratch.cut(edges.coalesce(-(-n // edges_per_task)).mapInPandas(_stars_of_task, "a binary, b binary"))
        scratch.drop(edges)
        edges = local
        if _are_stars(edges):
            break
        # Large star: larger neighbours of a node go to its smallest neighbour (or itself).
        two = both(edges)
        least = two.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = scratch.cut(two.join(least, "a").where("b > a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = scratch.cut(large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        scratch.drop(large)
        scratch.drop(edges)
        edges = small
    return scratch.cut(edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
                       .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct())


# ------------------------------------------------------------------ checks
def checked_pairs(pairs: DataFrame, payloads: DataFrame, check) -> DataFrame:
    """The (a, b) pairs for which ``check(payload_a, payload_b)`` holds."""
    one = payloads.select(F.col("node").alias("a"), F.col("payload").alias("pa"))
    two = payloads.select(F.col("node").alias("b"), F.col("payload").alias("pb"))

    def run(batches):
        for batch in batches:
            ok = [check(x, y) for x, y in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(ok, pa.bool_()))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "pa", "pb").mapInArrow(run, "a binary, b binary")


def _spanning(pairs, comps: list) -> list[tuple[int, int]]:
    """Of links between rows, those that join two components not joined before."""
    parent: dict = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for i, j in pairs:
        a, b = find(comps[i]), find(comps[j])
        if a != b:
            parent[a] = b
            out.append((i, j))
    return out


def _compare(links_between):
    """Rows (members of one chunk pair) → spanning links across components."""
    def run(batches):
        for batch in batches:
            a, b = [], []
            rows = batch.column("rows")
            ends = rows.offsets.to_numpy().tolist()
            columns = [rows.values.field(c) for c in ("node", "comp", "payload")]
            anchors = np.asarray(rows.values.field("anchor").to_numpy(zero_copy_only=False), bool)
            for lo, hi in zip(ends, ends[1:]):
                nodes, comps, payloads = (c[lo:hi].to_pylist() for c in columns)
                found = links_between(payloads, comps, anchors[lo:hi])
                for i, j in _spanning(found, comps):
                    a.append(nodes[i])
                    b.append(nodes[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
    return run


def mixed_bucket_links(buckets: DataFrame, comps: DataFrame, payloads: DataFrame, links_between,
                       scratch: Scratch, chunk_bytes: int = CHUNK_BYTES, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Step 3.  ``links_between(payloads, comps, anchor)`` yields index pairs (i, j) that are linked, of
    different components and with at least one anchor."""
    rows = (buckets.select("key", "node").join(comps, "node", "left")
            .select("key", "node", F.coalesce("comp", "node").alias("comp")))
    rows = rows.join(payloads.select("node", F.octet_length("payload").alias("bytes")), "node")
    per_comp = rows.groupBy("key", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("x"))
    top = F.max(F.struct("n", "comp", "bytes"))
    mixed = (per_comp.groupBy("key").agg(top.alias("top"), F.count(F.lit(1)).alias("n_comps"), F.sum("n").alias("n"),
                                         F.sum("bytes").alias("bytes"), F.bit_xor("x").alias("x"))
             .where("n_comps > 1 and n > 2"))  # of two nodes one is the leader, checked already
    # Buckets of the same nodes are compared once.
    chunks = lambda size, n: F.ceil(F.greatest(size / chunk_bytes, n / chunk_rows)).cast("int")
    mixed = (mixed.groupBy("x", "n", "top").agg(F.min("key").alias("key"), F.first("bytes").alias("bytes"))
             .select("key", F.col("top.comp").alias("major"),
                     chunks(F.col("top.bytes"), F.col("top.n")).alias("major_chunks"),
                     chunks(F.col("bytes") - F.col("top.bytes"), F.col("n") - F.col("top.n")).alias("minor_chunks")))
    rows = rows.join(mixed, "key").withColumn("anchor", F.col("comp") != F.col("major"))
    chunk = F.when(F.col("anchor"), F.col("major_chunks") + F.pmod(F.xxhash64("node"), F.col("minor_chunks")))
    rows = rows.withColumn("chunk", chunk.otherwise(F.pmod(F.xxhash64("node"), F.col("major_chunks"))).cast("int"))
    majors = F.sequence(F.lit(0), F.col("major_chunks") - 1)
    minors = F.sequence(F.col("major_chunks"), F.col("major_chunks") + F.col("minor_chunks") - 1)
    pair = lambda x, y: F.struct(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"))
    others = F.filter(minors, lambda c: c != F.col("chunk"))
    targets = F.when(F.col("anchor"), F.transform(F.concat(majors, others), lambda c: pair(c, F.col("chunk"))))
    targets = targets.otherwise(F.transform(minors, lambda c: pair(c, F.col("chunk"))))
    dealt = rows.select("key", "node", "comp", "anchor", F.explode(targets).alias("to"))
    dealt = dealt.join(payloads, "node")
    groups = dealt.groupBy("key", "to").agg(F.collect_list(F.struct("node", "comp", "anchor", "payload")).alias("rows"))
    return scratch.cut(groups.select("rows").mapInArrow(_compare(links_between), "a binary, b binary"))


def link_nodes(buckets: DataFrame, payloads: DataFrame, check, links_between, scratch: Scratch,
               prefilter=None) -> DataFrame:
    """buckets (key, node, leader), payloads (node, payload) → (node, comp) of the linked nodes."""
    star = buckets.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    if prefilter is not None:
        star = prefilter(star)
    first = scratch.cut(checked_pairs(star, payloads, check))
    comps = components(first, scratch)
    second = mixed_bucket_links(buckets, comps, payloads, links_between, scratch)
    if not second.limit(1).count():
        return comps
    return components(first.unionByName(second), scratch)


def led_buckets(rows: DataFrame) -> DataFrame:
    """(key, node) → (key, node, leader) of the buckets with two nodes or more."""
    led = rows.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(led.drop("n"), "key")


