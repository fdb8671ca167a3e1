"""Approximate nearest neighbours (operator 13): NN-descent graph, greedy graph search, Euclidean distance.

Method: equal vectors are one vertex (copies would fill each other's lists and cut the graph apart).  The graph starts
from the nearest of two random groups and improves by NN-descent: the neighbours and reverse neighbours of a vertex are
introduced to each other, a pair of which at least one link is new is measured once, and each vertex keeps its
``degree`` nearest, until fewer than ``settle`` of all links change or ``rounds`` passed.  A round is a Spark
join of links with vectors, blocked: a block of centres gets each vector it needs once, however many of its
links ask for it.  All links take part; the reverse links of a hub are dealt into tiles of ``TILE`` links that meet the hub's
own neighbours each, so no task gets a hub's whole fan-in.

Queries walk the graph in blocks: each round expands every unexpanded vertex among a query's ``beam`` nearest, measures
the vertices behind its links (again a join, each vector once per block) and stops when nothing in the beam is
unexpanded.  A walk starts from ``LANDMARKS`` fixed vertices (a bounded sample, dealt by hash) and, if the query's vector is itself
a vertex, from there.  The walk's graph keeps, besides each vertex's own links, its ``2 * degree`` nearest reverse links.

The answer is approximate in which vertices it finds; the distances are exact (double precision on the original
components), copies of a found vector all count, and ties go to the smaller id.

Defined cases: a vector that is null, empty or zero or that holds null or non-finite components takes no part, nor does a row without
``vec_id``; rows that repeat an id are one row, with the least vector.  Vectors of different length are never
neighbours.  With fewer than ``k`` candidates all that are found return.  An empty table gives no rows.  Other columns, whatever
their names, are ignored.  Negative zero equals zero.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import Scratch, shuffle_parts

DEGREE = 24       # neighbours kept per vertex
ROUNDS = 10       # most NN-descent rounds
SETTLE = 0.05     # share of links that may still change when the graph is done
TILE = 48         # reverse links of a vertex that are introduced to each other at once
GROUP = 256       # vertices of a random starting group
BEAM = 256        # nearest vertices a walk keeps
LANDMARKS = 64    # vertices every walk starts from
QUERY_BLOCK = 32  # queries that walk together
BLOCK_BYTES = 96 << 20  # vectors of one block of centres, at most
QUERY_MOD = 100


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, all components present and finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def vectors(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec): one row per id, components as doubles."""
    v = F.transform(table[vector], lambda x: x.cast("double") + F.lit(0.0))
    return (table.where(usable(table[vector]) & table[id_col].isNotNull())
            .select(table[id_col].cast("long").alias("vec_id"), v.alias("vec"))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.array(column.tolist(), dtype=dtype).reshape(len(column), -1)


def padded(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of one matrix, shorter ones filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == sizes[0]).all():
        return values[offsets[0]:offsets[-1]].reshape(len(sizes), -1)
    out = np.zeros((len(sizes), sizes.max(initial=0)), dtype=values.dtype)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[rows, :size] = values[offsets[rows][:, None] + np.arange(size)]
    return out


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by components, so that equal vectors are at exactly 0."""
    out = np.empty((len(a), len(b)))
    step = max(1, (4 << 20) // max(1, a.shape[0] * a.shape[1]))
    for i in range(0, len(b), step):
        out[:, i:i + step] = ((a[:, None] - b[None, i:i + step]) ** 2).sum(axis=2)
    return out


def nearest_of(ids: np.ndarray, x: np.ndarray, k: int):
    """(u, w, d): the k nearest of every vertex within one group."""
    sq = (x * x).sum(axis=1)
    d = np.maximum(sq[:, None] + sq[None] - 2 * (x @ x.T), 0)
    np.fill_diagonal(d, np.inf)
    k = min(k, len(ids) - 1)
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    return np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(d, near, 1).ravel()


def best(u: np.ndarray, w: np.ndarray, d: np.ndarray, k: int):
    """The k nearest distinct w of every u."""
    order = np.lexsort((w, u))
    u, w, d = u[order], w[order], d[order]
    first = np.ones(len(u), dtype=bool)
    first[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    u, w, d = u[first], w[first], d[first]
    order = np.lexsort((w, d, u))
    u, w, d = u[order], w[order], d[order]
    starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.r_[starts, len(u)])
    keep = np.arange(len(u)) - np.repeat(starts, sizes) < k
    return u[keep], w[keep], d[keep]


LINKS = "u long, w long, d float"


def _links(u, w, d) -> pd.DataFrame:
    return pd.DataFrame({"u": u, "w": w, "d": d.astype(np.float32)})


def first_graph(scratch: Scratch, vertices: DataFrame, degree: int, n: int) -> DataFrame:
    """Links to the nearest of two random groups of about ``GROUP`` vertices; one grouping alone would be closed in itself."""
    groups = max(1, n // GROUP)

    def group_links(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["id"].to_numpy(), matrix(pdf["vec"], np.float32)
        parts = [nearest_of(ids[i:i + 4 * GROUP], x[i:i + 4 * GROUP], degree) for i in range(0, len(ids), 4 * GROUP)
                 if len(ids[i:i + 4 * GROUP]) > 1]
        return _links(*[np.concatenate(p) for p in zip(*parts)]) if parts else _links(*[np.zeros(0, dtype=np.int64)] * 3)

    dealt = vertices.select("id", "vec", F.size("vec").alias("dim"), F.explode(F.array(F.lit(0), F.lit(1))).alias("deal"))
    dealt = dealt.withColumn("g", F.pmod(F.xxhash64("id", "deal"), F.lit(groups)))
    links = dealt.groupBy("dim", "deal", "g").applyInPandas(group_links, LINKS)
    return scratch.cut(nearest_links(links.withColumn("fresh", F.lit(True)), degree))


def nearest_links(links: DataFrame, degree: int) -> DataFrame:
    """Each vertex's ``degree`` nearest distinct links; one that was there before is not fresh."""
    once = links.groupBy("u", "w").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "w"))
    return once.withColumn("r", rank).where(F.col("r") <= degree).drop("r")


def introductions(links: DataFrame, tile: int) -> DataFrame:
    """(centre, tile, other, fresh): whom a vertex introduces to each other, its own neighbours in every tile."""
    back = links.select(F.col("w").alias("centre"), F.col("u").alias("other"), "fresh")
    hubs = back.groupBy("centre").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).select(
        "centre", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    own = links.select(F.col("u").alias("centre"), F.col("w").alias("other"), "fresh")
    own = own.join(hubs, "centre", "left").select(
        "centre", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)).alias("tile"), "other", "fresh")
    back = back.join(hubs, "centre", "left").select(
        "centre", F.pmod(F.xxhash64("other"), F.coalesce("tiles", F.lit(1))).cast("int").alias("tile"), "other", "fresh")
    return own.unionByName(back)


def descend(scratch: Scratch, links: DataFrame, vertices: DataFrame, degree: int, blocks: int) -> DataFrame:
    """One NN-descent round: the links after all introductions, fresh where they are new."""
    meet = introductions(links, TILE).withColumn("block", F.pmod(F.xxhash64("centre", "tile"), F.lit(blocks)).cast("int"))
    meet = scratch.cut(meet)
    far = links.groupBy(F.col("u").alias("id")).agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("n"))
    known = vertices.join(far, "id").select("id", "vec", F.when(F.col("n") < degree, float("inf")).otherwise(F.col("far")).alias("far"))
    needed = meet.select("block", F.col("other").alias("id")).distinct().join(known, "id").select(F.col("block").alias("part"), "id", "vec", "far")

    def introduce(meet_rows: pa.Table, vec_rows: pa.Table) -> pa.Table:
        order = np.argsort(vec_rows["id"].to_numpy())
        ids, far = vec_rows["id"].to_numpy()[order], vec_rows["far"].to_numpy()[order]
        x = padded(vec_rows["vec"])[order]  # all vectors of a centre have one length
        sq = (x * x).sum(axis=1)
        centre, tile, other, fresh = (meet_rows[c].to_numpy() for c in ("centre", "tile", "other", "fresh"))
        by_tile = np.lexsort((tile, centre))
        centre, tile, fresh = centre[by_tile], tile[by_tile], fresh[by_tile]
        at = np.searchsorted(ids, other[by_tile])
        cuts = np.flatnonzero(np.r_[True, (centre[1:] != centre[:-1]) | (tile[1:] != tile[:-1]), True])
        found, held, kept = [], 0, [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if not fresh[a:b].any():
                continue
            c, where = np.unique(at[a:b], return_inverse=True)
            new = np.zeros(len(c), dtype=bool)
            np.logical_or.at(new, where, fresh[a:b])
            d = np.maximum(sq[c][:, None] + sq[c][None] - 2 * (x[c] @ x[c].T), 0)
            want = (new[:, None] | new[None]) & (d < far[c][:, None])
            np.fill_diagonal(want, False)
            i, j = np.nonzero(want)
            found.append((ids[c[i]], ids[c[j]], d[i, j]))
            held += len(i)
            if held > 1_000_000:  # bound what is held: only the nearest of each vertex can enter its list
                kept = best(*[np.concatenate(p) for p in zip(kept, *found)], degree)
                found, held = [], 0
        u, w, d = best(*[np.concatenate(p) for p in zip(kept, *found)], degree)
        return pa.table({"u": u, "w": w, "d": d.astype(np.float32)})

    offers = meet.groupBy("block").cogroup(needed.groupBy("part")).applyInArrow(introduce, LINKS)
    both = links.select("u", "w", "d", F.lit(False).alias("fresh")).unionByName(offers.withColumn("fresh", F.lit(True)))
    out = scratch.cut(nearest_links(both, degree))
    scratch.drop(meet)
    return out


def build_graph(scratch: Scratch, vertices: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, settle: float = SETTLE) -> DataFrame:
    """(u, w, d): links of every vertex to about its ``degree`` nearest (squared distance)."""
    vertices = vertices.select("id", F.col("vec").cast("array<float>").alias("vec"))
    size = vertices.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    n, dim = size[0], size[1] or 1
    centres = max(16, BLOCK_BYTES // (4 * dim * 2 * TILE))
    blocks = max(shuffle_parts(scratch.spark), -(-n // centres))
    links = first_graph(scratch, vertices, degree, n)
    for _ in range(rounds):
        after = descend(scratch, links, vertices, degree, blocks)
        scratch.drop(links)
        links = after
        changed = links.agg(F.avg(F.col("fresh").cast("int"))).first()[0]
        if changed is None or changed <= settle:
            break
    return links


def walk_graph(scratch: Scratch, links: DataFrame, degree: int) -> DataFrame:
    """(id, near): links both ways, the reverse ones of a vertex its ``2 * degree`` nearest."""
    rank = F.row_number().over(Window.partitionBy("w").orderBy("d", "u"))
    back = links.withColumn("r", rank).where(F.col("r") <= 2 * degree).select(F.col("w").alias("id"), F.col("u").alias("n"))
    both = links.select(F.col("u").alias("id"), F.col("w").alias("n")).unionByName(back)
    return scratch.cut(both.groupBy("id").agg(F.collect_set("n").alias("near")))


WALK = "block int, q long, vec array<double>, pool array<struct<d: double, id: long, done: boolean>>"


def _walk(state: pd.DataFrame, vec_pdf: pd.DataFrame, beam: int) -> pd.DataFrame:
    """One round of a block of queries: what they expanded is done, measured vertices enter their beams."""
    ids = vec_pdf["id"].to_numpy(dtype=np.int64)
    dims = vec_pdf["vec"].map(len).to_numpy()
    pools, marks = [], state["vec"].map(len).to_numpy()
    measured = {}
    for dim in np.unique(marks):
        same = np.flatnonzero(dims == dim)
        if len(same):
            measured[dim] = (ids[same], squares(matrix(state["vec"][marks == dim]), matrix(vec_pdf["vec"].iloc[same])))
    row_of = dict.fromkeys(measured, 0)
    for dim, pool in zip(marks, state["pool"]):
        old = [(p["d"], p["id"]) for p in pool]
        known = {i for _, i in old}
        if dim in measured:
            near_ids, d = measured[dim]
            d = d[row_of[dim]]
            row_of[dim] += 1
            few = np.argpartition(d, beam)[:beam + 1] if len(d) > beam + 1 else np.arange(len(d))
            fresh = [(x, i) for x, i in zip(d[few].tolist(), near_ids[few].tolist()) if i not in known]
        else:
            fresh = []
        pools.append([{"d": x, "id": i, "done": i in known} for x, i in sorted(old + fresh)[:beam]])
    return pd.DataFrame({"block": state["block"], "q": state["q"], "vec": state["vec"], "pool": pools})


def walk(scratch: Scratch, queries: DataFrame, near: DataFrame, vertices: DataFrame, beam: int = BEAM) -> DataFrame:
    """(q, vec, pool): the ``beam`` nearest vertices that a greedy walk of every query (q, vec) finds."""
    n = queries.count()
    if not n:
        return queries.sparkSession.createDataFrame([], WALK)
    blocks = max(1, -(-n // QUERY_BLOCK))
    # Fixed starting points: a bounded sample of the vertices, the same for every query.
    marks = [r[0] for r in vertices.orderBy(F.xxhash64("id"), "id").limit(LANDMARKS).select("id").collect()]
    state = queries.select(F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"), "q", "vec",
                           F.from_json(F.lit("[]"), "array<struct<d: double, id: long, done: boolean>>").alias("pool"))
    state = scratch.cut(state)
    seeds = state.select("block").distinct().select("block", F.explode(F.array(*[F.lit(m).cast("long") for m in marks])).alias("id"))
    seeds = seeds.unionByName(state.join(vertices.select(F.col("id").alias("q")), "q", "left_semi").select("block", F.col("q").alias("id")))
    seen = state.select("block", F.lit(None).cast("long").alias("id")).limit(0)
    while True:
        # A block measures a vertex once, in the round that first reaches it.
        wanted = scratch.cut(seeds.distinct().join(seen, ["block", "id"], "left_anti"))
        seen = seen.unionByName(wanted)
        measured = wanted.join(vertices, "id").select(F.col("block").alias("part"), "id", "vec")
        old = state
        state = scratch.cut(state.groupBy("block").cogroup(measured.groupBy("part")).applyInPandas(lambda s, v: _walk(s, v, beam), WALK))
        scratch.drop(old)
        # What entered a beam in this round is expanded in the next.
        entered = state.select("block", F.explode(F.filter("pool", lambda p: ~p["done"])).alias("p")).select("block", F.col("p.id").alias("id"))
        if not entered.limit(1).count():
            return state
        seeds = entered.distinct().join(near, "id").select("block", F.explode("near").alias("id"))


def search(table: DataFrame, is_query, k: int = 10, beam: int = BEAM, degree: int = DEGREE, id_col: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows found for every row that ``is_query`` picks by id."""
    scratch = Scratch(table.sparkSession, "ann")
    rows = scratch.cut(vectors(table, id_col, vector))
    # Copies of a vector: one vertex, of which the k + 1 smallest ids can appear in an answer.
    copies = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    copies = scratch.cut(copies.withColumn("id", F.min("vec_id").over(Window.partitionBy("vec"))))
    vertices = scratch.cut(copies.where("r = 1").select("id", "vec"))
    near = walk_graph(scratch, build_graph(scratch, vertices, degree), degree)
    asked = scratch.cut(rows.where(is_query(F.col("vec_id"))).join(vertices, "vec").select("vec_id", "id"))
    starts = asked.select("id").distinct().join(vertices, "id").select(F.col("id").alias("q"), "vec")
    found = walk(scratch, starts, near, vertices, beam)
    # The query's own vertex comes with distance 0; k others suffice.
    pools = found.select("q", F.explode(F.slice("pool", 1, k + 1)).alias("p")).select("q", "p.id", "p.d")
    rows_found = pools.join(copies.select("id", "vec_id"), "id").select("q", "vec_id", "d")
    rows_found = rows_found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))).where(F.col("r") <= k + 1)
    pairs = asked.select(F.col("vec_id").alias("query_id"), F.col("id").alias("q")).join(rows_found, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    out = pairs.withColumn("rank", rank).where(F.col("rank") <= k)
    return scratch.finish(out.select("query_id", "rank", "vec_id", F.sqrt("d").alias("score")))
