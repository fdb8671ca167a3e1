"""Exact top-k inner-product search by no-random-access aggregation (operator 9).

Method: every block of candidates is indexed as one sorted list per dimension.
A query reads the lists in order, from the top where its own component is
positive and from the bottom where it is negative; what it has read gives a
lower and an upper bound of every candidate's score.  Candidates whose upper
bound is under the k-th best lower bound cannot qualify; reading stops when
the survivors are few or the lists end, and only the survivors' final scores are resolved.

The queries are a stated set, held in blocks; every query block meets every
candidate block once (an equi-join on the block number), and the k best per
block are merged per query by a ranked group limit.

Defined cases: vectors that are null, empty or hold null or non-finite components take no
part; vectors are only compared with vectors of the same length; a query is
never its own candidate (rows that repeat its id are left out too); equal scores rank by smaller id; repeated candidate rows count once
per id and vector; a null id takes no part; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import Scratch

K, QUERY_MOD, SCALE = 5, 50, 256.0
BLOCK_ROWS, QUERY_ROWS = 4096, 512
STEPS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: float) -> DataFrame:
    """id and floor(scale * x) of every usable vector; a repeated (id, vector) row counts once."""
    v = F.col("v")
    usable = F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(usable).select("id", F.transform(v, lambda x: F.floor(x * scale).cast("bigint")).alias("v"))
            .distinct())


def _blocked(rows: DataFrame, block_rows: int, scratch: Scratch) -> DataFrame:
    """Rows (id, v) → one row per block: dim, block, ids and vectors as packed arrays."""
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    blocks = sizes.select("dim", F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1)).cast("int").alias("blocks"))
    placed = rows.withColumn("dim", F.size("v")).join(blocks, "dim")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        m = np.array(frame["v"].tolist(), np.int64)
        return pd.DataFrame({"dim": frame["dim"].iloc[:1], "blocks": frame["blocks"].iloc[:1],
                             "block": frame["block"].iloc[:1],
                             "ids": [frame["id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()]})
    return scratch.cut(placed.groupBy("dim", "block").applyInPandas(
        pack, "dim int, blocks int, block int, ids binary, m binary"))


class SortedLists:
    """One block's index: per dimension the candidates in descending order of their component."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        order = np.argsort(-matrix, axis=0, kind="stable")
        self.values = np.take_along_axis(matrix, order, axis=0).astype(np.float64)
        self.place = np.empty_like(order)                       # of every candidate in every list
        np.put_along_axis(self.place, order, np.arange(len(ids))[:, None], axis=0)

    def bounds(self, depth: int, up: np.ndarray, down: np.ndarray):
        """Lower and upper score bounds (queries x candidates) after ``depth`` entries of every list.

        An entry read counts as it is; one not read yet lies between the list's end and the last value
        read.  Lists are read from the top for the query's positive parts, from the bottom for the negative ones.
        """
        n, m = len(self.ids), self.matrix
        top, bottom = self.place < depth, self.place >= n - depth
        first, last = self.values[0], self.values[-1]
        if depth >= n:
            exact = up @ m.T + down @ m.T
            return exact, exact
        upper = up @ np.where(top, m, self.values[depth - 1]).T + down @ np.where(bottom, m, self.values[n - depth]).T
        lower = up @ np.where(top, m, last).T + down @ np.where(bottom, m, first).T
        return lower, upper

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """Yields (query row, candidate rows, scores) with at least the k best of every query."""
        n = len(self.ids)
        up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        own = query_ids[:, None] == self.ids[None, :]
        for step in STEPS:
            depth = max(1, min(n, int(np.ceil(n * step))))
            lower, upper = self.bounds(depth, up, down)
            lower = np.where(own, -np.inf, lower)
            kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(lower), -np.inf)
            can = (upper >= kth[:, None]) & ~own
            if depth == n or can.sum() <= 4 * k * len(queries):
                break
        query, row = np.nonzero(can)
        cuts = np.searchsorted(query, np.arange(len(queries) + 1))
        for j in range(len(queries)):
            rows = row[cuts[j]:cuts[j + 1]]
            yield j, rows, self.matrix[rows] @ queries[j]       # final scores, in integers


def _search(k: int):
    def run(batches):
        for b in batches:
            out = []
            for dim, ids, m, qids, qm in zip(b["dim"], b["ids"], b["m"], b["qids"], b["qm"]):
                ids, qids = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64)
                lists = SortedLists(ids, np.frombuffer(m, np.int64).reshape(-1, dim))
                for j, rows, scores in lists.search(qids, np.frombuffer(qm, np.int64).reshape(-1, dim), k):
                    first = np.lexsort((ids[rows], -scores))[:k]
                    out.append(pd.DataFrame({"query_id": qids[j], "vec_id": ids[rows][first], "score": scores[first]}))
            if out:
                yield pd.concat(out)
    return run


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector: str = "embedding",
          scale: float = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best; ``is_query`` maps the id to a condition."""
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.cut(quantised(vectors, id_col, vector, scale))
    candidates = _blocked(rows, block_rows, scratch)
    queries = _blocked(rows.where(is_query(F.col("id"))), query_rows, scratch)
    shape = candidates.select("dim", "blocks").distinct().withColumnRenamed("blocks", "n")
    asked = (queries.join(shape, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"),
        F.col("ids").alias("qids"), F.col("m").alias("qm")))
    # Dealt by block pair, so a block's work spreads over the tasks.
    met = candidates.join(asked, ["dim", "block"]).select("dim", "ids", "m", "qids", "qm")
    met = met.repartition(max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))),
                          F.xxhash64("ids"), F.xxhash64("qids"))
    found = met.mapInPandas(_search(k), "query_id long, vec_id long, score long")
    # Each task passes on k rows of a query at most (group limit before the exchange).
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
