"""Filter interaction audit (operator 11): what every filter removes at every place of every order.

Method: min-plus removal ranks.  The rows of a part are told apart only by the set of filters they fail, so a
part is a weight vector over at most 2^F masks.  The mask matrix (0 where a mask fails a filter, infinite
elsewhere) is combined with the position matrix (the inverse permutation of every order) by minimum over the
filters: ``rank[mask, order] = min over f of (mask[m, f] + position[f, order])`` is the step that removes the mask.
Weighted scatter counts over these ranks give what is kept, removed and lost at each step; comparing a
filter's own position with the rank gives its redundant failures.

Texts are read once, in built-in functions; what is shuffled afterwards is a 32-byte digest, a mask and an id per
document.  Copies and labels are joined on narrow rows, every count is a partial aggregate, and one task gets at
most 2^F weight rows of a part.

Defined cases: a null text counts as empty, a null part as the empty string.  A document without words has no
repeated words and no upper-case share.  A row is a repeat if its text (whole, compared by SHA-256) also stands in
a row with a smaller ``doc_id``; rows with equal ids (a repeated row, a tie) are no repeats of each other, and a null id is neither smaller
nor larger than any.  Every row counts, repeated rows each for themselves; of several labels of a
document one that says so is enough, labels without id or document are ignored.  Texts of any length are read whole.  An
empty table gives no rows.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import UPPER, Scratch

REPEAT = "repeat"  # stands for the table-wide filter in a set of filters
MAX_FILTERS = 6    # all orders are reported: 720 of them
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def word_list(text: Column) -> Column:
    """Maximal runs of characters other than space and tab to carriage return."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")


def default_filters(text: Column) -> dict[str, Column | str]:
    """Failure conditions by letter: short, repetitive, shouting, markup, repeated."""
    words = word_list(text)
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {"A": n < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * n, "C": 100 * capitals > 5 * F.length(text),
            "D": text.rlike(r"[#$%&*|]"), "E": REPEAT}


def removal_ranks(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product: first step (from 1) at which an order removes a mask, or F + 1 if none does.

    ``masks`` is (m, F) boolean, ``positions`` (F, orders) the step of a filter in an order.
    """
    never = positions.shape[0] + 1
    gaps = np.where(masks, 0, never)
    return np.minimum((gaps[:, :, None] + positions[None]).min(axis=1), never)


def audit_tables(names: str):
    """Orders (as text), letters by order and step, and the position matrix of a set of filters."""
    orders = list(permutations(range(len(names))))
    letters = np.array(orders)
    positions = np.empty((len(names), len(orders)), dtype=np.int64)
    for f in range(len(names)):
        positions[f] = (letters == f).argmax(axis=1) + 1
    return ["".join(names[f] for f in o) for o in orders], letters, positions


def audit_part(names: str, masks: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of one part over all orders and steps; ``weights`` is (masks, 3): rows, good, toxic."""
    _, letters, positions = audit_tables(names)
    n_f, n_o = positions.shape
    failing = (masks[:, None] >> np.arange(n_f) & 1).astype(bool)
    rank = removal_ranks(failing, positions)
    lost = np.zeros((3, n_o, n_f + 2), dtype=np.int64)
    redundant = np.zeros((n_o, n_f), dtype=np.int64)
    at = np.arange(n_o)
    for m in range(len(masks)):
        lost[:, at, rank[m]] += weights[m][:, None]
        late = failing[m][letters] & (rank[m][:, None] < np.arange(1, n_f + 1))
        redundant += np.where(late, weights[m, 0], 0)
    lost = lost[:, :, 1:n_f + 1]
    alone = np.array([weights[masks == 1 << f, 0].sum() for f in range(n_f)], dtype=np.int64)
    share = np.array([lost[0][at, positions[f] - 1].sum() for f in range(n_f)], dtype=np.int64)
    return {"kept": weights[:, 0].sum() - lost[0].cumsum(axis=1), "removed": lost[0], "redundant": redundant,
            "unique_fails": alone[letters], "good_lost": lost[1], "toxic_lost": lost[2], "shapley": share[letters]}


def failure_weights(docs: DataFrame, labels: DataFrame, filters=None, part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): rows of every set of failed filters, bit k for the k-th filter."""
    scratch = Scratch(docs.sparkSession, "audit")
    text = F.coalesce(docs["text"], F.lit(""))
    filters = filters or default_filters(text)
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(filters.values()) if not isinstance(c, str)]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    repeat = next((1 << k for k, c in enumerate(filters.values()) if isinstance(c, str)), 0)
    rows = scratch.cut(docs.select(docs["doc_id"].alias("id"), F.coalesce(docs[part], F.lit("")).alias("part"),
                                   mask.cast("int").alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")))
    if repeat:
        # One row per text that several ids hold; a text of a third of all rows leaves each map task as one row.
        least = (rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                 .where(F.col("least") < F.col("most")).select("digest", "least"))
        rows = rows.join(least, "digest", "left").withColumn(
            "mask", F.col("mask") + F.when(F.col("least") < F.col("id"), repeat).otherwise(0))
    is_one = lambda c: F.max(F.when(labels[c] == 1, 1).otherwise(0))
    known = (labels.where(labels["doc_id"].isNotNull() & ((labels["quality"] == 1) | (labels["toxic"] == 1)))
             .groupBy(labels["doc_id"].alias("id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic")))
    out = (rows.select("id", "part", "mask").join(known, "id", "left").groupBy("part", "mask")
           .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    return scratch.finish(out)


def filter_audit(docs: DataFrame, labels: DataFrame, filters=None, part: str = "source") -> DataFrame:
    """One row per part, order of all filters and step: what is kept, removed, redundant and lost there.

    ``filters`` maps one-letter names to failure conditions on ``docs`` (or ``REPEAT`` for texts that a smaller id
    also has); by default the five of :func:`default_filters`.
    """
    names = "".join(filters or default_filters(docs["text"]))
    if len(names) > MAX_FILTERS or len(set(names)) != len(filters or names):
        raise ValueError(f"filters need one-letter names, {MAX_FILTERS} at most")

    def tables(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = audit_part(names, pdf["mask"].to_numpy(), pdf[["n", "good", "toxic"]].to_numpy(dtype=np.int64))
        orders, letters, _ = audit_tables(names)
        steps = np.tile(np.arange(1, len(names) + 1, dtype=np.int32), len(orders))
        return pd.DataFrame({"part": pdf["part"].iloc[0], "filter_order": np.repeat(orders, len(names)), "step": steps,
                             **{k: v.reshape(-1) for k, v in counts.items()}})

    return failure_weights(docs, labels, filters, part).groupBy("part").applyInPandas(tables, RESULT)
