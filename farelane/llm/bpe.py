"""Byte-level BPE by monoid tree reduction (operator 6).

Method: a piece of text is encoded by halves, recursively, and two encoded
neighbours are joined by re-encoding a window of tokens around the boundary.
The window grows until its first and last token come out as they were: an
encoding is valid exactly if every two adjacent tokens are, so from there on
nothing outside can change.  Decoding concatenates the tokens' bytes up the
same kind of tree.

Texts are cut by the tokenizer's own pattern first and every match is encoded
by itself.  The rank file is read once on the driver (its size is fixed by the vocabulary) and
broadcast; the work runs in Arrow batches with a bounded cache of pieces.

Defined cases: a null text is an empty one and gives no tokens; repeated rows give equal results; any
length of text or piece works (long texts are cut match by match, long pieces by the
tree); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from farelane.llm.common import small_batches

LEAF = 24            # bytes that are merged directly
CACHE_PIECES = 300_000
LONG_TEXT = 1 << 20  # characters beyond which matches are taken in portions
PORTION = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _merge_small(piece: bytes, ranks: dict) -> list[bytes]:
    """Merge the adjacent pair of lowest rank, leftmost first, until no pair is a token."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = 1 << 60
    pair = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pair:
        least = min(pair)
        if least == none:
            break
        i = pair.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return parts


def _merge_large(piece: bytes, ranks: dict) -> list[bytes]:
    """The same merges with a heap over a linked list, for long windows."""
    n = len(piece)
    token = [piece[i:i + 1] for i in range(n)]
    prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i):
        j = nxt[i]
        if j < n:
            both = token[i] + token[j]
            rank = ranks.get(both)
            if rank is not None:
                heapq.heappush(heap, (rank, i, both))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if token[i] is None or nxt[i] >= n or token[i] + token[nxt[i]] != both:
            continue
        j = nxt[i]
        token[i], token[j], nxt[i] = both, None, nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [t for t in token if t is not None]


def merge(piece: bytes, ranks: dict) -> list[bytes]:
    return _merge_small(piece, ranks) if len(piece) <= 64 else _merge_large(piece, ranks)


def join(left: list[bytes], right: list[bytes], ranks: dict) -> list[bytes]:
    """The encoding of the concatenation of two encoded texts."""
    if not left or not right:
        return left or right
    a = b = 1
    while True:
        a, b = min(a, len(left)), min(b, len(right))
        window = merge(b"".join(left[-a:]) + b"".join(right[:b]), ranks)
        stable_left = a == len(left) or window[0] == left[-a]
        stable_right = b == len(right) or window[-1] == right[b - 1]
        if stable_left and stable_right:
            return left[:-a] + window + right[b:]
        a, b = a if stable_left else 2 * a, b if stable_right else 2 * b


def encode_tree(piece: bytes, ranks: dict) -> list[bytes]:
    if len(piece) <= LEAF:
        return merge(piece, ranks)
    half = len(piece) // 2
    return join(encode_tree(piece[:half], ranks), encode_tree(piece[half:], ranks), ranks)


def encode_piece(piece: bytes, ranks: dict) -> list[int]:
    """Ids of one match of the pattern; a match that is a token itself is that token."""
    whole = ranks.get(piece)
    return [whole] if whole is not None else [ranks[t] for t in encode_tree(piece, ranks)]


def decode_tree(tokens: list[bytes]) -> bytes:
    """Concatenate tokens up a tree of portions."""
    while len(tokens) > PORTION:
        tokens = [b"".join(tokens[i:i + PORTION]) for i in range(0, len(tokens), PORTION)]
    return b"".join(tokens)


class _Pieces(dict):
    """Piece → its ids as little-endian 32-bit integers; two generations bound the memory."""

    def __init__(self, ranks):
        super().__init__()
        self.ranks, self.old = ranks, {}

    def __missing__(self, piece):
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(encode_piece(piece.encode(), self.ranks), "<u4").tobytes()
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


def _ids(text: str, split, pieces: _Pieces) -> bytes:
    if len(text) <= LONG_TEXT:
        return b"".join([pieces[p] for p in split.findall(text)])
    found, out = split.finditer(text), []
    while portion := [pieces[m.group()] for m in islice(found, PORTION)]:
        out.append(b"".join(portion))
    return b"".join(out)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id and ``ids`` (binary: little-endian unsigned 32-bit token ids) of every text."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches):
        split, pieces = regex.compile(pattern), _Pieces(shared.value)
        for b in batches:
            ids = [_ids(t or "", split, pieces) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], [id_col, "ids"])
    return docs.select(docs[id_col].alias(id_col), docs["text"]).mapInArrow(
        run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded`` (binary): the bytes that each row's ``ids`` stand for."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches):
        token = {i: t for t, i in shared.value.items()}
        for b in batches:
            out = [decode_tree([token[i] for i in np.frombuffer(x or b"", "<u4").tolist()])
                   for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])
    kinds = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{kinds}, decoded binary")
