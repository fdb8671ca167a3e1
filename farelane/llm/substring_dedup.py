"""Substring dedup by level-wise doubling (operator 4).

Method: windows of ``window`` words that occur in two documents or more are
repeated; only windows repeated at one length are extended to twice that
length (window at i and window at i + length, both repeated), again matched
over the corpus, and so on until no candidate survives.  The first level
decides which words go (those covered by a window that also starts in a
document with a smaller id); the later ones tell how long the repeated
passages are.

How it runs: a task turns its texts into blocks of (document, position, hash)
and deals the hashes over buckets by a second, independent hash.  A bucket
holds every occurrence of its hashes and finds the repeated ones; only these
come back.  A window that recurs inside a block is matched there and sent once
(for the block's smallest document), so a passage that a third of all
documents share reaches its bucket as one entry per block.  Blocks and buckets
have bounded sizes (their number follows the input).  Windows are equal when
64 bits of hash and the bucket's independent bits agree.

Defined cases: a null text has no words; a null ``doc_id`` counts as larger
than any id and is not smaller than another null; rows that share an id never remove words from
each other; repeated rows get equal results; texts with fewer words than a
window lose nothing; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm import textkernel as tk
from farelane.llm.common import Scratch, buckets_for, small_batches, text_bytes

WINDOW = 13
BLOCK_WORDS = 1 << 19
SLICE_ROWS = 200  # texts hashed at once, so that a worker holds little beside its block
BUCKET_BYTES = 4 << 20  # text whose windows meet in one bucket, which one task holds decoded
NO_ID = np.iinfo(np.int64).max
U = np.uint64

# A fragment: windows of one block and one bucket, run-length coded by document.  ``docs`` are places in
# the block's document table, which travels as a fragment of its own (``keys`` set, no windows).
FRAGMENT = ("bucket int, block long, known boolean, keys binary, ids binary, docs binary, counts binary, "
            "gaps binary, hashes binary, flags binary")
COLUMNS = [c.split()[0] for c in FRAGMENT.split(", ")]


# ------------------------------------------------------------------ fragments
def _squeeze(values: np.ndarray) -> bytes:
    """Integers (modulo 2**64), one byte each where under 255, else eight more."""
    v = values.astype(np.int64).view(U)
    wide = v >= 255
    return len(v).to_bytes(8, "little") + np.where(wide, U(255), v).astype(np.uint8).tobytes() + v[wide].tobytes()


def _spread(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    v = np.frombuffer(blob, np.uint8, n, 8).astype(U)
    wide = np.flatnonzero(v == 255)
    v[wide] = np.frombuffer(blob, U, len(wide), 8 + n)
    return v.view(np.int64)


def _encode(bucket, block, known, ids, run, pos, hashes, flags, docs=None) -> tuple:
    """ids by run, and docs, the run's place in the block's table (the run itself where not given);
    run, pos, hashes, flags by window (ordered by run, position)."""
    head = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    own = run[head].astype(np.int64)
    doc = own if docs is None else docs[own]
    gap = np.diff(pos.astype(np.int64), prepend=0)
    gap[head] = pos[head]
    step = np.diff(ids[own].view(U), prepend=U(0)).view(np.int64)
    return (bucket, block, known, None, _squeeze(step), _squeeze(np.diff(doc, prepend=0)),
            _squeeze(np.diff(np.append(head, len(run)))), _squeeze(gap), hashes.tobytes(), np.packbits(flags).tobytes())


class Windows:
    """Decoded windows of several fragments: ``ids`` and ``docs`` by run; run, pos, hash, flag by window."""

    def __init__(self, frame: pd.DataFrame):
        def joined(parts, kind):
            return np.concatenate(parts) if parts else np.zeros(0, kind)
        self.ids = joined([np.cumsum(_spread(x).view(U)).view(np.int64) for x in frame["ids"]], np.int64)
        self.docs = joined([np.cumsum(_spread(x)) for x in frame["docs"]], np.int64)
        counts = joined([_spread(x) for x in frame["counts"]], np.int64)
        gap = joined([_spread(x) for x in frame["gaps"]], np.int64)
        self.run = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        total = np.cumsum(gap)
        head = np.cumsum(counts) - counts
        total -= np.repeat(total[head] - gap[head], counts) if len(gap) else 0
        self.pos = total.astype(np.int32)
        self.hashes = np.frombuffer(b"".join(frame["hashes"]), U)
        self.sizes = np.fromiter((len(x) // 8 for x in frame["hashes"]), np.int64, len(frame))
        self.flags = joined([np.unpackbits(np.frombuffer(f, np.uint8), count=n)
                             for f, n in zip(frame["flags"], self.sizes)], np.uint8).astype(bool)


def _by_hash(hashes, doc, flags=None):
    """Per window: does a smaller document have it, and do two documents have it (or is one flagged)."""
    order = np.argsort(hashes)
    h, d = hashes[order], doc[order]
    head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    sizes = np.diff(np.append(head, len(h)))
    least, most = np.minimum.reduceat(d, head), np.maximum.reduceat(d, head)
    many = most > least
    if flags is not None:
        many |= np.logical_or.reduceat(flags[order], head)
    later, repeated = np.empty(len(h), bool), np.empty(len(h), bool)
    later[order] = d > np.repeat(least, sizes)
    repeated[order] = np.repeat(many, sizes)
    return later, repeated


def _fragments(block, ids, keys, listed, run, pos, hashes, bucket, buckets):
    """Rows of one block (documents in id order).  Windows with a smaller document inside the block are
    known already: with the document table they only pass through, in a bucket of the block's own.
    The table also lists the documents that ``listed`` holds."""
    own = int(tk.mix(np.array([block], U))[0] % U(buckets))
    nothing = np.zeros(0, np.int64)
    yield (own, block, True, keys.tobytes(), ids.tobytes(), _squeeze(np.diff(listed, prepend=0)), _squeeze(nothing),
           _squeeze(nothing), b"", b"")
    if not len(run):
        return
    known, repeated = _by_hash(hashes, ids[run])
    if known.any():
        k = np.flatnonzero(known)
        yield _encode(own, block, True, ids, run[k], pos[k], hashes[k], np.ones(len(k), bool))
    ask = np.flatnonzero(~known)
    ask = ask[np.argsort(bucket[ask], kind="stable")]
    cuts = np.flatnonzero(np.diff(bucket[ask])) + 1
    for part in np.split(ask, cuts):
        if len(part):
            yield _encode(int(bucket[part[0]]), block, False, ids, run[part], pos[part], hashes[part], repeated[part])


def _frame(rows) -> pd.DataFrame:
    return pd.DataFrame(list(rows), columns=COLUMNS)


# ------------------------------------------------------------------ steps
def _first_level(window: int, buckets: int, block_words: int):
    small = np.uint16 if buckets < 1 << 16 else np.int64

    def windows_of(b):
        """Of some rows: id, key and number of windows; position, hash and bucket of every window."""
        data, offsets = tk.flat(b.column("text"))
        starts, ends, first = tk.word_bounds(data, offsets)
        w = tk.word_hashes(data, starts, ends)
        inside, counts = tk.windows_inside(first, window)
        second = tk.window_hashes(w, window, tk.BASES[3])[inside]
        return (b.column("id").to_numpy(zero_copy_only=False), b.column("key").to_numpy(zero_copy_only=False),
                counts, (inside - np.repeat(first[:-1], counts)).astype(np.int32),
                tk.window_hashes(w, window)[inside], (second % U(buckets)).astype(small))

    def blocks(batches):
        part = TaskContext.get().partitionId() << 32
        held, words, n = [], 0, 0

        def flush():
            ids, keys = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            counts = np.concatenate([x[2] for x in held])
            order = np.lexsort((keys, ids))
            at = tk.ranges((np.cumsum(counts) - counts)[order], counts[order])
            pos, hashes, bucket = (np.concatenate([x[i] for x in held])[at] for i in (3, 4, 5))
            held.clear()
            run = np.repeat(np.arange(len(ids), dtype=np.int32), counts[order])
            rows = _frame(_fragments(part + n, ids[order], keys[order], run[:0], run, pos, hashes, bucket, buckets))
            return pa.RecordBatch.from_pandas(rows, schema=SCHEMA, preserve_index=False)

        for part_of_batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, len(b), SLICE_ROWS)):
            held.append(windows_of(part_of_batch))
            words += len(held[-1][3])
            if words >= block_words:
                yield flush()
                words, n = 0, n + 1
        if words:
            yield flush()
    return blocks


SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("known", pa.bool_())]
                   + [(c, pa.binary()) for c in COLUMNS[3:]])


def _match(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: keep the repeated windows of every fragment; flag those a smaller document has."""
    known = frame[frame["known"]]
    ask = frame[~frame["known"]]
    if not len(ask):
        return known
    w = Windows(ask)
    later, repeated = _by_hash(w.hashes, w.ids[w.run], w.flags)
    rows, lo = [], 0
    for n, block, bucket in zip(w.sizes, ask["block"], ask["bucket"]):
        at = lo + np.flatnonzero(repeated[lo:lo + n])
        lo += n
        if len(at):
            rows.append(_encode(bucket, block, False, w.ids, w.run[at], w.pos[at], w.hashes[at], later[at], w.docs))
    return pd.concat([known, _frame(rows)]) if len(known) else _frame(rows)


def _placed(frame: pd.DataFrame):
    """A block's document table and all its windows in (document, position) order."""
    table = frame[frame["keys"].notna()]
    ids, keys = (np.frombuffer(table[c].iloc[0], np.int64) for c in ("ids", "keys"))
    w = Windows(frame[frame["keys"].isna()])
    place = (w.docs[w.run] << 40) + w.pos
    order = np.argsort(place)
    return ids, keys, place[order], w.hashes[order], w.flags[order]


def _extend(length: int, buckets: int):
    small = np.uint16 if buckets < 1 << 16 else np.int64

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        ids, keys, place, hashes, _ = _placed(frame)
        if not len(place):
            return _frame([])
        nxt = np.searchsorted(place, place + length)
        ok = np.flatnonzero((nxt < len(place)) & (place[np.minimum(nxt, len(place) - 1)] == place + length))
        longer = tk.mix(hashes[ok] * U(tk.BASES[0]) + tk.mix(hashes[nxt[ok]] + U(length)))
        bucket = (tk.mix(longer * U(tk.BASES[1])) % U(buckets)).astype(small)
        return _frame(_fragments(int(frame["block"].iloc[0]), ids, keys, np.unique(place >> 40), place[ok] >> 40,
                                 place[ok] & ((1 << 40) - 1), longer, bucket, buckets))
    return step


def _covered(window: int):
    """One block → its documents with repeated windows: id, key, and the word ranges that removable
    windows cover (start, end pairs; null if there are none)."""
    def step(frame: pd.DataFrame) -> pd.DataFrame:
        ids, keys, place, _, removable = _placed(frame)
        docs = np.unique(place >> 40)
        out = pd.DataFrame({"block": frame["block"].iloc[0], "doc": docs, "id": ids[docs], "key": keys[docs],
                            "spans": None})
        place = place[removable]
        if len(place):
            head = np.flatnonzero(np.concatenate([[True], np.diff(place) > window]))
            tail = np.append(head[1:], len(place)) - 1
            spans = np.stack([place[head], place[tail] + window], 1)
            of = spans[:, 0] >> 40
            spans &= (1 << 40) - 1
            cuts = np.flatnonzero(np.diff(of)) + 1
            at = np.searchsorted(docs, of[np.append(0, cuts)])
            blobs = np.empty(len(docs), object)
            for i, part in zip(at, np.split(spans, cuts)):
                blobs[i] = part.astype(np.int64).tobytes()
            out["spans"] = blobs
        return out
    return step


def _members(length: int):
    """Documents that a block's table lists: those with a repeated window of this length."""
    def step(batches):
        for b in batches:
            docs = [np.cumsum(_spread(x)) for x in b["docs"]]
            yield pd.DataFrame({"block": np.repeat(b["block"].to_numpy(np.int64), [len(x) for x in docs]),
                                "doc": np.concatenate(docs) if docs else np.zeros(0, np.int64),
                                "longest": length})
    return step


def _keyed(docs: DataFrame) -> DataFrame:
    """id (null → largest), key of the text, text."""
    return docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(int(NO_ID))).alias("id"),
                       F.xxhash64(docs["text"]).alias("key"), docs["text"].alias("text"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per (id, key of text) with a repeated window: spans to remove (binary int64 pairs of word
    numbers, null if none) and ``longest``, the greatest length at which it has a repeated window."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "substrings")
    buckets = buckets_for(spark, text_bytes(docs), BUCKET_BYTES)

    def matched(fragments):
        return scratch.cut(fragments.groupBy("bucket").applyInPandas(_match, FRAGMENT), "none")

    state = matched(_keyed(docs).mapInArrow(_first_level(window, buckets, block_words), FRAGMENT))
    spans = scratch.cut(state.groupBy("block").applyInPandas(
        _covered(window), "block long, doc long, id long, key long, spans binary"))
    levels, length = [], window
    while state.where("keys is null").limit(1).count():
        longer = matched(state.groupBy("block").applyInPandas(_extend(length, buckets), FRAGMENT))
        scratch.drop(state)
        levels.append(scratch.cut(longer.where("keys is not null").select("block", "docs").mapInPandas(
            _members(length), "block long, doc long, longest long")))
        state, length = longer, 2 * length
    scratch.drop(state)
    if not levels:
        return spans.select("id", "key", "spans", F.lit(0).cast("long").alias("longest"))
    reach = reduce(DataFrame.unionByName, levels).groupBy("block", "doc").agg(F.max("longest").alias("longest"))
    # Repeated rows share id and key and have equal spans.
    return scratch.finish(spans.join(reach, ["block", "doc"]).groupBy("id", "key")
                          .agg(F.min("spans").alias("spans"), F.max("longest").alias("longest")))


def _strip(words: list, spans: bytes | None) -> tuple[list, int]:
    if not spans:
        return words, 0
    kept, at, gone = [], 0, 0
    for lo, hi in np.frombuffer(spans, np.int64).reshape(-1, 2).tolist():
        kept += words[at:lo]
        at, gone = hi, gone + hi - lo
    return kept + words[at:], gone


def _joined(docs: DataFrame, window: int) -> DataFrame:
    """row (all columns but the text), text, spans, longest."""
    spans = repeated_spans(docs, window)
    rest = [docs[c] for c in docs.columns if c != "text"]
    keyed = docs.select(F.struct(*rest).alias("row"),
                        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(int(NO_ID))).alias("id"),
                        F.xxhash64(docs["text"]).alias("key"), docs["text"].alias("text"))
    return keyed.join(spans, ["id", "key"], "left")


def substring_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, longest_repeat (0: no repeated window)."""
    joined = _joined(docs.select("doc_id", "text"), window)

    def report(batches):
        for b in batches:
            out = []
            for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                words = (text or "").encode().split()
                kept, gone = _strip(words, spans)
                out.append((len(words), gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, gone, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
                 b.column("longest")], ["doc_id", "n_words", "n_removed", "kept_sha256", "longest_repeat"])
    kind = dict(docs.dtypes)["doc_id"]
    return joined.select("row.doc_id", "text", "spans", F.coalesce("longest", F.lit(0)).alias("longest")).mapInArrow(
        report, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, longest_repeat long")


def remove_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated passages taken out of ``text``, same columns.

    A text that loses nothing stays as it is, byte by byte; one that loses words has the rest joined
    by single spaces; a document that loses all its words is dropped.
    """
    joined = _joined(docs, window)

    # Declared nondeterministic, else the filter below runs it again, with a second Python worker a task.
    @F.pandas_udf("string")
    def strip(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else b" ".join(_strip((t or "").encode().split(), s)[0]).decode()
                          for t, s in zip(text, spans)], dtype=object)
    out = joined.withColumn("stripped", F.when(F.col("spans").isNull(), F.col("text"))
                            .otherwise(strip.asNondeterministic()("text", "spans")))
    out = out.where(F.col("spans").isNull() | (F.col("stripped") != ""))
    return out.select(*[F.col("stripped").alias(c) if c == "text" else F.col("row").getField(c).alias(c)
                        for c in docs.columns])
