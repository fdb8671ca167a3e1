"""Fuzzy line dedup (operator 10).

Method: MinHash of every normalised line over its pairs of adjacent words, banded into buckets,
edit similarity as the check, and one occurrence kept per connected group.

A line is normalised by lower-casing A-Z and reading it as its words; every line with a word takes part.
Two lines are linked when their word edit similarity (1 - distance / longer length) is at least ``similarity``, by nothing
else.  Of a group, the occurrence with the smallest (doc_id, line number) stays; equal lines are one node, so a line that
occurs in a third of all documents costs one row per task.

SimHash blocks, the dealt way to candidates, lose links or selectivity at this similarity (figures in the README).

Links are looked for between lines that share a band.  A pair at edit similarity 0.8 whose edits are spread at
random has about 0.47 of its word pairs in common and shares none of 40 bands of 3 minima with probability 0.01,
a pair at 0.85 with probability 3e-4; evenly spread edits at 0.8 (0.43) miss with 0.04.

The band join runs packed: tasks send (32 bits of the band key, short name) of their distinct lines to buckets of the key, and a
bucket reports only the lines whose key another line has; lines that share several keys are reported under one.  A key that many lines of one task share
goes to buckets of its own, and only its first line to the common one, which so gets at most ``HOT_LINES`` lines of a
key from a task's fragment.  Links inside a key are found by ``linkage`` (leader first, then only across components).

Defined cases: a null or empty text has no lines to remove; blank lines stay; a null ``doc_id``
counts as larger than any id; a line that repeats inside a document counts as a later occurrence; rows that repeat id
and text are one document (both lose the same lines); an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from farelane.llm import linkage
from farelane.llm import textkernel as tk
from farelane.llm.common import Scratch, shuffle_parts, small_batches, text_bytes

SIMILARITY = 0.8
BANDS, ROWS = 40, 3
NO_ID = (1 << 63) - 1
HELD_LINES = 250_000  # lines a task holds before it deals them out
HOT_LINES = 1000  # lines of one key that a task sends to the key's common bucket
HELD_MARKS = 1 << 20  # (line, word) marks that a comparison of lines holds at once
HASHED_WORDS = 1 << 14  # features hashed at once: they stay in cache
SEED = 10
U, U32 = np.uint64, np.uint32
NEWLINE = 0x0A


# ------------------------------------------------------------------ kernels
def line_words(column):
    """Word hashes of a batch, first word of every line, and the lines' rows and numbers."""
    data, offsets = tk.flat(column)
    ends = np.flatnonzero(data == NEWLINE)
    per_row = np.searchsorted(ends, offsets[1:]) - np.searchsorted(ends, offsets[:-1]) + 1
    row = np.repeat(np.arange(len(offsets) - 1), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    start = np.repeat(offsets[:-1], per_row)
    later = number > 0
    start[later] = ends + 1
    lowered = tk.LOWER[data]
    s, e, _ = tk.word_bounds(lowered, offsets)
    words = tk.word_hashes(lowered, s, e)
    return words, np.append(np.searchsorted(s, start), len(s)), row, number


def features(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One per word: the word with its next one, or alone at the line's end.

    Single words would not do: the frequent words of a language make all its long lines alike.
    """
    out = tk.mix(words)
    out[:-1] = tk.window_hashes(words, 2)[:max(len(words) - 1, 0)]
    last = first[1:][np.diff(first) > 0] - 1
    out[last] = tk.mix(words[last] + U(1))
    return out


def line_ids(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128-bit hash of every line's word sequence: shape (lines, 2)."""
    sizes = np.diff(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], sizes)
    out = np.zeros((len(sizes), 2), U)
    if not len(words):
        return out
    full = np.flatnonzero(sizes)
    for i in range(2):
        up, _ = tk._powers(tk.BASES[i + 2], int(sizes.max()))
        out[full, i] = tk.mix(np.add.reduceat(words * up[place], first[:-1][full]) + sizes[full].astype(U))
    return out


def edit_similarity(a, b, least: float) -> bool:
    """Is 1 - distance / longer at least ``least``?  Bit-parallel edit distance over items."""
    if len(a) < len(b):
        a, b = b, a
    most = int((1 - least) * len(a) + 1e-9)
    return len(a) - len(b) <= most and _within(a, b, most)


def _within(a, b, most: int) -> bool:
    """Is the edit distance of ``a`` and ``b`` at most ``most``?"""
    m = len(b)
    if not m:
        return len(a) <= most
    at: dict = {}
    for i, x in enumerate(b):
        at[x] = at.get(x, 0) | (1 << i)
    ones = (1 << m) - 1
    plus, minus, top = ones, 0, 1 << (m - 1)
    spare = most + len(a) - m  # each word of ``a`` still to come lowers the distance by one at most
    for x in a:
        eq = at.get(x, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & ones)
        mh = plus & xh
        if not mh & top:
            spare -= 2 if ph & top else 1
            if spare < 0:
                return False
        ph = ((ph << 1) | 1) & ones
        mh = (mh << 1) & ones
        plus, minus = mh | (~(xv | ph) & ones), ph & xv
    return True


def band_keys(words: np.ndarray, first: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band and line: shape (bands, lines); every line has a word.

    Universal hash minima in 32 bits: (a x + b) mod 2**32 with odd a, ordered by their leading bits.
    """
    rng = np.random.default_rng(SEED)
    mult = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * U32(2) + U32(1)
    plus = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    pairs = (features(words, first) >> U(32)).astype(U32)
    least = np.empty((bands * rows, len(first) - 1), U32)
    lo = 0
    while lo < len(first) - 1:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + HASHED_WORDS, "right")) - 1)
        part, heads = pairs[first[lo]:first[hi]], first[lo:hi] - first[lo]
        held = np.empty_like(part)
        for i in range(bands * rows):
            np.multiply(part, mult[i], out=held)
            held += plus[i]
            np.minimum.reduceat(held, heads, out=least[i, lo:hi])
        lo = hi
    out = np.empty((bands, len(first) - 1), U)
    for band in range(bands):
        key = np.full(len(first) - 1, tk.BASES[3] ^ band, U)
        for i in range(band * rows, (band + 1) * rows):
            key = key * U(tk.BASES[1]) + least[i]
        out[band] = tk.mix(key)
    return out


def some_edit(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Which lengths have a partner that is not equal?  Shorter lines are linked with equal ones only."""
    longest = np.floor(sizes / similarity + 1e-9)
    return (1 - similarity) * longest + 1e-9 >= 1


# ------------------------------------------------------------------ steps
LINES = "id long, tkey long, line int, node binary"


def _lines():
    """Lines that take part; of equal lines in a document the first only."""
    def run(batches):
        for b in batches:
            words, first, row, number = line_words(b.column("text"))
            keep = np.flatnonzero(np.diff(first))
            ids = line_ids(words, first)[keep]
            out_ids = b.column("id").to_numpy(zero_copy_only=False)[row[keep]]
            keys = b.column("tkey").to_numpy(zero_copy_only=False)[row[keep]]
            raw = np.ascontiguousarray(ids).view(np.uint8).reshape(-1, 16)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_ids), pa.array(keys), pa.array(number[keep].astype(np.int32)),
                 pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(raw), [None, pa.py_buffer(raw.tobytes())])
                 .cast(pa.binary())], ["id", "tkey", "line", "node"])
    return run


def _dealt(similarity: float, buckets: int, hot_lines: int = HOT_LINES):
    """Texts → per (band, bucket) the packed short names and keys of a task's distinct lines."""
    def run(batches):
        held, n = [], 0

        def rows_of(band, names, keys):
            """Rows of one band: common buckets, and a bucket of its own (negative) per part of a hot key."""
            at = ((keys & U(0xFFFFFFFF)) % U(buckets) << U(32)) | (keys >> U(32))
            order = np.argsort(at)
            names, at = names[order], at[order]
            head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            size = np.diff(np.append(head, len(at)))
            common, hot = np.ones(len(at), bool), np.zeros(len(at), bool)
            for s, k in zip(head[size > hot_lines].tolist(), size[size > hot_lines].tolist()):
                common[s + 1:s + k], hot[s] = False, True
                # Every part starts with two lines at least, so its lines are reported.
                for part in np.array_split(np.arange(s, s + k), k // max(hot_lines, 2)):
                    own = -1 - int(tk.mix(names[part[:1]] + at[s:s + 1])[0] >> U(34))
                    yield (band, own, int(at[s] >> U(32)), names[part].tobytes(), at[part].astype(U32).tobytes(),
                           at[s:s + 1].tobytes())
            names, at, hot = names[common], at[common], hot[common]
            bucket = (at >> U(32)).astype(np.int32)
            for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(bucket)) + 1):
                home = int(bucket[part[0]])
                yield (band, home, home, names[part].tobytes(), at[part].astype(U32).tobytes(),
                       at[part][hot[part]].tobytes())

        def flush():
            parts = list(held)
            held.clear()
            names = np.concatenate([x for x, _ in parts])
            of_band = lambda band: np.concatenate([y[band] for _, y in parts])
            # Equal lines of several batches are sent once; lines that only share the short name stay apart.
            ends = names, of_band(0), of_band(-1)
            order = np.lexsort(ends[::-1])
            apart = np.ones(len(order), bool)
            apart[1:] = np.any([x[order][1:] != x[order][:-1] for x in ends], axis=0)
            once = order[apart]
            names = names[once]
            for band in range(len(parts[0][1])):  # the rows of one band at a time: they copy its names and keys
                out = list(rows_of(band, names, of_band(band)[once]))
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(out, columns=DEALT.names), schema=DEALT, preserve_index=False)
        for b in batches:
            words, first, _, _ = line_words(b.column("text"))
            sizes = np.diff(first)
            ids = line_ids(words, first)
            at = np.flatnonzero((sizes > 0) & some_edit(sizes, similarity))
            at = at[np.unique(np.ascontiguousarray(ids[at]).view("V16").ravel(), return_index=True)[1]]
            if len(at):
                own = np.concatenate([[0], np.cumsum(sizes[at])])
                keys = band_keys(words[tk.ranges(first[:-1][at], sizes[at])], own)
                held.append((ids[at, 0].byteswap(), keys))
                n += len(at)
            if n >= HELD_LINES:
                yield from flush()
                n = 0
        if n:
            yield from flush()
    return run


DEALT = pa.schema([("band", pa.int32()), ("bucket", pa.int32()), ("home", pa.int32()),
                   ("names", pa.binary()), ("keys", pa.binary()), ("hot", pa.binary())])


def _shared_keys(frame: pd.DataFrame):
    """One bucket: keys that two lines have, the lines of each, and whether a task found the key hot."""
    names = np.frombuffer(b"".join(frame["names"]), U)
    keys = np.frombuffer(b"".join(frame["keys"]), U32).astype(U)
    keys |= np.repeat(frame["home"].to_numpy().astype(U) << U(32), frame["names"].str.len().to_numpy() // 8)
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    order = order[np.append(False, same) | np.append(same, False)]
    order = order[np.lexsort((names[order], keys[order]))]
    names, keys = names[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    names, keys = names[new], keys[new]
    size = np.unique(keys, return_counts=True)[1]
    several = np.repeat(size > 1, size)
    names, keys, size = names[several], keys[several], size[size > 1]
    each = keys[np.cumsum(size) - size]
    hot = np.isin(each, np.frombuffer(b"".join(frame["hot"]), U))
    return tk.mix(each + tk.mix(frame["band"].to_numpy()[:1].astype(U) + U(1))), size, names, hot


def _rows(keys, size, names) -> pd.DataFrame:
    return pd.DataFrame({"key": np.repeat(keys, size).view(np.int64), "name": names.view(np.int64)})


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: (key, name) of the lines whose key another line has."""
    keys, size, names, _ = _shared_keys(frame)
    return _rows(keys, size, names)


def _shared_once(frame: pd.DataFrame) -> pd.DataFrame:
    """As ``_shared``, but a key is named by its lines, so that keys of the same lines, which near copies have in
    most bands, are one.  A hot key keeps its own name, which its parts in other buckets have too."""
    keys, size, names, hot = _shared_keys(frame)
    if len(keys):
        by_lines = np.add.reduceat(tk.mix(names ^ U(tk.BASES[0])), np.cumsum(size) - size)
        keys = np.where(hot, keys, tk.mix(by_lines + size.astype(U)))
    return _rows(keys, size, names)


def _wanted_words(batches):
    """Rows with a text and its wanted lines → node and payload (the word hashes)."""
    for b in batches:
        words, first, row, number = line_words(b.column("text"))
        base = np.searchsorted(row, np.arange(len(b) + 1))
        wanted = b.column("wanted")
        ends = wanted.offsets.to_numpy()
        line, node = (wanted.values.field(c)[ends[0]:ends[-1]] for c in ("line", "node"))
        at = np.repeat(base[:-1], np.diff(ends)) + line.to_numpy()
        size = first[at + 1] - first[at]
        ends = np.append(0, np.cumsum(8 * size)).astype(np.int64)
        payload = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(ends.tobytes()), pa.py_buffer(words[tk.ranges(first[at], size)].tobytes())])
        yield pa.RecordBatch.from_arrays([node, payload.cast(pa.binary())], ["node", "payload"])


def _linked(similarity: float):
    def check(x: bytes, y: bytes) -> bool:
        a, b = np.frombuffer(x, U), np.frombuffer(y, U)
        if len(a) < len(b):
            a, b = b, a
        n, m = len(a), len(b)
        most = int((1 - similarity) * n + 1e-9)
        if n - m > most:
            return False
        # Equal ends take no edit.
        same = a[:m] == b
        differ = m - np.count_nonzero(same)
        if differ + n - m <= most:
            return True
        lead = int(same.argmin())
        same = a[n - m + lead:] == b[lead:]
        if same.all():
            return True
        tail = int(same[::-1].argmin())
        a, b = a[lead:n - tail].tolist(), b[lead:m - tail].tolist()
        # Each word that the other line lacks takes an edit, and so does each time it has the word less often.
        other = set(b)
        if sum(w not in other for w in a) > most or len(a) - (Counter(a) & Counter(b)).total() > most:
            return False
        return _within(a, b, most)
    return check


def _numbered(words: np.ndarray, size: np.ndarray) -> tuple[int, np.ndarray]:
    """Numbers from 0 on for the words of lines, one for each time a line has a word: lines share as many numbers as words."""
    order = np.argsort(words, kind="stable")  # lines stay in order within a word
    words, line = words[order], np.repeat(np.arange(len(size)), size)[order]
    new = np.ones(len(words), bool)
    new[1:] = words[1:] != words[:-1]
    first = new.copy()
    first[1:] |= line[1:] != line[:-1]
    place = np.arange(len(words))
    times = place - np.maximum.accumulate(np.where(first, place, 0))
    most = np.maximum.reduceat(times, np.flatnonzero(new)) + 1
    number = np.empty(len(words), np.int64)
    number[order] = (np.cumsum(most) - most)[np.cumsum(new) - 1] + times
    return int(most.sum()), number


def _links_between(similarity: float):
    check = _linked(similarity)

    def run(payloads, comps, anchor):
        rows = [np.frombuffer(p, U) for p in payloads]
        size = np.array([len(r) for r in rows], np.int64)
        heads = np.cumsum(size) - size
        distinct, word = _numbered(np.concatenate(rows), size)
        joined: dict = {}

        def find(x):
            while joined.get(x, x) != x:
                joined[x] = joined.get(joined[x], joined[x])
                x = joined[x]
            return x
        anchors = np.flatnonzero(anchor)
        step = max(1, HELD_MARKS // len(word))
        for at in (anchors[lo:lo + step] for lo in range(0, len(anchors), step)):
            most = ((1 - similarity) * np.maximum(size, size[at][:, None]) + 1e-9).astype(np.int64)
            # Words of the longer line that the shorter one lacks, or has less often: each takes an edit.
            held = np.zeros((len(at), distinct), np.uint8)
            held[np.repeat(np.arange(len(at)), size[at]), word[tk.ranges(heads[at], size[at])]] = 1
            common = np.add.reduceat(held[:, word], heads, axis=1, dtype=np.int64)
            near = np.maximum(size, size[at][:, None]) - common <= most
            near &= ~anchor | (np.arange(len(size)) > at[:, None])
            for k, j in zip(*(x.tolist() for x in np.nonzero(near))):
                i = int(at[k])
                a, b = find(comps[i]), find(comps[j])
                if a != b and check(payloads[i], payloads[j]):
                    joined[a] = b
                    yield i, j
    return run


def removable_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, tkey, lines): the line numbers that go from each document that loses any."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "lines")
    base = docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(docs["text"]).alias("tkey"), docs["text"].alias("text"))
    lines = scratch.cut(base.mapInArrow(_lines(), LINES), "none")
    place = F.struct("id", "tkey", "line")
    nodes = scratch.cut(lines.groupBy("node").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("times")), "none")

    buckets = max(-(-2 * shuffle_parts(spark) // BANDS), -(-text_bytes(docs) // (64 << 20)))
    dealt = base.select("text").mapInArrow(
        _dealt(similarity, buckets), "band int, bucket int, home int, names binary, keys binary, hot binary")
    close = scratch.cut(dealt.groupBy("band", "bucket").applyInPandas(_shared_once, "key long, name long").distinct())
    # A short name is the first half of a node as a big-endian number.
    named = nodes.select("node", F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("bigint").alias("name"))
    close = scratch.cut(close.join(named, "name").select("key", "node"))
    led = scratch.cut(linkage.led_buckets(close))

    # The words of the lines in question, read again from one text each.
    wanted = (led.select("node").distinct().join(nodes.select("node", "at"), "node")
              .groupBy("at.id", "at.tkey").agg(F.collect_list(F.struct("at.line", "node")).alias("wanted")))
    once = base.join(wanted, ["id", "tkey"]).select("text", "wanted")
    payloads = scratch.cut(once.mapInArrow(_wanted_words, "node binary, payload binary")
                           .groupBy("node").agg(F.first("payload").alias("payload")), "none")
    comps = linkage.link_nodes(led, payloads, _linked(similarity), _links_between(similarity), scratch)

    # Per group the first occurrence stays; a node without links is a group of its own.
    grouped = (nodes.select("node", "at", "times").join(comps, "node", "left").where("times > 1 or comp is not null")
               .withColumn("comp", F.coalesce("comp", "node")))
    keep = grouped.groupBy("comp").agg(F.min("at").alias("keep"))
    kept = grouped.join(keep, "comp").select("node", "keep")
    gone = lines.select("id", "tkey", "line", "node").join(kept, "node").where(place != F.col("keep"))
    return scratch.finish(gone.groupBy("id", "tkey").agg(F.array_sort(F.collect_set("line")).alias("lines")))


def _cut_text(text: str | None, lines) -> str | None:
    if text is None or lines is None:
        return text
    gone = set(lines)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def _joined(docs: DataFrame, **options) -> DataFrame:
    """row (all columns but the text), text, lines."""
    rest = [docs[c] for c in docs.columns if c != "text"]
    keyed = docs.select(F.struct(*rest).alias("row"), docs["text"].alias("text"),
                        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)).alias("id"),
                        F.xxhash64(docs["text"]).alias("tkey"))
    return keyed.join(removable_lines(docs, **options), ["id", "tkey"], "left")


@F.pandas_udf(StringType())
def _without(text: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([_cut_text(t, n) for t, n in zip(text, lines)], dtype=object)


def remove_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents without later occurrences of lines, same columns; a document that loses every word goes."""
    # Declared nondeterministic, else the filter runs the function again, with a second Python worker a task.
    out = _joined(docs, **options).withColumn(
        "left", F.when(F.col("lines").isNull(), F.col("text")).otherwise(
            _without.asNondeterministic()("text", "lines")))
    out = out.where(F.col("lines").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[F.col("left").alias(c) if c == "text" else F.col("row").getField(c).alias(c)
                        for c in docs.columns])


def line_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_sha256 (of the text that is left, in UTF-8)."""
    joined = _joined(docs.select("doc_id", "text"), **options)

    def report(batches):
        for b in batches:
            n, gone, sha = [], [], []
            for text, lines in zip(b.column("text").to_pylist(), b.column("lines").to_pylist()):
                n.append(text.count("\n") + 1 if text else 0)
                gone.append(len(lines or ()))
                sha.append(hashlib.sha256((_cut_text(text, lines) or "").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_lines", "n_removed", "kept_sha256"])
    return joined.select("row.doc_id", "text", "lines").mapInArrow(
        report, f"doc_id {dict(docs.dtypes)['doc_id']}, n_lines long, n_removed long, kept_sha256 string")


