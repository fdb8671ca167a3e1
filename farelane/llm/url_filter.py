"""URL filters by a Bloom filter cascade (operator 1).

Method: level 1 encodes the listed keys; level 2 encodes the keys of the
corpus that level 1 lets through although they are not listed; level 3 the
listed keys that level 2 lets through, and so on until a level lets nothing
wrong through.  The complete key universe of the corpus takes part in the
build, so a key of the corpus is listed exactly if the first level that
rejects it is an even one (or none does and the depth is odd).  Judging a url
needs no join: its candidate keys (host suffix + path prefix) walk the levels.

A second cascade, over the listed keys, tells block rules from allow rules.
The key itself is the rule's text.  Filters are broadcast only up to
``max_filter_bytes`` each; a larger rule set is cut into hash shards whose
cascades are applied one after another, each within that bound.  Deeper levels grow with the corpus, not with
the rules: where one passes the bound, the build starts again with as many shards as that level needs.

Defined cases: a null url or one without ``://`` has empty host and path and
fits no rule; an url that fits no rule is allowed (not listed); repeated rows
are judged alike; a rule listed twice counts once, and block wins where it is listed as both; of rules that fit, the
longest text wins (two of one length would be the same text); very long urls are judged whole;
extra columns are kept out; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import Scratch, ascii_lower

FIRST_FP, LATER_FP = 0.01, 0.1
MAX_DEPTH = 64
MAX_FILTER_BYTES = 32 << 20
NONE, BLOCK, ALLOW = 0, 1, 2


# ------------------------------------------------------------------ bit kernels
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    """k bit positions of each key at one level: shape (k, keys)."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    a, b = _mix(h1.astype(np.uint64) ^ salt), _mix(h2.astype(np.uint64) + salt) | np.uint64(1)
    i = np.arange(k, dtype=np.uint64)[:, None]
    return ((a[None, :] + i * b[None, :]) % np.uint64(bits)).astype(np.int64)


class Level:
    """One Bloom filter of the cascade."""

    def __init__(self, number: int, bits: int, k: int, words: np.ndarray | None = None):
        self.number, self.bits, self.k = number, bits, k
        self.words = words if words is not None else np.zeros(-(-bits // 32), np.uint32)

    @classmethod
    def sized(cls, number: int, keys: int, fp: float) -> "Level":
        bits = max(64, math.ceil(keys * math.log(1 / fp) / math.log(2) ** 2))
        return cls(number, bits, max(1, round(math.log2(1 / fp))))

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        p = _positions(h1, h2, self.number, self.bits, self.k)
        return ((self.words[p >> 5] >> (p & 31).astype(np.uint32)) & 1).all(axis=0)


class Cascade:
    """Exact membership for every key of the universe it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def member(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        rejected = np.full(len(h1), len(self.levels))
        open_ = np.arange(len(h1))
        for i, level in enumerate(self.levels):
            ok = level.passes(h1[open_], h2[open_])
            rejected[open_[~ok]] = i
            open_ = open_[ok]
        return rejected % 2 == 1


# ------------------------------------------------------------------ building
def _fill(keys: DataFrame, level: Level) -> Level:
    """Set the bits of all keys: word by word in the tasks, OR-ed by a grouped aggregate."""
    number, bits, k = level.number, level.bits, level.k

    def words(batches):
        for b in batches:
            p = _positions(b["h1"].to_numpy(np.int64), b["h2"].to_numpy(np.int64), number, bits, k).ravel()
            at, inverse = np.unique(p >> 5, return_inverse=True)
            out = np.zeros(len(at), np.int64)
            np.bitwise_or.at(out, inverse, np.int64(1) << (p & 31))
            yield pd.DataFrame({"at": at, "bits": out})

    rows = keys.mapInPandas(words, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    level.words[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return level


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    spark = keys.sparkSession
    shared = spark.sparkContext.broadcast(level)

    def keep(batches):
        for b in batches:
            if len(b):
                yield b[shared.value.passes(b["h1"].to_numpy(np.int64), b["h2"].to_numpy(np.int64))]
    return keys.mapInPandas(keep, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame, scratch: Scratch,
                  max_filter_bytes: int = MAX_FILTER_BYTES) -> Cascade:
    """``listed`` and ``universe``: h1, h2 (repeats allowed in the universe, which may hold listed keys)."""
    n = listed.count()
    if not n:
        return Cascade([])
    levels = [_fill(listed, _bounded(Level.sized(0, n, FIRST_FP), max_filter_bytes))]
    wrong = scratch.cut(_passing(universe, levels[0]).distinct().join(listed, ["h1", "h2"], "left_anti"))
    encoded = listed
    while n := wrong.count():
        if len(levels) == MAX_DEPTH:
            raise ValueError("two different keys share both 64-bit hashes")
        levels.append(_fill(wrong, _bounded(Level.sized(len(levels), n, LATER_FP), max_filter_bytes)))
        encoded, wrong = wrong, scratch.cut(_passing(encoded, levels[-1]))
    return Cascade(levels)


class LevelTooLarge(ValueError):
    def __init__(self, need: int, bound: int):
        super().__init__(f"a level needs {need} bytes, over the bound of {bound}; use more shards")
        self.need, self.bound = need, bound


def _bounded(level: Level, most: int) -> Level:
    if level.words.nbytes > most:
        raise LevelTooLarge(level.words.nbytes, most)
    return level


# ------------------------------------------------------------------ urls and rules
def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as the contract states them; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), tail


def parse_rules(spark: SparkSession, rules) -> DataFrame:
    """Rules as (verdict, text) pairs or a DataFrame of them → key, verdict code; one row per key."""
    df = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "verdict string, rule string")
    host = F.regexp_extract("rule", r"^[^/]*", 0)
    path = F.substr(F.col("rule"), F.length(host) + F.lit(1))
    code = F.when(F.col("verdict") == "block", F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return (df.where("rule is not null")
            .select(F.concat(ascii_lower(host), path).alias("key"), F.size(F.split(host, r"\.")).alias("labels"),
                    F.length(path).alias("path_len"), code.alias("code"))
            .groupBy("key", "labels", "path_len").agg(F.min("code").alias("code")))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def candidate_keys(host: Column, path: Column, labels: list[int], path_lens: list[int]) -> Column:
    """Keys a rule of the given shapes could have for this url, longest first."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.filter(F.array(*[
        F.when(n >= k, F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")) for k in labels]),
        lambda s: s.isNotNull())
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in path_lens]),
                        lambda p: p.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    ordered = F.array_sort(F.transform(keys, lambda k: F.struct((-F.length(k)).alias("l"), k.alias("k"))))
    return F.transform(F.array_distinct(ordered), lambda x: x["k"])


def _lookup(shared):
    """Arrow-batched walk of both cascades: arrays of key hashes → arrays of codes."""
    @F.pandas_udf("array<tinyint>")
    def code(h1: pd.Series, h2: pd.Series) -> pd.Series:
        listed, blocked = shared.value
        sizes = np.fromiter((len(x) for x in h1), np.int64, len(h1))
        if not sizes.sum():
            return pd.Series([np.zeros(0, np.int8)] * len(h1))
        a = np.concatenate([np.asarray(x, np.int64) for x in h1])
        b = np.concatenate([np.asarray(x, np.int64) for x in h2])
        out = np.zeros(len(a), np.int8)
        hit = np.flatnonzero(listed.member(a, b))
        out[hit] = np.where(blocked.member(a[hit], b[hit]), BLOCK, ALLOW)
        return pd.Series(np.split(out, np.cumsum(sizes)[:-1]))
    return code


def _coded(df: DataFrame, hashed: DataFrame, universe: DataFrame, shards: int, scratch: Scratch,
           max_filter_bytes: int) -> DataFrame:
    """Add ``__codes``: what the cascades of every hash shard say of each candidate key."""
    spark = df.sparkSession

    def shard(keys, s):
        return keys if shards == 1 else keys.where(F.pmod(F.col("h1"), F.lit(shards)) == s)

    def cascades(s):
        own = shard(hashed, s)
        listed = own.select("h1", "h2")
        return (build_cascade(listed, shard(universe, s), scratch, max_filter_bytes),
                build_cascade(own.where(F.col("code") == BLOCK).select("h1", "h2"), listed, scratch,
                              max_filter_bytes))

    if shards == 1:
        return df.withColumn("__codes", _lookup(spark.sparkContext.broadcast(cascades(0)))("__h1", "__h2"))
    df = df.withColumn("__codes", F.transform("__keys", lambda k: F.lit(NONE).cast("tinyint")))
    for s in range(shards):
        code = _lookup(spark.sparkContext.broadcast(cascades(s)))
        df = df.withColumn("__found", code("__h1", "__h2")).withColumn("__codes", F.expr(
            f"transform(__codes, (c, i) -> case when pmod(__h1[i], {shards}) = {s} then __found[i] else c end)"))
        df = scratch.cut(df.drop("__found"))
    return df


def filter_urls(pages: DataFrame, rules, url: str = "url", id_col: str = "page_id",
                max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Judge every url: id, host, path, rule (text of the longest rule that fits, or null), verdict."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "url-filter")
    rule_keys = scratch.cut(parse_rules(spark, rules))
    shape = rule_keys.agg(F.collect_set("labels"), F.collect_set("path_len"), F.count(F.lit(1))).first()
    labels, path_lens, n_rules = sorted(shape[0]), sorted(shape[1]), shape[2]

    df = pages.select(F.col(id_col).alias(id_col), F.col(url).alias("__url"))
    host, path = url_parts(F.col("__url"))
    df = df.select(id_col, host.alias("host"), path.alias("path"))
    if not n_rules:
        return df.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    df = df.withColumn("__keys", candidate_keys(F.col("host"), F.col("path"), labels, path_lens))

    need = Level.sized(0, n_rules, FIRST_FP).words.nbytes
    shards = max(1, math.ceil(2 * need / max_filter_bytes)) if need > max_filter_bytes else 1
    h1, h2 = _hashes(F.col("key"))
    hashed = rule_keys.select(h1.alias("h1"), h2.alias("h2"), "code")
    universe = df.select(F.explode("__keys").alias("key")).select(h1.alias("h1"), h2.alias("h2"))

    df = df.withColumn("__h1", F.transform("__keys", lambda k: _hashes(k)[0]))
    df = df.withColumn("__h2", F.transform("__keys", lambda k: _hashes(k)[1]))
    while True:
        try:
            df = _coded(df, hashed, universe, shards, scratch, max_filter_bytes)
            break
        except LevelTooLarge as e:  # the universe's false positives outgrow the bound, not the rules
            shards = math.ceil(shards * max(2.0, 1.25 * e.need / e.bound))
    first = F.expr("array_position(transform(__codes, c -> c > 0), true)")
    df = df.withColumn("__at", first.cast("int"))
    rule = F.when(F.col("__at") > 0, F.expr("__keys[__at - 1]"))
    blocked = F.expr(f"coalesce(__at > 0 and __codes[greatest(__at - 1, 0)] = {BLOCK}, false)")
    return df.select(id_col, "host", "path", rule.alias("rule"),
                     F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
