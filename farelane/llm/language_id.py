"""Language identification (operator 8).

Method: sparse multinomial logistic regression on TF-IDF weights of hashed
character 1- to 3-grams, trained online with follow-the-regularised-leader
(FTRL-proximal) under an elastic-net penalty, then calibrated by one
temperature fitted on rows that the training did not see.

Document frequencies are counted over every learnable document.  The
regression itself is fitted on a bounded sample: at most
``max_rows_per_class`` rows of each language, chosen by a hash of the row,
in one task; only the model comes to the driver.
Prediction reads every whole text in Arrow batches.

A probability says which learned language fits best, not whether one fits.  ``unfamiliar`` says that: the share of a text's
3-grams that no learned language uses, i.e. that less than ``KNOWN_SHARE`` of the documents of every language hold.  A text is
in no learned language above the model's ``limit``, which is ``UNFAMILIAR`` or, where higher, 0.1 over the 99th
percentile of the sampled training rows.

Characters: lower-cased one by one; everything that is not a letter counts as
a space.  Defined cases: a null text, or one without a letter, is ``und`` with score 0;
a null ``doc_id`` is never learned from and not held out; rows without a language are not learned
from; with nothing to learn from everything is ``und``; equal scores go to the first language by name; a very
long text is summed up in parts, so memory follows its characters, not characters times languages; repeated rows get equal
answers; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import Scratch, small_batches

DIM_BITS = 16
GRAMS = (1, 2, 3)
MAX_ROWS_PER_CLASS = 1500
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.02
SCALE = 10.0
KNOWN_SHARE, UNFAMILIAR = 0.003, 0.5
CHUNK = 1 << 18
SLICE = 1 << 20  # bytes of weights in a row on their way to the driver
SUMS = 1 << 21  # doubles held at once while the grams of a text are summed up
U = np.uint64


# ------------------------------------------------------------------ features
@functools.lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter; the lower-case letter, or a space."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    fold = np.full(0x110000, 0x20, np.uint32)
    for c in np.flatnonzero(letter).tolist():
        low = chr(c).lower()
        fold[c] = ord(low) if len(low) == 1 else c
    return letter, fold


def _texts(column):
    """Groups of rows with bounded characters: (folded code points, offsets, has a letter)."""
    letter, fold = _tables()
    column = pc.fill_null(column, "")
    sizes = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    lo = 0
    while lo < len(sizes):
        total = np.cumsum(sizes[lo:])
        hi = lo + max(1, int(np.searchsorted(total, CHUNK, "right")))
        text = "".join(column.slice(lo, hi - lo).to_pylist())
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate([[0], total[:hi - lo]])
        seen = np.concatenate([[0], np.cumsum(letter[codes])])
        yield lo, hi, fold[codes].astype(U), offsets, seen[offsets[1:]] > seen[offsets[:-1]]
        lo = hi


def _grams(codes: np.ndarray, offsets: np.ndarray):
    """Hashed n-grams inside each row: (slot, first of row (rows + 1)) for every n."""
    h = np.zeros(len(codes), U)
    for n in GRAMS:
        if len(codes) < n:
            break
        h = h[:len(codes) - n + 1] * U(0x9E3779B97F4A7C15) + codes[n - 1:] + U(1)
        slot = ((h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)) >> U(64 - DIM_BITS)
        counts = np.maximum(np.diff(offsets) - (n - 1), 0)
        inside = np.ones(len(slot), bool)
        if n > 1:  # grams that start in the last n-1 characters of a row would cross into the next
            for back in range(1, n):
                at = offsets[1:] - back
                at = at[(at >= 0) & (at < len(slot))]
                inside[at] = False
        yield slot[inside].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def _document_frequencies(batches):
    """Documents that hold a slot as any gram, and as a 3-gram, per language."""
    totals: dict = {}
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), object)
        for lo, _, codes, offsets, _ in _texts(b.column("text")):
            for at in range(0, len(offsets) - 1, 64):
                part = offsets[at:at + 65]
                marks = np.zeros((2, len(part) - 1, 1 << DIM_BITS), bool)
                for n, (slot, first) in zip(GRAMS, _grams(codes[part[0]:part[-1]], part - part[0])):
                    of = np.repeat(np.arange(len(part) - 1), np.diff(first))
                    marks[0, of, slot] = True
                    if n == GRAMS[-1]:
                        marks[1, of, slot] = True
                own = langs[lo + at:lo + at + len(part) - 1]
                for lang in set(own.tolist()):
                    total = totals.setdefault(lang, np.zeros((2, 1 << DIM_BITS), np.int64))
                    total += marks[:, own == lang].sum(axis=1)
    for lang, total in totals.items():
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()),
                                          pa.array(total[0][used]), pa.array(total[1][used])], ["lang", "slot", "df", "long_df"])


def _sample_features(batches):
    """Sparse counts of each row: slots (uint16), counts and 3-gram counts (uint32) as packed bytes."""
    for b in batches:
        slots, counts, longs = [], [], []
        for _, _, codes, offsets, _ in _texts(b.column("text")):
            parts = list(_grams(codes, offsets))
            for i in range(len(offsets) - 1):
                s, c = np.unique(np.concatenate([slot[first[i]:first[i + 1]] for slot, first in parts]
                                                or [np.zeros(0, np.int64)]), return_counts=True)
                slots.append(s.astype(np.uint16).tobytes())
                counts.append(c.astype(np.uint32).tobytes())
                own = np.zeros(0, np.int64)
                if len(parts) == len(GRAMS):
                    slot, first = parts[-1]
                    own = np.searchsorted(s, slot[first[i]:first[i + 1]])
                longs.append(np.bincount(own, minlength=len(s)).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column("lang"), b.column("h"), *[pa.array(x, pa.binary()) for x in (slots, counts, longs)]],
            ["lang", "h", "slots", "counts", "longs"])


# ------------------------------------------------------------------ training
class Model:
    def __init__(self, classes: list[str], weights: np.ndarray, temperature: float, known: np.ndarray, limit: float):
        """weights: (slots, classes), already multiplied by the inverse document frequencies; known: slots of 3-grams
        that a learned language uses; limit: largest unfamiliar share of a text in a learned language."""
        self.classes, self.weights, self.temperature, self.known, self.limit = classes, weights, temperature, known, limit


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list, classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """rows: (slots, values, class).  FTRL-proximal per coordinate and class, L1 + L2."""
    z = np.zeros((1 << DIM_BITS, classes))
    n = np.zeros_like(z)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for slots, x, y in rows:
            zi, ni = z[slots], n[slots]
            w = weights(zi, ni)
            p = _softmax(x @ w)
            p[y] -= 1
            g = np.multiply.outer(x, p)
            z[slots] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[slots] = ni + g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature with the least log loss (golden-section search on its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean())

    lo, hi, ratio = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _fitted(classes: list[str], idf: np.ndarray, known: np.ndarray):
    """Sampled rows in the order of their hashes → the weights in slices of slots, the temperature, and the usual unfamiliar share."""
    def run(batches):
        rows, odd = [], []
        for b in batches:
            for lang, slots, counts, longs in zip(*(b.column(c).to_pylist() for c in ("lang", "slots", "counts", "longs"))):
                slots = np.frombuffer(slots, np.uint16).astype(np.int64)
                counts, longs = (np.frombuffer(x, np.uint32).astype(np.float64) for x in (counts, longs))
                rows.append((slots, SCALE * idf[slots] * counts / max(counts.sum(), 1), classes.index(lang)))
                odd.append(longs[~known[slots]].sum() / max(longs.sum(), 1))
        usual = float(np.quantile(odd, 0.99)) if rows else 0.0
        calibration = rows[4::5] if len(rows) >= 50 else []
        training = [r for i, r in enumerate(rows) if i % 5 != 4] if calibration else rows
        w = train_ftrl(training, len(classes))
        logits = np.array([x @ w[s] for s, x, _ in calibration]).reshape(-1, len(classes))
        temperature = fit_temperature(logits, np.array([y for _, _, y in calibration], np.int64))
        weights = (w * idf[:, None] * SCALE).astype(np.float32)
        step = max(1, SLICE // weights[:1].nbytes)
        for at in range(0, len(weights), step):
            yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int64()), "part": pa.array([weights[at:at + step].tobytes()], pa.binary()),
                                              "temperature": [temperature], "usual": [usual]})
    return run


def train(docs: DataFrame, max_rows_per_class: int = MAX_ROWS_PER_CLASS) -> Model | None:
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "language-id")
    learn = (docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), docs["lang"].alias("lang"))
             .where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                    & ~held_out(F.col("doc_id"))))
    per_class = dict(learn.groupBy("lang").count().orderBy("lang").collect())  # one row per language
    if not per_class:
        return None
    classes, n_docs = sorted(per_class), sum(per_class.values())
    sizes = F.create_map(*[x for c in classes for x in (F.lit(c), F.lit(per_class[c]))])
    df = (learn.select("text", "lang").mapInArrow(_document_frequencies, "lang string, slot long, df long, long_df long")
          .groupBy("slot", "lang").agg(F.sum("df").alias("df"), F.sum("long_df").alias("long_df"))
          .groupBy("slot").agg(F.sum("df").alias("df"), F.max(F.when(
              F.col("long_df") > 1, F.col("long_df") / F.element_at(sizes, F.col("lang")))).alias("share"))
          .toPandas())  # at most 2**DIM_BITS rows
    idf = np.full(1 << DIM_BITS, np.log(1 + n_docs))
    idf[df["slot"]] = np.log((1 + n_docs) / (1 + df["df"])) + 1
    known = np.zeros(1 << DIM_BITS, bool)
    known[df["slot"][df["share"].fillna(0) >= KNOWN_SHARE]] = True

    # A row's hash decides: an expected 0.9 of the bound per class, and never more than the bound.
    share = F.create_map(*[x for c in classes for x in (
        F.lit(c), F.lit(min(1.0, 0.9 * max_rows_per_class / per_class[c])))])
    h = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 40))
    picked = learn.withColumn("h", h).where(F.col("h") < F.element_at(share, F.col("lang")) * float(1 << 40))
    sample = scratch.cut(picked.select("text", "lang", "h").mapInArrow(
        _sample_features, "lang string, h long, slots binary, counts binary, longs binary"))
    # Fitted in one task: the sample is bounded, but a driver that collects it keeps several copies; the model is smaller.
    parts = sample.orderBy("h").limit(max_rows_per_class * len(classes)).mapInArrow(
        _fitted(classes, idf, known), "at long, part binary, temperature double, usual double").collect()
    if not parts:  # no row sampled and Spark skips the function on no rows
        parts = [r for b in _fitted(classes, idf, known)([]) for r in b.to_pylist()]
    parts.sort(key=lambda r: r["at"])
    weights = np.frombuffer(b"".join(r["part"] for r in parts), np.float32).reshape(-1, len(classes))
    return Model(classes, weights, parts[0]["temperature"], known, max(UNFAMILIAR, parts[0]["usual"] + 0.1))


# ------------------------------------------------------------------ prediction
def _predict(shared, names):
    def run(batches):
        model = shared.value
        step = max(1, SUMS // len(model.classes))
        for b in batches:
            lang, score, unfamiliar = [], [], []
            for lo, hi, codes, offsets, letters in _texts(b.column("text")):
                logits = np.zeros((hi - lo, len(model.classes)))
                total, strange = np.zeros(hi - lo), np.zeros(hi - lo)
                for n, (slot, first) in zip(GRAMS, _grams(codes, offsets)):
                    if not len(slot):
                        continue
                    if n == GRAMS[-1]:
                        odd = np.concatenate([[0], np.cumsum(~model.known[slot])])
                        strange = (odd[first[1:]] - odd[first[:-1]]) / np.maximum(np.diff(first), 1)
                    for at in range(0, len(slot), step):
                        part = slot[at:at + step]
                        sums = np.zeros((len(part) + 1, len(model.classes)))
                        np.cumsum(model.weights[part], axis=0, dtype=np.float64, out=sums[1:])
                        inside = np.clip(first - at, 0, len(part))
                        logits += sums[inside[1:]] - sums[inside[:-1]]
                    total += np.diff(first)
                p = _softmax(logits / np.maximum(total, 1)[:, None] / model.temperature)
                best = p.argmax(axis=1)
                lang += [model.classes[c] if ok else "und" for c, ok in zip(best, letters)]
                score += np.where(letters, p[np.arange(hi - lo), best], 0.0).tolist()
                unfamiliar += strange.tolist()
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(unfamiliar, pa.float64())], [*names, "lang_pred", "score", "unfamiliar"])
    return run


def predict(docs: DataFrame, model: Model | None, carry=("doc_id",)) -> DataFrame:
    """The carried columns, lang_pred, score, unfamiliar; only the text is used for the prediction."""
    spark = docs.sparkSession
    small_batches(spark)
    carry = list(carry)
    if model is None:
        return docs.select(*carry, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("unfamiliar"))
    shared = spark.sparkContext.broadcast(model)
    names = carry if "text" in carry else [*carry, "text"]
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*names).dtypes)
    return docs.select(*names).mapInArrow(
        _predict(shared, names), f"{fields}, lang_pred string, score double, unfamiliar double").select(
        *carry, "lang_pred", "score", "unfamiliar")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Train on the learnable rows, then predict every row: doc_id, held_out, lang_pred, score."""
    return predict(docs, train(docs, **options)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                                        "lang_pred", "score")
