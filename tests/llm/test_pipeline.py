"""The pipeline on the smallest tables: what every stage promises, checked by brute force on its input."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from farelane.llm.common import Scratch
from tests.llm.test_operators import shingles

SF = "/root/testdata/sf0.001"


def lines(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in (tuple(x.split()) for x in folded.split("\n")) if w]


def test_stages_keep_their_promises(spark):
    scratch, states = Scratch(spark, "test-pipeline"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    states.append({r.doc_id: r.text for r in docs.collect()})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, SF))
        assert docs.columns == columns
        assert all(r.n_chars == len(r.text) for r in docs.collect())
        states.append({r.doc_id: r.text for r in docs.collect()})
    start, spoken, lined, near, cut = states
    assert all(any(c.isalpha() for c in t) for t in spoken.values()) and len(spoken) >= 0.99 * len(start)

    first = {}
    for i in sorted(spoken):
        for w in lines(spoken[i]):
            first.setdefault(w, i)
    left = [w for t in lined.values() for w in lines(t)]
    assert len(left) == len(set(left)) and set(left) <= set(first)
    assert all(set(lined[i].split("\n")) <= set(spoken[i].split("\n")) for i in lined)

    sets = {i: shingles(t) for i, t in lined.items()}
    kept = sorted(near)
    for n, a in enumerate(kept):
        assert near[a] == lined[a]
        assert not any(sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in kept[:n])
    for gone in set(lined) - set(near):
        assert any(100 * len(sets[gone] & s) >= 80 * len(sets[gone] | s) for i, s in sets.items() if i != gone)

    seen = {}
    for i in sorted(near):
        w = near[i].split()
        gone = set()
        for p in range(len(w) - 12):
            if seen.setdefault(tuple(w[p:p + 13]), i) < i:
                gone.update(range(p, p + 13))
        rest = [x for p, x in enumerate(w) if p not in gone]
        assert cut.get(i, "").split() == rest

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id: r.n_tokens for r in packed} == {i: len(t.split()) for i, t in cut.items()}
    assert corpus_pipeline.run(spark, SF).count() == len(cut)


def test_language_stage_rejects_junk_and_unlearned_scripts(spark):
    """Planted letter junk and texts in scripts nobody labelled go; every document of the table with a letter stays."""
    rng = random.Random(9)
    alphabets = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфх", "的一是不了人我在有他这中大来上国")

    def junk(alphabet):
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 10))) for _ in range(40))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    planted = [(10_000_000 + i, junk(alphabets[i % 3]), None, "s", 1) for i in range(30)]
    planted += [(20_000_000, None, "en", "s", 0), (20_000_001, "", None, None, 0), (20_000_002, "12 34 !", "en", "s", 7)]
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    extra = spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.unionByName(extra.select(*[F.col(c).cast(kinds[c]).alias(c) for c in docs.columns]))
    kept = corpus_pipeline.keep_languages(spark, both.withColumn("score", F.lit("mine")), SF)
    assert kept.columns == [*docs.columns, "score"] and {r.score for r in kept.collect()} == {"mine"}
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert corpus_pipeline.keep_languages(spark, docs.limit(0), SF).collect() == []


def test_texts_are_cut_by_one_python_step(spark):
    """A second evaluation, for the filter on the text that is left, doubles the Python workers of an executor."""
    docs = spark.createDataFrame([(1, "a b\nc d", 7), (2, "a b", 3)], "doc_id long, text string, n_chars int")
    for stage in (corpus_pipeline.drop_lines, corpus_pipeline.drop_passages):
        plan = stage(spark, docs, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
