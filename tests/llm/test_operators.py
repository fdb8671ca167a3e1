"""Each operator on small tables: defined cases (null, empty, repeated, clashing columns) and brute force."""

import collections
import hashlib
import itertools
import os
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken

from farelane.llm import (bpe, exact_dedup, language_id, line_dedup, linkage, near_dedup, packing, registry,
                          substring_dedup, textkernel, tool_chat, topk_search, url_filter)
from farelane.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, key int, spans string, node string, row int"
LETTERS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau".split()


def words(rng, n):
    return [rng.choice(LETTERS) + rng.choice("abcdefgh") for _ in range(n)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "s", "n", 2) for i, t, lang in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = words(rng, 120)
    rows = [(i, " ".join(words(rng, rng.randint(1, 90))), "en") for i in range(40)]
    rows += [(50 + i, " ".join(base[:i % 7] + base), "en") for i in range(12)]             # near copies
    rows += [(70, " ".join(base), None), (70, " ".join(base), None)]                        # a repeated row
    rows += [(80 + i, " ".join(words(rng, 20) + base[30:60] + words(rng, 9)), "en") for i in range(5)]
    rows += [(90, None, None), (91, "", "en"), (92, " \n\t ", "en"), (None, " ".join(base), "en"), (93, "One", "en")]
    rows += [(94, "\n".join(" ".join(words(rng, 8)) for _ in range(9)) + "\nOne fixed line of five words", "en"),
             (95, "one FIXED line  of five words\nother", "en"), (96, " ".join(words(rng, 5000)), "en")]
    return rows


def test_exact_dedup(spark, corpus):
    rows = corpus + [(200, "ALPHA beta", "x"), (201, "alpha Beta", "x"), (202, "Älpha", "x"), (203, "älpha", "x")]
    for digest in (exact_dedup.sha_digest, lambda c: exact_dedup.F.length(c).cast("string").cast("binary")):
        got = exact_dedup.exact_dedup(docs(spark, rows), digest=digest).collect()
        norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups = collections.defaultdict(list)
        for i, t, _ in rows:
            groups[norm(t)].append(i)
        want = []
        for i, t, _ in rows:
            keep = max((x for x in groups[norm(t)] if x is not None), default=None)
            want.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert exact_dedup.deduplicated(docs(spark, rows)).count() == len(groups)


def test_substring_dedup(spark, corpus):
    got = {(r.doc_id, r.n_words): r for r in substring_dedup.substring_report(docs(spark, corpus)).collect()}
    first = {}
    big = 1 << 62
    for i, t, _ in corpus:
        w = (t or "").split()
        for p in range(len(w) - 12):
            k = tuple(w[p:p + 13])
            first[k] = min(first.get(k, big), big if i is None else i)
    for i, t, _ in corpus:
        w = (t or "").split()
        gone = set()
        for p in range(len(w) - 12):
            if first[tuple(w[p:p + 13])] < (big if i is None else i):
                gone.update(range(p, p + 13))
        r = got[(i, len(w))]
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        assert (r.n_removed, r.kept_sha256) == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert got[(50, 120)].longest_repeat == 104
    out = substring_dedup.remove_substrings(docs(spark, corpus))
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]


def shingles(t, k=5):
    w = tuple("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split())
    return {w[p:p + k] for p in range(len(w) - k + 1)} if len(w) >= k else ({w} if w else set())


def test_near_dedup(spark, corpus):
    # A chain whose ends are not similar: only steps link, whatever the bucket leaders are.
    rng = random.Random(9)
    chain, step = [], words(rng, 200)
    for i in range(12):
        chain.append((300 + i, " ".join(step), "en"))
        step = step[6:] + words(rng, 6)
    rows = corpus + chain
    got = near_dedup.near_dedup(docs(spark, rows)).collect()
    sets = [(i, shingles(t)) for i, t, _ in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if sets[a][1] and sets[b][1] and 100 * both >= 85 * len(sets[a][1] | sets[b][1]):
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for x in range(len(sets)):
        least[find(x)].append(sets[x][0])
    want = []
    for x, (i, s) in enumerate(sets):
        c = min((j for j in least[find(x)] if j is not None), default=None)
        want.append((i, len(s), c, i == c))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert len({w[2] for w in want if w[0] and w[0] >= 300}) == 1


def test_components_match_union_find(spark):
    rng = random.Random(3)
    for n, m, per_task in ((60, 40, 5), (300, 280, 50)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in edges:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        df = spark.createDataFrame([(a.to_bytes(16, "big"), b.to_bytes(16, "big")) for a, b in edges],
                                   "a binary, b binary").repartition(6)
        got = {int.from_bytes(r.node, "big"): int.from_bytes(r.comp, "big")
               for r in linkage.components(df, Scratch(spark, "t"), per_task).collect()}
        assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_line_dedup(spark, corpus):
    rng = random.Random(4)
    line = words(rng, 60)
    variants = [(400 + i, "short\n" + " ".join(line[:i] + ["odd"] + line[i + 1:]), "en") for i in range(8)]
    rows = corpus + variants
    got = {}
    for r in line_dedup.line_report(docs(spark, rows)).collect():
        got.setdefault(r.doc_id, set()).add((r.n_lines, r.n_removed, r.kept_sha256))
    big = 1 << 62
    seen = collections.defaultdict(set)
    for i, t, _ in rows:
        for n, x in enumerate((t or "").split("\n")):
            w = tuple(y for y in "".join(c.lower() if "A" <= c <= "Z" else c for c in x).split())
            if w:
                seen[w].add((big if i is None else i, n))
    keys = sorted(seen)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(keys)):
        for b in range(a):
            most = 0.2 * max(len(keys[a]), len(keys[b])) + 1e-9
            lacking = max(len(set(keys[a]) - set(keys[b])), len(set(keys[b]) - set(keys[a])))  # each takes an edit
            if lacking <= most and distance(keys[a], keys[b]) <= most:
                parent[find(a)] = find(b)
    keep = {}
    for x, k in enumerate(keys):
        keep[find(x)] = min(keep.get(find(x), (big + 1, 0)), min(seen[k]))
    gone = {o for x, k in enumerate(keys) for o in seen[k] if o != keep[find(x)]}
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for n, x in enumerate(lines) if (big if i is None else i, n) not in gone]
        want = (len(lines) if t else 0, len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
        assert want in got[i], i
    assert line_dedup.remove_lines(docs(spark, rows)).columns == [c.split()[0] for c in DOCS.split(", ")]


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a):
        cur = [i + 1]
        for j, y in enumerate(b):
            cur.append(min(prev[j] + (x != y), prev[j + 1] + 1, cur[j] + 1))
        prev = cur
    return prev[-1]


def test_edit_similarity_is_exact():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        b = [x for x in a if rng.random() > 0.15] + [rng.choice("abcd") for _ in range(rng.randint(0, 3))]
        least = rng.choice([0.5, 0.8, 0.9])
        n = max(len(a), len(b))
        assert line_dedup.edit_similarity(a, b, least) == (distance(a, b) <= int((1 - least) * n + 1e-9))


def test_bpe_matches_the_library(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    pools = ["ab", "a", "the ing tion", "aAéñ漢字12 \n", " \t\n\x1c\x85\xa0x", "".join(map(chr, range(33, 3000)))]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 400))) for _ in range(150)]
    texts += ["a" * 5000, "ab" * 3000, " " * 2000, "z" * 3 + "漢" * 900, "x y " * 300_000]
    split = regex.compile(public_tokenizers.PATTERN)
    for t in texts[:-1]:
        assert [i for p in split.findall(t) for i in bpe.encode_piece(p.encode(), ranks)] == want.encode_ordinary(t)
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, None, None), (7, "", None)]
    out = bpe.decode(bpe.encode(docs(spark, rows), path, public_tokenizers.PATTERN), path).collect()
    for (i, t, _), r in zip(rows, out):
        assert r.doc_id == i and bytes(r.decoded).decode() == (t or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == want.encode_ordinary(t or "")


def test_packing(spark, corpus):
    got = packing.pack(docs(spark, corpus), buckets=4, token_budget=300).collect()
    assert len(got) == len(corpus)
    length = [len((t or "").split()) for _, t, _ in corpus]
    distinct = sorted(set(length))
    best = min(sum(min(e for e in ends + (distinct[-1],) if e >= n) - n for n in length)
               for k in range(4) for ends in __import__("itertools").combinations(distinct[:-1], k))
    assert sum(r.padding for r in got) == best
    batches = collections.Counter((r.bucket, r.boundary, r.batch) for r in got)
    assert all(n == 1 or n * boundary <= 300 for (_, boundary, _), n in batches.items())
    for bucket in {b for b, _, _ in batches}:
        assert sorted(x for b, _, x in batches if b == bucket) == list(range(sum(b == bucket for b, _, _ in batches)))


def _least_padding(length, buckets):
    distinct = sorted(set(length))
    return min(sum(min(e for e in ends + (distinct[-1],) if e >= n) - n for n in length)
               for k in range(buckets) for ends in itertools.combinations(distinct[:-1], k))


def test_packing_boundaries_are_optimal_for_any_length():
    rng = random.Random(31)
    for case in range(60):
        spread = (20, 70_000, 5_000_000)[case % 3]
        length = [rng.randrange(spread) for _ in range(rng.randrange(1, 11))]
        count = collections.Counter(length * rng.randrange(1, 3))
        for buckets in (1, 2, 3, 8):
            ends = packing.optimal_boundaries(list(count), list(count.values()), buckets)
            assert set(ends) <= set(length) and len(ends) == min(buckets, len(count))
            padding = sum((min(e for e in ends if e >= n) - n) * c for n, c in count.items())
            assert padding == _least_padding(list(count.elements()), buckets)


def test_packing_keeps_long_lengths_exact(spark):
    length = [16385, 16386, 40001, 3, 0, None]
    rows = [(i, None if n is None else "w " * n, "aa") for i, n in enumerate(length)]
    got = {r.doc_id: r for r in packing.pack(docs(spark, rows)).collect()}
    assert all(r.padding == 0 and r.boundary == r.n_tokens == (length[i] or 0) for i, r in got.items())
    assert packing.pack(docs(spark, [])).collect() == []


def test_word_hashes_read_bytes_alone():
    rng = random.Random(3)
    texts = sorted({"".join(rng.choice("ab\u00e9\u4e16\0") for _ in range(n)) for n in [*range(1, 30), 63, 64, 65, 66, 500] for _ in range(6)})
    texts += [t + "\0" for t in texts[:20] if t + "\0" not in texts]
    def hashes(line):
        data, offsets = textkernel.flat(pa.array([line]))
        starts, ends, _ = textkernel.word_bounds(data, offsets)
        return textkernel.word_hashes(data, starts, ends).tolist()
    once = hashes(" ".join(texts))
    assert len(set(once)) == len(texts)
    shuffled = rng.sample(range(len(texts)), len(texts))
    # At other places, after other words, over several chunks, and alone.
    assert hashes(" \n".join(["x" * textkernel.CHUNK, *[texts[i] for i in shuffled]]))[1:] == [once[i] for i in shuffled]
    assert [hashes(t)[0] for t in texts] == once


def test_line_check_counts_repeated_words(monkeypatch):
    rng = random.Random(8)
    base = [[rng.randrange(12) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    lines = [x for b in base for x in (b, b[:-1], b[2:] + b[:1], [w if rng.random() > 0.15 else 3 for w in b], sorted(b))]
    payloads = [np.array(x, np.uint64).tobytes() for x in lines]
    near = {(i, j) for i, j in itertools.combinations(range(len(lines)), 2) if line_dedup.edit_similarity(lines[i], lines[j], 0.8)}
    check = line_dedup._linked(0.8)
    assert {(i, j) for i, j in itertools.combinations(range(len(lines)), 2) if check(payloads[i], payloads[j])} == near
    anchor = np.array([i % 3 > 0 for i in range(len(lines))])

    def groups(pairs):
        comp = list(range(len(lines)))
        for i, j in pairs:
            comp = [comp[i] if c == comp[j] else c for c in comp]
        return [comp.index(c) for c in comp]
    asked = [(i, j) for i, j in near if anchor[i] or anchor[j]]
    assert groups(line_dedup._links_between(0.8)(payloads, list(range(len(lines))), anchor)) == groups(asked)
    # The same words a different number of times: no edit distance is computed.
    monkeypatch.setattr(line_dedup, "_within", lambda *_: pytest.fail("compared word by word"))
    x, y = (np.array(w, np.uint64).tobytes() for w in ([5, 6, 7] * 8 + [5] * 10, [6, 5, 7] * 8 + [7] * 10))
    assert not line_dedup._linked(0.8)(x, y) and not list(line_dedup._links_between(0.8)([x, y], [0, 1], np.array([True, False])))


def test_language_id_against_plain_python(spark):
    """Grams, idf, FTRL and prediction written out one number at a time, on the sample the operator picks."""
    import math

    def slots(text):
        folded = [c.lower() if c.isalpha() else " " for c in text]
        for n in (1, 2, 3):
            for i in range(len(folded) - n + 1):
                h = 0
                for c in folded[i:i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2 ** 64
                yield ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % 2 ** 64) >> 48, n
    rng = random.Random(12)
    rows = [(i, " ".join("".join(rng.choice(p) for _ in range(4)) for _ in range(6)), lang)
            for i, (lang, p) in enumerate([("aa", "abcdef"), ("bb", "defghi")] * 16)]
    learn = [(t, lang) for i, t, lang in rows if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    df = collections.Counter(s for t, _ in learn for s in {s for s, _ in slots(t)})
    idf = {s: math.log((1 + len(learn)) / (1 + n)) + 1 for s, n in df.items()}
    frame = docs(spark, rows)
    hashes = {r.text: r.h for r in frame.selectExpr("text", "pmod(xxhash64(11, doc_id, text), 1L << 40) h").collect()}
    z, n, eta = collections.defaultdict(float), collections.defaultdict(float), language_id
    weight = lambda k: 0.0 if abs(z[k]) <= eta.L1 else -(z[k] - math.copysign(eta.L1, z[k])) / (
        (eta.BETA + math.sqrt(n[k])) / eta.ALPHA + eta.L2)

    def softmax(v):
        e = [math.exp(x - max(v)) for x in v]
        return [x / sum(e) for x in e]

    def tfidf(text):
        count = collections.Counter(s for s, _ in slots(text))
        return {s: eta.SCALE * idf.get(s, math.log(1 + len(learn))) * c / sum(count.values()) for s, c in count.items()}
    for _ in range(eta.EPOCHS):
        for text, lang in sorted(learn, key=lambda r: hashes[r[0]]):
            x = tfidf(text)
            w = {(s, c): weight((s, c)) for s in x for c in (0, 1)}
            p = softmax([sum(v * w[s, c] for s, v in x.items()) for c in (0, 1)])
            for s, v in x.items():
                for c in (0, 1):
                    g = v * (p[c] - (lang == ("aa", "bb")[c]))
                    z[s, c] += g - (math.sqrt(n[s, c] + g * g) - math.sqrt(n[s, c])) / eta.ALPHA * w[s, c]
                    n[s, c] += g * g
    model = language_id.train(frame)
    assert model.temperature == 1.0  # under 50 rows none is set aside
    got = {r.doc_id: r for r in language_id.predict(frame, model).collect()}
    share = collections.Counter((s, lang) for t, lang in learn for s in {s for s, k in slots(t) if k == 3})
    size = collections.Counter(lang for _, lang in learn)
    known = {s for (s, lang), c in share.items() if c > 1 and c / size[lang] >= eta.KNOWN_SHARE}
    for i, text, _ in rows:
        x = tfidf(text)
        p = softmax([sum(v * weight((s, c)) for s, v in x.items()) for c in (0, 1)])
        assert got[i].lang_pred == ("aa", "bb")[p[1] > p[0]] and abs(got[i].score - max(p)) < 1e-4
        longs = [s for s, k in slots(text) if k == 3]
        assert abs(got[i].unfamiliar - sum(s not in known for s in longs) / len(longs)) < 1e-12


def test_language_id_is_fitted_in_a_task(spark, monkeypatch):
    driver, fit = os.getpid(), language_id.train_ftrl

    def in_task(*args):
        assert os.getpid() != driver, "the sampled rows came to the driver"
        return fit(*args)
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, 9)), ["xx", "yy"][i % 2]) for i in range(80)]
    monkeypatch.setattr(language_id, "SLICE", 1 << 17)  # the weights come in several rows
    whole = language_id.train(docs(spark, rows))
    monkeypatch.setattr(language_id, "train_ftrl", in_task)
    model = language_id.train(docs(spark, rows))
    assert model.weights.shape == (1 << language_id.DIM_BITS, 2) and model.weights.any()
    assert np.array_equal(model.weights, whole.weights) and model.temperature == whole.temperature
    # Languages of which no row is sampled.
    monkeypatch.undo()
    none = language_id.train(docs(spark, rows), max_rows_per_class=0)
    assert none.classes == ["xx", "yy"] and not none.weights.any() and none.temperature == 1.0


def test_language_id_long_text_in_parts(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, " ".join("".join(rng.choice(pool) for _ in range(5)) for _ in range(20)), lang)
            for i, (lang, pool) in enumerate([("aa", "abcde"), ("bb", "vwxyz")] * 40)]
    model = language_id.train(docs(spark, rows))
    long = docs(spark, [(900, " ".join(t for _, t, lang in rows if lang == "bb") * 30, None), (901, "abcab", None)])
    whole = language_id.predict(long, model).collect()
    monkeypatch.setattr(language_id, "SUMS", 64)
    codes = pa.RecordBatch.from_pydict({"doc_id": [r.doc_id for r in long.collect()],
                                        "text": [r.text for r in long.collect()]})
    shared = type("Shared", (), {"value": model})
    parts = next(language_id._predict(shared, ["doc_id", "text"])([codes])).to_pylist()
    assert {r["doc_id"]: r["lang_pred"] for r in parts} == {r.doc_id: r.lang_pred for r in whole} == {900: "bb", 901: "aa"}
    assert all(abs(a["score"] - b.score) < 1e-9 for a, b in zip(sorted(parts, key=lambda r: r["doc_id"]),
                                                                sorted(whole, key=lambda r: r.doc_id)))


def test_url_cascade_few_rules_many_pages(spark):
    """The universe's false positives outgrow the bound although the rules would fit."""
    rules = [("block", f"h{i}.test/") for i in range(100)]
    pages = spark.range(60_000).selectExpr("id as page_id", "concat('http://h', id, '.test/p') as url")
    out = url_filter.filter_urls(pages, rules, max_filter_bytes=256)
    assert out.where("verdict = 'block'").selectExpr("count(*)", "min(page_id)", "max(page_id)").collect() == [(100, 0, 99)]
    assert out.where("verdict = 'allow' and rule is null").count() == 59_900
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def test_language_id(spark):
    rng = random.Random(6)
    pools = {"aa": "abcde", "bb": "vwxyz", "cc": "éèçàù"}
    rows = [(i, " ".join("".join(rng.choice(pools[lang]) for _ in range(5)) for _ in range(20)), lang)
            for i, lang in enumerate(list(pools) * 60)]
    rows += [(500, None, "aa"), (501, "123 !?", "aa"), (None, "abc abd", None), (502, "", None)]
    got = {r.doc_id: r for r in language_id.identify(docs(spark, rows)).collect()}
    import zlib
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows if i is not None)
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang in rows[:180])
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[None].lang_pred == "aa"
    nothing = docs(spark, [(1, "abc", None)])
    assert [tuple(r) for r in language_id.identify(nothing).select("lang_pred", "score").collect()] == [("und", 0.0)]


def test_topk(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)]                                      # ties
    rows += [(2000, None), (2050, [float("nan")] * 8), (2100, [1.0, None]), (None, [1.0] * 8), (2150, [2.0] * 3),
             (2200, []), (0, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(map(tuple, topk_search.top_k(df, lambda i: i % 50 == 0, block_rows=64, query_rows=3).collect()))
    ok = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(v).all()}
    want = []
    for q in ok:
        if q % 50 == 0:
            scored = sorted((-int(ok[q] @ ok[c]), c) for c in ok if c != q and len(ok[c]) == len(ok[q]))[:5]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    assert got == sorted(want)


def test_url_cascade(spark):
    urls = ["http://a.NET/x?y", "https://example.net/en/1", "http://net", "ftp://www.example.net/en", "example.net/en/",
            None, "http://m.EXAMPLE.com/de/5#t", "https://x.org/fr/", "https://org/fr/a/b", "http://net.org/fr", ""]
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls * 2)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, rules).collect()}
    assert got[0] == ("a.net", "/x", "net/", "block") and got[1] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("net", "", None, "allow") and got[3] == ("www.example.net", "/en", "net/", "block")
    assert got[4] == got[5] == got[10] == ("", "", None, "allow")
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == got[8][2:] == ("org/fr/", "allow")
    assert got[9][2:] == (None, "allow")
    # Many rules: several levels, and the same verdicts from hash shards.
    many = [("block" if i % 3 else "allow", f"h{i}.test/") for i in range(0, 3000, 2)]
    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://a.h', id, '.test/p') as url")
    for most in (url_filter.MAX_FILTER_BYTES, 1024):
        out = url_filter.filter_urls(pages, many, max_filter_bytes=most).collect()
        for r in out:
            i = r.page_id
            assert (r.rule, r.verdict) == ((f"h{i}.test/", "block" if i % 3 else "allow") if i % 2 == 0 else (None, "allow"))


def test_tool_calls(spark):
    schema = {"add": {"required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}, "s": {"type": "string"}}}}
    calls = spark.createDataFrame([
        (1, 0, "a", "add", {"x": "1"}, []), (1, 1, "b", "add", {"x": "2", "s": 'q"\n\x01'}, ["a", "a"]),
        (1, 2, "c", "add", {"x": "-1"}, ["b", "zz"]), (1, 3, "d", "sub", {}, ["d"]), (1, 4, "e", "add", {"x": "07"}, ["f"]),
        (1, 5, "f", "add", {"x": "3"}, ["e"]), (1, 0, "a", "add", {"x": "1"}, []), (1, 9, None, "add", {"x": "1"}, []),
        (2, 0, "g", "add", {"y": "1"}, None)],
        "conv_id long, turn long, call_id string, name string, arguments map<string,string>, depends_on array<string>")
    results = spark.createDataFrame([("a", "two"), ("a", "one"), ("b", None), (None, "x")], "call_id string, content string")
    got = {r.call_id: r for r in tool_chat.link_tool_calls(calls, results, schema).collect()}
    assert set(got) == set("abcdefg")
    assert {k: r.topo_level for k, r in got.items()} == {"a": 0, "b": 1, "c": 2, "d": 0, "e": None, "f": None, "g": 0}
    assert {k: r.status for k, r in got.items()} == {"a": "ok", "b": "ok", "c": "invalid", "d": "invalid",
                                                      "e": "cyclic", "f": "cyclic", "g": "invalid"}
    assert got["a"].n_copies == 2 and got["a"].n_results == 2
    assert got["c"].errors == "x: under 0; depends_on: unknown zz"
    assert got["g"].errors == "x: missing; y: unknown argument"
    assert got["b"].message == ('{"arguments":{"s":"q\\"\\n\\u0001","x":2},"id":"b","name":"add","needs":["a"],'
                                '"result":null,"status":"ok"}')


@pytest.mark.parametrize("run", [
    lambda d: exact_dedup.exact_dedup(d), lambda d: substring_dedup.substring_report(d),
    lambda d: near_dedup.near_dedup(d), lambda d: line_dedup.line_report(d), lambda d: packing.pack(d),
    lambda d: language_id.identify(d), lambda d: substring_dedup.remove_substrings(d),
    lambda d: line_dedup.remove_lines(d), lambda d: near_dedup.one_per_component(d)])
def test_empty_table(spark, run):
    assert run(docs(spark, [])).count() == 0


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_matches_reference_sql(spark, key):
    import duckdb
    from tools.check_oracle import TABLES, digest
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    df = registry.queries()[key](spark, "/root/testdata/sf0.001")
    res = con.execute(registry.oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, res.fetchall())[0]


def test_lines_link_by_edit_similarity_alone(spark):
    """Short and long lines at similarity 0.8 to 0.95 against brute force that knows no SimHash."""
    rng = random.Random(12)
    lines = []
    for n, edits in ((5, 1), (10, 1), (10, 2), (20, 1), (50, 5), (100, 20)):
        for _ in range(25):
            line = words(rng, n)
            other = list(line)
            for p in rng.sample(range(n), edits):
                other[p] = "x" + str(rng.randrange(10 ** 9))
            lines += [line, other]
    rows = [(i, " ".join(x), "en") for i, x in enumerate(lines)]
    pairs = [(a, b) for a in range(len(lines)) for b in range(a)
             if 10 * min(len(lines[a]), len(lines[b])) >= 8 * max(len(lines[a]), len(lines[b]))
             and distance(lines[a], lines[b]) <= 0.2 * max(len(lines[a]), len(lines[b])) + 1e-9]
    first = {}
    for a, b in sorted(pairs):
        first[a] = min(first.get(a, a), first.get(b, b))
    gone = {r.doc_id for r in line_dedup.line_report(docs(spark, rows)).collect()
            if r.n_removed}
    want = {a for a in first if first[a] != a}
    assert len(want) >= 150 and gone <= want and len(gone) >= 0.98 * len(want)


def test_short_lines_take_part(spark):
    rows = [(1, "Menu\nhome page\n\nterms of use\nOK", "en"), (2, "menu\nHOME  page\n\nown\nterms of us", "en"),
            (3, "menu\nmenu\n\nbetter terms of use\nbetter terms of use now", "en"), (4, "Menu", "en")]
    got = {r.doc_id: (r.n_removed, r.kept_sha256)
           for r in line_dedup.line_report(docs(spark, rows)).collect()}
    left = {1: rows[0][1], 2: "\nown\nterms of us", 3: "\nbetter terms of use", 4: ""}
    want = {i: (n, hashlib.sha256(left[i].encode()).hexdigest()) for i, n in ((1, 0), (2, 2), (3, 3), (4, 1))}
    assert got == want
    assert {r.doc_id for r in line_dedup.remove_lines(docs(spark, rows)).collect()} == {1, 2, 3}


def test_chunks_are_bounded_by_rows(spark):
    """Many short rows of one bucket: no group holds more than a few times the row bound, all links are found."""
    n, seen = 600, spark.sparkContext.accumulator(0)
    name = lambda i: i.to_bytes(16, "big")
    rows = spark.createDataFrame([(1, name(i)) for i in range(n)], "key long, node binary")
    payloads = spark.createDataFrame([(name(i), (i // 2).to_bytes(8, "big")) for i in range(n)],
                                     "node binary, payload binary")

    def links(payloads, comps, anchor):
        seen.add(len(payloads) > 150)
        at = collections.defaultdict(list)
        for i, p in enumerate(payloads):
            at[p].append(i)
        return [(v[0], v[1]) for v in at.values() if len(v) > 1]
    empty = spark.createDataFrame([], "node binary, comp binary")
    found = linkage.mixed_bucket_links(rows, empty, payloads, links, Scratch(spark, "t"), chunk_rows=40)
    assert {frozenset((bytes(r.a), bytes(r.b))) for r in found.collect()} == {
        frozenset((name(2 * i), name(2 * i + 1))) for i in range(n // 2)}
    assert seen.value == 0


def test_short_documents_are_compared_in_tiles():
    import tracemalloc
    n = 6000
    rng = np.random.default_rng(1)
    sets = [np.unique(np.append(np.arange(4, dtype=np.uint64), rng.integers(10, 1 << 60, 2, dtype=np.uint64)))
            for _ in range(n)]
    sets[17] = sets[5000]
    tracemalloc.start()
    found = list(near_dedup._links_between(85)([s.tobytes() for s in sets], [i.to_bytes(16, "big") for i in range(n)],
                                               np.ones(n, bool)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(17, 5000)] and peak < 200e6  # one 6000 x 6000 matrix of integers is 288 MB


def test_no_result_or_call_is_lost(spark):
    conv = spark.createDataFrame([
        (1, 0, "assistant", "opening"), (1, 1, "user", "q"), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"),
        (1, 2, "assistant", None), (1, 2, "assistant", "a"), (1, 3, "assistant", "more"), (2, 0, "tool", "raw"), (2, 1, "assistant", "done"),
        (3, 0, "user", "y"), (3, 0, "user", "x"), (3, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {r.call_id: r for r in tool_chat.format_chats(conv).collect()}
    assert {k: (r.conv_id, r.turn, r.status, r.n_copies, r.n_results) for k, r in got.items()} == {
        "1/-1": (1, 0, "no_call", 0, 1), "1/1": (1, 1, "invalid", 1, 4), "1/2": (1, 3, "no_call", 0, 1),
        "2/0": (2, 0, "invalid", 1, 1), "3/0": (3, 0, "no_result", 3, 0)}
    assert '"result":["a","b",null]' in got["1/1"].message and got["2/0"].errors.startswith("no schema for tool")
    assert got["1/2"].message == '{"arguments":null,"id":"1/2","name":null,"needs":[],"result":"more","status":"no_call"}'
    one = '{"arguments":{"conversation":3,"prompt":"%s","turn":0},"name":"ask"}'
    assert got["3/0"].message.endswith(f'"variants":[{one % "x"},{one % "y"}]}}')


def test_hot_line_key_is_spread():
    import pandas as pd
    import pyarrow as pa
    rng = random.Random(13)
    base = words(rng, 60)
    texts = ["\n".join(" ".join(base + [f"n{40 * i + j}"]) for j in range(40)) for i in range(10)] + [" ".join(words(rng, 60))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    out = {}
    for cap in (10, 10 ** 9):
        frame = pd.concat([b.to_pandas() for b in line_dedup._dealt(0.8, 2, cap)([batch])])
        groups = [line_dedup._shared(g) for _, g in frame.groupby(["band", "bucket"])]
        out[cap] = set(map(tuple, pd.concat(groups)[["key", "name"]].to_numpy().tolist()))
        if cap == 10:
            assert max(len(b"".join(g["names"])) // 8 for _, g in frame.groupby(["band", "bucket"])) <= 100
    assert out[10] == out[10 ** 9] and len(out[10]) > 400


def test_keys_of_the_same_lines_are_reported_once():
    import pandas as pd
    import pyarrow as pa
    rng = random.Random(14)
    one, two = words(rng, 40), words(rng, 40)
    texts = [" ".join(one), " ".join(one[:-1] + ["x"]), "\n".join(" ".join(two + [f"n{i}"]) for i in range(30))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])

    def groups(cap, rows):
        frame = pd.concat([b.to_pandas() for b in line_dedup._dealt(0.8, 2, cap)([batch])])
        out = pd.concat([rows(g) for _, g in frame.groupby(["band", "bucket"])]).drop_duplicates()
        return out.groupby("key")["name"].agg(lambda x: tuple(sorted(x)))
    for cap in (5, 10 ** 9):  # hot keys and none
        every, once = groups(cap, line_dedup._shared), groups(cap, line_dedup._shared_once)
        assert set(every) == set(once) and len(once) < len(every)
    pair = [x for x in every if len(x) == 2]
    assert len(pair) > 20 and len(set(pair)) == list(once).count(pair[0]) == 1


def test_one_document_of_a_component_stays(spark):
    rng = random.Random(21)
    one, two, three = words(rng, 200), words(rng, 200), words(rng, 200)
    near = lambda w, k: " ".join(w[:-1] + [f"last{k}"])
    rows = [(7, near(one, 0), "en"), (7, near(one, 1), "en"), (8, near(one, 2), "en"), (None, near(one, 3), "en"),
            (None, near(two, 0), "en"), (None, near(two, 1), "en"), (None, near(three, 0), "en"),
            (None, near(three, 0), "en"), (None, None, "en"), (9, "", "en")]
    got = near_dedup.one_per_component(docs(spark, rows)).collect()
    left = collections.Counter((r.doc_id, " ".join((r.text or "").split()[:2])) for r in got)
    assert left == {(7, " ".join(one[:2])): 1, (None, " ".join(two[:2])): 1, (None, " ".join(three[:2])): 1,
                    (None, ""): 1, (9, ""): 1}


def test_linked_agrees_with_the_edit_distance(monkeypatch):
    """Equal ends, replaced words, moved words and unrelated lines; an edit within the limit needs no distance table."""
    rng, check = random.Random(5), line_dedup._linked(0.8)
    packed = lambda x: np.array(x, np.uint64).tobytes()
    lines = []
    for _ in range(400):
        a = [rng.randrange(9) for _ in range(rng.randrange(1, 30))]
        b = list(a)
        for _ in range(rng.randrange(0, 7)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = [rng.randrange(9)] * rng.randrange(2)
        lines.append((a, b or [1]))
    for a, b in lines + [(a, c) for (a, _), (_, c) in zip(lines, lines[1:])]:
        assert check(packed(a), packed(b)) == (distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))
    monkeypatch.setattr(line_dedup, "_within", None)
    base = list(range(100))
    assert check(packed(base), packed(base[:40] + base[45:])) and check(packed(base), packed([7, *base[1:50], 9, *base[51:]]))
    assert not check(packed(base), packed(range(200, 300)))


def test_links_between_equal_pairwise_checks(monkeypatch):
    """Whatever number of lines is compared at once: the links join the components that all checked pairs join."""
    rng = random.Random(6)
    base = [[rng.randrange(40) for _ in range(20)] for _ in range(4)]
    rows = [[rng.randrange(40) if rng.random() < 0.06 else w for w in rng.choice(base)] for _ in range(30)]
    payloads = [np.array(r, np.uint64).tobytes() for r in rows]
    anchor = np.array([rng.random() < 0.6 for _ in rows])
    comps = [b"%d" % i for i in range(len(rows))]
    check = line_dedup._linked(0.8)
    every = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if (anchor[i] or anchor[j]) and check(payloads[i], payloads[j])]

    def groups(links):
        of = list(range(len(rows)))
        for i, j in links:
            of = [of[i] if x == of[j] else x for x in of]
        return {frozenset(k for k, y in enumerate(of) if y == x) for x in of}
    for marks in (1, 1500, 1 << 20):
        monkeypatch.setattr(line_dedup, "HELD_MARKS", marks)
        found = list(line_dedup._links_between(0.8)(payloads, comps, anchor))
        assert {tuple(sorted(x)) for x in found} <= set(every) and groups(found) == groups(every)


def test_wanted_words_follow_the_lines():
    text = pa.array(["A b\n\nc", "d\nE f g"])
    wanted = pa.array([[{"line": 2, "node": b"x"}, {"line": 0, "node": b"y"}], [{"line": 1, "node": b"z"}]],
                      pa.list_(pa.struct([("line", pa.int32()), ("node", pa.binary())])))
    batch = pa.RecordBatch.from_arrays([text, wanted], ["text", "wanted"])
    size = {r["node"]: len(r["payload"]) // 8 for out in line_dedup._wanted_words([batch]) for r in out.to_pylist()}
    assert size == {b"x": 1, b"y": 2, b"z": 3}
    same = pa.RecordBatch.from_arrays([pa.array(["C\ne F g"]), wanted[:1].take([0])], ["text", "wanted"])
    assert same.num_rows == 1


def test_first_level_holds_a_slice_of_a_batch(monkeypatch):
    """A batch is hashed in slices, whose cut changes no window."""
    class Task:
        get = staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 1)}))
    monkeypatch.setattr(substring_dedup, "TaskContext", Task)
    rng = random.Random(8)
    texts = [" ".join(words(rng, rng.randrange(0, 40))) for _ in range(25)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(27), pa.int64()), pa.array(range(27), pa.int64()),
                                        pa.array(texts, pa.string())], ["id", "key", "text"])
    seen = []
    flat = substring_dedup.tk.flat
    monkeypatch.setattr(substring_dedup.tk, "flat", lambda c: seen.append(len(c)) or flat(c))
    outs = []
    for rows in (4, 1000):
        monkeypatch.setattr(substring_dedup, "SLICE_ROWS", rows)
        outs.append([r.to_pylist() for r in substring_dedup._first_level(13, 3, 1 << 19)([batch])])
    assert outs[0] == outs[1] and outs[0] and max(seen[:7]) == 4
