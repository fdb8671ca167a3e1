"""Filter audit, conversation repair and neighbour search against plain versions, with the defined cases."""

import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from farelane.llm import ann_search, chat_repair, filter_audit, registry
from farelane.llm.common import Scratch

DOCS = "doc_id long, text string, source string, mask int, digest string, part string, n int, id int"


def audit_docs():
    rng = random.Random(3)
    texts = ["", None, " \n", "A B C", "same words " * 40, "x" * 70000, "tag # one", "fifty " + " ".join(f"w{i}" for i in range(60))]
    texts += [" ".join(rng.choice(["Alpha", "beta", "gamma", "d&d", "E"] + [f"t{i}" for i in range(60)]) for _ in range(rng.randint(1, 90)))
              for _ in range(40)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, "hot", "hot", "hot"])) for i in range(160)]
    return rows + [(7, rows[7][1], "a"), (None, "same words " * 40, "a"), (None, "only here", "b"), rows[9]]


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = {}
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {k for k, bad in zip("ABCDE", [len(w) < 50, 100 * len(set(w)) < 65 * len(w),
                                               100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search(r"[#$%&*|]", t),
                                               i is not None and least.get(t, i) < i]) if bad}
        parts.setdefault(s or "", []).append((i, fails))
    out = []
    for part, docs in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[f] += len(gone)
                lines.append([part, "".join(order), step, len(left), len(gone),
                              sum(f in d[1] for d in docs) - len(gone), sum(d[1] == {f} for d in docs),
                              sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f])
        out += [tuple(x[:-1] + [removed_by[x[-1]]]) for x in lines]
    return sorted(out)


def test_filter_audit_equals_applying_the_filters(spark):
    rows = audit_docs()
    labels = [(i, i % 3 == 0 and 1 or 0, 1 if i % 7 == 0 else None) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(i, t, s, 1, "d", "p", 2, 3) for i, t, s in rows], DOCS)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, known)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_filter_audit_of_other_filters_and_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (2, "a", "s"), (3, "bb", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, labels, {"L": docs["text"] == "a", "R": filter_audit.REPEAT}).collect()
    assert {(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.shapley) for r in got} == {
        ("LR", 1, 1, 2, 0, 3), ("LR", 2, 1, 0, 1, 1), ("RL", 1, 2, 1, 0, 1), ("RL", 2, 1, 1, 1, 3)}
    assert filter_audit.filter_audit(docs.limit(0), labels).count() == 0
    with pytest.raises(ValueError):
        filter_audit.filter_audit(docs, labels, {"AB": docs["text"] == "a"})


def test_removal_ranks_are_the_first_failing_step():
    _, letters, positions = filter_audit.audit_tables("ABCD")
    masks = (np.arange(16)[:, None] >> np.arange(4) & 1).astype(bool)
    ranks = filter_audit.removal_ranks(masks, positions)
    for m in range(16):
        for o, order in enumerate(letters):
            assert ranks[m, o] == next((s for s, f in enumerate(order, 1) if masks[m, f]), 5)


def chats():
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(30)]:
        for turn in range(rng.choice([1, 2, 5, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, turn if rng.random() < .9 else None, role, rng.choice(["Fine.", "cut off", "", " \n", None, "Ok! ", "Ä?\t"])))
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 5 else "no end") for t in range(400)]   # one long, sound
    rows += [(101, t, "user", "x.") for t in range(90)]                                                          # duplicates only
    rows += [(102, t, "user", f"same role {t}.") for t in range(150)]                                            # never converges
    rows += [(103, 0, r, x) for r in ("assistant", "user") for x in ("one.", "two.", "one.")]                    # ties
    rows += [(104, t, "system", f"rule {t}") for t in range(40)]
    rows += [(105, -3, "user", "long " * 20000), (105, 9, "assistant", "z" * 300000 + ".")]
    return rows + [rows[3], rows[50]]


CHATS = "conv_id long, turn long, role string, text string"


def plain_repair(rows, conv):
    """Least-cost, then least-audit edits by a search over (turn, state) from the end."""
    turns = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[3]))
    seen, judged = set(), []
    for turn, role, text, _ in turns:
        ink = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}
    fits = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best = {0: (0, "", ()), 1: (6, "II", ("user:", "assistant:")), 2: (3, "I", ("assistant:",)), 3: (0, "", ())}
    for role, text, fault in reversed(judged):
        plain = {}
        for q in range(4):
            ways = [(4 + best[q][0], "D" + best[q][1], best[q][2])]
            if fault not in ("b", "d"):
                more = 3 if fault == "t" else 0
                if (role[:1], q) in fits:
                    c, a, lines = best[fits[role[:1], q]]
                    ways.append((more + c, "K" + a, (f"{role}:{text}",) + lines))
                c, a, lines = best[nxt[q]]
                ways.append((3 + more + c, "R" + a, (f"{name[nxt[q]]}:{text}",) + lines))
            plain[q] = min(ways)
        for _ in range(3):
            plain = {q: min(plain[q], (3 + plain[nxt[q]][0], "I" + plain[nxt[q]][1], (name[nxt[q]] + ":",) + plain[nxt[q]][2])) for q in plain}
        best = plain
    pairs = [(a[0][:1], b[0][:1]) for a, b in zip(judged, judged[1:])]
    known = [t for t, *_ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults = [f for *_, f in judged]
    return (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"),
            sum("".join(p) not in ("su", "ua", "au") for p in pairs), best[0][0], best[0][1], best[0][2])


@pytest.mark.parametrize("block", [3, 16, chat_repair.BLOCK])
def test_chat_repair_equals_a_plain_search(spark, block):
    import hashlib
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in chats()]
    report, repaired = chat_repair.repair(spark.createDataFrame([r + (1, "b", 0) for r in chats()], CHATS + ", n int, block string, code int"),
                                          block=block)
    got = {r.conv_id: tuple(r) for r in report.collect()}
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.block, r.pos)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    digests = {r.conv_id: r.repaired_sha256 for r in chat_repair.text_digests(repaired).collect()}
    assert set(got) == {c for c, *_ in rows}
    for conv in got:
        mine = [(t, r, x, hashlib.sha256(x.encode()).hexdigest()) for c, t, r, x in rows if c == conv]
        want = plain_repair(mine, conv)
        assert got[conv] == want[:-1], conv
        assert tuple(lines.get(conv, [])) == want[-1], conv
        if want[-1]:
            assert digests[conv] == hashlib.sha256("\n".join(want[-1]).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines.get(conv, [])))


def test_chat_repair_of_nothing_and_of_dropped_conversations(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], CHATS)
    r = chat_repair.repair_damaged(df).collect()
    assert [tuple(x) for x in r] == [(dropped, 0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")]
    assert chat_repair.repair_damaged(df.limit(0)).count() == 0


def test_chat_repair_matches_sql_after_damage(spark):
    df = spark.createDataFrame(chats(), CHATS)
    got = sorted(map(str, map(tuple, chat_repair.repair_damaged(df).collect())))
    con = duckdb.connect()
    con.register("chats", df.toArrow())
    assert got == sorted(map(str, con.execute(registry.repair_sql("chats")).fetchall()))


def test_speculative_vectors_converge_exactly():
    """Wherever a chunk counts as converged, every cost vector that a continuation can give leads to its start vector."""
    rng, auto = random.Random(2), chat_repair.Repair()
    settled = 0
    for _ in range(400):
        chunk, rest = ([rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 13]) for _ in range(rng.randint(1, n))] for n in (12, 30))
        m = auto.matrix(chunk)
        end = auto.vectors(rest, chat_repair.END)[-1]
        true = auto.vectors(chunk, end)[-1]
        assert chat_repair.apply(m, end) == list(true)
        assert chat_repair.product(m, auto.matrix(rest)) == auto.matrix(chunk + rest)
        known = chat_repair.converged(m)
        if known is not None:
            settled += 1
            assert known == list(true)
    assert settled > 100


VECS = "vec_id long, embedding array<float>, id int, vec string, q int, block int"


def brute(rows, k):
    out = []
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    for n, i in enumerate(ids):
        if i % 100 == 0:
            d = np.sqrt(((x - x[n]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if j != n][:k]
            out.append((int(i), [(int(ids[j]), float(d[j])) for j in order]))
    return dict(out)


def vec_rows(n, dim, copies):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[rng.choice(n, copies, replace=False)] = x[0]  # a third of all rows hold one vector
    return [(i, x[i].tolist()) for i in range(n)]


def test_neighbours_found(spark):
    rows = vec_rows(3000, 24, 1000)
    odd = [(9001, None), (9002, []), (9003, [0.0] * 24), (9004, [float("nan")] * 24), (9005, [1.0, None] + [0.0] * 22), (None, rows[1][1]),
           (9007, [float("inf")] * 24), (9100, [1.0, 2.0, 3.0]), (9101, [1.0, 2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, "v", 2, 3) for i, v in rows + odd + rows[5:9]], VECS)
    got = {}
    for r in ann_search.search(df, lambda i: i % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert [(1, 9101, 1.0)] == got.pop(9100)
    want = brute(rows, 10)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, *_ in mine] == list(range(1, 11))
        assert mine == [(n, i, s) for n, (s, i) in enumerate(sorted((s, i) for _, i, s in mine), 1)]
        x = dict(rows)
        for _, i, s in mine:
            assert math.isclose(s, float(np.sqrt(((np.array(x[q], float) - np.array(x[i], float)) ** 2).sum())), rel_tol=1e-12)
        hits += len({i for _, i, _ in mine} & {i for i, _ in near})
    assert hits >= 0.95 * 10 * len(want)
    hot = {q for q, v in rows if v == rows[0][1] and q % 100 == 0}  # copies: exact, smallest ids first
    assert hot and all([i for _, i, _ in sorted(got[q])] == [i for i, _ in want[q]] for q in hot)


def test_neighbours_of_few_and_of_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (200, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann_search.search(df, lambda i: i % 100 == 0).collect())
    assert got == [(0, 1, 200, 0.0), (0, 2, 1, 1.0), (200, 1, 0, 0.0), (200, 2, 1, 1.0)]
    assert ann_search.search(df.limit(0), lambda i: i % 100 == 0).count() == 0
    assert ann_search.search(df.limit(1), lambda i: i % 100 == 0).count() == 0


def test_descent_improves_the_random_graph(spark):
    rows = vec_rows(2000, 32, 0)
    scratch = Scratch(spark, "test-ann")
    vertices = scratch.cut(spark.createDataFrame(rows, "id long, vec array<double>"))
    x = np.array([v for _, v in rows])
    true = {i: set(np.argsort(((x - x[i]) ** 2).sum(axis=1))[1:11].tolist()) for i in range(0, 2000, 20)}

    def recall(links):
        mine = {}
        for r in links.where("u % 20 = 0").collect():
            mine.setdefault(r.u, set()).add(r.w)
        return sum(len(true[i] & mine[i]) for i in true) / (10 * len(true))

    first = ann_search.first_graph(scratch, vertices, 16, 2000)
    after = ann_search.build_graph(scratch, vertices, 16)
    assert recall(first) < 0.6 and recall(after) > 0.8
    assert after.groupBy("u").count().agg({"count": "max"}).first()[0] == 16
    assert after.select("u", "w").distinct().count() == after.count() and after.where("u = w").count() == 0
