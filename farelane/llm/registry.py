"""Queries of the training-data operators and their reference SQL (None where SQL cannot express one)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import (ann_search, bpe, chat_repair, exact_dedup, filter_audit, language_id, line_dedup, near_dedup,
                          packing, substring_dedup, tool_chat, topk_search, url_filter)

QUERIES: dict = {}


def reg(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = (fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the url query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{r}', '{r.split('/')[0]}', '{'/' + r.split('/', 1)[1]}')" for v, r in URL_RULES)
    return f"""WITH parts AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  judged AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
  rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules})
  SELECT j.page_id, j.host, j.path,
    (SELECT arg_max(r.rule, length(r.rule)) FROM rules r WHERE (j.host = r.rule_host OR ends_with(j.host, '.' || r.rule_host)) AND starts_with(j.path, r.rule_path)) AS rule,
    coalesce((SELECT arg_max(r.verdict, length(r.rule)) FROM rules r WHERE (j.host = r.rule_host OR ends_with(j.host, '.' || r.rule_host)) AND starts_with(j.path, r.rule_path)), 'allow') AS verdict
  FROM judged j"""


@reg("op1_url_filters", _url_sql())
def op1(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _json_sql(c: str) -> str:
    out = c
    for i, esc in [(92, "\\\\"), (34, '\\"'), (8, "\\b"), (9, "\\t"), (10, "\\n"), (12, "\\f"), (13, "\\r")]:
        out = f"replace({out}, chr({i}), '{esc}')"
    for i in range(1, 32):
        if i not in (8, 9, 10, 12, 13):
            out = f"replace({out}, chr({i}), '\\u{i:04x}')"
    return f"coalesce('\"' || {out} || '\"', 'null')"


_CHAT_SQL = f"""WITH calls AS (
    SELECT conv_id, turn, conv_id || '/' || turn AS call_id, min(CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END) AS name,
           count(*) AS n_copies, arg_min(text, (CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END, text)) AS body
    FROM conversations WHERE role IN ('user', 'system') GROUP BY conv_id, turn),
  answers AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results
    FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
  opening AS (SELECT conv_id FROM calls WHERE turn = 0),
  joined AS (
    SELECT c.*, a.content, coalesce(a.n_results, 0) AS n_results, o.conv_id IS NOT NULL AS opened,
      concat_ws('; ', CASE WHEN name = 'configure' AND length(body) < 1 THEN 'instructions: shorter than 1' END,
                      CASE WHEN name = 'ask' AND length(body) < 1 THEN 'prompt: shorter than 1' END,
                      CASE WHEN c.turn > 0 AND o.conv_id IS NULL THEN 'depends_on: unknown ' || c.conv_id || '/0' END) AS errors
    FROM calls c LEFT JOIN answers a USING (conv_id, turn) LEFT JOIN opening o ON o.conv_id = c.conv_id),
  judged AS (SELECT *, CASE WHEN errors <> '' THEN 'invalid' WHEN n_results = 0 THEN 'no_result' ELSE 'ok' END AS status FROM joined)
  SELECT conv_id, turn, call_id, name, CAST(CASE WHEN turn > 0 AND opened THEN 1 ELSE 0 END AS INTEGER) AS topo_level,
    n_copies, n_results, status, errors,
    '{{"arguments":{{"conversation":' || conv_id || ',"' ||
      CASE name WHEN 'ask' THEN 'prompt' ELSE 'instructions' END || '":' || {_json_sql('body')} || ',"turn":' || turn ||
      '}},"id":"' || call_id || '","name":"' || name || '","needs":[' ||
      CASE WHEN turn > 0 THEN '"' || conv_id || '/0"' ELSE '' END || '],"result":' || {_json_sql('content')} ||
      ',"status":"' || status || '"}}' AS message
  FROM judged"""


@reg("op2_tool_chats", _CHAT_SQL)
def op2(spark, sf_dir):
    return tool_chat.format_chats(table(spark, sf_dir, "conversations"))


@reg("op3_exact_dedup", """WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
  SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
  FROM d JOIN g USING (t)""")
def op3(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def words_cte(source: str = "documents") -> str:
    return f"""words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {source}))"""


def _substring_sql(window: int = substring_dedup.WINDOW) -> str:
    key = " || ' ' || ".join(["word"] + [f"lead(word, {k}) OVER o" for k in range(1, window)])
    # Doubled lengths 13, 26, ... up to 13 * 2**12 words, past the longest text of the test tables.
    levels = ",\n  ".join(f"""level{n} AS (SELECT a.doc_id, a.i, md5(a.c || b.c) AS c
    FROM level{n - 1} a JOIN level{n - 1} b ON a.doc_id = b.doc_id AND b.i = a.i + {window << (n - 1)}
    QUALIFY min(a.doc_id) OVER (PARTITION BY md5(a.c || b.c)) < max(a.doc_id) OVER (PARTITION BY md5(a.c || b.c)))"""
                           for n in range(1, 13))
    reached = " UNION ALL ".join(f"SELECT doc_id, {window << n} AS n FROM level{n}" for n in range(13))
    return f"""WITH {words_cte()},
  windows AS (SELECT doc_id, i, word, {key} AS k FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
  judged AS (SELECT doc_id, i, word, k IS NOT NULL AND min(doc_id) OVER (PARTITION BY k) < doc_id AS gone FROM windows),
  covered AS (SELECT doc_id, i, word, bool_or(gone) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS gone FROM judged),
  left_over AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id),
  level0 AS (SELECT doc_id, i, md5(k) AS c FROM windows WHERE k IS NOT NULL
    QUALIFY min(doc_id) OVER (PARTITION BY md5(k)) < max(doc_id) OVER (PARTITION BY md5(k))),
  {levels},
  reach AS (SELECT doc_id, max(n) AS longest FROM ({reached}) GROUP BY doc_id)
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
    coalesce(longest, 0) AS longest_repeat
  FROM documents d LEFT JOIN left_over USING (doc_id) LEFT JOIN reach USING (doc_id)"""


@reg("op4_substring_dedup", _substring_sql())
def op4(spark, sf_dir):
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


def packing_sql(source: str = "documents", buckets: int = packing.BUCKETS, budget: int = packing.TOKEN_BUDGET) -> str:
    """The same buckets by plain layers: best(k, j) over every cut i, then walk the cuts back."""
    ctes = [f"""lens AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM {source})""",
            """hist AS (SELECT row_number() OVER (ORDER BY n_tokens) AS j, n_tokens AS grid, CAST(sum(n) OVER (ORDER BY n_tokens) AS BIGINT) AS total,
      CAST(sum(n * n_tokens) OVER (ORDER BY n_tokens) AS BIGINT) AS mass FROM (SELECT n_tokens, count(*) AS n FROM lens GROUP BY n_tokens))""",
            "ends0 AS (SELECT 0 AS j, 0 AS grid, 0 AS total, 0 AS mass UNION ALL SELECT * FROM hist)",
            "best1 AS (SELECT j, CAST(grid * total - mass AS BIGINT) AS cost, 0 AS cut FROM hist)"]
    for k in range(2, buckets + 1):
        ctes.append(f"""best{k} AS (SELECT h.j, min(b.cost + h.grid * (h.total - p.total) - (h.mass - p.mass)) AS cost,
      arg_min(b.j, (b.cost + h.grid * (h.total - p.total) - (h.mass - p.mass), b.j)) AS cut
    FROM hist h JOIN best{k - 1} b ON b.j < h.j AND b.j >= {k - 1} JOIN ends0 p ON p.j = b.j GROUP BY h.j)""")
    ctes.append(f"layers AS (SELECT least({buckets}, (SELECT count(*) FROM hist)) AS k)")
    ctes.append(f"end{buckets} AS (SELECT max(j) AS j FROM hist WHERE (SELECT k FROM layers) >= {buckets})")
    for k in range(buckets - 1, 0, -1):
        ctes.append(f"""end{k} AS (SELECT CASE WHEN (SELECT k FROM layers) = {k} THEN (SELECT max(j) FROM hist)
      ELSE (SELECT b.cut FROM best{k + 1} b JOIN end{k + 1} e ON b.j = e.j) END AS j)""")
    bounds = " UNION ALL ".join(f"SELECT {k - 1} AS bucket, h.grid AS boundary FROM end{k} e JOIN hist h ON h.j = e.j"
                                for k in range(1, buckets + 1))
    ctes.append(f"bounds AS ({bounds})")
    ctes.append("""placed AS (SELECT g.doc_id, g.n_tokens, CAST(min(b.bucket) AS INTEGER) AS bucket, min(b.boundary) AS boundary, g.rn
    FROM (SELECT *, row_number() OVER () AS rn FROM lens) g JOIN bounds b ON b.boundary >= g.n_tokens GROUP BY ALL)""")
    ctes.append(f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n_tokens,
      coalesce(((doc_id % {packing.PRIME} + {packing.PRIME}) % {packing.PRIME}) * {packing.STEP} % {packing.PRIME} % {packing.CHUNKS}, -1), doc_id) - 1 AS r FROM placed)""")
    return "WITH " + ",\n  ".join(ctes) + f"""
  SELECT doc_id, n_tokens, bucket, boundary, CAST(r // greatest({budget} // greatest(boundary, 1), 1) AS BIGINT) AS batch,
    boundary - n_tokens AS padding FROM ranked"""


@reg("op5_minhash_dedup")
def op5(spark, sf_dir):
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@reg("op6_byte_bpe")
def op6(spark, sf_dir):
    encoded = bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)
    return bpe.decode(encoded, VOCABULARY).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@reg("op7_packing", packing_sql())
def op7(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@reg("op8_language_id")
def op8(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@reg("op9_topk_search", """WITH v AS (
    SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
  SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op9(spark, sf_dir):
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % topk_search.QUERY_MOD == 0)


@reg("op10_line_dedup")
def op10(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@reg("op11_filter_audit", """WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
  listed AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
  least AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
  judged AS (
    SELECT doc_id, part, concat(
      CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
      CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN first_id < doc_id THEN 'E' END) AS fails
    FROM listed JOIN least USING (t)),
  known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
  weights AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM judged LEFT JOIN known USING (doc_id) GROUP BY part, fails),
  letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
  orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
  steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
  counted AS (
    SELECT part, filter_order, step, f, sum(n) AS total,
      coalesce(sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') = fails), 0) AS removed,
      coalesce(sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') <> fails), 0) AS redundant,
      coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
      coalesce(sum(good) FILTER (contains(fails, f) AND translate(fails, before, '') = fails), 0) AS good_lost,
      coalesce(sum(toxic) FILTER (contains(fails, f) AND translate(fails, before, '') = fails), 0) AS toxic_lost
    FROM weights, steps GROUP BY ALL)
  SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    CAST(total - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step) AS BIGINT) AS kept,
    CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
  FROM counted""")
def op11(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _crc32_sql(c: str) -> str:
    """CRC-32 (reflected polynomial 0xEDB88320) of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(acc, b)] || range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))"
    return (f"xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({c}, ''), lambda x: ord(x)::BIGINT), "
            f"lambda acc, b: {bits}))")


def repair_sql(source: str = "conversations") -> str:
    """Backward costs turn by turn, then the least edit that is still cheapest, one edit per step."""
    ink = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    back = lambda q, fits: f"least(4 + b[{q}], 3 + add + b[{3 if q != 3 else 4}]{''.join(f', CASE WHEN ini = {i!r} THEN add + b[{t}] ELSE 99999999 END' for i, t in fits)})"  # noqa: E731,E501
    raw = [back(1, [("s", 2), ("u", 3)]), back(2, [("u", 3)]), back(3, [("a", 4)]), back(4, [("u", 3)])]
    return f"""WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM {source}),
  dealt AS (SELECT *, {_crc32_sql('k')} % 20 AS lot FROM keyed),
  damaged AS (
    SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
      CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
      unnest(CASE WHEN lot = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM dealt WHERE lot <> 0),
  placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
      substr(role, 1, 1) AS ini, rtrim(text, {ink}) AS inked FROM damaged),
  judged AS (SELECT *, CASE WHEN inked = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(inked, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
      lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS after FROM placed),
  rows_ AS (SELECT conv_id, i, ini, role, text, coalesce(fault IN ('blank', 'duplicate'), false) AS must,
      CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS add FROM judged),
  counts AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
      count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (after IS NOT NULL AND ini || after NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
  back AS (
    SELECT conv_id, n + 1 AS i, [0, 6, 3, 0]::BIGINT[] AS b FROM counts
    UNION ALL
    SELECT conv_id, i, [least(x[1], 3 + x[3], 6 + x[4]), least(x[2], 3 + x[3], 6 + x[4]), least(x[3], 3 + x[4]), least(x[4], 3 + x[3])]
    FROM (SELECT r.conv_id, r.i, CASE WHEN must THEN list_transform(b, lambda v: v + 4)
            ELSE [{', '.join(raw)}] END AS x
          FROM back k JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM k.conv_id AND r.i = k.i - 1)),
  moves AS (SELECT k.conv_id, k.i, k.b, z.b AS z, r.ini, r.role, r.text, r.must, r.add
    FROM back k LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM k.conv_id AND r.i = k.i
    LEFT JOIN back z ON z.conv_id IS NOT DISTINCT FROM k.conv_id AND z.i = k.i + 1),
  walk AS (
    SELECT conv_id, 1::BIGINT AS i, 1 AS q, '' AS audit, []::VARCHAR[] AS out, 0 AS step FROM counts
    UNION ALL
    SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN q WHEN 'K' THEN kept ELSE grown END, audit || e,
      CASE e WHEN 'D' THEN out WHEN 'K' THEN out || [role || ':' || text]
        WHEN 'R' THEN out || [CASE grown WHEN 3 THEN 'user:' ELSE 'assistant:' END || text]
        ELSE out || [CASE grown WHEN 3 THEN 'user:' ELSE 'assistant:' END] END, step + 1
    FROM (SELECT w.*, m.role, m.text, CASE q WHEN 3 THEN 4 ELSE 3 END AS grown,
            CASE WHEN ini = 's' AND q = 1 THEN 2 WHEN ini = 'u' AND q <> 3 THEN 3 WHEN ini = 'a' AND q = 3 THEN 4 END AS kept,
            CASE WHEN m.z IS NOT NULL AND 4 + m.z[q] = m.b[q] THEN 'D'
              WHEN 3 + m.b[CASE q WHEN 3 THEN 4 ELSE 3 END] = m.b[q] THEN 'I'
              WHEN m.z IS NULL THEN NULL
              WHEN ini = 's' AND q = 1 AND add + m.z[2] = m.b[q] THEN 'K'
              WHEN ini = 'u' AND q <> 3 AND add + m.z[3] = m.b[q] THEN 'K'
              WHEN ini = 'a' AND q = 3 AND add + m.z[4] = m.b[q] THEN 'K' ELSE 'R' END AS e
          FROM walk w JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i)
    WHERE e IS NOT NULL),
  ended AS (SELECT conv_id, arg_max(audit, step) AS audit, arg_max(out, step) AS out FROM walk GROUP BY conv_id),
  costs AS (SELECT conv_id, b[1] AS cost FROM back WHERE i = 1)
  SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(array_to_string(out, chr(10)), '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM {source}) d
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN costs k ON k.conv_id IS NOT DISTINCT FROM d.conv_id"""


@reg("op12_chat_repair", repair_sql())
def op12(spark, sf_dir):
    return chat_repair.repair_damaged(table(spark, sf_dir, "conversations"))


@reg("op13_ann_search")
def op13(spark, sf_dir):
    return ann_search.search(table(spark, sf_dir, "embeddings"), lambda i: i % ann_search.QUERY_MOD == 0)


def queries() -> dict:
    return {k: fn for k, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql is not None}
