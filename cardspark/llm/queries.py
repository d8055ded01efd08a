"""The queries of the operators, and the SQL twins of those that SQL can
express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_WS = r"[ \t\n\x0b\x0c\r]+"


# -------------------------------------------------------------- 9: quality

@query("op9_quality_rules", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, [x FOR x IN string_split_regex(t, '{_WS}') IF x <> ''] AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^ \t\n\x0b\x0c\r]')] AS ls
      FROM d),
r AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i+1], ws[i+2]) AS n FROM r),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, t, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[0-9[:punct:] \t\n\x0b\x0c\r]', '', 'g')) AS letters,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
             length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits,
             len(string_split(t, '!!')) - 1 AS shouts
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 4 * n_lines OR word_chars < 2 * n_words
            OR word_chars > 15 * n_words OR 2 * letters < word_chars
            OR 2 * capitals > letters OR 5 * digits > word_chars
            OR 5 * shouts > n_words) AS kept
FROM m""")
def op9_quality_rules(spark, sf_dir):
    """Measures and verdict of every document."""
    from cardspark.llm.quality_rules import judge
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


# --------------------------------------------------------------- 5: mixing

@query("op5_mixing", rf"""
WITH d AS (SELECT doc_id, source, len([x FOR x IN string_split_regex(coalesce(text, ''), '{_WS}') IF x <> '']) AS size,
                  substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 16) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS total,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM d GROUP BY source),
l AS (SELECT *, 3 * total / CAST(weight AS DOUBLE) AS ratio,
             CAST(sum(total) OVER () - coalesce(sum(3 * total) OVER (ORDER BY 3 * total / CAST(weight AS DOUBLE), source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / sum(weight) OVER (ORDER BY 3 * total / CAST(weight AS DOUBLE), source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
t AS (SELECT source, total, least(CAST(3 * total AS DOUBLE), weight * coalesce((SELECT max(level) FROM l WHERE ratio > level), 0.0)) AS target FROM l),
o AS (SELECT d.doc_id, size, total, target, CAST(floor(target + 0.5) AS BIGINT) AS goal,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, total AS source_size, CAST(target AS DOUBLE) AS target,
       CAST(greatest(0, least(goal - place, size)) + greatest(0, least(goal - total - place, size))
            + greatest(0, least(goal - 2 * total - place, size)) AS BIGINT) AS taken
FROM o""")
def op5_mixing(spark, sf_dir):
    """What the mix takes of every document."""
    from cardspark.llm.mixing import mix_report
    return mix_report(table(spark, sf_dir, "documents")).drop("position")


# -------------------------------------------------------------- 8: packing

@query("op8_packing")
def op8_packing(spark, sf_dir):
    """Every piece of every document with its place in a sequence."""
    from cardspark.llm.packing import pack
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


# ------------------------------------------------------------------ 3: PII

@query("op3_pii")
def op3_pii(spark, sf_dir):
    """Personal data and disclosing terms of every document."""
    from cardspark.llm.pii import pii_report
    return pii_report(table(spark, sf_dir, "documents"))


# --------------------------------------------------------- 6: near-duplicates

@query("op6_near_dedup", rf"""
WITH RECURSIVE
w AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WS}') IF x <> ''] AS ws
      FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents
                    UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""")
def op6_near_dedup(spark, sf_dir):
    """The near-duplicate group of every document."""
    from cardspark.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------- 2: LM scores

@query("op2_lm_score")
def op2_lm_score(spark, sf_dir):
    """Base and model log-probability of every document."""
    from cardspark.llm.lm_score import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


# ------------------------------------------------------ 4: nearest neighbours

@query("op4_nearest", """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
      WHERE list_dot_product(e, e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (q.n * c.n) AS score
      FROM u q JOIN u c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s)
WHERE rank <= 5""")
def op4_nearest(spark, sf_dir):
    """The 5 nearest vectors of every fiftieth (exact: factor 1)."""
    from cardspark.llm.vptree import nearest, usable
    points = usable(table(spark, sf_dir, "embeddings"))
    return nearest(points, points.filter("vec_id % 50 = 0"), k=5, factor=1.0)


# -------------------------------------------------------------- 10: languages

@query("op10_language")
def op10_language(spark, sf_dir):
    """The language of every document."""
    from cardspark.llm.langid import language_report
    return language_report(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------- 1: HTML

@query("op1_main_text")
def op1_main_text(spark, sf_dir):
    """The main text of every page."""
    from cardspark.llm.html_crf import extract
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


# ------------------------------------------------------------------- 7: WARC

@query("op7_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes,
             sha256(t) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d
      WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest""")
def op7_warc(spark, sf_dir):
    """Every page, written to WARC files and read back through their index."""
    from cardspark.llm.warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"))


# ------------------------------------------------------- 11: byte-level BPE

@query("op11_bpe")
def op11_bpe(spark, sf_dir):
    """Ids of every document and the bytes they decode to, as digests."""
    from cardspark.llm.bpe import decode, digests, encode
    ids = encode(table(spark, sf_dir, "documents"), keep=["doc_id"])
    both = decode(ids, keep=["doc_id", "ids"])
    return both.select("doc_id", *digests("ids", "decoded"))


# ------------------------------------------------------ 12: periodic runs

# crc32 in SQL: the table of its bytes, and a text's value from it.
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda x: list_reduce(range(8),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS crc)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT)),
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


@query("op12_word_runs", rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} AS h,
             [x FOR x IN string_split_regex(coalesce(text, ''), '{_WS}') IF x <> ''] AS ws
      FROM documents, crc_table),
s AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a FROM d),
t AS (SELECT doc_id, n, unnest(range(n)) AS i, ws, h, a, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM s),
w AS (SELECT doc_id, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
      FROM t),
e AS (SELECT x.doc_id, y.i - x.i AS q, x.i,
             x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
      FROM w x JOIN w y ON y.doc_id = x.doc_id AND y.word = x.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
c AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM e GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM c
      WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
o AS (SELECT doc_id, count(*) AS n_runs,
             sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256,
             arg_min(struct_pack(s := start, l := length, p := period), (-length, start, period)) AS best
      FROM r GROUP BY doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS collapsed
      FROM w ANTI JOIN g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start,
       CAST(best.l AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
       CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN o ON o.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id""")
def op12_word_runs(spark, sf_dir):
    """Periodic runs of words in every document, some of them planted."""
    from cardspark.llm.runs import digests, with_planted_runs, word_runs
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    return word_runs(docs, keep=["doc_id"]).select("doc_id", *digests())


# ---------------------------------------------- 13: conversation structure

def _edits(after: str, before: str) -> str:
    """SQL of the least of a row's edits: ``after`` u or a is the row due next
    in the state ``before`` (s: nothing yet, t: after s, u, a)."""
    keeps = {"s": [("s", "t"), ("u", "u")], "t": [("u", "u")], "a": [("u", "u")], "u": [("a", "a")]}[before]
    due = {"u": "user", "a": "assistant"}[after]
    options = [f"{{c: {before}.c + 3, e: 'D' || {before}.e, l: {before}.l}}"]
    options += [f"CASE WHEN stays AND initial = '{i}' THEN {{c: {to}.c + more, e: 'K' || {to}.e, "
                f"l: role || ':' || text || chr(10) || {to}.l}} END" for i, to in keeps]
    options.append(f"CASE WHEN stays THEN {{c: {after}.c + 2 + more, e: 'R' || {after}.e, "
                   f"l: '{due}:' || text || chr(10) || {after}.l}} END")
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


def _with_insert(state: str, then: str) -> str:
    due = {"u": "user", "a": "assistant"}[then[-1]]
    return (f"list_sort([{state}, {{c: {then}.c + 2, e: 'I' || {then}.e, "
            f"l: '{due}:' || chr(10) || {then}.l}}])[1]")


@query("op13_conversation_repair", rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k
      FROM conversations, crc_table),
x AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS no FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), no) AS i,
             count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS initial FROM x),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM o),
f AS (SELECT *, NOT regexp_matches(text, '[^ \t\n\x0b\x0c\r]') AS blank,
             NOT regexp_matches(text, '[.!?][ \t\n\x0b\x0c\r]*$') AS cut FROM g),
h AS (SELECT *, NOT blank AND again = 1 AS stays, CASE WHEN cut THEN 1 ELSE 0 END AS more FROM f),
z AS (SELECT conv_id, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again > 1) AS duplicate,
             count(*) FILTER (stays AND cut) AS truncated,
             count(*) FILTER (i > 1 AND coalesce(earlier || initial, '') NOT IN ('su', 'ua', 'au')) AS illegal,
             coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(n) AS n
      FROM h GROUP BY conv_id),
b AS (SELECT conv_id, n AS i, {{c: 0, e: '', l: ''}} AS s,
             {{c: 4, e: 'II', l: 'user:' || chr(10) || 'assistant:' || chr(10)}} AS t,
             {{c: 2, e: 'I', l: 'assistant:' || chr(10)}} AS u, {{c: 0, e: '', l: ''}} AS a FROM z
      UNION ALL
      SELECT conv_id, i, {_with_insert('s', 'new_u')}, {_with_insert('t', 'new_u')}, new_u, new_a
      FROM (SELECT conv_id, i, s, t, {_with_insert('u', 'a')} AS new_u, {_with_insert('a', 'u')} AS new_a
            FROM (SELECT b.conv_id, b.i - 1 AS i, {_edits('u', 's')} AS s, {_edits('u', 't')} AS t,
                         {_edits('a', 'u')} AS u, {_edits('u', 'a')} AS a
                  FROM b JOIN h ON h.conv_id IS NOT DISTINCT FROM b.conv_id AND h.i = b.i)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s.c, 0) AS BIGINT) AS cost,
       coalesce(s.e, '') AS audit, sha256(coalesce(left(s.l, length(s.l) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 0""")
def op13_conversation_repair(spark, sf_dir):
    """Faults and cheapest repair of every conversation, after damage."""
    from cardspark.llm.conversations import repair_report
    return repair_report(table(spark, sf_dir, "conversations"))
