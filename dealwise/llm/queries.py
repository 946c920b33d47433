"""Queries ``opN_<name>`` over the given tables, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.llm import (centroids, chat, common, decontaminate, html, licenses, mix, neardups, quality, repair, shard,
                          simhash, substrings, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- 2: chat

_ESC = (r"regexp_replace(regexp_replace({0}, '<(\\*)(/?s>)', '<\\\1\2', 'g'), "
        r"'\[(\\*)(/?INST\])', '[\\\1\2', 'g')")

OP2_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS all_turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + 20) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(all_turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""

#: The conversation that holds its own template's control strings.
PROBE = "</s>[INST] ok [/INST]"


@query("op2_chat_format", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted text."""
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    chats = chat.format_chats(given.unionByName(probe))
    turns = chat.parse(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = chats.select("conv_id", "formatted", F.size(turns).cast("bigint").alias("n_turns"), said.alias("said"),
                        chat.loss_text(F.col("formatted"), F.col("spans")).alias("loss"))
    return rows.select("conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


# ---------------------------------------------------------------- 4: decontamination

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NORM_WORDS = (rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), "
               r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP4_SQL = rf"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_NORM_WORDS} AS ws FROM benchmark),
bl AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
bi AS (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM bl),
bw AS (SELECT DISTINCT item_id, k, array_to_string(ws[i : i + k - 1], ' ') AS w FROM bi),
d AS (SELECT doc_id, {_NORM_WORDS} AS ws FROM documents),
ks AS (SELECT DISTINCT k FROM bw),
di AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') AS w FROM di),
hit AS (SELECT doc_id, dw.k AS k, i, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.w = bw.w),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit),
np AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN np USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op4_decontaminate", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.benchmark_hits(docs, common.table(spark, sf_dir, "benchmark"), out="h")
    return hits.select("doc_id", F.col("h.n_words").alias("n_words"), F.col("h.n_hit").alias("n_hit"),
                       F.size("h.items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("h.items", ",").cast("binary"), 256).alias("items_sha256"),
                       (F.col("h.n_hit") > 0).alias("contaminated"))


# ---------------------------------------------------------------- 6: licences

def _op6_sql() -> str:
    rows = ", ".join("('{}', [{}])".format(n, ", ".join(f"'{g}'" for g in grams))
                     for n, grams in licenses.template_bigrams(licenses.TEMPLATES).items())
    t = licenses.THRESHOLD
    return rf"""
WITH t(license, grams) AS (VALUES {rows}),
u AS (
  SELECT doc_id, -1 AS line, text AS unit FROM documents WHERE contains(text, chr(10))
  UNION ALL
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS unit
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, line, regexp_extract_all(lower(unit), '{licenses.WORD}') AS ws FROM u),
g AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS grams
      FROM w WHERE len(ws) > 1),
m AS (SELECT doc_id, line, license,
             2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
      FROM g JOIN t ON len(g.grams) * {2 - t} >= len(t.grams) * {t} AND len(g.grams) * {t} <= len(t.grams) * {2 - t})
SELECT doc_id, CAST(line AS INTEGER) AS line, license, dice FROM m WHERE dice >= {t}
"""


@query("op6_licenses", _op6_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence matches of every line and text of the documents (those are the SQL's rows),
    and of passages that no line or text shows."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.license_matches(docs).unionByName(licenses.license_passages(docs))


# ---------------------------------------------------------------- 8: shards

@query("op8_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard.shard_texts(docs, 24, out="p").select("doc_id", "p.*")


# ---------------------------------------------------------------- 9: quality

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
p AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN
             w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o
             END AS w5
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, CASE WHEN w5 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w5) > 1 THEN 1 ELSE 0 END AS again
      FROM g),
c AS (SELECT doc_id, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM r),
n AS (SELECT doc_id, sum(hit) AS n FROM c GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN n USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > 3 * n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_dup_lines > 3 * n_lines
            OR 2 * n_upper > word_chars) AS kept
FROM m
"""
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@query("op9_quality", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.quality_cascade(docs, out="q", measures=_MEASURES)
    failed = (F.col("q.n_words") < 10) | (100 * F.col("q.n_repeat_words") > 20 * F.col("q.n_words"))
    return judged.select("doc_id", *[F.col(f"q.{m}").alias(m) for m in _MEASURES],
                         failed.alias("base_failed"), F.col("q.kept").alias("kept"))


# ---------------------------------------------------------------- 10: mixing

#: Target shares of the sources' bytes: one hot source held to a tenth, a second
#: raised, all other sources share the rest.
WEIGHTS = {"src0": 0.10, "src1": 0.15, "src2": 0.10, "src3": 0.05}
_G = "CASE WHEN source IN ({}) THEN source END".format(", ".join(f"'{s}'" for s in WEIGHTS))
_W = "CASE g {} ELSE {} END".format(" ".join(f"WHEN '{s}' THEN {w}::DOUBLE" for s, w in WEIGHTS.items()),
                                    max(0.0, 1.0 - sum(WEIGHTS.values())))

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS print, {_G} AS g, greatest(strlen(coalesce(text, '')), 1) AS b FROM documents),
r AS (SELECT g, ({_W}) * (SELECT sum(b) FROM d) / sum(b) AS rate FROM d GROUP BY g),
k AS (SELECT g, CAST(greatest(1, ceil(rate / {mix.STEP})) AS INTEGER) AS draws, rate / greatest(1, ceil(rate / {mix.STEP})) AS mean
      FROM r),
c AS (SELECT g, draws, n, exp(-mean + n * ln(mean) - lgamma(n + 1)) AS term FROM k, range(0, 80) AS s(n)),
f AS (SELECT g, draws, n, sum(term) OVER (PARTITION BY g ORDER BY n) AS cdf FROM c),
l AS (SELECT g, draws, list(cdf ORDER BY n) AS cdfs FROM f GROUP BY g, draws),
u AS (SELECT doc_id, source, print, cdfs, unnest(range(0, draws)) AS j FROM d JOIN l ON d.g IS NOT DISTINCT FROM l.g),
x AS (SELECT doc_id, source, print, len(list_filter(cdfs, lambda q:
             q <= CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR) || ':' || print || ':' || CAST(j AS VARCHAR)), 1, 13)
                       AS BIGINT) / 4503599627370496.0::DOUBLE)) AS n FROM u),
t AS (SELECT doc_id, source, sum(n) AS times FROM x GROUP BY doc_id, source, print)
SELECT doc_id, source, CAST(unnest(range(0, CAST(times AS BIGINT))) AS INTEGER) AS copy FROM t WHERE times > 0
"""


@query("op10_mix", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents repeated to the target shares, shuffled."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix.poisson_mix(docs, WEIGHTS).select("doc_id", "source", "copy")


# ---------------------------------------------------------------- 3: substring dedup

OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS w FROM s),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY w) AS n FROM g) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM r),
a AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
k AS (SELECT a.doc_id, count(c.p) AS n_removed, string_agg(w, ' ' ORDER BY a.p) FILTER (WHERE c.p IS NULL) AS kept
      FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.p = c.p GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op3_substring_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = substrings.remove_repeats(docs)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# ---------------------------------------------------------------- 7: near duplicates

OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 5 * c >= 4 * (x.n + y.n - c)),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT d.doc_id, least(d.doc_id, coalesce((SELECT min(v) FROM r WHERE r.u = d.doc_id), d.doc_id)) AS class_id,
       (SELECT count(*) FROM e WHERE e.u = d.doc_id) AS n_links
FROM d
"""


@query("op7_neardups", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document."""
    return neardups.near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- 1: toxicity

@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the ids is held out of learning."""
    held = F.coalesce(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held)
    scored = toxicity.toxicity(docs, labels, out="t")
    return scored.select("doc_id", held.alias("held_out"), F.col("t.score").alias("score"),
                         (F.col("t.score") >= 0.7).cast("int").alias("predicted"))


# ---------------------------------------------------------------- 5: main text of pages

@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.main_text(pages, out="m").select("page_id", "url", F.col("m.text").alias("text"),
                                                  F.length("m.text").cast("bigint").alias("n_chars"))


# ---------------------------------------------------------------- 11: conversation repair

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _op11_sql() -> str:
    """The cheapest edits from the last turn backwards: a suffix's (cost, audit) for each
    state, so that putting an edit in front keeps the order of audits."""
    def put(s: str, cost: str, letter: str, line: str) -> str:
        return (f"{{'k': printf('%06d', CAST({s}.k[1:6] AS INTEGER) + {cost}) || '{letter}' || {s}.k[7:], "
                f"'t': {line} || {s}.t}}")

    def said(role: str, text: str = "''") -> str:
        return f"chr(10) || {role} || ':' || {text}"

    def row(q: int) -> str:
        nxt = 3 if q == 2 else 2
        role = "'assistant'" if q == 2 else "'user'"
        more = "CASE WHEN cut THEN 5 ELSE 0 END"
        ways = [put(f"w.s{q}", "2", "D", "''"),
                f"CASE WHEN NOT gone THEN {put(f'w.s{nxt}', f'1 + {more}', 'R', said(role, 'text'))} END"]
        keeps = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[q]
        ways += [f"CASE WHEN NOT gone AND ini = '{i}' THEN {put(f'w.s{to}', more, 'K', said('role', 'text'))} END"
                 for i, to in keeps]
        return f"least({', '.join(ways)}) AS o{q}"

    user, helper = said("'user'"), said("'assistant'")
    return rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
c AS (SELECT k.*, xor(4294967295, list_reduce(list_transform(string_split(id, ''), lambda x: CAST(unicode(x) AS BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT)) % 20 AS code FROM k, tab),
d AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
             CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             right(rtrim(text, {_WS}), 1) AS tail FROM d),
f AS (SELECT *, substr(role, 1, 1) AS ini, tail = '' AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
r AS (SELECT *, blank OR again AS gone, tail NOT IN ('.', '!', '?') AS cut FROM f),
m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
             count(*) FILTER (NOT gone AND cut) AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal,
             count(*) AS n FROM r GROUP BY conv_id),
w(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, n + 1, {{'k': '000000', 't': ''}}, {{'k': '000010II', 't': {user} || {helper}}},
         {{'k': '000005I', 't': {helper}}}, {{'k': '000000', 't': ''}} FROM m
  UNION ALL
  SELECT conv_id, i, least(o0, {put('p2', '5', 'I', user)}), least(o1, {put('p2', '5', 'I', user)}), p2,
         least(o3, {put('o2', '5', 'I', user)})
  FROM (SELECT *, least(o2, {put('o3', '5', 'I', helper)}) AS p2
        FROM (SELECT w.conv_id, r.i, {row(0)}, {row(1)}, {row(2)}, {row(3)}
              FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1)))
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(s0.k[1:6], '0') AS BIGINT) AS cost, coalesce(s0.k[7:], '') AS audit,
       sha256(coalesce(substr(s0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM a.conv_id AND w.i = 1
"""


@query("op11_repair", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = repair.repair_report(repair.damaged(given)).withColumnRenamed("conv_id", "c")
    every = given.groupBy("conv_id").agg(F.lit(0).alias("none")).drop("none")
    rows = every.join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(n, F.lit(0).cast("bigint")).alias(n)
              for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


# ---------------------------------------------------------------- 12: centroids

def _op12_sql() -> str:
    n, dim, scale, rounds = centroids.K, centroids.DIM, centroids.SCALE, centroids.ROUNDS
    parts = [rf"""
WITH e AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, q FROM e),
c0 AS MATERIALIZED (SELECT * FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1
                                          AS c, q FROM v) WHERE c < {n})"""]
    for k in range(rounds + 1):
        parts.append(rf"""
a{k} AS MATERIALIZED (SELECT r, min(CAST(list_sum(list_transform(range(1, {dim + 1}), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))
         AS BIGINT) * {n} + c.c) AS m FROM v, c{k} c GROUP BY r)""")
        if k < rounds:
            parts.append(rf"""
u{k} AS (SELECT m % {n} AS c, i, sum(q[i]) AS s, count(*) AS n FROM v JOIN a{k} USING (r), range(1, {dim + 1}) AS x(i) GROUP BY 1, 2),
c{k + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(n.q, c.q) AS q FROM c{k} c
  LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM u{k} GROUP BY c) n USING (c))""")
    return ",".join(parts) + rf"""
SELECT vec_id, CAST(m % {n} AS INTEGER) AS cluster, m // {n} AS distance,
       CAST(sum(m // {n}) OVER (PARTITION BY m % {n}) AS BIGINT) AS cluster_inertia, CAST(sum(m // {n}) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} c ON c.c = m % {n}
"""


@query("op12_centroids", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector."""
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return centroids.cluster_vectors(vectors, out="p").select("vec_id", *[F.col(f"p.{n}").alias(n) for n in names])


# ---------------------------------------------------------------- 13: SimHash

@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
