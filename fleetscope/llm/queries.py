"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies one operator to its whole table and derives the digest
columns of its contract from the operator's own results.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.session import prepare
from fleetscope.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text", *more)


# --- 6: secret scans -----------------------------------------------------------

def _secrets_sql() -> str:
    rules = [  # rank, kind, pattern, judged group, least length
        ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", "AKIA[A-Z0-9]+", 0, 16),
        ("hex", "[0-9a-f]+", 0, 32),
        ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ]
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    matches = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS rank, '{kind}' AS kind, {least} AS least, "
        f"string_split_regex(text, {lit(p)}) AS gaps, regexp_extract_all(text, {lit(p)}, 0) AS hits, "
        f"regexp_extract_all(text, {lit(p)}, {group}) AS judged FROM d WHERE regexp_matches(text, {lit(p)})"
        for i, (kind, p, group, least) in enumerate(rules))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({matches}),
e AS (SELECT doc_id, rank, kind, least, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit, unnest(judged) AS judged,
             unnest(range(len(hits))) AS pos FROM m),
s AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY pos) AS stop FROM e),
f AS (SELECT doc_id, rank, kind, stop - length(hit) AS start, stop FROM s WHERE length(judged) >= least),
a AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
             coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank <= 2), '') AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


@query("op6_secret_scans", _secrets_sql())
def op6(spark, sf_dir):
    from fleetscope.llm import secret_scan as S
    base = [r.kind for r in S.BASE_RULES]
    found = S.scan(documents(spark, sf_dir))
    n = lambda kind: F.size(F.filter("findings", lambda x: x.kind == kind)).cast("long")
    return found.select("doc_id", *[n(k).alias(f"n_{k}") for k in base],
                        F.sha2(S.listed("findings", base), 256).alias("base_sha256"),
                        S.listed("findings").alias("spans"))


# --- 8: byte-level BPE ---------------------------------------------------------

@query("op8_bpe_round_trip")
def op8(spark, sf_dir):
    import public_tokenizers as P

    from fleetscope.llm import bpe
    return bpe.round_trip(documents(spark, sf_dir), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


# --- 10: URL filters -----------------------------------------------------------

def _urls_sql() -> str:
    from fleetscope.llm.urls import HOST_RULES, PATTERN_RULES
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ", ".join(f"({lit(r.text)}, {lit(r.text.partition('/')[0])}, "
                      f"{lit('/' + r.text.partition('/')[2])}, {lit(r.verdict)})" for r in HOST_RULES)
    fits = lambda v: " OR ".join(f"regexp_matches(target, {lit(r.regex)})"
                                 for r in PATTERN_RULES if r.verdict == v) or "false"
    return f"""
WITH rules(rule, rhost, rpath, verdict) AS (VALUES {rules}),
p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^/?#]*(.*)$', 1) AS tail FROM p),
t AS (SELECT page_id, host, path, host || tail AS target,
             (SELECT arg_max(struct_pack(rule := rule, verdict := verdict), length(rule)) FROM rules
              WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best FROM q)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN {fits('allow')} THEN 'allow' WHEN {fits('block')} THEN 'block' ELSE 'allow' END) AS verdict
FROM t
"""


@query("op10_url_filters", _urls_sql())
def op10(spark, sf_dir):
    from fleetscope.llm import urls as U
    judged = U.judge_urls(read_table(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


# --- 1: embedding near-duplicates ----------------------------------------------

@query("op1_embedding_near_dedup")
def op1(spark, sf_dir):
    from fleetscope.llm import embeddings as E
    return E.near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


# --- 4: SimHash near-duplicates ------------------------------------------------

@query("op4_simhash_near_dedup")
def op4(spark, sf_dir):
    from fleetscope.llm import simhash as H
    found = H.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- 3: benchmark decontamination ----------------------------------------------

DECONTAMINATION_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(words)) AS n,
             unnest(list_transform(range(greatest(1, len(words) - 9)), lambda i: array_to_string(words[i + 1:i + 10], ' '))) AS gram
      FROM b WHERE len(words) > 0),
lengths AS (SELECT DISTINCT n FROM g),
d AS (SELECT doc_id, n, unnest(range(len(words) - n + 1)) AS pos,
             unnest(list_transform(range(len(words) - n + 1), lambda i: array_to_string(words[i + 1:i + n], ' '))) AS gram
      FROM w, lengths WHERE len(words) >= n),
h AS (SELECT d.doc_id, d.pos, d.n, g.item_id FROM d JOIN g ON d.gram = g.gram AND d.n = g.n),
k AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
      FROM h GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN k USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query("op3_benchmark_decontamination", DECONTAMINATION_SQL)
def op3(spark, sf_dir):
    from fleetscope.llm import decontaminate as D
    found = D.report(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


# --- 2: toxicity ---------------------------------------------------------------

@query("op2_toxicity")
def op2(spark, sf_dir):
    from fleetscope.llm import toxicity as X
    docs = documents(spark, sf_dir)
    return X.score(docs, X.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic")))


# --- 9: substring deduplication ------------------------------------------------

SUBSTRINGS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, unnest(range(len(words) - 19)) AS pos,
             unnest(list_transform(range(len(words) - 19), lambda i: array_to_string(words[i + 1:i + 20], ' '))) AS gram
      FROM w WHERE len(words) >= 20),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS k FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS p FROM r WHERE k > 1),
e AS (SELECT doc_id, unnest(range(len(words))) AS p, unnest(words) AS word FROM w),
a AS (SELECT e.doc_id, count(c.p) AS n_removed, string_agg(CASE WHEN c.p IS NULL THEN word END, ' ' ORDER BY e.p) AS kept
      FROM e LEFT JOIN c USING (doc_id, p) GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN a USING (doc_id)
"""


@query("op9_substring_dedup", SUBSTRINGS_SQL)
def op9(spark, sf_dir):
    from fleetscope.llm import substrings as U
    found = U.repeats_removed(documents(spark, sf_dir))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x.stop - x.start))
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


# --- 5: language-model scores --------------------------------------------------

LM_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (SELECT doc_id, len(words) AS size, unnest(words) AS word, unnest(list_prepend(NULL, words[:-2])) AS prev FROM w WHERE len(words) > 0),
c1 AS (SELECT word, count(*) AS n FROM t GROUP BY ALL), d1 AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL),
c2 AS (SELECT prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY ALL),
d2 AS (SELECT doc_id, prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY ALL),
s AS (SELECT t.doc_id, c1.n - d1.n AS one, c2.n - d2.n AS two, p1.n - q1.n AS context,
             greatest((SELECT count(*) FROM t) - size, 1) AS rest
      FROM t JOIN c1 ON t.word = c1.word JOIN d1 ON t.doc_id = d1.doc_id AND t.word = d1.word
      LEFT JOIN c2 ON t.prev = c2.prev AND t.word = c2.word LEFT JOIN d2 ON t.doc_id = d2.doc_id AND t.prev = d2.prev AND t.word = d2.word
      LEFT JOIN c1 p1 ON t.prev = p1.word LEFT JOIN d1 q1 ON t.doc_id = q1.doc_id AND t.prev = q1.word),
a AS (SELECT doc_id, sum(CASE WHEN two > 0 THEN ln(two / context) ELSE ln(greatest(one, 1) / rest)
             + CASE WHEN two IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END END) AS score, count(*) FILTER (two = 0) AS n_backoff FROM s GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, round(coalesce(score, 0), 6) AS log_score, coalesce(n_backoff, 0)::BIGINT AS n_backoff
FROM w LEFT JOIN a USING (doc_id)
"""


@query("op5_lm_scores", LM_SQL)
def op5(spark, sf_dir):
    from fleetscope.llm import lm_scores as L
    return L.scores(documents(spark, sf_dir)).withColumn("log_score", F.round("log_score", 6))


LM3_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (SELECT doc_id, len(words) AS size, unnest(words) AS word, unnest(list_prepend(NULL, words)[:len(words)]) AS prev,
             unnest(list_prepend(NULL, list_prepend(NULL, words))[:len(words)]) AS prev2 FROM w WHERE len(words) > 0),
c1 AS (SELECT word, count(*) AS n FROM t GROUP BY ALL), d1 AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL),
c2 AS (SELECT prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY ALL),
d2 AS (SELECT doc_id, prev, word, count(*) AS n FROM t WHERE prev IS NOT NULL GROUP BY ALL),
c3 AS (SELECT prev2, prev, word, count(*) AS n FROM t WHERE prev2 IS NOT NULL GROUP BY ALL),
d3 AS (SELECT doc_id, prev2, prev, word, count(*) AS n FROM t WHERE prev2 IS NOT NULL GROUP BY ALL),
s AS (SELECT t.doc_id, c1.n - d1.n AS one, c2.n - d2.n AS two, c3.n - d3.n AS three, p1.n - q1.n AS context, p2.n - q2.n AS context2,
             greatest((SELECT count(*) FROM t) - size, 1) AS rest
      FROM t JOIN c1 ON t.word = c1.word JOIN d1 ON t.doc_id = d1.doc_id AND t.word = d1.word
      LEFT JOIN c2 ON t.prev = c2.prev AND t.word = c2.word LEFT JOIN d2 ON t.doc_id = d2.doc_id AND t.prev = d2.prev AND t.word = d2.word
      LEFT JOIN c3 ON t.prev2 = c3.prev2 AND t.prev = c3.prev AND t.word = c3.word
      LEFT JOIN d3 ON t.doc_id = d3.doc_id AND t.prev2 = d3.prev2 AND t.prev = d3.prev AND t.word = d3.word
      LEFT JOIN c1 p1 ON t.prev = p1.word LEFT JOIN d1 q1 ON t.doc_id = q1.doc_id AND t.prev = q1.word
      LEFT JOIN c2 p2 ON t.prev2 = p2.prev AND t.prev = p2.word LEFT JOIN d2 q2 ON t.doc_id = q2.doc_id AND t.prev2 = q2.prev AND t.prev = q2.word),
a AS (SELECT doc_id, sum(CASE WHEN three > 0 THEN ln(three / context2) ELSE CASE WHEN three IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END
             + CASE WHEN two > 0 THEN ln(two / context) ELSE ln(greatest(one, 1) / rest)
               + CASE WHEN two IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END END END) AS score,
             count(*) FILTER (three = 0) + count(*) FILTER (two = 0) AS n_backoff FROM s GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, round(coalesce(score, 0), 6) AS log_score, coalesce(n_backoff, 0)::BIGINT AS n_backoff
FROM w LEFT JOIN a USING (doc_id)
"""


@query("op5_lm_scores_order3", LM3_SQL)
def op5_order3(spark, sf_dir):
    from fleetscope.llm import lm_scores as L
    return L.scores(documents(spark, sf_dir), order=3).withColumn("log_score", F.round("log_score", 6))


# --- 7: suffix-array deduplication ---------------------------------------------

@query("op7_suffix_array_dedup")
def op7(spark, sf_dir):
    from fleetscope.llm import suffixes as S
    found = S.repeats_removed(documents(spark, sf_dir))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x.stop - x.start))
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


# --- 11: license scans ---------------------------------------------------------

def _licenses_sql() -> str:
    from fleetscope.llm import licenses as C
    words = lambda p: "[" + ", ".join(f"'{w}'" for w in p) + "]"
    phrases = C._phrases(C.TEMPLATES)
    starts = ", ".join(f"CASE WHEN list_has_all(words, {words(p)}) THEN list_filter(range(len(words) - {len(p) - 1}), "
                       f"lambda s: words[s + 1:s + {len(p)}] = {words(p)}) ELSE [] END AS p{i}" for i, p in enumerate(phrases))
    base = [phrases.index(tuple(C.words_of(k))) for t in C.BASE for k in t.keys]
    labels, shares = [], []
    for t in C.TEMPLATES:
        text, keys = C.words_of(t.text), [tuple(C.words_of(k)) for k in t.keys]
        stands = " AND ".join(f"len(p{phrases.index(k)}) > 0" for k in keys)
        labels.append(f"CASE WHEN {stands} THEN '{t.label}' END")
        for k in keys:
            at = C._place(text, list(k))
            shares.append(f"CASE WHEN {stands} THEN list_max(list_transform(p{phrases.index(k)}, lambda s: len(list_filter(range({len(text)}), "
                          f"lambda i: s - {at} + i >= 0 AND words[s - {at} + i + 1] = {words(text)}[i + 1])) / {len(text)})) END")
    joined = lambda x: f"array_to_string(list_sort(list_distinct([{', '.join(x)}])), ',')"
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
p AS (SELECT doc_id, words, {starts} FROM w),
b AS (SELECT *, list_concat({', '.join(f'p{i}' for i in base)}) AS places FROM p)
SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
       list_max(places)::BIGINT AS last_word, {joined(labels[:len(C.BASE)])} AS base_labels, {joined(labels)} AS labels,
       coalesce(greatest({', '.join(shares)}), 0)::DOUBLE AS score
FROM b
"""


@query("op11_license_scans", _licenses_sql())
def op11(spark, sf_dir):
    from fleetscope.llm import licenses as C
    found = C.scan(documents(spark, sf_dir))
    label = {" ".join(C.words_of(k)): t.label for t in C.BASE for k in t.keys}
    base = F.filter("places", lambda x: x.phrase.isin(*label))
    starts = found.withColumn("starts", F.transform(base, lambda x: x.start)).withColumn("phrases", F.transform(base, lambda x: x.phrase))
    names = F.filter(F.array(*[F.when(F.array_contains("phrases", p), F.lit(v)) for p, v in label.items()]), lambda x: x.isNotNull())
    return starts.select("doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
                         F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
                         F.array_join(F.sort_array(F.array_distinct(names)), ",").alias("base_labels"),
                         F.array_join("labels", ",").alias("labels"), "score")


# --- 12: periodic runs ---------------------------------------------------------

def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of the contract: in every tenth one (by checksum) the words
    from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
                       .alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    rows = rows.select("doc_id", "text", "words", "g", F.when(n > 0, n).alias("n"))
    rows = rows.select("*", F.when(F.col("n").isNotNull(), F.col("g") % F.col("n")).cast("int").alias("a"))
    rows = rows.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    tail = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(tail / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), tail)), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), made).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    from fleetscope.llm import periodic as P
    found = P.periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return (found.select("doc_id", "runs", "collapsed", best.alias("best"))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


# --- 13: conversation prefix trie ----------------------------------------------

def _crc32_sql(text: str) -> str:
    bit = "xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295)"


CONVERSATIONS_SQL = f"""
WITH t AS (SELECT conv_id AS c, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
                  ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, turns, c - c % 5 AS base, {_crc32_sql('c::VARCHAR')} % 9 AS h FROM t),
r AS (SELECT h.c, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS path FROM h LEFT JOIN t b ON b.c = h.base),
m AS (SELECT c, len(path) = d AS ends, d, path[1:d] AS path FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM r)),
n AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends FROM m GROUP BY path, d),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.path[d].text) END AS own
      FROM n LEFT JOIN k ON n.path = k.path),
u AS (SELECT path[1:e] AS path, sum(own) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(d + 1)) AS e FROM v) GROUP BY ALL)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM v JOIN u ON v.path = u.path LEFT JOIN n p ON v.d > 0 AND p.path = v.path[1:v.d - 1]
"""


def rebuilt(turns: DataFrame) -> DataFrame:
    """The conversations of the contract: the first turns of every fifth one before their own later ones."""
    c, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    own = turns.select("conv_id", "tokens", (c - c % 5).alias("base"), h.alias("h"))
    base = turns.select(F.col("conv_id").alias("base"), F.col("tokens").alias("first"))
    first = F.coalesce("first", F.array().cast("array<string>"))
    later = F.slice("tokens", F.col("h") + 1, F.greatest(F.size("tokens") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv_id", F.concat(F.slice(first, F.lit(1), F.col("h")), later).alias("tokens"))


@query("op13_conversation_trie", CONVERSATIONS_SQL)
def op13(spark, sf_dir):
    from fleetscope.llm import conversations as C
    turns = C.turn_tokens(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return C.prefix_trie(rebuilt(turns)).drop("node", "parent")
