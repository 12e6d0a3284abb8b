"""One query for each operator, applied with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm import decontam, filters, langid, lm, packing, pii, prefixes, repair, secrets, simhash, spans, substring, suffix, topk
from wardflow.llm.common import ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(ready(spark), folder)

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.personal_data(docs, pii.fit(docs))
    counts = [spans.count("base", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, spans.digest("base", pii.KINDS).alias("base_sha256"), spans.listed("spans").alias("spans"))


@query("op2_secrets")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secrets(table(spark, folder, "documents"))
    counts = [spans.count("spans", k).alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, spans.digest("spans", secrets.BASE).alias("base_sha256"), spans.listed("spans").alias("spans"))


WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op3_benchmark_decontamination",
    f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, w[i : i + 9] AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM bw),
dw AS (SELECT doc_id, n, i, w[i : i + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (g)),
spots AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
""",
)
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(table(spark, folder, "documents"), decontam.blocks(table(spark, folder, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op4_lm_scores")
def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(table(spark, folder, "documents"))


@query(
    "op5_substring_dedup",
    """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i : i + 12] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY 1),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id),
w AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM w ANTI JOIN r USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM r GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
""",
)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query(
    "op6_suffix_dedup",
    """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY 1),
m AS (SELECT doc_id, i FROM g JOIN f USING (g) WHERE first < doc_id),
s AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM m)),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM s GROUP BY doc_id, run),
x AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
k AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM x JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
)
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs, langid.fit(docs))


@query(
    "op8_exact_top_k",
    """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""",
)
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op9_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_harmonic_packing")
def harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query(
    "op11_filter_audit",
    """
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copied
    FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY 1),
f AS (
    SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN copied THEN 'E' ELSE '' END AS failed
    FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
    SELECT part, filter_order, step, n, good, bad, contains(failed, substr(filter_order, step, 1)) AS fails, failed = substr(filter_order, step, 1) AS lone,
        len(translate(failed, substr(filter_order, 1, step - 1), '')) = len(failed) AS came
    FROM m, o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(sum(n) FILTER (came AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (came AND fails), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails AND NOT came), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (lone), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (came AND fails), 0)::BIGINT AS good_lost, coalesce(sum(bad) FILTER (came AND fails), 0)::BIGINT AS toxic_lost
    FROM s GROUP BY 1, 2, 3)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley FROM r
""",
)
def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filters.audit(filters.failures(table(spark, folder, "documents"), table(spark, folder, "labels")))


SHIFTED = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"


def _crc_steps() -> str:
    """A byte of a CRC-32, one bit a select."""
    inner = "SELECT i, CAST(i AS BIGINT) AS v FROM (SELECT unnest(range(256)) AS i)"
    for _ in range(8):
        inner = f"SELECT i, {SHIFTED.format('v')} AS v FROM ({inner})"
    return f"SELECT list(v ORDER BY i) AS crc FROM ({inner})"


def _fold() -> str:
    """Costs and audits after one more turn x, without insertions, from each state; o: nothing yet, s, u, a: after that role."""
    cut = "CASE WHEN upper(x) = x THEN 1 ELSE 0 END"

    def stands(role: str, other: str) -> str:
        return f"{{'c': CASE WHEN lower(x) = '{role}' THEN {cut} ELSE {other} END + acc.{role}.c, 'e': CASE WHEN lower(x) = '{role}' THEN 'K' ELSE 'R' END || acc.{role}.e}}"

    states = []
    for state, roles in {"o": "su", "s": "u", "u": "a", "a": "u"}.items():
        ways = [f"{{'c': 3 + acc.{state}.c, 'e': 'D' || acc.{state}.e}}"]
        ways += [stands(r, "1000000000" if r == "s" else f"CASE WHEN x = 'd' THEN 1000000000 ELSE 2 + {cut} END") for r in roles]
        states.append(f"'{state}': list_min([{', '.join(ways)}])")
    return f"({{{', '.join(states)}}})"


def _inserted(f: str) -> str:
    """The same with the insertions that may come before."""

    def put(role: str) -> str:
        return f"{{'c': 2 + {f}.{role}.c, 'e': 'I' || {f}.{role}.e}}"

    two_more = f"{{'c': 4 + {f}.a.c, 'e': 'II' || {f}.a.e}}"
    return f"{{'o': list_min([{f}.o, {put('u')}, {two_more}]), 's': list_min([{f}.s, {put('u')}, {two_more}]), 'u': list_min([{f}.u, {put('a')}]), 'a': list_min([{f}.a, {put('u')}])}}"


DONE = "{'c': 0, 'e': ''}"
LAST = f"{{'o': {DONE}, 's': {{'c': 4, 'e': 'II'}}, 'u': {{'c': 2, 'e': 'I'}}, 'a': {DONE}}}"


@query(
    "op12_conversation_repair",
    f"""
WITH crc AS MATERIALIZED ({_crc_steps()}),
c AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce([ascii(b) FOR b IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')], lambda h, b: xor(h >> 8, crc[xor(h & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS fault
    FROM conversations, crc),
x AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM c),
n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(len(role) || ':' || role || text), copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending
    FROM x),
m AS (
    SELECT *, ending = '' AS is_blank, ending <> '' AND seen AS is_copy, ending <> '' AND NOT seen AND ending NOT IN ('.', '!', '?') AS is_cut, left(role, 1) AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM n),
k AS (SELECT *, CASE WHEN is_blank OR is_copy THEN 'd' WHEN is_cut THEN upper(y) ELSE y END AS letter FROM (SELECT *, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS y FROM m)),
g AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_copy) AS duplicate, count(*) FILTER (is_cut) AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, list(letter ORDER BY i DESC) AS letters, list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts
    FROM k GROUP BY 1),
b AS (SELECT *, list_reduce(letters, lambda acc, x: {_inserted(_fold())}, {LAST}).o AS best FROM g),
e AS (SELECT *, len(translate(best.e, 'D', '')) AS size, unnest(string_split(best.e, '')) AS edit, unnest(range(1, len(best.e) + 1)) AS p FROM b),
q AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i, count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS j
    FROM e),
r AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN roles[i] WHEN (size - j) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE texts[i] END, chr(10) ORDER BY j) AS repaired
    FROM q WHERE edit <> 'D' GROUP BY 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
    coalesce(best.e, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN b USING (conv_id) LEFT JOIN r USING (conv_id)
""",
)
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, folder, "conversations")), copies_col="copies")


@query("op13_prefix_token_counts")
def prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = prefixes.token_counts(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
