"""Text columns and text jobs."""

from pyspark.sql import functions as F

from wardflow.functions import text as X
from wardflow.queries.registry import query


def c(name):
    return F.col(name)


PART = "SELECT p_partkey, "
query("b_s1_case", PART + "upper(p_name) AS upper, lower(p_type) AS lower, upper(p_type[1]) || lower(p_type[2:]) AS capitalized, list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title, upper(p_brand[1:0]) || lower(p_brand[1]) || upper(p_brand[2:]) AS swapped FROM part")(
    lambda t: t.part.select("p_partkey", F.upper("p_name").alias("upper"), F.lower("p_type").alias("lower"), X.capitalize(c("p_type")).alias("capitalized"), X.title(c("p_name")).alias("title"), X.swapcase(c("p_brand")).alias("swapped"))
)
query("b_s1_case_whole_texts", "SELECT doc_id, md5(upper(replace(text, 'ß', 'SS'))) AS upper, md5(lower(text)) AS lower FROM documents")(
    lambda t: t.documents.select("doc_id", F.md5(F.upper("text")).alias("upper"), F.md5(F.lower("text")).alias("lower"))
)
query(
    "b_s2_pad_strip_slice",
    PART + "CASE WHEN length(p_name) >= 12 THEN p_name ELSE lpad(p_name, 12, '*') END AS left_pad, CASE WHEN length(p_name) >= 12 THEN p_name ELSE rpad(p_name, 12, '-') END AS right_pad, "
    "repeat(' ', greatest(12 - length(p_name), 0) // 2) || p_name || repeat(' ', greatest(12 - length(p_name), 0) - greatest(12 - length(p_name), 0) // 2) AS both_pad, "
    "'-' || lpad(CAST(p_size AS VARCHAR), 5, '0') AS zeros, replace(p_brand, 'Brand#', '') AS no_prefix, CASE WHEN p_name LIKE '%ring' THEN p_name[:-5] ELSE p_name END AS no_suffix, "
    "p_name[3:5] AS middle, p_name[:2] || '..' || p_name[6:] AS replaced, repeat(p_type, 2) AS doubled, trim(p_name, 'sg') AS stripped FROM part",
)(
    lambda t: t.part.select(
        "p_partkey", X.pad(c("p_name"), 12, "left", "*").alias("left_pad"), X.pad(c("p_name"), 12, "right", "-").alias("right_pad"), X.pad(c("p_name"), 12, "both").alias("both_pad"),
        X.zfill(F.concat(F.lit("-"), c("p_size").cast("string")), 6).alias("zeros"), X.remove_prefix(c("p_brand"), "Brand#").alias("no_prefix"), X.remove_suffix(c("p_name"), "ring").alias("no_suffix"),
        X.slice_text(c("p_name"), 2, 5).alias("middle"), X.slice_replace(c("p_name"), 2, 5, "..").alias("replaced"), F.repeat("p_type", 2).alias("doubled"), F.trim(c("p_name"), F.lit("sg")).alias("stripped"),
    )
)
query("b_s2_wrap", "SELECT item_id, rtrim(regexp_replace(text, '(.{1,40})(?: +|$)', '\\1\n', 'g'), chr(10)) AS wrapped FROM benchmark")(
    lambda t: t.benchmark.select("item_id", X.wrap(c("text"), 40).alias("wrapped"))
)
query(
    "b_s3_search",
    "SELECT doc_id, contains(text, 'the') AS has_the, starts_with(text, 'The') AS begins, ends_with(text, '.') AS ends, regexp_matches(text, '^(?:[A-Z][a-z]+ )') AS matches, regexp_full_match(source, '[a-z]+') AS full_match, "
    "CAST(len(regexp_extract_all(text, 'an')) AS INTEGER) AS n_an, CAST(instr(text, 'er') - 1 AS INTEGER) AS first_er, "
    "CAST(CASE WHEN instr(text, 'er') = 0 THEN -1 ELSE length(text) - instr(reverse(text), 're') - 1 END AS INTEGER) AS last_er, CAST(len(regexp_extract_all(text, '[0-9]+')) AS INTEGER) AS numbers, regexp_extract_all(text, '[0-9]+')[1] AS first_number FROM documents",
)(
    lambda t: t.documents.select(
        "doc_id", c("text").contains("the").alias("has_the"), c("text").startswith("The").alias("begins"), c("text").endswith(".").alias("ends"), X.match(c("text"), "[A-Z][a-z]+ ").alias("matches"),
        X.full_match(c("source"), "[a-z]+").alias("full_match"), X.count(c("text"), "an").alias("n_an"), X.find(c("text"), "er").alias("first_er"), X.rfind(c("text"), "er").alias("last_er"),
        F.size(X.find_all(c("text"), "[0-9]+")).alias("numbers"), F.get(X.find_all(c("text"), "[0-9]+"), F.lit(0)).alias("first_number"),
    )
)
query(
    "b_s4_split_join",
    "SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS head, CASE WHEN contains(o_orderpriority, '-') THEN substr(o_orderpriority, instr(o_orderpriority, '-') + 1) ELSE '' END AS after, '-' AS sep, string_split(o_orderpriority, '-')[1] AS before, "
    "reverse(string_split(reverse(o_orderpriority), ' ')[1]) AS last_word, CAST(len(string_split(o_orderpriority, ' ')) AS INTEGER) AS words, array_to_string(string_split(o_orderpriority, ' '), '_') AS joined, concat_ws('/', o_orderstatus, o_orderpriority) AS path FROM orders",
)(
    lambda t: t.orders.select(
        "o_orderkey", F.get(X.split_left(c("o_orderpriority"), "-", 1), 0).alias("head"), *X.partition(c("o_orderpriority"), "-"), F.element_at(X.split_right(c("o_orderpriority"), " ", 1), -1).alias("last_word"),
        F.size(F.split("o_orderpriority", " ")).alias("words"), F.array_join(F.split("o_orderpriority", " "), "_").alias("joined"), F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("path"),
    )
)
query(
    "b_s5_replace_extract",
    "SELECT event_id, regexp_replace(props, '[0-9]+', '#', 'g') AS masked, translate(event_type, 'aeiou', '12345') AS coded, CASE WHEN regexp_matches(props, '\"(.)\": ([0-9]+)') THEN regexp_extract(props, '\"(.)\": ([0-9]+)', 1) END AS name, "
    "CASE WHEN regexp_matches(props, '\"(.)\": ([0-9]+)') THEN regexp_extract(props, '\"(.)\": ([0-9]+)', 2) END AS number FROM events",
)(
    lambda t: t.events.select("event_id", F.regexp_replace("props", "[0-9]+", "#").alias("masked"), F.translate("event_type", "aeiou", "12345").alias("coded"), *X.extract(c("props"), '"(.)": ([0-9]+)', ["name", "number"]))
)
_classes = {
    "is_alnum": "[\\p{L}\\p{N}]+", "is_alpha": "\\p{L}+", "is_decimal": "\\p{Nd}+", "is_digit": "[0-9]+", "is_numeric": "\\p{N}+", "is_space": "\\s+",
    "is_lower": "[^\\p{Lu}]*\\p{Ll}[^\\p{Lu}]*", "is_upper": "[^\\p{Ll}]*\\p{Lu}[^\\p{Ll}]*",
    "is_title": "[^\\p{Lu}\\p{Ll}]*\\p{Lu}\\p{Ll}*([^\\p{Lu}\\p{Ll}]+\\p{Lu}\\p{Ll}*)*[^\\p{Lu}\\p{Ll}]*",
}
query("b_s6_class_tests", "SELECT word, count(*) AS n, " + ", ".join(f"regexp_full_match(word, '{p}') AS {n}" for n, p in _classes.items()) + ", CAST(length(word) AS INTEGER) AS length FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1")(
    lambda t: t.documents.select(F.explode(F.split("text", r"[ \t\n\r]+")).alias("word")).filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    .select("word", "n", *X.class_tests(c("word")), F.length("word").alias("length"))
)


def removed(p):
    return f"length(regexp_replace(text, '{p}', '', 'g'))"


_figures = {
    "chars": "length(text)", "digits": removed("[^0-9]"), "uppers": removed("[^\\p{Lu}]"), "spaces": removed("[^ \\t\\n\\r]"), "tokens": "len(regexp_extract_all(text, '[^ \\t\\n\\r]+'))",
    **{n: f"len(regexp_extract_all(text, '{p}'))" for n, p in X.PATTERNS.items()},
}
_sums = ", ".join(f"CAST(sum({e}) AS BIGINT) AS {n}" for n, e in _figures.items())
_shares = ", ".join(f"round(sum({_figures[n]}) / sum(length(text)), 10) AS {n}_share" for n in ("digits", "uppers", "spaces"))
query("b_s7_text_profile_by_language", f"SELECT lang, count(*) AS texts, {_sums}, {_shares} FROM documents GROUP BY 1")(lambda t: X.text_profile(t.documents, "text", ["lang"]))
query("b_s7_text_profile_by_source_and_quality", f"SELECT source, quality, count(*) AS texts, {_sums}, {_shares} FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2")(
    lambda t: X.text_profile(t.documents.join(t.labels, "doc_id"), "text", ["source", "quality"])
)
query("b_s7_text_profile_by_role", f"SELECT role, count(*) AS texts, {_sums}, {_shares} FROM conversations GROUP BY 1")(lambda t: X.text_profile(t.conversations, "text", ["role"]))
query("b_s7_text_figures", "SELECT doc_id, " + ", ".join(f"{e} AS {n}" for n, e in _figures.items()) + " FROM documents")(lambda t: X.text_figures(t.documents, "text", ["doc_id"]))
AUTH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
query(
    "b_s8_url_parts",
    f"SELECT page_id, split_part(url, ':', 1) AS scheme, {AUTH} AS host, CASE split_part(url, ':', 1) WHEN 'http' THEN 80 WHEN 'https' THEN 443 END AS port, "
    "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, CASE WHEN contains(url, '#') THEN substr(url, instr(url, '#') + 1) END AS fragment FROM pages",
)(lambda t: t.pages.select("page_id", *X.url_parts(c("url"))))
query(
    "b_s8_url_query_pairs",
    "SELECT page_id, CAST(i - 1 AS INTEGER) AS place, split_part(p, '=', 1) AS key, url_decode(replace(substr(p, instr(p, '=') + 1), '+', ' ')) AS value FROM (SELECT page_id, unnest(string_split(q, '&')) AS p, unnest(range(1, len(string_split(q, '&')) + 1)) AS i "
    "FROM (SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages) WHERE q <> '')",
)(lambda t: X.url_query_pairs(t.pages, "url", ["page_id"]))
query(
    "b_s9_table_cells",
    "SELECT p_partkey, 0 AS table_no, CAST(r AS INTEGER) AS row_no, CAST(k AS INTEGER) AS column_no, CASE WHEN r = 0 THEN ['name', 'size & type'][k + 1] ELSE [p_name, CAST(p_size AS VARCHAR) || ' & ' || p_type][k + 1] END AS text FROM part, range(2) a(r), range(2) b(k)",
)(
    lambda t: X.html_cells(
        t.part.selectExpr("p_partkey", "concat('<html><TABLE border=1>\n<tr><th>name</th><th> size &amp; type</th></tr>\n<tr class=x><td><b>', p_name, '</b></td><td>', p_size, ' &amp; ', p_type, '\n</td></tr></TABLE></html>') AS html"),
        "html", ["p_partkey"],
    )
)
query(
    "b_s9_list_cells",
    "SELECT page_id, 0 AS table_no, 0 AS row_no, CAST(i - 1 AS INTEGER) AS column_no, regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS text FROM (SELECT page_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS l FROM pages))",
)(lambda t: X.html_cells(t.pages, "html", ["page_id"], table="ul", row="", cell="li"))

# A name over two rows, a size over two columns, a table inside a cell, and no end tags but those of tables.
GRID_PAGE = (
    "concat('<p>x</p><table><thead><tr><th>name<th colspan=2>size &amp; type</thead><tr><td rowspan=\"2\">', p_name, '<td>', p_size, '<td>', p_type, "
    "'<tr><td colspan=2>', p_brand, '<table><tr><td>inner ', p_partkey, '</table>tail<!-- <td>no --><script>\"<td>\"</script></table>')"
)
query(
    "b_s9_table_grid",
    """SELECT p_partkey, c.* FROM part, LATERAL (VALUES
(0, NULL::INTEGER, 'head', 0, 0, true, 'name'), (0, NULL, 'head', 0, 1, true, 'size & type'), (0, NULL, 'head', 0, 2, true, 'size & type'),
(0, NULL, 'body', 1, 0, false, p_name), (0, NULL, 'body', 1, 1, false, p_size::VARCHAR), (0, NULL, 'body', 1, 2, false, p_type),
(0, NULL, 'body', 2, 0, false, p_name), (0, NULL, 'body', 2, 1, false, p_brand || 'tail'), (0, NULL, 'body', 2, 2, false, p_brand || 'tail'),
(1, 0, 'body', 0, 0, false, 'inner ' || p_partkey)) c(table_no, inside, section, row_no, column_no, header, text)""",
)(lambda t: X.html_grid(t.part.selectExpr("p_partkey", f"{GRID_PAGE} AS html"), "html", ["p_partkey"]))
