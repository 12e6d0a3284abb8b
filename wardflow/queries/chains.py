"""The method-chain interface."""

from pyspark.sql import functions as F

from wardflow.operators import query as Q
from wardflow.operators.query import TableQuery
from wardflow.queries.registry import query

STATUS = "CASE WHEN o_totalprice < 450000 THEN o_orderstatus END AS status"


def orders(t):
    return TableQuery(t.orders.selectExpr("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", STATUS))


BASE = f"SELECT o_orderkey FROM (SELECT *, {STATUS} FROM orders) WHERE "


def chain(name, where, build):
    query(name, BASE + where)(lambda t: build(orders(t)).df.select("o_orderkey"))


chain("b_q1_eq_gt_lte", "status = 'F' AND o_totalprice > 100000 AND o_custkey <= 900", lambda q: q.eq("status", "F").gt("o_totalprice", 100000).lte("o_custkey", 900))
chain("b_q1_neq_gte_lt", "status <> 'F' AND o_totalprice >= 200000 AND o_custkey < 700", lambda q: q.neq("status", "F").gte("o_totalprice", 200000).lt("o_custkey", 700))
chain("b_q1_is_null", "status IS NULL", lambda q: q.is_("status", None))
chain("b_q1_in", "o_orderpriority IN ('1-URGENT', '5-LOW')", lambda q: q.in_("o_orderpriority", ["1-URGENT", "5-LOW"]))
chain("b_q1_not", "NOT (status = 'F') AND status IS NOT NULL AND o_custkey > 5", lambda q: q.not_.eq("status", "F").not_.is_("status", None).gt("o_custkey", 5))
chain("b_q2_like", "o_orderpriority LIKE '%HIGH' OR FALSE", lambda q: q.like("o_orderpriority", "%HIGH"))
chain("b_q2_ilike", "o_orderpriority ILIKE '%urg_nt'", lambda q: q.ilike("o_orderpriority", "%urg_nt"))
chain("b_q2_like_all_of", "o_orderpriority LIKE '%I%' AND o_orderpriority LIKE '%H%'", lambda q: q.like_all_of("o_orderpriority", ["%I%", "%H%"]))
chain("b_q2_like_any_of", "o_orderpriority LIKE '1%' OR o_orderpriority LIKE '%LOW'", lambda q: q.like_any_of("o_orderpriority", ["1%", "%LOW"]))
chain("b_q2_ilike_all_of", "o_orderpriority ILIKE '%med%' AND o_orderpriority ILIKE '3%'", lambda q: q.ilike_all_of("o_orderpriority", ["%med%", "3%"]))
chain("b_q2_ilike_any_of", "o_orderpriority ILIKE '%low' OR o_orderpriority ILIKE '%spec%'", lambda q: q.ilike_any_of("o_orderpriority", ["%low", "%spec%"]))
chain("b_q3_or", "status = 'P' OR o_totalprice < 10000", lambda q: q.or_(F.col("status") == "P", F.col("o_totalprice") < 10000))
chain("b_q3_match", "status = 'O' AND o_orderpriority = '2-HIGH'", lambda q: q.match({"status": "O", "o_orderpriority": "2-HIGH"}))
NAMES = "SELECT p_partkey FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part) WHERE "


def words(t):
    return t.part.select("p_partkey", F.split("p_name", " ").alias("w"))


query("b_q4_contains", NAMES + "list_has_all(w, ['red', 'ring'])")(lambda t: words(t).filter(Q.contains("w", ["red", "ring"])).select("p_partkey"))
query("b_q4_contained_by", NAMES + "list_has_all(['red', 'small', 'ring', 'widget'], w)")(lambda t: words(t).filter(Q.contained_by("w", ["red", "small", "ring", "widget"])).select("p_partkey"))
query("b_q4_overlaps", NAMES + "list_has_any(w, ['red', 'gadget'])")(lambda t: words(t).filter(Q.overlaps("w", ["red", "gadget"])).select("p_partkey"))
query("b_q4_json_contains", "SELECT event_id FROM events WHERE props::JSON ->> 'k' = '42'")(lambda t: t.events.filter(Q.json_contains("props", {"k": 42})).select("event_id"))
LO, HI = 100, 400
RANGE = "SELECT o_orderkey FROM (SELECT o_orderkey, o_custkey AS lo, o_custkey + 100 AS hi FROM orders) WHERE "


def ranges(t):
    return t.orders.select("o_orderkey", F.struct(F.col("o_custkey").alias("lo"), (F.col("o_custkey") + 100).alias("hi")).alias("r"))


for _name, _where, _fn in [
    ("strictly_left", "hi <= 100", Q.strictly_left), ("strictly_right", "lo >= 400", Q.strictly_right), ("not_extending_left", "lo >= 100", Q.not_extending_left),
    ("not_extending_right", "hi <= 400", Q.not_extending_right), ("adjacent", "hi = 100 OR lo = 400", Q.adjacent), ("overlaps", "lo < 400 AND hi > 100", Q.range_overlaps),
]:
    query(f"b_q5_range_{_name}", RANGE + _where)(lambda t, f=_fn: ranges(t).filter(f("r", LO, HI)).select("o_orderkey"))
TOKENS = "(SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' AS w FROM documents)"
query("b_q6_search_plain", f"SELECT doc_id FROM {TOKENS} WHERE contains(w, ' the ') AND contains(w, ' in ')")(lambda t: t.documents.filter(Q.search_plain("text", "in the")).select("doc_id"))
query("b_q6_search_phrase", f"SELECT doc_id FROM {TOKENS} WHERE contains(w, ' de la ')")(lambda t: t.documents.filter(Q.search_phrase("text", "de la")).select("doc_id"))
query("b_q6_search_web", f"SELECT doc_id FROM {TOKENS} WHERE NOT contains(w, ' the ') AND (contains(w, ' la ') OR contains(w, ' der ')) AND contains(w, ' en ')")(
    lambda t: t.documents.filter(Q.search_web("text", required=["en"], excluded=["the"], any_group=["la", "der"])).select("doc_id")
)
LISTED = "(SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS t FROM documents)"
NEXT = "len(list_filter(range(1, len(t) + 1), lambda i: {0})) > 0"
query("b_q6_search_web_text", f"SELECT doc_id FROM {TOKENS} WHERE (contains(w, ' de la ') AND NOT contains(w, ' en ')) OR (contains(w, ' der ') AND contains(w, ' die ') AND NOT contains(w, ' in der ')) ")(
    lambda t: TableQuery(t.documents).wfts("text", '"de la" -en OR der die -"in der"').select("doc_id").df
)
query("b_q6_search_in_a_chain", f"SELECT doc_id FROM {TOKENS} WHERE contains(w, ' the ') AND NOT (contains(w, ' in ') OR contains(w, ' of ')) AND contains(w, ' and ')")(
    lambda t: TableQuery(t.documents).fts("text", "the").not_.fts("text", "in | of").plfts("text", "and").select("doc_id").df
)
RAW_SEARCHES = {
    "or_of_ands": ("the & !in | der & die", "(list_contains(t, 'the') AND NOT list_contains(t, 'in')) OR (list_contains(t, 'der') AND list_contains(t, 'die'))"),
    "brackets": ("(the | la) & !(in | que)", "(list_contains(t, 'the') OR list_contains(t, 'la')) AND NOT (list_contains(t, 'in') OR list_contains(t, 'que'))"),
    "phrase": ("de <-> la & !en", NEXT.format("t[i] = 'de' AND t[i + 1] = 'la'") + " AND NOT list_contains(t, 'en')"),
    "distance": ("la <3> de", NEXT.format("t[i] = 'la' AND t[i + 3] = 'de'")),
    "chain": ("(de | la) <-> que <2> en", NEXT.format("t[i] IN ('de', 'la') AND t[i + 1] = 'que' AND t[i + 3] = 'en'")),
    "not_before": ("!de <-> la", NEXT.format("t[i] = 'la' AND (i = 1 OR t[i - 1] <> 'de')")),
    "not_after": ("the <-> !(in | of)", NEXT.format("t[i] = 'the' AND coalesce(t[i + 1] NOT IN ('in', 'of'), true)")),
    "beginning": ("unge:* & !un:* <-> un:*", "len(list_filter(t, lambda w: starts_with(w, 'unge'))) > 0 AND " + NEXT.format("starts_with(t[i], 'un') AND (i = 1 OR NOT starts_with(t[i - 1], 'un'))")),
}
for _name, (_text, _where) in RAW_SEARCHES.items():
    query(f"b_q6_search_raw_{_name}", f"SELECT doc_id FROM {LISTED} WHERE {_where}")(lambda t, s=_text: t.documents.filter(Q.search_raw("text", s)).select("doc_id"))
query("b_q7_order_range", f"SELECT o_orderkey, status FROM (SELECT *, {STATUS} FROM orders) ORDER BY status DESC NULLS FIRST, o_orderkey DESC NULLS FIRST LIMIT 41 OFFSET 20")(
    lambda t: orders(t).select("o_orderkey", "status").order("status", "o_orderkey", desc=True).range(20, 60).df
)
query("b_q7_order_limit", f"SELECT o_orderkey, status FROM (SELECT *, {STATUS} FROM orders) ORDER BY status NULLS FIRST, o_orderkey NULLS FIRST LIMIT 30")(
    lambda t: orders(t).select("o_orderkey", "status").order("status", "o_orderkey", nulls_first=True).limit(30).df
)


@query("b_q8_counts", "SELECT 'exact' AS kind, count(*) AS n, TRUE AS close FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'estimated', NULL, TRUE")
def _(t):
    q = TableQuery(t.orders).eq("o_orderstatus", "F")
    exact, guess = q.count(), q.estimated_count(0.2)
    return t.spark.createDataFrame([("exact", exact, True), ("estimated", None, abs(guess - exact) <= 0.2 * exact)], "kind string, n long, close boolean")


query("b_q9_single", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")(
    lambda t: TableQuery(t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)).single()
)
query("b_q9_maybe_single", "SELECT count(*) AS n FROM (SELECT 1 FROM orders WHERE o_totalprice > 1e12)")(
    lambda t: TableQuery(t.orders).gt("o_totalprice", 1e12).maybe_single().agg(F.count(F.lit(1)).alias("n"))
)
COLS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def target(t):
    return t.orders.filter("o_orderstatus <> 'P'").select(*COLS)


def incoming(t):
    return t.orders.filter("o_orderstatus <> 'F'").selectExpr("o_orderkey", "'N' AS o_orderstatus", "o_totalprice * 2 AS o_totalprice")


query("b_q10_insert", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 'new', NULL FROM orders WHERE o_orderstatus <> 'F'")(
    lambda t: Q.insert(target(t), incoming(t).select("o_orderkey"), default_to_null=False, defaults={"o_orderstatus": "new"})
)
query("b_q10_upsert_on_conflict", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'N' END AS o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice FROM orders")(
    lambda t: Q.upsert_rows(target(t), incoming(t), on_conflict=["o_orderkey"], version=["o_totalprice"])
)
query("b_q10_upsert_ignore_duplicates", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders")(
    lambda t: Q.upsert_rows(target(t), incoming(t), on_conflict=["o_orderkey"], version=["o_totalprice"], ignore_duplicates=True)
)
query("b_q10_update", f"SELECT o_orderkey, CASE WHEN status = 'F' THEN 'done' ELSE status END AS status FROM (SELECT *, {STATUS} FROM orders)")(
    lambda t: Q.update(orders(t).select("o_orderkey", "status").df, F.col("status") == "F", status=F.lit("done"))
)
query("b_q10_delete", f"SELECT o_orderkey FROM (SELECT *, {STATUS} FROM orders) WHERE NOT coalesce(status = 'F', FALSE)")(
    lambda t: Q.delete(orders(t).df, F.col("status") == "F").select("o_orderkey")
)
query("b_q11_expressions", "SELECT o_orderkey, o_totalprice / 2 + o_custkey AS half FROM orders WHERE o_totalprice > 1000 * (o_custkey % 100) AND o_orderstatus <> 'P'")(
    lambda t: t.orders.filter("o_totalprice > 1000 * (o_custkey % 100) AND o_orderstatus != 'P'").selectExpr("o_orderkey", "o_totalprice / 2 + o_custkey AS half")
)
