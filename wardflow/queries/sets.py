"""Order, top-n, sampling, sets, hashes and lookups."""

from datetime import datetime

from pyspark.sql import functions as F, types as T

from wardflow.operators import sets as S
from wardflow.queries.registry import query

OR = ["o_orderkey", "o_custkey", "o_totalprice"]
query("b_o1_sort_page", "SELECT o_orderkey, o_orderpriority, price, row_number() OVER (ORDER BY lower(o_orderpriority) DESC, price ASC NULLS FIRST, o_orderkey) AS place FROM (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)")(
    lambda t: S.sorted_positions(
        t.orders.selectExpr("o_orderkey", "o_orderpriority", "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price"),
        [("o_orderpriority", False), ("price", True)], ["o_orderkey"], nulls_last=False, key={"o_orderpriority": F.lower("o_orderpriority")}, name="place",
    )
)
query("b_o1_order_positions", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place FROM orders")(
    lambda t: S.numbered_by_value(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], "place").select("o_orderkey", "place")
)
for _keep, _order in [("first", "l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey"), ("last", "l_quantity DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC")]:
    query(f"b_o2_nlargest_{_keep}", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem ORDER BY {_order} LIMIT 40")(
        lambda t, k=_keep: S.n_largest(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), 40, "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], keep=k)
    )
query("b_o2_nlargest_all", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= (SELECT min(l_quantity) FROM (SELECT l_quantity FROM lineitem ORDER BY 1 DESC LIMIT 40))")(
    lambda t: S.n_largest(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), 40, "l_quantity", [], keep="all")
)
query("b_o2_nsmallest", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")(
    lambda t: S.n_largest(t.orders.select("o_orderkey", "o_totalprice"), 25, "o_totalprice", ["o_orderkey"], smallest=True)
)


def u(keys, seed):
    text = " || '|' || ".join([f"CAST({k} AS VARCHAR)" for k in keys] + [f"'{seed}'"])
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0)"


K = ["o_orderkey"]
query("b_o3_sample_fraction", f"SELECT o_orderkey FROM orders WHERE {u(K, 's1')} < 0.2")(lambda t: S.sample_fraction(t.orders, 0.2, K, "s1").select("o_orderkey"))
query("b_o3_sample_n", f"SELECT o_orderkey FROM orders ORDER BY {u(K, 's2')}, o_orderkey LIMIT 300")(lambda t: S.sample_n(t.orders, 300, K, "s2").select("o_orderkey"))
query("b_o3_sample_weighted", f"SELECT o_orderkey FROM orders ORDER BY -ln(1 - {u(K, 's3')}) / o_totalprice, o_orderkey LIMIT 300")(
    lambda t: S.sample_n(t.orders, 300, K, "s3", weight="o_totalprice").select("o_orderkey")
)
query("b_o3_sample_by_group", f"SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {u(K, 's4')}, o_orderkey) AS n FROM orders) WHERE n <= 50")(
    lambda t: S.sample_by_group(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderpriority"], 50, K, "s4")
)
query(
    "b_o3_sample_with_replacement",
    f"SELECT id AS draw, o_orderkey FROM (SELECT id, floor({u(['id'], 's5')} * (SELECT count(*) FROM orders)) + 1 AS p FROM range(1000) r(id)) JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS p FROM orders) USING (p)",
)(lambda t: S.sample_with_replacement(t.orders.select("o_orderkey"), 1000, K, "s5"))
query("b_o4_unique_values", "SELECT l_quantity, count(*) AS count, min(l_orderkey) AS first_place, dense_rank() OVER (ORDER BY l_quantity) - 1 AS code FROM lineitem GROUP BY 1")(
    lambda t: S.unique_values(t.lineitem.select("l_quantity", "l_orderkey"), "l_quantity", "l_orderkey")
)
query("b_o4_inverse_codes", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS code FROM orders")(
    lambda t: S.inverse_codes(t.orders.select("o_orderkey", "o_custkey"), "o_custkey").select("o_orderkey", "code")
)


def value_sets(t):
    return t.orders.select(F.col("o_custkey").alias("k")), t.events.select((F.col("user_id") * 3).alias("k"))


A, B = "SELECT o_custkey AS k FROM orders", "SELECT user_id * 3 AS k FROM events"
query("b_o5_union", f"{A} UNION {B}")(lambda t: S.union_of(*value_sets(t)))
query("b_o5_intersection", f"{A} INTERSECT {B}")(lambda t: S.intersection_of(*value_sets(t)))
query("b_o5_difference", f"{A} EXCEPT {B}")(lambda t: S.difference_of(*value_sets(t)))
query("b_o5_symmetric_difference", f"({A} EXCEPT {B}) UNION ({B} EXCEPT {A})")(lambda t: S.symmetric_difference(*value_sets(t)))
query("b_o7_changed_by_hash", "SELECT o_orderkey FROM orders WHERE o_totalprice > 200000 AND o_orderstatus IS DISTINCT FROM 'P' OR o_totalprice < 5000")(
    lambda t: S.changed_by_hash(
        t.orders, t.orders.withColumn("o_orderstatus", F.expr("CASE WHEN o_totalprice > 200000 THEN 'P' WHEN o_totalprice < 5000 THEN NULL ELSE o_orderstatus END")), K, ["o_custkey", "o_orderstatus", "o_totalprice"]
    )
)
EDGES = [5, 10, 10.5, 20, 45]
LIST = "[5, 10, 10.5, 20, 45]"
query("b_o9_search_sorted", f"SELECT l_orderkey, l_linenumber, l_partkey, CAST(len(list_filter({LIST}, lambda e: e < l_quantity)) AS INTEGER) AS left_place, CAST(len(list_filter({LIST}, lambda e: e <= l_quantity)) AS INTEGER) AS right_place FROM lineitem")(
    lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", S.search_sorted("l_quantity", EDGES).alias("left_place"), S.search_sorted("l_quantity", EDGES, "right").alias("right_place"))
)
query("b_o9_digitize", f"SELECT event_id, CAST(len(list_filter({LIST}, lambda e: e <= value)) AS INTEGER) AS bin, CAST(len(list_filter({LIST}, lambda e: e < value)) AS INTEGER) AS bin_right FROM events")(
    lambda t: t.events.select("event_id", S.digitize("value", EDGES).alias("bin"), S.digitize("value", EDGES, right=True).alias("bin_right"))
)
query("b_o9_linear_lookup", "SELECT event_id, round(CASE WHEN value < 10 THEN 1 WHEN value < 50 THEN 1 + (value - 10) / 40 * 4 WHEN value < 200 THEN 5 + (value - 50) / 150 * -3.7 ELSE 1.3 END, 7) AS y FROM events")(
    lambda t: t.events.select("event_id", F.round(S.linear_lookup("value", [(10, 1), (50, 5), (200, 1.3)]), 7).alias("y"))
)
query("b_o8_select_types_rename", "SELECT o_totalprice AS O_TOTALPRICE, o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY FROM orders")(
    lambda t: S.rename(S.select_types(t.orders, include=(T.NumericType,)), function=str.upper)
)
query("b_o10_truncate", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'")(
    lambda t: S.truncate(t.events, "ts", datetime(2024, 1, 5), datetime(2024, 1, 20, 12)).select("event_id")
)
query("b_o10_head_tail", "(SELECT event_id, 'head' AS part FROM events ORDER BY event_id LIMIT 5) UNION ALL (SELECT event_id, 'tail' FROM events ORDER BY event_id DESC LIMIT 5)")(
    lambda t: t.events.select("event_id").orderBy("event_id").limit(5).withColumn("part", F.lit("head")).unionByName(
        t.events.select("event_id").orderBy(F.desc("event_id")).limit(5).withColumn("part", F.lit("tail"))
    )
)
query("b_o4_codes_of_text", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM orders")(
    lambda t: S.inverse_codes(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority").select("o_orderkey", "code")
)
