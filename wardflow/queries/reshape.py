"""Reshaping."""

from pyspark.sql import functions as F, types as T

from wardflow.operators import reshape as S
from wardflow.operators.reshape import pivot_long
from wardflow.queries.registry import query

ST = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def cells(expr, where="", names=ST, col="o_orderstatus"):
    return ", ".join(expr.format(w=f"{col} = '{v}'") + f' AS "{v}"' for v in names)


query("b_r1_pivot_table", f"SELECT o_orderpriority, {cells('max(o_totalprice) FILTER ({w})')} FROM orders GROUP BY 1")(
    lambda t: S.pivot_table(t.orders, index=["o_orderpriority"], columns="o_orderstatus", values=ST, agg=F.max("o_totalprice"))
)
query("b_r1_pivot_table_fill", f"SELECT o_custkey, {cells('count(*) FILTER ({w})')} FROM orders GROUP BY 1")(
    lambda t: S.pivot_table(t.orders, index=["o_custkey"], columns="o_orderstatus", values=None, agg=F.count(F.lit(1)), fill=0)
)
MARGIN = f"{cells('count(*) FILTER ({w})')}, count(*) AS \"All\" FROM orders"
query("b_r1_pivot_table_margins", f"SELECT o_orderpriority, {MARGIN} GROUP BY 1 UNION ALL SELECT 'All', {MARGIN}")(
    lambda t: S.pivot_table(t.orders, index=["o_orderpriority"], columns="o_orderstatus", values=ST, agg=F.count(F.lit(1)), fill=0, margins=True)
)
for _kind in ("cube", "rollup"):
    query(f"b_r2_margins_{_kind}", f"SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(grouping_id(o_orderpriority, o_orderstatus) AS INTEGER) AS grouping_id FROM orders GROUP BY {_kind}(o_orderpriority, o_orderstatus)")(
        lambda t, k=_kind: S.totals(t.orders, ["o_orderpriority", "o_orderstatus"], F.count(F.lit(1)).alias("n"), k)
    )


def daily_counts(t):
    return t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
query("b_r3_pivot", f"SELECT CAST(ts AS DATE) AS day, {cells('nullif(count(*) FILTER ({w}), 0)', names=EVENT_TYPES, col='event_type')} FROM events GROUP BY 1")(
    lambda t: S.pivot(daily_counts(t), index=["day"], columns="event_type", values=EVENT_TYPES, cell="n")
)
query("b_r4_crosstab_margins", f"SELECT o_orderpriority, {MARGIN} GROUP BY 1 UNION ALL SELECT 'All', {MARGIN}")(
    lambda t: S.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ST, margins=True)
)
_bases = {"index": "count(*)", "all": "(SELECT count(*) FROM orders)", "columns": "(SELECT count(*) FROM orders WHERE {w})"}
for _norm, _base in _bases.items():
    query(f"b_r4_crosstab_{_norm}", "SELECT o_orderpriority, " + cells("round(count(*) FILTER ({w}) / " + _base + ", 10)") + " FROM orders GROUP BY 1")(
        lambda t, n=_norm: S.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ST, normalize=n).select("o_orderpriority", *[F.round(c, 10).alias(c) for c in ST])
    )
NUM = ["l_quantity", "l_discount", "l_tax"]
query("b_r5_melt", "SELECT l_orderkey, l_linenumber, l_partkey, variable, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME variable VALUE value)")(
    lambda t: S.melt(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *NUM), ["l_orderkey", "l_linenumber", "l_partkey"], NUM)
)


def wide_orders(t):
    aggs = [F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s}") for s in ST]
    aggs += [F.max(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(f"price_{s}") for s in ST]
    return t.orders.groupBy("o_custkey").agg(*aggs)


WIDE = "w AS (SELECT o_custkey, " + ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') AS n_{s}, max(o_totalprice) FILTER (o_orderstatus = '{s}') AS price_{s}" for s in ST) + " FROM orders GROUP BY 1)"
LONG = " UNION ALL ".join(f"SELECT o_custkey, '{s}' AS status, n_{s} AS n, price_{s} AS price FROM w" for s in ST)
query("b_r6_wide_to_long", f"WITH {WIDE} {LONG}")(lambda t: S.wide_to_long(wide_orders(t), ["n", "price"], ["o_custkey"], "status"))
query("b_r7_long_by_groups", f"WITH {WIDE} SELECT o_custkey, n, price FROM ({LONG}) WHERE price IS NOT NULL")(
    lambda t: S.long_by_groups(wide_orders(t), {"n": ["n_F", "n_O", "n_P"], "price": ["price_F", "price_O", "price_P"]})
)
query("b_r8_stack", f"WITH {WIDE} " + " UNION ALL ".join(f"SELECT o_custkey, 'price_{s}' AS \"column\", price_{s} AS value FROM w WHERE price_{s} IS NOT NULL" for s in ST))(
    lambda t: S.stack(wide_orders(t).select("o_custkey", "price_F", "price_O", "price_P"), ["o_custkey"])
)
query("b_r8_unstack", f"SELECT CAST(ts AS DATE) AS day, {cells('count(*) FILTER ({w})', names=EVENT_TYPES, col='event_type')} FROM events GROUP BY 1")(
    lambda t: S.unstack(daily_counts(t), ["day"], "event_type", "n", EVENT_TYPES, fill=0)
)
STATUS = "CASE WHEN o_totalprice < 450000 THEN o_orderstatus END"


def open_status(t):
    return t.orders.selectExpr("o_orderkey", f"{STATUS} AS status")


query("b_r9_get_dummies", f"SELECT o_orderkey, CAST(coalesce({STATUS} = 'O', FALSE) AS INTEGER) AS s_O, CAST(coalesce({STATUS} = 'P', FALSE) AS INTEGER) AS s_P, CAST({STATUS} IS NULL AS INTEGER) AS s_nan FROM orders")(
    lambda t: S.get_dummies(open_status(t), "status", prefix="s", dummy_na=True, drop_first=True)
)
query("b_r10_from_dummies", f"SELECT o_orderkey, coalesce({STATUS}, 'none') AS status FROM orders")(
    lambda t: S.from_dummies(S.get_dummies(open_status(t), "status", values=ST), ["status_F", "status_O", "status_P"], name="status", default="none")[0]
)
query("b_r10_from_dummies_rejects", f"SELECT o_orderkey FROM orders WHERE o_totalprice >= 450000")(
    lambda t: S.from_dummies(S.get_dummies(open_status(t), "status", values=ST), ["status_F", "status_O", "status_P"], name="status")[1].select("o_orderkey")
)


@query("b_r11_label_dummies", "SELECT p_partkey, CAST(list_contains(string_split(p_name, ' '), 'red') AS INTEGER) AS red, CAST(list_contains(string_split(p_name, ' '), 'small') AS INTEGER) AS small, CAST(list_contains(string_split(p_name, ' '), 'ring') AS INTEGER) AS ring FROM part")
def _(t):
    return S.label_dummies(t.part, ["p_partkey"], "p_name", " ").select("p_partkey", "red", "small", "ring")


EDGES = [0, 5, 10, 25, 50]
CASES_RIGHT = "CASE WHEN {c} > 0 AND {c} <= 5 THEN 0 WHEN {c} > 5 AND {c} <= 10 THEN 1 WHEN {c} > 10 AND {c} <= 25 THEN 2 WHEN {c} > 25 AND {c} <= 50 THEN 3 END"
query("b_r12_cut_right", f"SELECT p_partkey, {CASES_RIGHT.format(c='(p_size - 1)')} AS size_band FROM part")(
    lambda t: S.cut(t.part.selectExpr("p_partkey", "p_size - 1 AS s"), "s", EDGES, "size_band").drop("s")
)
query("b_r12_cut_include_lowest", f"SELECT p_partkey, CASE WHEN p_size = 1 THEN 0 ELSE {CASES_RIGHT.format(c='(p_size - 1)')} END AS size_band FROM part")(
    lambda t: S.cut(t.part.selectExpr("p_partkey", "p_size - 1 AS s"), "s", EDGES, "size_band", include_lowest=True).drop("s")
)
query("b_r12_cut_left_labels", "SELECT p_partkey, CASE WHEN p_size < 5 THEN 'tiny' WHEN p_size < 10 THEN 'small' WHEN p_size < 25 THEN 'middle' WHEN p_size < 50 THEN 'large' END AS size_band FROM part")(
    lambda t: S.cut(t.part.select("p_partkey", "p_size"), "p_size", EDGES, "size_band", right=False, labels=["tiny", "small", "middle", "large"]).drop("p_size")
)
query(
    "b_r12_cut_equal_width",
    "WITH r AS (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b FROM part) SELECT p_partkey, CASE WHEN p_retailprice <= a + (b - a) * 1 / 4 THEN 0 WHEN p_retailprice <= a + (b - a) * 2 / 4 THEN 1 WHEN p_retailprice <= a + (b - a) * 3 / 4 THEN 2 ELSE 3 END AS band FROM part, r",
)(lambda t: S.cut_equal(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", 4, "band").drop("p_retailprice"))
query(
    "b_r13_qcut",
    "WITH r AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders) SELECT o_orderkey, CASE WHEN o_totalprice <= q[1] THEN 0 WHEN o_totalprice <= q[2] THEN 1 WHEN o_totalprice <= q[3] THEN 2 ELSE 3 END AS quarter FROM orders, r",
)(lambda t: S.qcut(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 4, "quarter").drop("o_totalprice"))


def _people(t):
    return {"customer": t.customer.selectExpr("c_custkey AS id", "c_nationkey AS nation", "c_mktsegment AS segment"), "supplier": t.supplier.selectExpr("s_suppkey AS id", "s_nationkey AS nation")}


query("b_r14_concat_rows_outer", "SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, 'customer' AS origin FROM customer UNION ALL SELECT s_suppkey, s_nationkey, NULL, 'supplier' FROM supplier")(
    lambda t: S.concat_rows(_people(t), key="origin")
)
query("b_r14_concat_rows_inner", "SELECT c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")(
    lambda t: S.concat_rows(_people(t), join="inner")
)
query("b_r15_concat_columns", "SELECT coalesce(a.k, b.k) AS k, a.orders, b.events FROM (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1) a FULL JOIN (SELECT user_id * 2 AS k, count(*) AS events FROM events GROUP BY 1) b ON a.k = b.k")(
    lambda t: S.concat_columns([t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("orders")), t.events.groupBy((F.col("user_id") * 2).alias("k")).agg(F.count(F.lit(1)).alias("events"))], ["k"])
)
query("b_r16_explode_list", "SELECT p_partkey, unnest(CASE WHEN p_size >= 10 THEN string_split(p_name, ' ') ELSE [NULL] END) AS word FROM part")(
    lambda t: S.explode_list(t.part.selectExpr("p_partkey", "CASE WHEN p_size >= 10 THEN split(p_name, ' ') WHEN p_size >= 5 THEN CAST(array() AS ARRAY<STRING>) END AS word"), "word")
)
LINE = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("q", T.DoubleType())])
ORDER = T.StructType(
    [T.StructField("order", T.StructType([T.StructField("id", T.LongType()), T.StructField("ship", T.StructType([T.StructField("flag", T.StringType())]))])),
     T.StructField("groups", T.ArrayType(T.StructType([T.StructField("lines", T.ArrayType(LINE))])))]
)


@query(
    "b_r17_json_records",
    'SELECT l_orderkey AS "order.id", l_returnflag AS "order.ship.flag", unnest([l_linenumber, l_linenumber + 1]) AS n, unnest([l_quantity, NULL]) AS q FROM lineitem',
)
def _(t):
    text = (
        "to_json(named_struct('order', named_struct('id', l_orderkey, 'ship', named_struct('flag', l_returnflag)), 'groups', array(named_struct('lines', "
        "array(named_struct('n', l_linenumber, 'q', l_quantity), named_struct('n', l_linenumber + 1, 'q', CAST(NULL AS DOUBLE))))))) AS doc"
    )
    return S.normalise_json(t.lineitem.selectExpr(text), "doc", ORDER, record_path=["groups", "lines"], meta=[["order", "id"], ["order", "ship", "flag"]])


query("b_r18_list_access", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, embedding[1] AS first_item, embedding[-1] AS last_item, embedding[100000] AS beyond FROM embeddings")(
    lambda t: t.embeddings.select("vec_id", F.size("embedding").alias("size"), F.get("embedding", F.lit(0)).alias("first_item"), F.element_at("embedding", -1).alias("last_item"), F.get("embedding", F.lit(99999)).alias("beyond"))
)
query("b_r18_list_flatten", "SELECT label, unnest(range(1, len(embedding) + 1)) AS place, unnest(embedding) AS item FROM embeddings")(
    lambda t: t.embeddings.select("label", F.posexplode("embedding").alias("p", "item")).selectExpr("label", "CAST(p + 1 AS BIGINT) AS place", "item")
)
query("b_r18_struct_fields", "SELECT event_id, CAST(props::JSON ->> 'k' AS BIGINT) AS k FROM events")(
    lambda t: t.events.select("event_id", F.from_json("props", "k bigint").alias("s")).select("event_id", "s.*")
)
query(
    "b_r19_transpose",
    "SELECT 'n' AS key, " + cells("CAST(count(*) FILTER ({w}) AS DOUBLE)") + " FROM orders UNION ALL SELECT 'dearest', " + cells("max(o_totalprice) FILTER ({w})") + " FROM orders",
)(lambda t: t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("o_totalprice").alias("dearest")).transpose("o_orderstatus"))
query("b_r1_pivot_long", "SELECT l_returnflag, l_partkey, round(sum(l_quantity), 4) AS value FROM lineitem GROUP BY 1, 2")(
    lambda t: pivot_long(t.lineitem, ["l_returnflag"], "l_partkey", F.round(F.sum("l_quantity"), 4))
)
