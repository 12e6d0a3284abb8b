"""Missing values, duplicates, replacement, typing and rules."""

from pyspark.sql import functions as F

from wardflow.operators import missing as M, quality as C
from wardflow.operators.ordered import Series
from wardflow.queries.registry import query

GAP = "CASE WHEN event_type NOT IN ('error', 'view') THEN value END"
O = "PARTITION BY user_id ORDER BY ts, event_id"
X = f"x AS (SELECT event_id, user_id, ts, event_type, value, {GAP} AS v, row_number() OVER ({O}) AS n FROM events)"
NEAR = f"""{X}, y AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN {{n: n, t: epoch_us(ts), v: v}} END IGNORE NULLS) OVER ({O} ROWS UNBOUNDED PRECEDING) AS p,
  first_value(CASE WHEN v IS NOT NULL THEN {{n: n, t: epoch_us(ts), v: v}} END IGNORE NULLS) OVER ({O} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM x)"""


def series(t):
    return Series.fitted(t.events, ["user_id"], "ts", "event_id")


def rows(t):
    return t.events.selectExpr("event_id", "user_id", "ts", "event_type", "value", f"{GAP} AS v")


def near(expr):
    return f"WITH {NEAR} SELECT event_id, {expr} AS v FROM y"


query("b_a23_fillna", f"SELECT event_id, coalesce({GAP}, 0) AS v FROM events")(lambda t: rows(t).fillna({"v": 0.0}).select("event_id", "v"))
query("b_a23_ffill", near("p.v"))(lambda t: M.fill(rows(t), series(t), "v").select("event_id", "v"))
query("b_a23_bfill", near("q.v"))(lambda t: M.fill(rows(t), series(t), "v", backward=True).select("event_id", "v"))
query("b_m2_ffill_many_columns", near("p.v"))(lambda t: M.carry_forward(rows(t), series(t), ["v"]).select("event_id", "v"))
query("b_m2_ffill_limit", near("CASE WHEN n - p.n <= 1 THEN p.v END"))(lambda t: M.fill(rows(t), series(t), "v", limit=1).select("event_id", "v"))
query("b_m2_bfill_limit_inside", near("CASE WHEN q.n - n <= 2 AND p IS NOT NULL THEN q.v END"))(
    lambda t: M.fill(rows(t), series(t), "v", backward=True, limit=2, area="inside").select("event_id", "v")
)
query("b_m2_ffill_outside", near("CASE WHEN v IS NOT NULL THEN v WHEN q IS NULL THEN p.v END"))(
    lambda t: M.fill(rows(t), series(t), "v", area="outside").select("event_id", "v")
)
LINE = "CASE WHEN v IS NOT NULL THEN v WHEN p IS NULL THEN q.v WHEN q IS NULL THEN p.v ELSE p.v + (q.v - p.v) * (({at} - p.{k}) / CAST(q.{k} - p.{k} AS DOUBLE)) END"
ROW_LINE, TIME_LINE = LINE.format(at="n", k="n"), LINE.format(at="epoch_us(ts)", k="t")
query("b_m3_interpolate_rows", near(f"round(CASE WHEN p IS NOT NULL THEN {ROW_LINE} END, 7)"))(
    lambda t: M.interpolate(rows(t), series(t), "v", "w").select("event_id", F.round("w", 7).alias("v"))
)
query("b_m3_interpolate_time", near(f"round(CASE WHEN p IS NOT NULL THEN {TIME_LINE} END, 7)"))(
    lambda t: M.interpolate(rows(t), series(t), "v", "w", ts="ts").select("event_id", F.round("w", 7).alias("v"))
)
query("b_m3_interpolate_limit_both", near(f"round(CASE WHEN n - p.n <= 1 OR q.n - n <= 1 THEN {ROW_LINE} END, 7)"))(
    lambda t: M.interpolate(rows(t), series(t), "v", "w", limit=1, direction="both").select("event_id", F.round("w", 7).alias("v"))
)
query("b_m3_interpolate_backward_inside", near(f"round(CASE WHEN p IS NOT NULL AND q.n - n <= 2 THEN {ROW_LINE} END, 7)"))(
    lambda t: M.interpolate(rows(t), series(t), "v", "w", limit=2, direction="backward", area="inside").select("event_id", F.round("w", 7).alias("v"))
)
query("b_m4_drop_rows", "SELECT event_id FROM (SELECT event_id, " + GAP + " AS v, CASE WHEN value > 20 THEN value END AS w FROM events) WHERE v IS NOT NULL OR w IS NOT NULL")(
    lambda t: rows(t).withColumn("w", F.when(F.col("value") > 20, F.col("value"))).dropna(thresh=1, subset=["v", "w"]).select("event_id")
)
query("b_m5_first_last_valid", f"SELECT user_id, min(CASE WHEN {GAP} IS NOT NULL THEN ts END) AS first_valid, max(CASE WHEN {GAP} IS NOT NULL THEN ts END) AS last_valid FROM events GROUP BY 1")(
    lambda t: M.first_last_valid(rows(t), ["user_id"], "ts", "v")
)
query("b_m6_replace_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders")(
    lambda t: t.orders.select("o_orderkey", M.replace_values(F.col("o_orderstatus"), {"F": "final", "O": "open"}).alias("status"))
)
query("b_m6_replace_patterns", "SELECT o_orderkey, regexp_replace(regexp_replace(o_orderpriority, '^([0-9])-', 'p\\1 ', 'g'), 'SPECIFIED', 'GIVEN', 'g') AS priority FROM orders")(
    lambda t: t.orders.select("o_orderkey", M.replace_patterns(F.col("o_orderpriority"), {"^([0-9])-": "p$1 ", "SPECIFIED": "GIVEN"}).alias("priority"))
)
KEY = "l_orderkey, l_linenumber"
LK = ["l_orderkey", "l_linenumber"]
LO = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
LOS = ", ".join(LO)
for _keep, _sql in {
    "first": f"row_number() OVER (PARTITION BY {KEY} ORDER BY {LOS}) > 1",
    "last": f"row_number() OVER (PARTITION BY {KEY} ORDER BY {', '.join(c + ' DESC' for c in LO)}) > 1",
    "none": f"count(*) OVER (PARTITION BY {KEY}) > 1",
}.items():
    query(f"b_m7_duplicated_{_keep}", f"SELECT {KEY}, {LOS}, {_sql} AS duplicated FROM lineitem")(
        lambda t, k=_keep: M.mark_duplicates(t.lineitem.select(*LK, *LO), LK, LO, keep=k)
    )
    query(f"b_m7_drop_duplicates_{_keep}", f"SELECT {KEY}, {LOS} FROM (SELECT *, {_sql} AS d FROM lineitem) WHERE NOT d")(
        lambda t, k=_keep: M.drop_duplicates(t.lineitem.select(*LK, *LO), LK, LO, keep=k)
    )
query("b_m8_text_to_number", "SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE ' ' || value || ' ' END AS DOUBLE) AS number FROM events")(
    lambda t: t.events.select("event_id", M.to_number(F.expr("CASE WHEN event_type = 'error' THEN 'n/a' ELSE concat(' ', CAST(value AS STRING), ' ') END")).alias("number"))
)
query(
    "b_m8_narrowest_integer",
    "SELECT c AS \"column\", low, high, CASE WHEN low >= -128 AND high < 128 THEN 'tinyint' WHEN low >= -32768 AND high < 32768 THEN 'smallint' WHEN low >= -2147483648 AND high < 2147483648 THEN 'int' ELSE 'bigint' END AS narrowest FROM ("
    "SELECT 'p_partkey' AS c, min(p_partkey) AS low, max(p_partkey) AS high FROM part UNION ALL SELECT 'p_size', min(p_size), max(p_size) FROM part)",
)(lambda t: M.narrowest_integer(t.part, ["p_partkey", "p_size"]))
query("b_m9_clip_round", "SELECT event_id, least(greatest(value, 5), 50) AS clipped, round_even(value * 10, 0) / 1 AS rounded FROM events")(
    lambda t: t.events.select("event_id", M.clip(F.col("value"), 5.0, 50.0).alias("clipped"), F.bround(F.col("value") * 10, 0).alias("rounded"))
)
query(
    "b_m10_case_map_between_isin",
    "SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END AS band, "
    "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS mapped, o_totalprice BETWEEN 50000 AND 60000 AS inside, o_orderpriority IN ('1-URGENT', '2-HIGH') AS pressing FROM orders",
)(
    lambda t: t.orders.select(
        "o_orderkey", F.when(F.col("o_totalprice") < 100000, "low").when(F.col("o_totalprice") < 300000, "middle").otherwise("high").alias("band"),
        F.try_element_at(F.create_map(F.lit("F"), F.lit(1), F.lit("O"), F.lit(2)), F.col("o_orderstatus")).alias("mapped"),
        F.col("o_totalprice").between(50000, 60000).alias("inside"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("pressing"),
    )
)
RULES = {
    "l_quantity <= 45": "NOT (l_quantity <= 45)",
    "l_quantity > 3": "NOT (l_quantity > 3)",
    "l_discount in [0.01, 0.09]": "l_discount NOT BETWEEN 0.01 AND 0.09",
    "l_linenumber multiple of 2": "l_linenumber % 2 <> 0",
    "length of l_returnflag in [1, 1]": "FALSE",
    "not (l_tax < 0.05)": "l_tax < 0.05",
}


def column_rules():
    return [
        C.le("l_quantity", 45), C.gt("l_quantity", 3), C.interval("l_discount", 0.01, 0.09), C.multiple_of("l_linenumber", 2),
        C.length_between("l_returnflag", 1, 1), C.negate(C.lt("l_tax", 0.05)),
    ]


_broken = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in RULES.items()) + "], lambda r: r IS NOT NULL)"
query("b_m11_broken_rules", f"SELECT rule, count(*) AS n FROM (SELECT unnest({_broken}) AS rule FROM lineitem) GROUP BY 1")(
    lambda t: t.lineitem.select(F.explode(C.broken_rules(column_rules())).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
)
query("b_m11_quarantine", f"SELECT {KEY}, l_partkey, l_suppkey, {_broken}[1] AS reason FROM lineitem WHERE len({_broken}) > 0")(
    lambda t: C.split_valid(t.lineitem, column_rules())[1].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reason")
)
query("b_m11_zone_rule", "SELECT event_id FROM events WHERE event_type <> 'view'")(
    lambda t: C.split_valid(t.events.selectExpr("event_id", "concat(CAST(ts AS STRING), CASE WHEN event_type = 'view' THEN 'Z' ELSE '' END) AS at"), [C.zoned("at")])[1].select("event_id")
)
query("b_m12_infer_types", "SELECT unnest(['k', 'price', 'day', 'status']) AS \"column\", unnest(['int', 'double', 'timestamp_ntz', 'string']) AS inferred FROM (SELECT count(*) FROM orders)")(
    lambda t: M.infer_types(t.orders.selectExpr("CAST(o_orderkey AS STRING) AS k", "CAST(o_totalprice AS STRING) AS price", "CAST(o_orderdate AS STRING) AS day", "o_orderstatus AS status"), ["k", "price", "day", "status"])
)
