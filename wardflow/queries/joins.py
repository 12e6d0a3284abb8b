"""Join operators."""

from pyspark.sql import functions as F

from wardflow.operators import joins as J
from wardflow.queries.registry import query

# Orders moved into the month of the events; the key is the customer.
MOVED = "o_orderkey, o_custkey AS user_id, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((epoch(o_orderdate) // 86400 * 7 + o_orderkey) % 720 AS INTEGER)) AS ts, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus"
RIGHT = f"r AS (SELECT {MOVED} FROM orders)"


def moved_orders(t):
    return t.orders.selectExpr(
        "o_orderkey", "o_custkey AS user_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST((datediff(o_orderdate, DATE '1970-01-01') * 7 + o_orderkey) % 720 AS INT)) AS ts",
        "o_totalprice", "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus",
    )


def left_events(t):
    return t.events.select("event_id", "user_id", "ts")


def _keyed(t):
    a = t.customer.selectExpr("CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k", "c_acctbal AS v").groupBy("k").agg(F.count("*").alias("n"))
    b = t.orders.selectExpr("CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 100 END AS k").groupBy("k").agg(F.count("*").alias("n"))
    return a, b


KEYED = """WITH a AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k, count(*) AS n FROM customer GROUP BY 1),
b AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 100 END AS k, count(*) AS n FROM orders GROUP BY 1)
"""
ON = "ON a.k IS NOT DISTINCT FROM b.k"
for _how, _sql in [("inner", "JOIN"), ("left", "LEFT JOIN"), ("full", "FULL JOIN")]:
    query(f"b_j1_{_how}_join", f"{KEYED} SELECT coalesce(a.k, b.k) AS k, a.n AS n_x, b.n AS n_y FROM a {_sql} b {ON}")(
        lambda t, how=_how: J.hash_join(*_keyed(t), ["k"], how)
    )


@query("b_j1_order_lines", "SELECT o_orderpriority, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    joined = J.hash_join(t.orders.select("o_orderkey", "o_orderpriority"), lines, ["o_orderkey"])
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query(
    "b_j3_multi_key_join",
    "SELECT l_returnflag, l_linestatus, a.n, b.q FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) a JOIN (SELECT l_returnflag, l_linestatus, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2) b USING (l_returnflag, l_linestatus)",
)
def _(t):
    keys = ["l_returnflag", "l_linestatus"]
    return t.lineitem.groupBy(*keys).agg(F.count("*").alias("n")).join(t.lineitem.groupBy(*keys).agg(F.max("l_quantity").alias("q")), keys)


query("b_j4_join_with_origin", f"{KEYED} SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.n IS NULL THEN 'left_only' WHEN a.n IS NULL THEN 'right_only' ELSE 'both' END AS _merge FROM a FULL JOIN b {ON}")(
    lambda t: J.join_with_origin(*_keyed(t), ["k"]).select("k", "_merge")
)
query("b_j5_cardinality", "SELECT (SELECT max(n) = 1 FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)) AS left_unique, (SELECT max(n) = 1 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)) AS right_unique, '1:m' AS kind")(
    lambda t: J.join_cardinality(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"])
)

PICK = "{f}({{ts: r.ts, o_orderkey: r.o_orderkey, o_totalprice: r.o_totalprice}}, (r.ts, r.o_orderkey))"


def _asof_sql(direction, op, extra="", where="TRUE"):
    f = "arg_max" if direction == "backward" else "arg_min"
    return f"""WITH {RIGHT}, m AS (
  SELECT event_id, {PICK.format(f=f)} AS x FROM events e JOIN r ON r.user_id = e.user_id AND r.ts {op} e.ts {extra} WHERE {where} GROUP BY 1)
SELECT e.event_id, e.user_id, e.ts, x.ts AS ts_right, x.o_orderkey AS o_orderkey, x.o_totalprice AS o_totalprice FROM events e LEFT JOIN m USING (event_id)"""


ASOF = dict(on="ts", by=["user_id"], columns=["o_orderkey", "o_totalprice"], ties=["o_orderkey"])
query("b_j6_asof_backward", _asof_sql("backward", "<="))(lambda t: J.asof_join(left_events(t), moved_orders(t), **ASOF))
query("b_j6_asof_forward", _asof_sql("forward", ">="))(lambda t: J.asof_join(left_events(t), moved_orders(t), direction="forward", **ASOF))
query("b_j6_asof_backward_tolerance", _asof_sql("backward", "<=", "AND r.ts >= e.ts - INTERVAL 12 HOUR"))(
    lambda t: J.asof_join(left_events(t), moved_orders(t), tolerance="12 hours", **ASOF)
)


@query(
    "b_j6_asof_not_exact",
    f"""WITH {RIGHT}, l AS (SELECT event_id, user_id, date_trunc('hour', ts) AS ts FROM events), m AS (
  SELECT event_id, {PICK.format(f='arg_max')} AS x FROM l JOIN r ON r.user_id = l.user_id AND r.ts < l.ts GROUP BY 1)
SELECT l.event_id, l.user_id, l.ts, x.ts AS ts_right, x.o_orderkey AS o_orderkey, x.o_totalprice AS o_totalprice FROM l LEFT JOIN m USING (event_id)""",
)
def _(t):
    left = left_events(t).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return J.asof_join(left, moved_orders(t), exact=False, **ASOF)


query(
    "b_j6_asof_nearest",
    f"""WITH {RIGHT}, b AS (SELECT event_id, {PICK.format(f='arg_max')} AS x FROM events e JOIN r ON r.user_id = e.user_id AND r.ts <= e.ts GROUP BY 1),
a AS (SELECT event_id, {PICK.format(f='arg_min')} AS x FROM events e JOIN r ON r.user_id = e.user_id AND r.ts >= e.ts GROUP BY 1),
m AS (SELECT e.event_id, e.user_id, e.ts, CASE WHEN b.x IS NULL OR epoch_us(a.x.ts) - epoch_us(e.ts) < epoch_us(e.ts) - epoch_us(b.x.ts) THEN a.x ELSE b.x END AS x
  FROM events e LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id))
SELECT event_id, user_id, ts, x.ts AS ts_right, x.o_orderkey AS o_orderkey, x.o_totalprice AS o_totalprice FROM m""",
)(lambda t: J.asof_join(left_events(t), moved_orders(t), direction="nearest", **ASOF))
query("b_j7_asof_last_complete", _asof_sql("backward", "<=", "AND r.o_orderstatus IS NOT NULL"))(
    lambda t: J.asof_last_complete(left_events(t), moved_orders(t), subset=["o_orderstatus"], **ASOF)
)


@query(
    "b_j8_ordered_join_fill",
    f"""WITH {RIGHT}, a AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS events FROM events GROUP BY 1, 2),
b AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS orders FROM r GROUP BY 1, 2)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.ts, b.ts) AS ts,
  last_value(events IGNORE NULLS) OVER w AS events, last_value(orders IGNORE NULLS) OVER w AS orders
FROM a FULL JOIN b ON a.user_id = b.user_id AND a.ts = b.ts
WINDOW w AS (PARTITION BY coalesce(a.user_id, b.user_id) ORDER BY coalesce(a.ts, b.ts) ROWS UNBOUNDED PRECEDING)""",
)
def _(t):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")
    a = t.events.groupBy("user_id", day).agg(F.count("*").alias("events"))
    b = moved_orders(t).groupBy("user_id", day).agg(F.count("*").alias("orders"))
    return J.ordered_join(a, b, on="ts", by=["user_id"], fill=["events", "orders"])


for _closed, _lo, _hi in [("left", ">=", "<"), ("right", ">", "<="), ("both", ">=", "<="), ("neither", ">", "<")]:

    def _inside(t, closed=_closed):
        points = t.events.select("event_id", "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at"))
        spans = moved_orders(t).select("user_id", "o_orderkey", F.col("ts").alias("low"), F.expr("ts + INTERVAL '36' HOUR").alias("high"))
        return J.interval_join(points, spans, point="at", low="low", high="high", by=["user_id"], closed=closed).select("event_id", "o_orderkey")

    query(
        f"b_j9_interval_closed_{_closed}",
        f"WITH {RIGHT} SELECT event_id, o_orderkey FROM events e JOIN r ON r.user_id = e.user_id AND date_trunc('hour', e.ts) {_lo} r.ts AND date_trunc('hour', e.ts) {_hi} r.ts + INTERVAL 36 HOUR",
    )(_inside)


MIXED_END = "CASE o_orderkey % 4 WHEN 0 THEN ts + INTERVAL '40' SECOND WHEN 1 THEN ts + INTERVAL '3' HOUR WHEN 2 THEN ts + INTERVAL '9' DAY ELSE ts + INTERVAL '20' YEAR END"


@query(
    "b_j9_interval_mixed_lengths",
    f"WITH {RIGHT}, s AS (SELECT user_id, o_orderkey, ts AS low, {MIXED_END} AS high FROM r) SELECT event_id, o_orderkey FROM events e JOIN s ON s.user_id = e.user_id AND e.ts >= low AND e.ts < high",
)
def _(t):
    """Intervals of seconds and of decades in one table."""
    spans = moved_orders(t).select("user_id", "o_orderkey", F.col("ts").alias("low"), F.expr(MIXED_END).alias("high"))
    return J.interval_join(t.events.select("event_id", "user_id", "ts"), spans, point="ts", low="low", high="high", by=["user_id"]).select("event_id", "o_orderkey")


@query(
    "b_j10_interval_overlap",
    "SELECT o_orderkey, coalesce(max(o_orderdate + INTERVAL 60 DAY) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > o_orderdate, FALSE) AS overlaps FROM orders",
)
def _(t):
    spans = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("low"), F.expr("o_orderdate + INTERVAL '60' DAY").alias("high"))
    return J.overlaps_earlier(spans, low="low", high="high", by=["o_custkey"], ties=["o_orderkey"]).select("o_orderkey", "overlaps")


def _patch(t):
    a = t.orders.filter("o_orderstatus <> 'P'").selectExpr("o_orderkey", "CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price", "o_orderpriority AS priority")
    b = t.orders.filter("o_orderstatus <> 'F'").selectExpr("o_orderkey", "CASE WHEN o_totalprice < 400000 THEN -o_totalprice END AS price", "o_orderstatus AS status")
    return a, b


PATCH = """WITH a AS (SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price, o_orderpriority AS priority FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT o_orderkey, CASE WHEN o_totalprice < 400000 THEN -o_totalprice END AS price, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F')
"""
query("b_j11_combine_first", PATCH + "SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.price, b.price) AS price, priority, status FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey")(
    lambda t: J.combine_first(*_patch(t), ["o_orderkey"])
)
query("b_j11_update_from", PATCH + "SELECT a.o_orderkey, coalesce(b.price, a.price) AS price, priority FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey")(
    lambda t: J.update_from(*_patch(t), ["o_orderkey"])
)


@query(
    "b_j12_cell_diff",
    """SELECT o_orderkey, 'status' AS "column", o_orderstatus AS self, 'P' AS other FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority, NULL FROM orders WHERE o_totalprice > 300000""",
)
def _(t):
    a = t.orders.selectExpr("o_orderkey", "o_orderstatus AS status", "o_orderpriority AS priority")
    b = t.orders.selectExpr("o_orderkey", "'P' AS status", "CASE WHEN o_totalprice <= 300000 THEN o_orderpriority END AS priority")
    return J.compare(a, b, ["o_orderkey"])


@query("b_j13_key_grid", "SELECT user_id, event_type FROM (SELECT DISTINCT user_id FROM events), (SELECT DISTINCT event_type FROM events)")
def _(t):
    return J.grid(t.events.select("user_id"), t.events.select("event_type"))
