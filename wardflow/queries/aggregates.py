"""Grouped aggregation."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wardflow.operators import aggregates as A, ranks as R
from wardflow.operators.ordered import Series
from wardflow.queries.registry import query

G = ["l_returnflag", "l_linestatus"]
GSQL = "l_returnflag, l_linestatus"


def _agg(name, sql, make, table="lineitem", keys=G):
    """A grouped query whose result column is called ``r``."""
    by = ", ".join(keys)
    query(name, f"SELECT {by}, {sql} AS r FROM {table} GROUP BY {by}")(
        lambda t: getattr(t, table).groupBy(*keys).agg(make().alias("r"))
    )


ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ROW_SQL = "(l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_agg("b_a23_sum", "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)", lambda: A.sum_of(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"))
_agg("b_a2_sum_min_count", "CASE WHEN count(CASE WHEN l_quantity > 49 THEN 1 END) >= 200 THEN CAST(coalesce(sum(CASE WHEN l_quantity > 49 THEN l_quantity END), 0) AS BIGINT) END", lambda: A.sum_of(F.when(F.col("l_quantity") > 49, F.col("l_quantity")), 200).cast("bigint"))
_agg("b_a2_empty_sum", "CAST(coalesce(sum(CASE WHEN l_quantity > 60 THEN 1 END), 0) AS BIGINT)", lambda: A.sum_of(F.when(F.col("l_quantity") > 60, F.lit(1))).cast("bigint"))
_agg("b_a23_prod", "round(product(1 + l_tax), 8)", lambda: F.round(A.product_of(F.col("l_tax") + 1), 8), keys=["l_orderkey"])
_agg("b_a23_min", "min(l_extendedprice)", lambda: F.min("l_extendedprice"))
_agg("b_a23_max", "max(l_extendedprice)", lambda: F.max("l_extendedprice"))
_agg("b_a23_mean", "round(avg(l_quantity), 8)", lambda: F.round(F.avg("l_quantity"), 8))
_agg("b_a23_count", "count(CASE WHEN l_tax > 0 THEN l_tax END)", lambda: F.count(F.when(F.col("l_tax") > 0, F.col("l_tax"))))
_agg("b_a23_size", "count(*)", lambda: F.count(F.lit(1)))
_agg("b_a23_var", "round(var_samp(l_quantity), 6)", lambda: F.round(A.variance("l_quantity"), 6))
_agg("b_a3_var_population", "round(var_pop(l_quantity), 6)", lambda: F.round(A.variance("l_quantity", 0), 6))
_agg("b_a23_std", "round(stddev_samp(l_quantity), 6)", lambda: F.round(A.std("l_quantity"), 6))
_agg("b_a23_sem", "round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 8)", lambda: F.round(A.sem("l_quantity"), 8))
_agg("b_a23_skew", "round(skewness(l_extendedprice), 6)", lambda: F.round(A.skew("l_extendedprice"), 6))
_agg("b_a3_kurtosis", "round(kurtosis(l_extendedprice), 6)", lambda: F.round(A.kurtosis("l_extendedprice"), 6))
_agg("b_a23_any", "bool_or(l_quantity > 49)", lambda: F.bool_or(F.col("l_quantity") > 49), keys=["l_suppkey"])
_agg("b_a23_all", "bool_and(l_quantity > 1)", lambda: F.bool_and(F.col("l_quantity") > 1), keys=["l_suppkey"])
_agg("b_a23_nunique", "count(DISTINCT l_partkey)", lambda: F.count_distinct("l_partkey"))
EV, EV_SQL = ["ts", "event_id"], "(ts, event_id)"
GAP = "CASE WHEN event_type <> 'error' THEN value END"
_agg("b_a23_first", f"arg_min({GAP}, CASE WHEN event_type <> 'error' THEN {EV_SQL} END)", lambda: A.first_by(F.expr(GAP), EV), "events", ["user_id"])
_agg("b_a23_last", f"arg_max({GAP}, CASE WHEN event_type <> 'error' THEN {EV_SQL} END)", lambda: A.last_by(F.expr(GAP), EV), "events", ["user_id"])
_agg("b_a23_idxmin", "arg_min(event_id, (value, event_id))", lambda: A.label_of_min("event_id", "value", ["event_id"]), "events", ["user_id"])
_agg("b_a23_idxmax", "arg_min(event_id, (-value, event_id))", lambda: A.label_of_max("event_id", "value", ["event_id"]), "events", ["user_id"])
_agg("b_a10_cov", "round(covar_samp(l_quantity, l_extendedprice), 4)", lambda: F.round(F.covar_samp("l_quantity", "l_extendedprice"), 4))
_agg("b_a10_corr", "round(corr(l_quantity, l_extendedprice), 8)", lambda: F.round(A.correlation("l_quantity", "l_extendedprice"), 8))
_agg("b_a21_weighted_mean", "round(sum(l_discount * l_quantity) / sum(l_quantity), 10)", lambda: F.round(A.weighted_mean("l_discount", "l_quantity"), 10))

query("b_a23_corrwith", f"SELECT {GSQL}, round(corr(l_extendedprice, l_quantity), 8) AS l_quantity, round(corr(l_extendedprice, l_discount), 8) AS l_discount, round(corr(l_extendedprice, l_tax), 8) AS l_tax FROM lineitem GROUP BY ALL")(
    lambda t: t.lineitem.groupBy(*G).agg(*[F.round(A.correlation("l_extendedprice", c), 8).alias(c) for c in ["l_quantity", "l_discount", "l_tax"]])
)
query("b_a23_median", f"SELECT {GSQL}, median(l_extendedprice) AS r FROM lineitem GROUP BY ALL")(
    lambda t: R.median(t.lineitem, G, "l_extendedprice", "r")
)
query("b_a4_median_many_groups", "SELECT user_id, round(median(value), 6) AS r FROM events GROUP BY 1")(
    lambda t: R.median(t.events, ["user_id"], "value", "r").withColumn("r", F.round("r", 6))
)
query("b_a23_quantile", f"SELECT {GSQL}, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY ALL")(
    lambda t: R.quantiles(t.lineitem, G, "l_extendedprice", {"p10": 0.1, "p90": 0.9}).select(*G, F.round("p10", 6).alias("p10"), F.round("p90", 6).alias("p90"))
)
for _mode, _index in {"lower": "floor({h})", "higher": "ceil({h})", "nearest": "round_even({h}, 0)"}.items():
    query(
        f"b_a4_quantile_{_mode}",
        f"SELECT user_id, list_sort(list(value))[CAST({_index.format(h='(count(value) - 1) * 0.3')} AS BIGINT) + 1] AS r FROM events GROUP BY 1",
    )(lambda t, m=_mode: R.quantiles(t.events, ["user_id"], "value", {"r": 0.3}, interpolation=m))
query(
    "b_a4_quantile_midpoint",
    "SELECT user_id, round((list_sort(list(value))[CAST(floor((count(value) - 1) * 0.3) AS BIGINT) + 1] + list_sort(list(value))[CAST(ceil((count(value) - 1) * 0.3) AS BIGINT) + 1]) / 2, 6) AS r FROM events GROUP BY 1",
)(lambda t: R.quantiles(t.events, ["user_id"], "value", {"r": 0.3}, interpolation="midpoint").withColumn("r", F.round("r", 6)))


@query("b_a4_quantile_approx", f"SELECT {GSQL}, TRUE AS close FROM lineitem GROUP BY ALL")
def _(t):
    exact = R.quantiles(t.lineitem, G, "l_extendedprice", {"a": 0.24, "b": 0.26})
    near = t.lineitem.groupBy(*G).agg(F.percentile_approx("l_extendedprice", 0.25, 1000).alias("p"))
    return exact.join(near, G).select(*G, F.col("p").between(F.col("a"), F.col("b")).alias("close"))




def by_user(t):
    return Series.fitted(t.events, ["user_id"], "ts", "event_id")


for _n, _order in [(2, "ts, event_id"), (-1, "ts DESC, event_id DESC")]:
    query(
        f"b_a6_nth_{'last' if _n < 0 else _n}",
        f"SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_order}) AS n FROM events) WHERE n = {_n + 1 if _n >= 0 else -_n}",
    )(lambda t, n=_n: A.nth(t.events.select("user_id", "ts", "event_id", "value"), by_user(t), n).select("user_id", "event_id", "value"))
query("b_a8_value_shares", "SELECT o_orderstatus, o_orderpriority, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 10) AS proportion FROM orders GROUP BY 1, 2")(
    lambda t: A.value_shares(t.orders, ["o_orderstatus"], "o_orderpriority").withColumn("proportion", F.round("proportion", 10))
)
query("b_a9_open_high_low_close", f"SELECT user_id, CAST(ts AS DATE) AS day, arg_min(value, {EV_SQL}) AS open, max(value) AS high, min(value) AS low, arg_max(value, {EV_SQL}) AS close FROM events GROUP BY 1, 2")(
    lambda t: t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(*A.ohlc("value", EV))
)
query(
    "b_a10_spearman",
    f"""WITH x AS (SELECT {GSQL}, l_quantity, l_extendedprice, rank() OVER (PARTITION BY {GSQL} ORDER BY l_quantity) + (count(*) OVER (PARTITION BY {GSQL}, l_quantity) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY {GSQL} ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY {GSQL}, l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
SELECT {GSQL}, round(corr(a, b), 8) AS spearman FROM x GROUP BY ALL""",
)(lambda t: A.spearman(t.lineitem.select(*G, "l_quantity", "l_extendedprice"), G, "l_quantity", "l_extendedprice").withColumn("spearman", F.round("spearman", 8)))
query("b_a11_describe_numbers", "SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, max(o_totalprice) AS max FROM orders")(
    lambda t: A.describe_numbers(t.orders, "o_totalprice").select("count", "min", "max", *[F.round(c, 4).alias(c) for c in ["mean", "std", "q25", "q50", "q75"]])
)
query("b_a11_describe_text", "SELECT CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", arg_min(o_orderpriority, (-n, o_orderpriority)) AS top, max(n) AS freq FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)")(
    lambda t: A.describe_text(t.orders, "o_orderpriority")
)
query("b_a11_describe_times", "SELECT count(*) AS count, make_timestamp(CAST(floor(avg(u)) AS BIGINT)) AS mean, make_timestamp(min(u)) AS min, make_timestamp(CAST(floor(quantile_cont(u, 0.25)) AS BIGINT)) AS q25, make_timestamp(CAST(floor(quantile_cont(u, 0.5)) AS BIGINT)) AS q50, make_timestamp(CAST(floor(quantile_cont(u, 0.75)) AS BIGINT)) AS q75, make_timestamp(max(u)) AS max FROM (SELECT epoch_us(o_orderdate) AS u FROM orders)")(
    lambda t: A.describe_times(t.orders, "o_orderdate")
)
query("b_a12_named_aggregation", "SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS dearest, min(o_orderdate) AS first_day FROM orders GROUP BY 1")(
    lambda t: t.orders.groupBy("o_orderstatus").agg(*[f.alias(n) for n, f in {"orders": F.count("*"), "dearest": F.max("o_totalprice"), "first_day": F.min("o_orderdate")}.items()])
)
query("b_a13_keep_groups", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING avg(value) > 50 AND count(*) >= 5)")(
    lambda t: A.keep_groups(t.events.select("event_id", "user_id", "value"), ["user_id"], (F.avg("value") > 50) & (F.count("*") >= 5)).select("event_id", "user_id")
)
query("b_a14_group_transform", "SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id), 8) AS centred, count(*) OVER (PARTITION BY user_id) AS size FROM events")(
    lambda t: A.transform_groups(t.events.select("event_id", "user_id", "value"), ["user_id"], {"m": F.avg("value"), "size": F.count("*")}).select("event_id", F.round(F.col("value") - F.col("m"), 8).alias("centred"), "size")
)


@query("b_a15_own_group_function", "SELECT event_type, round(exp(avg(ln(value))), 8) AS geometric_mean, round(max(value) - min(value), 6) AS spread FROM events WHERE value > 0 GROUP BY 1")
def _(t):
    def partial(pdf):
        return {"logs": float(np.log(pdf["value"]).sum()), "n": len(pdf), "low": pdf["value"].min(), "high": pdf["value"].max()}

    return A.apply_groups(
        t.events.filter("value > 0").select("event_type", "value"), ["event_type"], partial,
        "logs double, n long, low double, high double",
        [F.round(F.exp(F.sum("logs") / F.sum("n")), 8).alias("geometric_mean"), F.round(F.max("high") - F.min("low"), 6).alias("spread")],
    )


def falls(key, batches):
    """How often a value is below the one before it, and the deepest fall from the highest so far."""
    before, top, count, deepest = None, float("-inf"), 0, 0.0
    for pdf in batches:
        for v in pdf["value"]:
            count += before is not None and v < before
            before, top = v, max(top, v)
            deepest = max(deepest, top - v)
    return pd.DataFrame({"falls": [count], "deepest": [deepest]})


for _key in ("user_id", "event_type"):
    query(
        f"b_a15_whole_group_function_by_{_key.split('_')[0]}",
        f"SELECT {_key}, count(*) FILTER (value < before) AS falls, round(max(top - value), 6) AS deepest FROM (SELECT {_key}, value, lag(value) OVER w AS before, max(value) OVER w AS top FROM events WINDOW w AS (PARTITION BY {_key} ORDER BY ts, event_id)) GROUP BY 1",
    )(
        lambda t, k=_key: A.apply_whole_groups(t.events.select(k, "ts", "event_id", "value"), [k], ["ts", "event_id"], falls, "falls long, deepest double").withColumn("deepest", F.round("deepest", 6))
    )
query("b_a16_time_bucket_groups", "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS bucket, event_type, count(*) AS n FROM events GROUP BY 1, 2")(
    lambda t: t.events.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), "event_type", "n")
)
query("b_a23_ngroup", "SELECT event_id, dense_rank() OVER (ORDER BY user_id) - 1 AS ngroup FROM events")(
    lambda t: A.group_numbers(t.events.select("event_id", "user_id"), "user_id").select("event_id", "ngroup")
)

# Histograms of order prices by rule
SPREAD, N = "(max(x) - min(x))", "count(x)"
RULES = {
    "sqrt": f"{SPREAD} / sqrt({N})",
    "sturges": f"{SPREAD} / (log2({N}) + 1)",
    "rice": f"{SPREAD} / (2 * pow({N}, 1 / 3.0))",
    "scott": f"pow(24 * sqrt(pi()) / {N}, 1 / 3.0) * stddev_pop(x)",
    "doane": f"{SPREAD} / (1 + log2({N}) + log2(1 + abs(skewness(x) * ({N} - 2) / sqrt({N} * ({N} - 1.0))) / sqrt(6.0 * ({N} - 2) / (({N} + 1.0) * ({N} + 3)))))",
    "fd": f"2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / pow({N}, 1 / 3.0)",
}
RULES["auto"] = f"least({RULES['fd']}, {RULES['sturges']})"
for _rule, _width in RULES.items():
    query(
        f"b_a18_histogram_{_rule}",
        f"""WITH d AS (SELECT value AS x FROM events), s AS (SELECT min(x) AS lo, max(x) AS hi, CAST(ceil({SPREAD} / ({_width})) AS INTEGER) AS k FROM d),
e AS (SELECT CAST(i AS INTEGER) AS i, lo + i * ((hi - lo) / k) AS a, CASE WHEN i + 1 = k THEN hi ELSE lo + (i + 1) * ((hi - lo) / k) END AS b, i + 1 = k AS is_last FROM s, range(10000) r(i) WHERE i < k)
SELECT i AS bin, round(a, 6) AS low, round(b, 6) AS high, count(*) AS count FROM e JOIN d ON x >= a AND (x < b OR (is_last AND x <= b)) GROUP BY ALL""",
    )(
        lambda t, r=_rule: A.histogram(t.events, "value", A.bin_edges(t.events, "value", r)).select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "count")
    )
EDGES = [0.0, 10.0, 25.0, 100.0, 250.0, 500.0]
EDGE_ROWS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))
EDGE_JOIN = f"(VALUES {EDGE_ROWS}) e(bin, low, high) JOIN events ON value >= low AND (value < high OR (bin = 4 AND value = high))"
query("b_a18_histogram_edges_weighted", f"SELECT bin, low, high, round(sum(value), 4) AS count FROM {EDGE_JOIN} GROUP BY ALL")(
    lambda t: A.histogram(t.events, "value", EDGES, weight="value").withColumn("count", F.round("count", 4))
)
query("b_a18_histogram_density", f"SELECT bin, low, high, count(*) AS count, round(count(*) / sum(count(*)) OVER () / (high - low), 10) AS density FROM {EDGE_JOIN} GROUP BY bin, low, high")(
    lambda t: A.histogram(t.events, "value", EDGES, density=True).withColumn("density", F.round("density", 10))
)
BIN = "CASE WHEN {c} < {a} OR {c} > {z} THEN NULL WHEN {c} = {z} THEN {k} - 1 ELSE CAST(floor(({c} - {a}) / {w}) AS INTEGER) END"
query(
    "b_a19_histogram_2d",
    f"SELECT {BIN.format(c='l_quantity', a=0, z=50, k=5, w=10)} AS l_quantity_bin, {BIN.format(c='l_extendedprice', a=0, z=100000, k=4, w=25000)} AS l_extendedprice_bin, count(*) AS count FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 100000 GROUP BY 1, 2",
)(lambda t: A.histogram_nd(t.lineitem, {"l_quantity": [0, 10, 20, 30, 40, 50], "l_extendedprice": [0, 25000, 50000, 75000, 100000]}))
query(
    "b_a19_histogram_3d",
    f"SELECT {BIN.format(c='l_quantity', a=0, z=50, k=2, w=25)} AS l_quantity_bin, {BIN.format(c='l_extendedprice', a=0, z=100000, k=2, w=50000)} AS l_extendedprice_bin, CASE WHEN l_linenumber < 4 THEN 0 ELSE 1 END AS l_linenumber_bin, CAST(sum(l_quantity) AS DOUBLE) AS count FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 100000 GROUP BY 1, 2, 3",
)(lambda t: A.histogram_nd(t.lineitem, {"l_quantity": [0, 25, 50], "l_extendedprice": [0, 50000, 100000], "l_linenumber": [0, 4, 8]}, weight="l_quantity"))
TYPES = ["click", "error", "purchase", "refund", "signup", "view"]
query(
    "b_a20_categories_with_zero",
    "SELECT u.user_id, c.event_type, count(e.event_id) AS count FROM (SELECT DISTINCT user_id FROM events) u, (VALUES " + ", ".join(f"('{v}')" for v in TYPES) + ") c(event_type) LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = c.event_type GROUP BY 1, 2",
)(lambda t: A.categories_with_zero(t.events, ["user_id"], "event_type", TYPES))
query("b_a22_straight_line", f"SELECT {GSQL}, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2 FROM lineitem GROUP BY ALL")(
    lambda t: t.lineitem.groupBy(*G).agg(*A.straight_line("l_extendedprice", "l_quantity")).select(*G, F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 8).alias("r2"))
)
# One value far out makes very many bins, nearly all of them empty.
query(
    "b_a18_histogram_outlier",
    "WITH d AS (SELECT CASE WHEN event_id = 1 THEN 1e7 ELSE value END AS x FROM events), s AS (SELECT min(x) AS lo, max(x) AS hi FROM d) "
    "SELECT CAST(least(floor((x - lo) / ((hi - lo) / 12500000)), 12499999) AS BIGINT) AS bin, count(*) AS count FROM d, s GROUP BY 1",
)(lambda t: A.histogram(d := t.events.selectExpr("CASE WHEN event_id = 1 THEN 1e7D ELSE value END AS x"), "x", A.bin_edges(d, "x", 12_500_000)).select("bin", "count"))
query("b_a17_group_numbers_of_two_keys", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderstatus, o_orderpriority) - 1 AS ngroup FROM orders")(
    lambda t: A.group_numbers(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"]).select("o_orderkey", "ngroup")
)
