"""Windows over ordered rows of a user's events."""

from pyspark.sql import functions as F

from wardflow.operators import ranks as R, windows as W
from wardflow.operators.ordered import Series, position
from wardflow.queries.registry import query

# The value over 7.919: results then have no short decimal form, and rounding them has no ties.
GAP = "CASE WHEN event_id % 5 <> 0 THEN value / 7.919 END"
X = f"x AS (SELECT event_id, user_id, ts, event_type, value / 7.919 AS value, {GAP} AS v, length(props) + value / 7.919 AS u FROM events)"


def series(t):
    return Series.fitted(t.events, ["user_id"], "ts", "event_id")


def rows(t):
    return t.events.selectExpr("event_id", "user_id", "ts", "event_type", "value / 7.919 AS value", f"{GAP} AS v", "length(props) + value / 7.919 AS u")


def out(df, *cols, digits=6):
    return df.select("event_id", *[F.round(c, digits).alias(c) for c in cols])


O = "PARTITION BY user_id ORDER BY ts, event_id"
ROLL = f"({O} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


def sql(body, frame=ROLL, where=""):
    return f"WITH {X} SELECT event_id, {body} FROM x WINDOW w AS {frame}"


def least(n, e, digits=6):
    return f"CASE WHEN count(v) OVER w >= {n} THEN round({e}, {digits}) END"


BASIC = {"sum": "sum(v) OVER w", "mean": "avg(v) OVER w", "min": "min(v) OVER w", "max": "max(v) OVER w", "count": "count(v) OVER w", "var": "var_samp(v) OVER w", "std": "stddev_samp(v) OVER w"}


def body(items, n):
    return ", ".join(f"{least(n, e)} AS {k}" for k, e in items.items())


query("b_w1_rolling_rows", sql(body(BASIC, 3)))(
    lambda t: out(W.rolling(rows(t), series(t), "v", 5, {k: W.KERNELS[k] for k in BASIC}, min_periods=3), *BASIC)
)
SPAN = "RANGE BETWEEN INTERVAL 24 HOUR {a} PRECEDING AND {b}"
FRAMES = {
    "right": "RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW",
    "both": "RANGE BETWEEN INTERVAL 86400000000 MICROSECOND PRECEDING AND CURRENT ROW",
    "left": "RANGE BETWEEN INTERVAL 86400000000 MICROSECOND PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING",
    "neither": "RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING",
}
for _closed, _frame in FRAMES.items():
    query(f"b_w2_rolling_time_{_closed}", sql(body({"sum": "sum(v) OVER w", "mean": "avg(v) OVER w", "count": "count(v) OVER w"}, 1), f"(PARTITION BY user_id ORDER BY ts {_frame})"))(
        lambda t, c=_closed: out(W.rolling_time(rows(t), ["user_id"], "ts", "v", "24 hours", {k: W.KERNELS[k] for k in ("sum", "mean", "count")}, closed=c), "sum", "mean", "count")
    )
for _closed, _frame in FRAMES.items():
    query(f"b_w2_rolling_time_sums_{_closed}", sql(body({"sum": "sum(v) OVER w", "mean": "avg(v) OVER w", "count": "count(v) OVER w"}, 1), f"(PARTITION BY user_id ORDER BY ts {_frame})"))(
        lambda t, c=_closed: out(W.rolling_time_sums(rows(t), series(t), "ts", "v", "24 hours", closed=c), "sum", "mean", "count")
    )
query("b_w3_rolling_centred", sql(body({"mean": BASIC["mean"]}, 3), f"({O} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"))(
    lambda t: out(W.rolling(rows(t), series(t), "v", 5, {"mean": W.KERNELS["mean"]}, min_periods=3, center=True), "mean")
)
query("b_w3_rolling_forward", sql(body({"sum": BASIC["sum"], "max": BASIC["max"]}, 3), f"({O} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)"))(
    lambda t: out(W.rolling(rows(t), series(t), "v", 5, {k: W.KERNELS[k] for k in ("sum", "max")}, min_periods=3, forward=True), "sum", "max")
)
query("b_w3_rolling_step", f"SELECT event_id, sum FROM (WITH {X} SELECT event_id, {least(3, 'sum(v) OVER w')} AS sum, row_number() OVER (ORDER BY user_id, ts, event_id) AS dummy, row_number() OVER ({O}) AS n FROM x WINDOW w AS {ROLL}) WHERE (n - 1) % 3 = 0")(
    lambda t: out(W.rolling(rows(t), series(t), "v", 5, {"sum": W.KERNELS["sum"]}, min_periods=3, step=3), "sum")
)
query("b_w4_rolling_median_quantile", sql(body({"median": "quantile_cont(v, 0.5) OVER w", "q25": "quantile_cont(v, 0.25) OVER w"}, 3)))(
    lambda t: out(W.rolling(rows(t), series(t), "v", 5, {"median": W.KERNELS["median"], "q25": W.quantile_kernel(0.25)}, min_periods=3), "median", "q25")
)
RANK = "CASE WHEN v IS NOT NULL THEN len(list_filter(list(v) OVER w, lambda e: e < v)) + (len(list_filter(list(v) OVER w, lambda e: e = v)) + 1) / 2.0 END"
query("b_w4_rolling_rank", sql(f"{least(3, RANK)} AS rank"))(lambda t: out(W.rolling(rows(t), series(t), "v", 5, {"rank": W.KERNELS["rank"]}, min_periods=3), "rank"))
LONG = "PARTITION BY event_type ORDER BY ts, event_id"
LONG_FRAME = f"({LONG} ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)"
LONG_STATISTICS = {
    **BASIC, "skew": "skewness(v) OVER w", "kurt": "kurtosis(v) OVER w", "median": "quantile_cont(v, 0.5) OVER w", "q90": "quantile_cont(v, 0.9) OVER w", "rank": RANK,
}


def by_type(t):
    return Series.fitted(t.events, ["event_type"], "ts", "event_id")


def long_kernels():
    return {k: W.KERNELS[k] for k in (*BASIC, "skew", "kurt", "median", "rank")} | {"q90": W.quantile_kernel(0.9)}


query("b_w4_rolling_long_frames", sql(body(LONG_STATISTICS, 20), LONG_FRAME))(
    lambda t: out(W.rolling(rows(t), by_type(t), "v", 500, long_kernels(), min_periods=20), *LONG_STATISTICS)
)
query("b_w4_rolling_time_quantile_rank", sql(body({k: LONG_STATISTICS[k] for k in ("median", "q90", "rank", "min", "max", "std")}, 2), f"(PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 86400000000 MICROSECOND PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"))(
    lambda t: out(W.rolling_time(rows(t), ["event_type"], "ts", "v", "1 day", {k: f for k, f in long_kernels().items() if k in ("median", "q90", "rank", "min", "max", "std")}, closed="left", min_periods=2), "median", "q90", "rank", "min", "max", "std")
)
ROLL8 = f"({O} ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)"
query("b_w5_rolling_skew_kurt", sql(body({"skew": "skewness(v) OVER w", "kurt": "kurtosis(v) OVER w"}, 4), ROLL8))(
    lambda t: out(W.rolling(rows(t), series(t), "v", 8, {k: W.KERNELS[k] for k in ("skew", "kurt")}, min_periods=4), "skew", "kurt")
)
query("b_w6_rolling_cov_corr", f"WITH {X} SELECT event_id, CASE WHEN count(*) OVER w >= 5 THEN round(covar_samp(value, u) OVER w, 6) END AS cov, CASE WHEN count(*) OVER w >= 5 THEN round(corr(value, u) OVER w, 6) END AS corr FROM x WINDOW w AS {ROLL}")(
    lambda t: out(W.rolling_pair(rows(t), series(t), "value", "u", 5), "cov", "corr")
)
for _shape in ("triang", "hamming", "gaussian"):
    _w = W.window_weights(_shape, 5, 1.5)
    _lags = [f"lag(value, {4 - i}) OVER ({O})" for i in range(5)]
    _sum = " + ".join(f"{w!r} * {x}" for w, x in zip(_w, _lags))
    _mean = f"(({_sum}) / {sum(_w)!r})"
    _var = "(" + " + ".join(f"{w!r} * pow(a{i} - m, 2)" for i, w in enumerate(_w)) + f") * 5 / (4 * {sum(_w)!r})"
    _cols = ", ".join(f"{x} AS a{i}" for i, x in enumerate(_lags))
    query(f"b_w7_rolling_weighted_{_shape}", f"WITH {X}, y AS (SELECT event_id, {_cols}, {_sum} AS s, {_mean} AS m FROM x) SELECT event_id, round(s, 6) AS wsum, round(m, 6) AS wmean, round({_var}, 6) AS wvar FROM y")(
        lambda t, w=tuple(_w): out(W.rolling_weighted(rows(t), series(t), "value", list(w)), "wsum", "wmean", "wvar")
    )
query("b_w8_rolling_own_function", f"WITH {X} SELECT event_id, CASE WHEN count(*) OVER w >= 5 THEN round(max(value) OVER w - min(value) OVER w, 6) END AS spread FROM x WINDOW w AS {ROLL}")(
    lambda t: out(W.rolling_apply(rows(t), series(t), "value", 5, lambda s: float(s.max() - s.min()), "spread"), "spread")
)
EXP = f"({O} ROWS UNBOUNDED PRECEDING)"
EXPANDING = {**BASIC, "sem": "stddev_samp(v) OVER w / sqrt(count(v) OVER w - 1)"}
query("b_w9_expanding", sql(", ".join((f"{e} AS {k}" if k == "count" else f"{least(2, e)} AS {k}") for k, e in EXPANDING.items()), EXP))(
    lambda t: out(W.expanding(rows(t), series(t), "v", list(EXPANDING), min_periods=2), *EXPANDING)
)
query("b_w9_expanding_skew_kurt", sql(body({"skew": "skewness(v) OVER w", "kurt": "kurtosis(v) OVER w"}, 5), EXP).replace(", 6) END", ", 5) END"))(
    lambda t: out(W.expanding(rows(t), series(t), "v", ["skew", "kurt"], min_periods=5), "skew", "kurt", digits=5)
)
query("b_w9_expanding_cov_corr", f"WITH {X} SELECT event_id, round(covar_samp(value, u) OVER w, 6) AS cov, CASE WHEN count(*) OVER w > 1 THEN round(corr(value, u) OVER w, 6) END AS corr FROM x WINDOW w AS {EXP}")(
    lambda t: out(W.expanding_pair(rows(t), series(t), "value", "u"), "cov", "corr")
)
DAYS = "d AS (SELECT user_id, CAST(ts AS DATE) AS day, round(sum(value), 4) AS total FROM events GROUP BY 1, 2)"
DRANK = "len(list_filter(list(total) OVER w, lambda e: e < total)) + (len(list_filter(list(total) OVER w, lambda e: e = total)) + 1) / 2.0"
query(
    "b_w9_expanding_median_quantile_rank",
    f"WITH {DAYS} SELECT user_id, day, round(quantile_cont(total, 0.5) OVER w, 6) AS median, round(quantile_cont(total, 0.9) OVER w, 6) AS q90, {DRANK} AS rank FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)",
)(
    lambda t: W.expanding_order_statistics(
        t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.round(F.sum("value"), 4).alias("total")),
        ["user_id"], "day", "total", {"median": W.KERNELS["median"], "q90": W.quantile_kernel(0.9), "rank": W.KERNELS["rank"]},
    ).select("user_id", "day", F.round("median", 6).alias("median"), F.round("q90", 6).alias("q90"), "rank")
)
SO_FAR = {"median": "quantile_cont(v, 0.5) OVER w", "q90": "quantile_cont(v, 0.9) OVER w", "rank": RANK}
for _key in ("user_id", "event_type"):
    query(f"b_w9_expanding_quantiles_of_rows_by_{_key.split('_')[0]}", sql(body(SO_FAR, 2), f"(PARTITION BY {_key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"))(
        lambda t, k=_key: out(W.expanding_quantiles(rows(t), Series.fitted(t.events, [k], "ts", "event_id"), "v", {"median": 0.5, "q90": 0.9}, rank="rank", min_periods=2), *SO_FAR)
    )

# Exponentially weighted.  The SQL sums the weights of all earlier rows directly.


def pairs(extra="", where="p.v IS NOT NULL", decay="pow(1 - {a}, c.n - p.n)", alpha=0.3):
    w = decay.format(a=alpha)
    return f"""WITH {X}, n AS (SELECT *, row_number() OVER ({O}) AS n, count(v) OVER ({O} ROWS UNBOUNDED PRECEDING) AS k FROM x),
p AS (SELECT c.event_id, c.k AS k, sum({w}) AS s0, sum({w} * p.v) AS s1, sum({w} * p.v * p.v) AS s2, sum({w} * {w}) AS ww,
  sum({w} * p.u) AS su, sum({w} * p.u * p.u) AS suu, sum({w} * p.v * p.u) AS svu
  FROM n c JOIN n p ON p.user_id = c.user_id AND p.n <= c.n AND p.v IS NOT NULL GROUP BY ALL)"""


ALL_ROWS = " FROM events LEFT JOIN p USING (event_id)"
# At a NULL row the sums have decayed alike, so ratios repeat the last result.
query("b_w10_ewm_mean", pairs() + " SELECT event_id, round(s1 / s0, 6) AS mean" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["mean"], alpha=0.3), "mean")
)
query("b_w10_ewm_mean_span", pairs(alpha=2 / 11) + " SELECT event_id, round(s1 / s0, 6) AS mean" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["mean"], alpha=W.decay_rate(span=10)), "mean")
)
query("b_w10_ewm_mean_ignore_na", pairs(decay="pow(1 - {a}, c.k - p.k)") + " SELECT event_id, round(s1 / s0, 6) AS mean" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["mean"], alpha=0.3, ignore_na=True), "mean")
)
query("b_w10_ewm_var_std", pairs() + " SELECT event_id, CASE WHEN k > 1 THEN round((s2 / s0 - pow(s1 / s0, 2)) * s0 * s0 / (s0 * s0 - ww), 5) END AS var, CASE WHEN k > 1 THEN round(sqrt(greatest(0, (s2 / s0 - pow(s1 / s0, 2)) * s0 * s0 / (s0 * s0 - ww))), 5) END AS std" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["var", "std"], alpha=0.3), "var", "std", digits=5)
)
query("b_w10_ewm_cov_corr", pairs() + " SELECT event_id, CASE WHEN k > 1 THEN round((svu / s0 - s1 / s0 * su / s0) * s0 * s0 / (s0 * s0 - ww), 5) END AS cov, CASE WHEN k > 1 THEN round((svu / s0 - s1 / s0 * su / s0) / CASE WHEN least(s2 / s0 - pow(s1 / s0, 2), suu / s0 - pow(su / s0, 2)) > 1e-9 THEN sqrt((s2 / s0 - pow(s1 / s0, 2)) * (suu / s0 - pow(su / s0, 2))) END, 5) END AS corr" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["cov", "corr"], alpha=0.3, other="u"), "cov", "corr", digits=5)
)
query("b_w10_ewm_sum", pairs().replace("p.v", "p.value") + " SELECT event_id, round(s1, 5) AS sum" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "value", ["sum"], alpha=0.3), "sum", digits=5)
)
query("b_w10_ewm_mean_by_time", pairs(decay="pow(0.5, (epoch_us(c.ts) - epoch_us(p.ts)) / 172800000000.0)") + " SELECT event_id, round(s1 / s0, 6) AS mean" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["mean"], halflife_time="2 days", ts="ts"), "mean")
)
query(
    "b_w10_ewm_mean_recursive",
    f"""WITH RECURSIVE {X}, n AS (SELECT user_id, event_id, value, row_number() OVER ({O}) AS n FROM x),
r AS (SELECT user_id, event_id, n, value AS m FROM n WHERE n = 1 UNION ALL
  SELECT n.user_id, n.event_id, n.n, 0.7 * r.m + 0.3 * n.value FROM r JOIN n ON n.user_id = r.user_id AND n.n = r.n + 1)
SELECT event_id, round(m, 6) AS mean FROM r""",
)(lambda t: out(W.ewm(rows(t), series(t), "value", ["mean"], alpha=0.3, adjust=False), "mean"))
query(
    "b_w10_ewm_mean_recursive_gaps",
    f"""WITH RECURSIVE {X}, q AS (SELECT *, row_number() OVER ({O}) AS n FROM x),
n AS (SELECT *, n - lag(n) OVER (PARTITION BY user_id ORDER BY n) AS k, row_number() OVER (PARTITION BY user_id ORDER BY n) AS i FROM q WHERE v IS NOT NULL),
r AS (SELECT user_id, event_id, n, i, v AS m FROM n WHERE i = 1 UNION ALL
  SELECT n.user_id, n.event_id, n.n, n.i, (pow(0.7, n.k) * r.m + 0.3 * n.v) / (pow(0.7, n.k) + 0.3) FROM r JOIN n ON n.user_id = r.user_id AND n.i = r.i + 1)
SELECT q.event_id, round(last_value(r.m IGNORE NULLS) OVER (PARTITION BY q.user_id ORDER BY q.n ROWS UNBOUNDED PRECEDING), 6) AS mean FROM q LEFT JOIN r USING (event_id)""",
)(lambda t: out(W.ewm(rows(t), series(t), "v", ["mean"], alpha=0.3, adjust=False), "mean"))

# Cumulative results and neighbours
CUM = {"cumsum": ("sum", "sum(v) OVER w"), "cummin": ("min", "min(v) OVER w"), "cummax": ("max", "max(v) OVER w")}
for _name, (_kind, _e) in CUM.items():
    query(f"b_a23_{_name}", sql(f"CASE WHEN v IS NOT NULL THEN round({_e}, 4) END AS {_name}", EXP))(
        lambda t, n=_name, k=_kind: out(W.cumulative(rows(t), series(t), "v", {n: k}), n, digits=4)
    )
query("b_a23_cumprod", f"SELECT event_id, round(product(1 + value / 10000) OVER ({O} ROWS UNBOUNDED PRECEDING), 8) AS cumprod FROM events")(
    lambda t: out(W.cumulative(t.events.withColumn("f", 1 + F.col("value") / 10000), series(t), "f", {"cumprod": "product"}), "cumprod", digits=8)
)
query("b_a23_cumcount", f"SELECT event_id, row_number() OVER ({O}) - 1 AS cumcount FROM events")(
    lambda t: position(rows(t), series(t), "p").select("event_id", (F.col("p") - 1).alias("cumcount"))
)
query("b_a23_shift", f"SELECT event_id, lag(value, 2, -1) OVER ({O}) AS back, lead(value, 1) OVER ({O}) AS ahead FROM (SELECT event_id, user_id, ts, value / 7.919 AS value FROM events)")(
    lambda t: W.shifts(rows(t), series(t), {"back": ("value", 2, -1.0), "ahead": ("value", -1)}).select("event_id", "back", "ahead")
)
query("b_a23_diff", f"WITH {X} SELECT event_id, round(v - lag(v, 2) OVER ({O}), 6) AS diff FROM x")(lambda t: out(W.difference(rows(t), series(t), "v", 2), "diff"))
query("b_a23_pct_change", f"SELECT event_id, round(value / lag(value) OVER ({O}) - 1, 6) AS pct_change FROM events")(
    lambda t: out(W.percent_change(rows(t), series(t), "value"), "pct_change")
)
RK = "PARTITION BY event_type ORDER BY q"
RANKED = "(SELECT event_id, event_type, floor(value) AS q, CASE WHEN event_id % 5 <> 0 THEN floor(value) END AS g FROM events)"
RANKS = {
    "average": f"rank() OVER ({RK}) + (count(*) OVER (PARTITION BY event_type, q) - 1) / 2.0",
    "min": f"rank() OVER ({RK})",
    "max": f"rank() OVER ({RK}) + count(*) OVER (PARTITION BY event_type, q) - 1",
    "dense": f"dense_rank() OVER ({RK})",
    "first": f"row_number() OVER ({RK}, event_id)",
}


def ranked(t):
    return t.events.selectExpr("event_id", "event_type", "floor(value) AS q", "CASE WHEN event_id % 5 <> 0 THEN floor(value) END AS g")


for _m, _e in RANKS.items():
    query(f"b_w14_rank_{_m}", f"SELECT event_id, CAST({_e} AS DOUBLE) AS rank FROM {RANKED}")(
        lambda t, m=_m: R.ranks(ranked(t), ["event_type"], "q", method=m, ties=["event_id"]).select("event_id", "rank")
    )
query("b_w14_rank_descending_pct", f"SELECT event_id, round(rank() OVER (PARTITION BY event_type ORDER BY q DESC) / count(*) OVER (PARTITION BY event_type), 10) AS rank FROM {RANKED}")(
    lambda t: R.ranks(ranked(t), ["event_type"], "q", method="min", ascending=False, pct=True).select("event_id", F.round("rank", 10).alias("rank"))
)
query("b_w14_rank_nulls_keep", f"SELECT event_id, CASE WHEN g IS NOT NULL THEN CAST(rank() OVER (PARTITION BY event_type ORDER BY g NULLS LAST) AS DOUBLE) END AS rank FROM {RANKED}")(
    lambda t: R.ranks(ranked(t), ["event_type"], "g", method="min").select("event_id", "rank")
)
for _nulls, _pos in [("top", "FIRST"), ("bottom", "LAST")]:
    query(f"b_w14_rank_nulls_{_nulls}", f"SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY g NULLS {_pos}) + (count(*) OVER (PARTITION BY event_type, g) - 1) / 2.0 AS rank FROM {RANKED}")(
        lambda t, n=_nulls: R.ranks(ranked(t), ["event_type"], "g", nulls=n).select("event_id", "rank")
    )
NUMBERED = f"(SELECT event_id, row_number() OVER ({O}) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z FROM events)"
query("b_w15_group_head", f"SELECT event_id FROM {NUMBERED} WHERE a <= 3")(lambda t: W.head(rows(t), series(t), 3).select("event_id"))
query("b_w15_group_tail", f"SELECT event_id FROM {NUMBERED} WHERE z <= 2")(lambda t: W.tail(rows(t), series(t), 2).select("event_id"))
query("b_w15_group_head_negative", f"SELECT event_id FROM {NUMBERED} WHERE z > 4")(lambda t: W.head(rows(t), series(t), -4).select("event_id"))
query("b_w15_group_slice", f"SELECT event_id FROM {NUMBERED} WHERE a - 1 >= 2 AND a - 1 < 11 AND (a - 3) % 3 = 0")(
    lambda t: W.rows_between(rows(t), series(t), 2, 11, 3).select("event_id")
)
query("b_w16_autocorrelation", f"SELECT user_id, round(corr(value, p), 8) AS autocorr FROM (SELECT user_id, value, lag(value, 2) OVER ({O}) AS p FROM events) GROUP BY 1")(
    lambda t: W.autocorrelation(rows(t), series(t), "value", 2).withColumn("autocorr", F.round("autocorr", 8))
)
US = "epoch_us(ts)"


def timed(t):
    return rows(t).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


query("b_w17_trapezoid", f"SELECT user_id, round(sum((us - pus) / 3.6e9 * (value + pv) / 2), 6) AS area FROM (SELECT user_id, {US} AS us, lag({US}) OVER ({O}) AS pus, value / 7.919 AS value, lag(value / 7.919) OVER ({O}) AS pv FROM events) GROUP BY 1")(
    lambda t: W.trapezoid(timed(t), series(t), "us", "value").withColumn("area", F.round(F.col("area") / 3.6e9, 6))
)
query(
    "b_w17_gradient",
    f"""WITH {X}, d AS (SELECT event_id, value AS y, lag(value) OVER ({O}) AS a, lead(value) OVER ({O}) AS b, (epoch_us(ts) - epoch_us(lag(ts) OVER ({O}))) / 3.6e9 AS hs, (epoch_us(lead(ts) OVER ({O})) - epoch_us(ts)) / 3.6e9 AS hd FROM x)
SELECT event_id, round(CASE WHEN hs IS NULL THEN (b - y) / hd WHEN hd IS NULL THEN (y - a) / hs ELSE (hd * ((y - a) / hs) + hs * ((b - y) / hd)) / (hs + hd) END, 5) AS gradient FROM d""",
)(lambda t: W.gradient(timed(t), series(t), "us", "value").select("event_id", F.round(F.col("gradient") * 3.6e9, 5).alias("gradient")))
# Text, dates, and a value that most rows share.
for _name, _col in (("text", "o_orderpriority"), ("date", "CAST(o_orderdate AS DATE)"), ("shared_value", "CASE WHEN o_orderkey % 10 < 8 THEN 'common' ELSE o_orderpriority END")):
    query(f"b_w14_rank_{_name}", f"SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY v, o_orderkey) AS DOUBLE) AS rank, CAST(dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY v) AS DOUBLE) AS dense FROM (SELECT *, {_col} AS v FROM orders)")(
        lambda t, c=_col: R.ranks(
            R.ranks(t.orders.selectExpr("o_orderkey", "o_orderstatus", f"{c} AS v"), ["o_orderstatus"], "v", method="first", ties=["o_orderkey"]), ["o_orderstatus"], "v", "dense", method="dense"
        ).select("o_orderkey", "rank", "dense")
    )
query("b_w10_ewm_alpha_one", "SELECT event_id, round(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS mean FROM (SELECT *, CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM events)")(
    lambda t: out(W.ewm(t.events.selectExpr("event_id", "user_id", "ts", "CASE WHEN event_id % 4 <> 0 THEN value END AS v"), series(t), "v", ["mean"], alpha=1.0), "mean")
)
query("b_w10_ewm_mean_long_halflife", pairs(decay="pow(0.5, (epoch_us(c.ts) - epoch_us(p.ts)) / (86400000000.0 * 400))") + " SELECT event_id, round(s1 / s0, 6) AS mean" + ALL_ROWS)(
    lambda t: out(W.ewm(rows(t), series(t), "v", ["mean"], halflife_time="400 days", ts="ts"), "mean")
)
query(
    "b_w10_ewm_recursive_long_gaps",
    f"""WITH RECURSIVE q AS (SELECT event_id, CASE WHEN event_id % 1201 < 2 THEN value / 7.919 END AS v, row_number() OVER (ORDER BY ts, event_id) AS n FROM events),
n AS (SELECT *, n - lag(n) OVER (ORDER BY n) AS k, row_number() OVER (ORDER BY n) AS i FROM q WHERE v IS NOT NULL),
r AS (SELECT event_id, n, i, v AS m FROM n WHERE i = 1 UNION ALL SELECT n.event_id, n.n, n.i, (pow(0.5, n.k) * r.m + 0.5 * n.v) / (pow(0.5, n.k) + 0.5) FROM r JOIN n ON n.i = r.i + 1)
SELECT q.event_id, round(last_value(r.m IGNORE NULLS) OVER (ORDER BY q.n ROWS UNBOUNDED PRECEDING), 6) AS mean FROM q LEFT JOIN r USING (event_id)""",
)(
    lambda t: out(
        W.ewm(t.events.selectExpr("event_id", "0 AS k", "ts", "CASE WHEN event_id % 1201 < 2 THEN value / 7.919 END AS v"), Series.fitted(t.events.selectExpr("0 AS k", "ts"), ["k"], "ts", "event_id"), "v", ["mean"], alpha=0.5, adjust=False), "mean"
    )
)
