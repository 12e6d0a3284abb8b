"""Ordered operators on a table in which one key holds most rows, cut into many small
pieces, against pandas."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardflow.operators import aggregates as A, joins as J, missing as M, ranks as R, resample as S, sets as X, windows as W
from wardflow.operators.ordered import Series, position


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 900
    key = np.where(rng.random(n) < 0.6, 1, rng.integers(2, 9, n))
    at = [datetime(2024, 1, 1) + timedelta(seconds=int(s)) for s in np.sort(rng.choice(20 * 86400, n, replace=False))]
    v = np.round(rng.normal(50, 20, n), 3)
    gap = rng.random(n) < 0.3
    return pd.DataFrame({"id": np.arange(n), "k": key, "ts": at, "v": np.where(gap, np.nan, v), "w": rng.normal(5, 2, n)})


@pytest.fixture(scope="module")
def rows(spark, table):
    df = spark.createDataFrame(table.astype({"ts": "datetime64[us]"})).selectExpr(
        "id", "CASE WHEN k = 8 THEN NULL ELSE k END AS k", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "nanvl(v, NULL) AS v", "w"
    )
    return df.repartition(7).cache()


def series():
    return Series.by_time(["k"], "ts", "id", width="6 hours")


def values(df, *cols):
    out = df.select("id", *cols).toPandas().sort_values("id")
    return [out[c].astype(float).to_numpy() for c in cols]


def same(a, b, **kw):
    np.testing.assert_allclose(np.asarray(a, float), np.asarray(b, float), rtol=1e-9, atol=1e-9, **kw)


def test_position_counts_rows_of_a_key_with_null_as_a_key(rows, table):
    same(values(position(rows, series(), "p"), "p")[0], table.groupby("k").cumcount() + 1)


@pytest.mark.parametrize("n, center", [(3, False), (10, False), (5, True), (40, False)])
def test_rolling_rows_across_blocks(rows, table, n, center):
    got = values(W.rolling(rows, series(), "v", n, {k: W.KERNELS[k] for k in ("sum", "mean", "var", "median")}, min_periods=2, center=center, block=16), "sum", "mean", "var", "median")
    roll = table.groupby("k")["v"].rolling(n, min_periods=2, center=center)
    for mine, theirs in zip(got, (roll.sum(), roll.mean(), roll.var(), roll.median())):
        same(mine, theirs.reset_index(0, drop=True).sort_index())


@pytest.mark.parametrize("closed", ["right", "left", "both", "neither"])
def test_rolling_time_across_blocks(rows, table, closed):
    kernels = {k: W.KERNELS[k] for k in ("sum", "count")}
    got = values(W.rolling_time(rows, ["k"], "ts", "v", "9 hours", kernels, closed=closed, width="1 hour"), "sum", "count")
    roll = table.set_index("ts").groupby("k")["v"].rolling("9h", closed=closed)
    order = table.sort_values(["k", "ts"])["id"].to_numpy()
    same(got[0], pd.Series(roll.sum().to_numpy(), index=order).sort_index())
    count = pd.Series(roll.count().to_numpy(), index=order).sort_index()
    same(np.nan_to_num(got[1]), np.nan_to_num(count))


def test_expanding_and_cumulative(rows, table):
    kinds = ["sum", "mean", "min", "max", "var", "std", "sem", "skew", "kurt"]
    got = values(W.expanding(rows, series(), "v", kinds, min_periods=4), *kinds)
    for kind, mine in zip(kinds, got):
        roll = table.groupby("k")["v"].expanding(min_periods=4)
        same(mine, getattr(roll, kind)().reset_index(0, drop=True).sort_index())
    same(values(W.cumulative(rows, series(), "v", {"c": "sum"}), "c")[0], table.groupby("k")["v"].cumsum())


@pytest.mark.parametrize(
    "options", [dict(alpha=0.3), dict(alpha=0.9), dict(alpha=0.05, ignore_na=True), dict(alpha=0.4, adjust=False), dict(alpha=0.4, adjust=False, ignore_na=True), dict(alpha=0.5, min_periods=5)]
)
def test_ewm_mean(rows, table, options):
    got = values(W.ewm(rows, series(), "v", ["mean"], **options), "mean")[0]
    same(got, table.groupby("k")["v"].transform(lambda s: s.ewm(**{"min_periods": 1, **options}).mean()))


@pytest.mark.parametrize("options", [dict(alpha=0.3), dict(alpha=0.2, bias=True), dict(alpha=0.2, adjust=False, ignore_na=True)])
def test_ewm_second_moments(rows, table, options):
    pandas = {k: v for k, v in options.items() if k != "bias"}
    bias = options.get("bias", False)
    got = values(W.ewm(rows, series(), "v", ["var", "std"], **options), "var", "std")
    var = table.groupby("k")["v"].transform(lambda s: s.ewm(**pandas).var(bias=bias))
    # The first value has no spread; pandas gives 0 for the biased form, we do too.
    np.testing.assert_allclose(got[0], var, rtol=1e-7, atol=1e-7)
    np.testing.assert_allclose(got[1], np.sqrt(var), rtol=1e-6, atol=1e-6)
    cov, corr = values(W.ewm(rows, series(), "v", ["cov", "corr"], other="w", **options), "cov", "corr")
    want = pd.concat([g["v"].ewm(**pandas).cov(g["w"], bias=bias) for _, g in table.groupby("k")]).sort_index()
    np.testing.assert_allclose(cov, want, rtol=1e-7, atol=1e-7)
    want = pd.concat([g["v"].ewm(**pandas).corr(g["w"]) for _, g in table.groupby("k")]).sort_index()
    np.testing.assert_allclose(corr, want, rtol=1e-6, atol=1e-6)


def test_ewm_by_time(rows, table):
    got = values(W.ewm(rows, series(), "v", ["mean"], halflife_time="3 hours", ts="ts"), "mean")[0]
    want = pd.concat([g["v"].ewm(halflife="3h", times=g["ts"]).mean() for _, g in table.groupby("k")]).sort_index()
    same(got, want)


@pytest.mark.parametrize("n", [1, 3, -2])
def test_shift_across_blocks(rows, table, n):
    same(values(W.shift(rows, series(), "w", n, "s", block=8), "s")[0], table.groupby("k")["w"].shift(n))


@pytest.mark.parametrize("options", [dict(), dict(limit=1), dict(backward=True), dict(backward=True, limit=2)])
def test_fill(rows, table, options):
    got = values(M.fill(rows, series(), "v", **options), "v")[0]
    g = table.groupby("k")["v"]
    same(got, g.bfill(options.get("limit")) if options.get("backward") else g.ffill(options.get("limit")))


@pytest.mark.parametrize("direction", ["forward", "backward", "both"])
@pytest.mark.parametrize("limit, area", [(None, None), (1, None), (2, "inside")])
def test_interpolate(rows, table, direction, limit, area):
    got = values(M.interpolate(rows, series(), "v", "x", limit=limit, direction=direction, area=area), "x")[0]
    same(got, table.groupby("k")["v"].transform(lambda s: s.interpolate(limit=limit, limit_direction=direction, limit_area=area)))


@pytest.mark.parametrize("method", ["average", "min", "max", "dense", "first"])
@pytest.mark.parametrize("nulls", ["keep", "top", "bottom"])
def test_ranks(rows, table, method, nulls):
    if method == "first" and nulls != "keep":
        pytest.skip("ties between NULLs have no order of their own")
    got = values(R.ranks(rows.withColumn("r", F.round("v", -1)), ["k"], "r", "x", method=method, nulls=nulls, ties=["id"]), "x")[0]
    same(got, table.assign(r=table["v"].round(-1)).groupby("k")["r"].rank(method=method, na_option=nulls))


@pytest.mark.parametrize("mode", ["linear", "lower", "higher", "nearest", "midpoint"])
def test_quantiles(rows, table, mode):
    got = R.quantiles(rows, ["k"], "v", {"a": 0.1, "b": 0.73}, interpolation=mode).toPandas().sort_values("k", na_position="last")
    groups = [g.dropna() for _, g in table.groupby("k")["v"]]
    for name, q in (("a", 0.1), ("b", 0.73)):
        same(got[name], [np.quantile(g, q, method=mode) for g in groups])


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, "2 hours"])
def test_asof_join(spark, table, direction, exact, tolerance):
    left = table[["id", "k", "ts"]].assign(ts=table["ts"].dt.floor("h"))
    right = table[["k", "ts", "w"]].assign(ts=table["ts"].dt.floor("3h")).drop_duplicates(["k", "ts"])
    tol = {} if tolerance is None else {"tolerance": pd.Timedelta(tolerance)}
    want = pd.merge_asof(left.sort_values(["ts", "id"]), right.sort_values("ts"), on="ts", by="k", direction=direction, allow_exact_matches=exact, **tol)

    def to_spark(pdf):
        return spark.createDataFrame(pdf.astype({"ts": "datetime64[us]"})).withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    got = J.asof_join(to_spark(left), to_spark(right), on="ts", by=["k"], columns=["w"], direction=direction, exact=exact, tolerance=tolerance)
    same(values(got, "w")[0], want.sort_values("id")["w"])


def test_top_rows_and_samples_of_a_hot_group(rows, table):
    got = W.head(rows, series(), 4).select("id").toPandas()["id"]
    assert sorted(got) == sorted(table.groupby("k").head(4)["id"])
    got = W.tail(rows, series(), 3).select("id").toPandas()["id"]
    assert sorted(got) == sorted(table.groupby("k").tail(3)["id"])
    sample = X.sample_by_group(rows, ["k"], 20, ["id"], "s").groupBy("k").count().toPandas()
    assert (sample["count"] == 20).all()


def test_sample_is_the_same_in_any_partitioning(rows):
    one = X.sample_n(rows, 50, ["id"], "seed").select("id").toPandas()["id"]
    two = X.sample_n(rows.repartition(3, "w"), 50, ["id"], "seed").select("id").toPandas()["id"]
    assert sorted(one) == sorted(two)


def test_sessions(rows, table):
    got = S.sessions(rows, ts="ts", by=["k"], gap="5 hours").toPandas()
    fresh = table.groupby("k")["ts"].diff().ge("5h") | table.groupby("k").cumcount().eq(0)
    want = table.assign(s=fresh.groupby(table["k"]).cumsum()).groupby(["k", "s"])["ts"].agg(["min", "max", "count"])
    assert sorted(got["n"]) == sorted(want["count"])
    assert sorted(got["start"]) == sorted(want["min"])


def test_own_function_sees_bounded_batches(spark):
    df = spark.range(50_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k", "CAST(id AS DOUBLE) AS v")

    def partial(pdf):
        assert len(pdf) <= 10_000
        return {"s": pdf["v"].sum(), "n": len(pdf)}

    out = A.apply_groups(df, ["k"], partial, "s double, n long", [F.sum("s").alias("s"), F.sum("n").alias("n")])
    want = df.groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("closed", ["right", "left", "both", "neither"])
def test_rolling_time_sums_agree_with_frames(rows, closed):
    frames = values(W.rolling_time(rows, ["k"], "ts", "v", "9 hours", {k: W.KERNELS[k] for k in ("sum", "count")}, closed=closed), "sum", "count")
    linear = values(W.rolling_time_sums(rows, series(), "ts", "v", "9 hours", closed=closed), "sum", "count")
    same(linear[0], frames[0])
    same(linear[1], frames[1])


def test_buckets_are_narrowed_for_a_busy_key(rows):
    narrow = Series.fitted(rows, ["k"], "ts", "id", rows=10, width="5 days")
    sizes = rows.groupBy("k", narrow.bucket.alias("b")).count().agg(F.max("count")).first()[0]
    assert sizes <= 10
    wide = Series.fitted(rows, ["k"], "ts", "id", width="5 days")
    assert rows.select(wide.bucket.alias("b")).distinct().count() <= 6


def test_many_value_buckets(rows, table):
    got = R.quantiles(rows, ["k"], "v", {"a": 0.31}).toPandas().sort_values("k", na_position="last")
    same(got["a"], table.groupby("k")["v"].quantile(0.31))


@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize("n", [0, 1, 700, 2999, 3000, 5000])
def test_sample_size_is_cut_in_cells(spark, monkeypatch, weight, n):
    monkeypatch.setattr(X, "CELLS", 4)
    monkeypatch.setattr(X, "LAST_ROWS", 5)
    df = spark.range(3000).selectExpr("id", "CAST(1 + id % 1000 AS DOUBLE) AS w")
    got = {r["id"] for r in X.sample_n(df, n, ["id"], "s", weight=weight).collect()}
    u = X.uniform(["id"], "s")
    score = u if weight is None else -F.log1p(-u) / F.col("w")
    assert got == {r["id"] for r in df.orderBy(score, "id").limit(n).collect()}
