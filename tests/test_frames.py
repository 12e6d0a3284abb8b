"""Frames put together from pieces, against the plain frame; raw expanding quantiles against numpy."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardflow.operators import windows as W
from wardflow.operators.frames import Wavelet, folded, moments
from wardflow.operators.ordered import Series

T0 = dt.datetime(2024, 1, 1)
ROWS = "k int, id long, ts timestamp_ntz, v double, note string"


def table(spark, values, keys=1, minutes=1):
    rows = [(i % keys, i, T0 + dt.timedelta(minutes=minutes * (i // keys)), v, f"n{i}") for i, v in enumerate(values)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["k", "id", "ts", "v", "note"]).assign(v=[r[3] for r in rows]), ROWS) if not any(v is None for v in values) else spark.createDataFrame(rows, ROWS)


def series():
    return Series.by_time(["k"], "ts", "id", width="1 hour")


def test_pieces_of_frames():
    rng = np.random.default_rng(1)
    v = rng.normal(size=257).round(1)
    a = rng.integers(0, 257, 900)
    b = np.minimum(257, a + rng.integers(1, 90, 900))
    total, (mean, m2, m3, m4) = folded(v, a, b, np.add), moments(v, a, b)
    tree = Wavelet(v)
    low = tree.smallest(a, b, np.zeros(900, np.int64))
    for i in range(900):
        x = v[a[i] : b[i]]
        assert (total[i], mean[i], low[i]) == pytest.approx((x.sum(), x.mean(), x.min()))
        assert [m2[i], m3[i], m4[i]] == pytest.approx([((x - x.mean()) ** p).sum() for p in (2, 3, 4)], abs=1e-8)


def same(got, want):
    got, want = np.array(got, float), np.array(want, float)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9, equal_nan=True), [(i, x, y) for i, (x, y) in enumerate(zip(got, want)) if not np.isclose(x, y, rtol=1e-9, equal_nan=True)][:5]


NAMES = ("sum", "mean", "min", "max", "count", "var", "std", "sem", "skew", "kurt")


@pytest.mark.parametrize("center, forward", [(False, False), (True, False), (False, True)])
def test_long_row_frames_agree_with_plain_frames(spark, center, forward):
    rng = np.random.default_rng(2)
    values = [None if i % 11 == 0 else float(x) for i, x in enumerate(rng.normal(size=700).round(2))]
    kernels = {n: W.KERNELS[n] for n in NAMES}
    df = table(spark, values, keys=2)
    plain = {n: lambda c, w, f=k.over: f(c, w) for n, k in kernels.items()}
    results = [W.rolling(df, series(), "v", 90, k, min_periods=3, center=center, forward=forward, block=128).orderBy("id").toPandas() for k in (kernels, plain)]
    assert list(results[0].columns) == list(results[1].columns)
    for n in NAMES:
        same(results[0][n], results[1][n])


def test_a_huge_value_and_a_nan_are_felt_by_their_own_frames_alone(spark):
    values = [1e17, *[1.0] * 150, float("nan"), *[2.0] * 150]
    df = table(spark, values, minutes=60)
    rows = W.rolling(df, series(), "v", 80, {n: W.KERNELS[n] for n in ("sum", "var", "max")}, block=64).orderBy("id").toPandas()
    assert rows["sum"][80:151].tolist() == [80.0] * 71 and rows["var"][80:151].tolist() == [0.0] * 71
    assert rows["sum"][151:231].isna().all() and rows["sum"][231:].tolist() == [160.0] * 71
    times = W.rolling_time(df, ["k"], "ts", "v", "2 hours", {n: W.KERNELS[n] for n in ("sum", "std")}).orderBy("id").toPandas()
    sums = W.rolling_time_sums(df, series(), "ts", "v", "2 hours").orderBy("id").toPandas()
    for got in (times["sum"], sums["sum"]):
        assert got[:4].tolist() == [1e17, 1e17 + 1, 2.0, 2.0]
        assert np.isnan(got[151]) and np.isnan(got[152]) and got[153] == 4.0
    assert times["std"][3] == 0.0


@pytest.mark.parametrize("closed", list(W.CLOSED))
@pytest.mark.parametrize("span", ["7 minutes", "1 hour"])
def test_time_frames_agree_with_plain_frames(spark, closed, span):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 2)), i, T0 + dt.timedelta(minutes=int(rng.integers(0, 400))), None if i % 9 == 0 else float(round(x, 2)), "") for i, x in enumerate(rng.normal(size=500))]
    df = spark.createDataFrame(rows, ROWS)
    kernels = {n: W.KERNELS[n] for n in (*NAMES, "median", "rank")}
    plain = {n: lambda c, w, f=k.over: f(c, w) for n, k in kernels.items()}
    one, other = (W.rolling_time(df, ["k"], "ts", "v", span, k, closed=closed, width="2 hours").orderBy("id").toPandas() for k in (kernels, plain))
    for n in kernels:
        same(one[n], other[n])
    sums = W.rolling_time_sums(df, series(), "ts", "v", span, closed=closed).orderBy("id").toPandas()
    for n in ("count", "sum", "mean", "min", "max"):
        same(sums[n], other[n].where(other["count"] > 0))


def test_frames_of_ten_thousand_rows(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(size=30_000).round(2)
    df = table(spark, list(map(float, values)))
    got = W.rolling(df, series(), "v", 10_000, {"median": W.KERNELS["median"], "q90": W.quantile_kernel(0.9), "rank": W.KERNELS["rank"], "sum": W.KERNELS["sum"]}, min_periods=5, block=8192).orderBy("id").toPandas()
    frame = pd.Series(values).rolling(10_000, min_periods=5)
    for name, want in (("median", frame.median()), ("q90", frame.quantile(0.9)), ("rank", frame.rank()), ("sum", frame.sum())):
        assert np.allclose(got[name], want, atol=1e-6, equal_nan=True)


def test_whole_numbers_stay_whole(spark):
    big = 2**60
    df = spark.createDataFrame([(1, i, T0 + dt.timedelta(minutes=i), big + i) for i in range(100)], "k int, id long, ts timestamp_ntz, v long")
    got = W.rolling(df, series(), "v", 70, {n: W.KERNELS[n] for n in ("max", "count")}, min_periods=1).orderBy("id").collect()
    assert [(r["max"], r["count"]) for r in got] == [(big + i, min(i + 1, 70)) for i in range(100)]
    assert dict(W.rolling(df, series(), "v", 70, {"sum": W.KERNELS["sum"]}).dtypes)["sum"] == "bigint"


def test_expanding_quantiles_of_raw_rows(spark, monkeypatch):
    """A third of the rows have one key; no window partition outgrows its block."""
    rng = np.random.default_rng(5)
    rows = [(0 if i % 3 == 0 else int(rng.integers(1, 9)) if i % 50 else None, i, T0 + dt.timedelta(minutes=int(rng.integers(0, 3000))), None if i % 13 == 0 else float(rng.integers(0, 300)), "") for i in range(1500)]
    df = spark.createDataFrame(rows, ROWS)
    sizes, plain = [], W.running

    def watched(frame, along, what, **more):
        if "_node" in along.by:
            sizes.append(frame.groupBy(*along.by, along.bucket.alias("_b")).count().agg(F.max("count")).first()[0])
        return plain(frame, along, what, **more)

    monkeypatch.setattr(W, "running", watched)
    got = W.expanding_quantiles(df, series(), "v", {"median": 0.5, "q95": 0.95, "least": 0.0}, rank="rank", min_periods=2, block=64)
    frame = pd.DataFrame(rows, columns=["k", "id", "ts", "v", "note"]).sort_values(["ts", "id"])
    frame["k"] = frame["k"].fillna(-1)
    so_far = frame.groupby("k")["v"].expanding(2)
    want = pd.DataFrame({"median": so_far.median(), "q95": so_far.quantile(0.95), "least": so_far.min(), "rank": so_far.rank()}).reset_index(level=0, drop=True).sort_index()
    have = got.orderBy("id").toPandas().set_index("id")
    assert len(sizes) == 2 and max(sizes) <= 64 * 7
    for name in ("median", "q95", "least"):
        assert np.allclose(have[name], want[name], equal_nan=True)
    assert np.allclose(have["rank"], want["rank"].where(frame["v"].notna()).sort_index(), equal_nan=True)


@pytest.mark.parametrize("kind", ["double", "long", "decimal(12,2)"])
def test_expanding_quantiles_write_a_row_once(spark, monkeypatch, kind):
    """Long keys, a value that most rows of one share, NaN and NULL keys; what is written on the way does not grow with the number of quantiles."""
    rng = np.random.default_rng(6)
    rows = [(None if i % 3 == 0 else 1 if i % 3 == 1 else int(rng.integers(2, 40)), i, T0 + dt.timedelta(minutes=int(rng.integers(0, 3000))), None if i % 11 == 0 else 7.0 if i % 3 == 0 and i % 4 else float(rng.integers(-90, 90)), "") for i in range(3000)]
    rows = [(*r[:3], float("nan") if kind == "double" and r[1] % 97 == 5 and r[3] is not None else r[3], r[4]) for r in rows]
    df = spark.createDataFrame(rows, ROWS).withColumn("v", F.col("v").cast(kind))
    written, plain = [], W.settle
    monkeypatch.setattr(W, "settle", lambda frame: written.append((out := plain(frame)).count()) or out)
    got = W.expanding_quantiles(df, series(), "v", {"median": 0.5, "q95": 0.95, "least": 0.0}, rank="rank", min_periods=2, block=700).orderBy("id").collect()
    assert sum(written) < 1.5 * len(rows)
    seen = {}
    want = {}
    for k, i, _, v, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        own = seen.setdefault(k, [])
        own += [] if v is None else [math.inf if math.isnan(v) else v]
        if len(own) < 2:
            want[i] = (None,) * 4
            continue
        x = math.inf if v is not None and math.isnan(v) else v
        order, found = sorted(own), []
        for q in (0.5, 0.95, 0.0):
            spot = (len(order) - 1) * q
            low, up = order[math.floor(spot)], order[math.ceil(spot)]
            found.append(low if low == up else low + (up - low) * (spot - math.floor(spot)))
        want[i] = (*found, None if v is None else sum(o < x for o in own) + (own.count(x) + 1) / 2)
    for r in got:
        have = [math.inf if c is not None and math.isnan(c) else c for c in (r["median"], r["q95"], r["least"], r["rank"])]
        assert have == pytest.approx(list(want[r["id"]]), nan_ok=True), r


def test_expanding_quantiles_without_values(spark):
    df = table(spark, [None, None])
    assert [tuple(r) for r in W.expanding_quantiles(df, series(), "v", {"median": 0.5}, rank="rank").select("median", "rank").collect()] == [(None, None)] * 2
    assert W.expanding_quantiles(df.filter("k > 5"), series(), "v", {"median": 0.5}).isEmpty()


def test_a_long_gap_does_not_divide_by_zero(spark):
    df = table(spark, [3.0, *[None] * 1200, 5.0, None, 6.0])
    got = [r["mean"] for r in W.ewm(df, series(), "v", ["mean"], alpha=0.5, adjust=False).orderBy("id").collect()]
    assert got[1200] == 3.0 and got[1201] == pytest.approx(5.0)
    assert got[-1] == pytest.approx((0.25 * 5 + 0.5 * 6) / 0.75)
