"""Rules taken from the reference's own tests, beyond what the registered queries reach."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from wardflow.functions import dates as D, text as X
from wardflow.operators import aggregates as A, joins as J, query as Q, reshape as R, sets as S, windows as W
from wardflow.operators.ordered import Series, edges_below
from wardflow.streaming import feeds


def column(spark, values, kind, make):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


DURATIONS = {
    "1 days 02:03:04.5": 93_784_500_000, "5 h 30 min": 19_800_000_000, "1.5 hours": 5_400_000_000, "1.5 days": 129_600_000_000, "-01:00:00": -3_600_000_000, "2 weeks": 1_209_600_000_000,
    "-1 days +01:00:00": -82_800_000_000, "-1 days 2 min 3us": -86_520_000_003, "10ms": 10_000, "00:01": 60_000_000, "": None, "soon": None, "3 days or so": None, "1 day 2": None, "+4 s": 4_000_000,
}


def test_durations(spark):
    assert dict(zip(DURATIONS, column(spark, DURATIONS, "string", D.duration_micros))) == DURATIONS


def test_business_days_from_a_weekend(spark):
    saturday = [dt.date(2024, 3, 2)]
    assert [column(spark, saturday, "date", lambda d, n=n: D.move_business_days(d, n))[0].day for n in (1, 0)] == [4, 4]
    assert column(spark, saturday, "date", lambda d: D.move_business_days(d, -1)) == [dt.date(2024, 3, 1)]


def test_skipped_and_repeated_clock_times(spark):
    skipped, twice = dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30)
    one = lambda v, **how: column(spark, [v], "timestamp_ntz", lambda c: D.localize(c, "America/New_York", **how))[0]
    assert one(skipped) == dt.datetime(2024, 3, 10, 7)
    assert one(skipped, nonexistent="shift_backward") == dt.datetime(2024, 3, 10, 6, 59, 59, 999999)
    assert one(twice) == dt.datetime(2024, 11, 3, 5, 30) and one(twice, ambiguous="second") == dt.datetime(2024, 11, 3, 6, 30)
    assert one(twice, ambiguous="null") is None and one(skipped, nonexistent="null") is None
    for v, how in ((skipped, {"nonexistent": "raise"}), (twice, {"ambiguous": "raise"})):
        with pytest.raises(Exception, match="no such time|shown twice"):
            one(v, **how)


def test_text_rules(spark):
    words = ["12", "12\n", "\u0663", "\u00b2", "x1"]
    assert column(spark, words, "string", lambda c: X.full_match(c, "[0-9]+")) == [True, False, False, False, False]
    assert column(spark, words, "string", lambda c: X.class_tests(c, ["is_digit"])[0]) == [True, False, True, True, False]
    assert column(spark, ["foo-bar o'neil x2y", "ÉCOLE"], "string", X.title) == ["Foo-Bar O'Neil X2Y", "École"]
    assert column(spark, ["Foo-Bar 2X", "FooBar", "foo", "2"], "string", lambda c: X.class_tests(c, ["is_title"])[0]) == [True, False, False, False]
    assert column(spark, ["Straße", "ΣΑΣ"], "string", X.casefold) == ["strasse", "σασ"]


def test_json_members(spark):
    texts = ['{"a": true, "n": 1.50, "s": "x", "o": {"b": false}, "l": [1, 2, 3]}', '{"a": "yes"}']
    for values, found in (({"a": True}, True), ({"a": False}, False), ({"n": 1.5}, True), ({"s": "x", "o": {"b": False}}, True), ({"l": [3, 1]}, True), ({"l": [4]}, False)):
        assert bool(column(spark, texts, "string", lambda c, v=values: Q.json_contains(c, v))[0]) is found
    assert not column(spark, texts, "string", lambda c: Q.json_contains(c, {"a": True}))[1]


@pytest.mark.parametrize("n", [1, 7, 300, 5000])
def test_any_number_of_edges(spark, n):
    edges = [float(2 * i) for i in range(n)]
    rows = spark.range(-3, 2 * n + 3).select(F.col("id").cast("double").alias("v"))
    plan = rows.select(edges_below("v", edges))._jdf.queryExecution().toString()
    assert "Python" not in plan
    got = rows.select("v", edges_below("v", edges).alias("le"), edges_below("v", edges, strict=True).alias("lt")).collect()
    assert all(r["le"] == sum(e <= r["v"] for e in edges) and r["lt"] == sum(e < r["v"] for e in edges) for r in got[:: max(1, n // 50)])


def test_many_categories(spark):
    cells = spark.range(12_000).select((F.col("id") % 3).alias("k"), F.concat(F.lit("c"), "id").alias("c"))
    assert J.grid(cells.select("k"), cells.select("c")).count() == 36_000
    assert R.pivot_long(cells, ["k"], "c", F.count(F.lit(1))).count() == 12_000
    assert R.dummies_long(cells, ["k"], "c").count() == 12_000


def test_a_shared_value_is_cut_by_its_ties(spark):
    rows = spark.range(20_000).select("id", F.lit("same").alias("v")).repartition(8)
    numbered = S.numbered_by_value(rows, "v", ["id"], "place")
    assert numbered.filter("place <> id + 1").isEmpty()


def test_parameters_of_exponential_weights(spark):
    for bad in ({"com": -1}, {"span": 0}, {"halflife": 0}, {"alpha": 0}, {"alpha": 1.5}, {}):
        with pytest.raises(ValueError):
            W.decay_rate(**bad)
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, i + 1), float(i)) for i in range(5)], "k int, ts timestamp_ntz, v double")
    with pytest.raises(ValueError, match="adjust"):
        W.ewm(rows, Series.by_time(["k"], "ts"), "v", ["mean"], halflife_time="1 day", ts="ts", adjust=False)
    assert [r["mean"] for r in W.ewm(rows, Series.by_time(["k"], "ts"), "v", ["mean"], alpha=1.0).orderBy("ts").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_an_old_value_far_larger_than_all_later_ones(spark):
    """The first value outweighs the others although it is many blocks of decay back."""
    values = [1e30, *[1.0] * 99]
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), v) for i, v in enumerate(values)], "k int, ts timestamp_ntz, v double")
    got = [r["mean"] for r in W.ewm(rows, Series.by_time(["k"], "ts"), "v", ["mean"], alpha=0.5).orderBy("ts").collect()]
    weight = total = 0.0
    for v, g in zip(values, got):
        weight, total = weight * 0.5 + 1, total * 0.5 + v
        assert g == pytest.approx(total / weight, rel=1e-9)


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def test_change_feed_goes_on_after_a_restart(spark, tmp_path):
    schema = "id long, v double, event string, sequence long"
    follow = lambda: feeds.follow_changes(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"), SCHEMA, ["id"], "sequence", f"{tmp_path}/job")
    write(spark, f"{tmp_path}/in", "a", [(1, 1.0, "INSERT", 1), (None, 2.0, "INSERT", 2), (3, 3.0, "INSERT", 3)], schema)
    assert follow().count() == 3
    assert follow().count() == 3  # nothing new
    for n in range(3):
        write(spark, f"{tmp_path}/in", f"b{n}", [(None, 5.0 + n, "UPDATE", 10 + n), (3, None, "DELETE", 20 + n)], schema)
        state = {r["id"]: r["v"] for r in follow().collect()}
        assert state == {1: 1.0, None: 5.0 + n}
    assert len([p for p in (tmp_path / "job/state/list").iterdir() if p.is_dir()]) == 2


@pytest.mark.parametrize("alpha, expected", [(0.5, [1.0, 7 / 3, 1.0, 7 / 3]), (1.0, [1.0, 3.0, 1.0, 3.0])])
def test_online_mean_keeps_the_state_of_a_null_key(spark, tmp_path, alpha, expected):
    schema = "k long, ts timestamp_ntz, v double"
    series = Series.by_time(["k"], "ts")
    run = lambda: feeds.online_ewm(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"), series, "v", alpha, f"{tmp_path}/job")
    for n, v in enumerate((1.0, 3.0)):
        write(spark, f"{tmp_path}/in", f"d{n}", [(None, dt.datetime(2024, 1, 1 + n), v), (1, dt.datetime(2024, 1, 1 + n), v)], schema)
        means = run()
    assert [r["mean"] for r in means.orderBy(F.col("k").asc_nulls_first(), "ts").collect()] == pytest.approx(expected)


def test_scratch_is_cleared_when_asked(spark, monkeypatch, tmp_path):
    from wardflow import session

    monkeypatch.setattr(session, "_own_folder", lambda spark, root: f"{tmp_path}/app")
    assert session.settle(spark.range(5)).count() == 5
    assert list(tmp_path.glob("app/*"))
    session.clear_scratch(spark)
    assert not list(tmp_path.glob("app/*"))


def test_correlation_of_values_that_stay_the_same(spark):
    rows = [(i, i % 2, 5.0 if i < 8 else float(i), float(i * i)) for i in range(20)] + [(20, 0, None, 1.0), (21, 2, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, k int, x double, y double").withColumn("ts", F.timestamp_seconds("id").cast("timestamp_ntz"))
    along = Series.by_time(["k"], "ts", "id")
    got = {r["id"]: r for r in W.rolling_pair(df, along, "x", "y", 3).collect()}
    assert got[2]["corr"] is None and got[20]["corr"] is None and got[21]["corr"] is None
    assert math.isnan(got[4]["corr"]) and got[4]["cov"] == 0.0 and math.isnan(got[7]["corr"])
    assert got[19]["corr"] == pytest.approx(np.corrcoef([15, 17, 19], [225, 289, 361])[0, 1])
    grouped = {r["k"]: r for r in df.filter("id < 8 OR k = 2").groupBy("k").agg(A.correlation("x", "y").alias("c"), A.correlation("y", "id").alias("d")).collect()}
    assert math.isnan(grouped[0]["c"]) and grouped[2]["c"] is None and grouped[1]["d"] == pytest.approx(np.corrcoef([1, 9, 25, 49], [1, 3, 5, 7])[0, 1])
    still = W.autocorrelation(df.filter("id < 8"), along, "x", 1).collect()
    assert all(math.isnan(r["autocorr"]) for r in still) and len(still) == 2
