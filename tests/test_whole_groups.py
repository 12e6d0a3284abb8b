"""Functions of whole groups, searches with operators, tables of pages, intervals of all lengths."""

import datetime as dt
import time
import tracemalloc

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardflow.functions.html_tables import tables
from wardflow.functions.text import html_grid
from wardflow.operators import aggregates as A, joins as J, query as Q


def test_a_group_larger_than_a_batch_is_streamed(spark):
    """Three quarters of the rows have one key; what is held does not grow with it."""
    df = spark.range(240_000).selectExpr("CASE WHEN id % 4 = 0 THEN id % 7 END AS k", "id AS at", "id % 1000 AS v", "repeat('x', 100) AS ballast")

    def run(key, batches):
        tracemalloc.start()
        before, rises, rows, most = None, 0, 0, 0
        for pdf in batches:
            most, rows = max(most, len(pdf)), rows + len(pdf)
            steps = pd.concat([pd.Series([before] if before is not None else [], dtype="float"), pdf["v"].astype(float)])
            rises += int((steps.diff() > 0).sum())
            before = pdf["v"].iloc[-1]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        yield pd.DataFrame({"rows": [rows], "rises": [rises], "most": [most], "peak": [peak]})

    got = {r["k"]: r for r in A.apply_whole_groups(df, ["k"], ["at"], run, "rows long, rises long, most long, peak long").collect()}
    want = df.toPandas()
    assert set(got) == {None, *range(7)}
    for k, r in got.items():
        part = want[want["k"].isna()] if k is None else want[want["k"] == k]
        assert (r["rows"], r["rises"]) == (len(part), int((part["v"].diff() > 0).sum()))
    assert got[None]["rows"] == 180_000 and got[None]["most"] <= 10_000
    # Its peak is that of a few batches: 180,000 rows with their ballast take over 30 MB.
    assert got[None]["peak"] < 12_000_000


def test_a_group_function_may_stop_early_or_give_many_rows(spark):
    df = spark.range(30_000).selectExpr("id % 3 AS k", "id AS at")
    first = A.apply_whole_groups(df, ["k"], ["at"], lambda key, batches: next(batches)[["at"]].head(1), "at long")
    assert sorted(map(tuple, first.collect())) == [(0, 0), (1, 1), (2, 2)]
    same = A.apply_whole_groups(df, ["k"], ["at"], lambda key, batches: (b[["at"]] for b in batches), "at long")
    assert same.count() == 30_000 and same.exceptAll(df.select("k", "at")).isEmpty()
    assert A.apply_whole_groups(df.filter("k > 5"), ["k"], ["at"], lambda key, batches: next(batches), "at long").isEmpty()


@pytest.mark.parametrize(
    "text, hits",
    [
        ("cat", [0, 1, 2]), ("!cat", [3, 4]), ("cat & dog | bird", [0, 3]), ("cat & (dog | bird)", [0]), ("!cat & bird", [3]), ("!(cat | bird)", [4]),
        ("fat <-> cat", [1]), ("fat <2> cat", [2]), ("fat <0> fat", [1, 2]), ("(fat | big) <-> cat", [0, 1]), ("big <-> cat <-> dog", [0]), ("big <-> (cat <-> dog)", [0]), ("!fat <-> cat", [0, 2]),
        ("cat <-> !dog", [1, 2]), ("ca:*", [0, 1, 2]), ("fa:* <-> c:*", [1]), ("CAT & Dog", [0]), ("!!bird", [3]),
    ],
)
def test_searches_with_operators(spark, text, hits):
    texts = ["A big cat, dog!", "fat CAT", "fat old cat", "bird; catalogue?"[:5], "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert [r["id"] for r in df.filter(Q.search_raw("text", text)).orderBy("id").collect()] == hits


def test_a_search_by_distance_takes_a_step_for_each_word(spark):
    often = "the in the of in of " * 700
    df = spark.createDataFrame([(0, often), (1, often + "the end"), (2, often + "the")], "id long, text string").coalesce(1)
    begun = time.monotonic()
    for text, hits in [("the <-> !(in | of)", [1, 2]), ("!(in | of) <-> the", [0, 1, 2]), ("(the <-> in | of) <3> (in | of) <-> end", []), ("(of | the) <-> !(in | the | of | en:*)", [0, 2])]:
        assert [r["id"] for r in df.filter(Q.search_raw("text", text)).orderBy("id").collect()] == hits
    assert time.monotonic() - begun < 30


@pytest.mark.parametrize(
    "text, hits",
    [
        ("cat dog", [0]), ("cat -dog", [1, 2]), ('"fat cat"', [1]), ('"fat cat', [1]), ("cat -fat or bird", [0, 3]), ('-"old cat" cat', [0, 1]), ("Or bird", [3]), ("bird or", [3]),
        ("-- !! cat", [0, 1, 2]), ("", []), ("or", []), ("-bird", [0, 1, 2, 4]), ("cat,dog", [0]),
    ],
)
def test_searches_as_typed(spark, text, hits):
    texts = ["A big cat, dog!", "fat CAT", "fat old cat", "bird; catalogue?"[:5], "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert [r["id"] for r in Q.TableQuery(df).wfts("text", text).df.orderBy("id").collect()] == hits


@pytest.mark.parametrize("text", ["", "a b", "a &", "(a", "a)", "| a", "a <x> b", "!a <-> !b", "a <-> !"])
def test_searches_that_are_not_understood(text):
    with pytest.raises(ValueError):
        Q.search_raw("text", text)


def grid(page, table=0):
    rows = {}
    for section, row, column, header, text in tables(page)[table].grid():
        rows.setdefault((row, section), {})[column] = text.upper() if header else text
    return [(s, [v[k] for k in sorted(v)]) for (_, s), v in sorted(rows.items())]


def test_tables_as_a_browser_reads_them():
    assert grid("<table><tr><td>a<td>b<tr><td>c</table>") == [("body", ["a", "b"]), ("body", ["c"])]
    assert grid("<TABLE><tr><th>x</th><th>y</th></tr><tr><th>r<td>1 &lt; 2</table>") == [("head", ["X", "Y"]), ("body", ["R", "1 < 2"])]
    # Spans, one beyond the last row.
    assert grid("<table><tr><td rowspan=3>a<td colspan='2'>b<tr><td>c<td>d</table>") == [("body", ["a", "b", "b"]), ("body", ["a", "c", "d"]), ("body", ["a"])]
    assert grid('<table><tr><td>a<td rowspan="2">b<td>c<tr><td>d<td>e</table>') == [("body", ["a", "b", "c"]), ("body", ["d", "b", "e"])]
    assert grid("<table><tr><td rowspan=0>a<td colspan=x>b</table>") == [("body", ["a", "b"])]
    # The foot comes last, wherever it stands; cells without a row open one.
    assert grid("<table><tfoot><tr><td>f<tbody><td>a</td><td>b<thead><tr><td>h</table>") == [("head", ["h"]), ("body", ["a", "b"]), ("foot", ["f"])]
    nested = "<table><tr><td>a<table><tr><td>in</td></tr></table>z<td>b</table><table><tr><td>second"
    assert [t.inside for t in tables(nested)] == [None, 0, None]
    assert grid(nested) == [("body", ["az", "b"])] and grid(nested, 1) == [("body", ["in"])] and grid(nested, 2) == [("body", ["second"])]
    assert grid("<table><caption>no</caption><tr><td> a <br> b<p>c</p>\n d <i title='>'>e</i><!-- <td>x --><script>'<td>'</script></table>") == [("body", ["a b c d e"])]
    assert tables("") == [] and tables("<td>x</td></table>") == [] and grid("<table></table>") == []


def test_grid_keeps_columns_and_skips_pages_without_tables(spark):
    df = spark.createDataFrame([(1, "<table><tr><td>a<td>b</table>"), (2, "no"), (3, None), (None, "<table><tr><th>c")], "id long, html string")
    got = sorted(map(tuple, html_grid(df, "html", ["id"]).collect()), key=str)
    assert got == [(1, 0, None, "body", 0, 0, False, "a"), (1, 0, None, "body", 0, 1, False, "b"), (None, 0, None, "head", 0, 0, True, "c")]


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
def test_intervals_of_seconds_and_of_decades(spark, closed):
    t0 = dt.datetime(1969, 12, 30)
    points = [(i, i % 2 or None, t0 + dt.timedelta(hours=7 * i, seconds=i % 3)) for i in range(120)] + [(500, 1, None)]
    spans = [(i, i % 2 or None, t0 + dt.timedelta(hours=5 * i), t0 + dt.timedelta(hours=5 * i) + [dt.timedelta(0), dt.timedelta(seconds=2), dt.timedelta(days=3), dt.timedelta(days=9000)][i % 4]) for i in range(90)]
    spans += [(900, 1, t0, None), (901, 1, t0 + dt.timedelta(days=2), t0), (902, 1, t0 - dt.timedelta(days=9999), t0 + dt.timedelta(days=9999))]
    p = spark.createDataFrame(points, "pid long, k int, at timestamp_ntz")
    s = spark.createDataFrame(spans, "sid long, k int, low timestamp_ntz, high timestamp_ntz")
    got = {(r["pid"], r["sid"]) for r in J.interval_join(p, s, point="at", low="low", high="high", by=["k"], closed=closed).collect()}
    lower = (lambda a, b: a <= b) if closed in ("left", "both") else (lambda a, b: a < b)
    upper = (lambda a, b: a <= b) if closed in ("right", "both") else (lambda a, b: a < b)
    want = {(i, j) for i, k, at in points for j, m, a, b in spans if k == m and at and b and a <= b and lower(a, at) and upper(at, b)}
    assert got == want and want


def test_an_interval_touches_few_cells(spark, monkeypatch):
    seen = []
    plain = J.join_null_safe
    monkeypatch.setattr(J, "join_null_safe", lambda left, right, keys, how="inner": seen.append((left.count(), right.groupBy("sid").count().agg(F.max("count")).first()[0])) or plain(left, right, keys, how))
    t0 = dt.datetime(2024, 1, 1)
    spans = [(i, t0, t0 + dt.timedelta(microseconds=3**i)) for i in range(34)]
    points = spark.createDataFrame([(1, t0)], "pid long, at timestamp_ntz")
    J.interval_join(points, spark.createDataFrame(spans, "sid long, low timestamp_ntz, high timestamp_ntz"), point="at", low="low", high="high").count()
    assert seen[0][0] <= 32 and seen[0][1] <= 3
