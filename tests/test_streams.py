"""Streams of several files: late rows, changes over batches, carried state."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from wardflow.operators.ordered import Series
from wardflow.sources.buckets import BucketTable
from wardflow.streaming import feeds as S
from wardflow.streaming.references import References

EVENTS = "id long, k long, ts timestamp_ntz, v double"


def write(spark, rows, schema, path, name):
    """One file per batch, in order of time."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/{name}")


def read(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")


def test_late_rows_are_dropped(spark, tmp_path):
    day = datetime(2024, 1, 1)
    write(spark, [(1, 1, day, 1.0), (2, 1, day + timedelta(hours=1), 1.0)], EVENTS, tmp_path, "a")
    write(spark, [(3, 1, day + timedelta(hours=30), 1.0)], EVENTS, tmp_path, "b")
    write(spark, [(6, 1, day + timedelta(hours=31), 1.0)], EVENTS, tmp_path, "c")
    write(spark, [(4, 1, day + timedelta(hours=2), 1.0), (5, 1, day + timedelta(hours=60), 1.0)], EVENTS, tmp_path, "d")
    counts = S.window_counts(read(spark, tmp_path, EVENTS), "ts", ["k"], "12 hours", delay="1 hour")
    got = {r["start"]: r["n"] for r in S.run_to_files(counts, str(tmp_path / "w")).collect()}
    assert got == {day: 2, day + timedelta(hours=24): 2}


def test_change_feed_over_batches(spark, tmp_path):
    schema = "id long, v string, event string, table string, seq long"
    write(spark, [(1, "a", "INSERT", "t", 1), (2, "b", "INSERT", "t", 2), (9, "z", "INSERT", "other", 3)], schema, tmp_path, "a")
    write(spark, [(1, "a2", "UPDATE", "t", 5), (1, "a1", "UPDATE", "t", 4), (2, None, "DELETE", "t", 6), (3, "c", "INSERT", "t", 7)], schema, tmp_path, "b")
    write(spark, [(2, "back", "INSERT", "t", 8)], schema, tmp_path, "c")
    stream = S.listen(read(spark, tmp_path, schema), table="t")
    state = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    got = S.follow_changes(stream, state, ["id"], "seq", str(tmp_path / "w"))
    assert sorted(map(tuple, got.collect())) == [(1, "a2"), (2, "back"), (3, "c")]


def test_repeated_pull_is_ingested_once(spark, tmp_path):
    schema = "form_id long, updated_at timestamp_ntz"
    at = datetime(2024, 1, 1, 12)
    write(spark, [(1, at), (2, at)], schema, tmp_path, "a")
    write(spark, [(2, at), (2, at + timedelta(hours=1)), (3, at)], schema, tmp_path, "b")
    rows = S.run_to_files(S.ingest(read(spark, tmp_path, schema), "form_id", "updated_at"), str(tmp_path / "w"))
    assert sorted(map(tuple, rows.collect())) == [(1, at), (2, at), (2, at + timedelta(hours=1)), (3, at)]


def test_online_ewm_over_batches(spark, tmp_path):
    rows = [(i, i % 3, datetime(2024, 1, 1) + timedelta(hours=i), float((i * 7) % 11)) for i in range(90)]
    for n in range(3):
        write(spark, rows[n * 30 : n * 30 + 30], EVENTS, tmp_path, f"part{n}")
    series = Series.by_time(["k"], "ts", "id")
    got = S.online_ewm(read(spark, tmp_path, EVENTS), series, "v", 0.3, str(tmp_path / "w")).select("id", "mean").toPandas().sort_values("id")
    frame = pd.DataFrame(rows, columns=["id", "k", "ts", "v"])
    want = frame.groupby("k")["v"].transform(lambda s: s.ewm(alpha=0.3).mean())
    pd.testing.assert_series_equal(got["mean"].reset_index(drop=True), want.rename("mean"), rtol=1e-9)


def test_presence_reports_joins_and_leaves(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    write(spark, [(1, 1, t0, 1.0), (2, 1, t0 + timedelta(minutes=20), 1.0), (3, 2, t0 + timedelta(hours=5), 1.0)], EVENTS, tmp_path, "a")
    write(spark, [(4, 1, t0 + timedelta(hours=9), 1.0)], EVENTS, tmp_path, "b")
    write(spark, [(5, 3, t0 + timedelta(hours=20), 1.0)], EVENTS, tmp_path, "c")
    diff = S.presence(read(spark, tmp_path, EVENTS), "ts", "k", "30 minutes", "1 hour")
    got = sorted((r["k"], r["at"].hour, r["change"]) for r in S.run_to_files(diff, str(tmp_path / "w")).collect())
    assert got == [(1, 0, "join"), (1, 0, "leave"), (1, 9, "join"), (1, 9, "leave"), (2, 5, "join"), (2, 5, "leave")]


CHANGE = "id long, v string, event string, seq long"
STATE = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def test_changes_out_of_order(spark, tmp_path):
    batches = [
        [(1, "new", "UPDATE", 5), (2, None, "DELETE", 6), (3, "c", "INSERT", 1), (4, "d2", "UPDATE", 2)],
        [(1, "old", "UPDATE", 3), (2, "late", "INSERT", 4), (3, None, "DELETE", 2), (4, "d1", "INSERT", 1), (None, "n", "INSERT", 1)],
        [(2, "back", "INSERT", 7), (3, "late", "UPDATE", 1), (1, "new", "UPDATE", 5), (1, "other", "UPDATE", 5), (None, "none", "UPDATE", None)],
    ]
    for n, rows in enumerate(batches):
        write(spark, rows, CHANGE, tmp_path, f"{n}")
        got = S.follow_changes(spark.readStream.schema(CHANGE).parquet(f"{tmp_path}/in/*"), STATE, ["id"], "seq", f"{tmp_path}/w", buckets=4)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "new"), (2, "back"), (4, "d2"), (None, "n")]


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    write(spark, [(i, str(i), "INSERT", 1) for i in range(2000)], CHANGE, tmp_path, "a")
    job = lambda: S.follow_changes(spark.readStream.schema(CHANGE).parquet(f"{tmp_path}/in/*"), STATE, ["id"], "seq", f"{tmp_path}/w", buckets=64)
    assert job().count() == 2000
    write(spark, [(i, "x", "UPDATE", 2) for i in range(10)], CHANGE, tmp_path, "b")
    assert job().filter("v = 'x'").count() == 10
    listed = {r["bucket"]: r["version"] for r in spark.read.parquet(f"{tmp_path}/w/state/list/1").collect() if r["bucket"] >= 0}
    assert len(listed) == 64
    assert 0 < sum(v == 1 for v in listed.values()) <= 10
    # What no list names any more is removed, one batch later.
    write(spark, [(0, "y", "UPDATE", 3)], CHANGE, tmp_path, "c")
    assert job().count() == 2000
    kept = list((tmp_path / "w/state/data").glob("*/_bucket=*"))
    assert len(kept) == 64 + 1


def test_online_mean_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    series = Series.by_time(["k"], "ts", "id")
    t0 = datetime(2024, 1, 1)
    write(spark, [(i, i, t0, 1.0) for i in range(500)], EVENTS, tmp_path, "a")
    job = lambda: S.online_ewm(spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in/*"), series, "v", 0.5, f"{tmp_path}/w", buckets=32)
    job()
    write(spark, [(500, 3, t0 + timedelta(hours=1), 4.0)], EVENTS, tmp_path, "b")
    assert job().filter("id = 500").first()["mean"] == (0.5 * 1 + 4) / 1.5
    listed = {r["bucket"]: r["version"] for r in spark.read.parquet(f"{tmp_path}/w/state/list/1").collect() if r["bucket"] >= 0}
    assert sum(v == 1 for v in listed.values()) == 1


def test_a_bucket_table_survives_a_failed_and_a_repeated_change(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())])
    table = BucketTable(spark, f"{tmp_path}/t", schema, ["id"], buckets=8)
    put = lambda t, rows, version=None: t.change(spark.createDataFrame(rows, schema), lambda old, new: old.join(new, "id", "left_anti").unionByName(new), version)
    put(table, [(i, 0) for i in range(50)])
    # A change that wrote its rows and died before its list.
    spark.createDataFrame([(1, 99, 0)], "id long, v long, _bucket int").write.partitionBy("_bucket").parquet(f"{tmp_path}/t/data/1")
    again = BucketTable(spark, f"{tmp_path}/t", schema, ["id"], buckets=3)
    assert (again.version, again.buckets) == (0, 8)
    assert again.read().agg({"v": "sum"}).first()[0] == 0
    for _ in range(2):
        assert put(again, [(1, 7), (100, 8)], version=1) == 1
        assert again.read().count() == 51
        assert {r["id"]: r["v"] for r in again.read(again.hit(spark.createDataFrame([(1,), (100,)], "id int"))).filter("v > 0").collect()} == {1: 7, 100: 8}
    assert put(again, []) == 2
    assert again.read().count() == 51


SIGNS = "k long, ref string, ts timestamp_ntz, gone boolean"


def test_presence_of_a_key_with_two_references(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    at = lambda minutes: t0 + timedelta(minutes=minutes)
    batches = [
        [(1, "phone", at(0), False), (1, "desk", at(10), False), (2, "x", at(0), False)],
        # Late by less than the watermark's delay; the leave of a reference that is not there; a row without a time.
        [(1, "phone", at(15), True), (1, "desk", at(25), False), (3, "z", at(40), True), (1, "desk", None, False)],
        [(1, "phone", at(20), False), (1, "phone", at(20), True), (2, "x", at(200), False), (1, "phone", at(130), False)],
        [(9, "end", at(1000), False)],
    ]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SIGNS).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(SIGNS).parquet(f"{tmp_path}/in/*")
        changes = S.run_to_files(S.reference_presence(stream, "ts", "k", "ref", F.col("gone"), "30 minutes", "1 hour"), f"{tmp_path}/w")
    got = sorted((r["k"], r["ref"], (r["at"] - t0).seconds // 60, r["change"]) for r in changes.collect())
    assert got == [
        (1, "desk", 10, "join"), (1, "desk", 55, "leave"),
        (1, "phone", 0, "join"), (1, "phone", 15, "leave"), (1, "phone", 20, "join"), (1, "phone", 20, "leave"), (1, "phone", 130, "join"), (1, "phone", 160, "leave"),
        (2, "x", 0, "join"), (2, "x", 30, "leave"), (2, "x", 200, "join"), (2, "x", 230, "leave"),
    ]
    keys = sorted((r["k"], (r["at"] - t0).seconds // 60, r["change"]) for r in S.key_presence(changes, "k", "ref").collect())
    assert keys == [(1, 0, "join"), (1, 55, "leave"), (1, 130, "join"), (1, 160, "leave"), (2, 0, "join"), (2, 30, "leave"), (2, 200, "join"), (2, 230, "leave")]


class Kept:
    """State and timers in memory; every call is counted."""

    def __init__(self):
        self.values, self.timers, self.calls = {}, set(), 0

    def getValueState(self, name, schema):
        return KeptState(self, name)

    getListState = getValueState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class KeptState:
    def __init__(self, kept, name):
        self.kept, self.name = kept, name

    def __getattr__(self, method):
        self.kept.calls += 1
        values, name = self.kept.values, self.name
        return {
            "exists": lambda: name in values, "get": lambda: values[name], "update": lambda v: values.update({name: v}), "put": lambda v: values.update({name: v}),
            "appendValue": lambda v: values.setdefault(name, []).append(v), "clear": lambda: values.pop(name, None),
        }[method]


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_references_of_a_bucket_are_worked_on_together():
    rng, timeout = np.random.default_rng(5), 30_000_000
    names = [(k, r) for k in ["9007199254740993", "9007199254740992", None] for r in ["", None, *map(str, range(100))]]
    kept, job, got, events = Kept(), References(timeout), [], []
    job.init(kept)
    for batch in range(6):
        fresh = [(*names[i], int(at), bool(gone)) for i, at, gone in zip(rng.integers(0, len(names), 900), rng.integers(batch * 10**8 + 1, (batch + 1) * 10**8, 900), rng.random(900) < 0.25)]
        events += fresh
        list(job.handleInputRows((0,), iter([pd.DataFrame(fresh[i : i + 400], columns=["presence_key", "presence_ref", "at_us", "leaves"]) for i in (0, 400, 800)]), None))
        mark = (batch + 1) * 100_000 - 20_000
        assert len(kept.timers) == 1
        if min(kept.timers) <= mark:
            kept.timers.clear()
            got += [tuple(r) for out in job.handleExpiredTimer((0,), Clock(mark), None) for r in out.itertuples(index=False)]
    want = []
    for name in names:
        last = None
        for *_, at, gone in sorted((e for e in events if e[:2] == name and e[2] <= mark * 1000), key=lambda e: e[2:]):
            if last is not None and at > last + timeout:
                want.append((*name, "leave", last + timeout))
                last = None
            if gone and last is not None:
                want.append((*name, "leave", at))
            elif not gone and last is None:
                want.append((*name, "join", at))
            last = None if gone else at
        if last is not None and last + timeout <= mark * 1000:
            want.append((*name, "leave", last + timeout))
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 3000
    # Some calls for each batch, whatever the number of references.
    assert kept.calls < 6 * 20


def test_presence_of_a_null_key_leaves_other_keys_alone(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    keys, far = [None, 1, 2, 2**53, 2**53 + 1], t0 + timedelta(days=1)
    for n in range(2):
        rows = [(k, ref, t0 + timedelta(minutes=40 * n + i), False) for i, k in enumerate(keys) for ref in ("a", None)] + [(9, "end", far, False)] * n
        spark.createDataFrame(rows, SIGNS).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(SIGNS).parquet(f"{tmp_path}/in/*")
        changes = S.run_to_files(S.reference_presence(stream, "ts", "k", "ref", F.col("gone"), "30 minutes", "1 hour", buckets=2), f"{tmp_path}/w")
    got = {(r["k"], r["ref"], r["change"], r["at"]) for r in changes.collect()}
    begun = [(k, ref, t0 + timedelta(minutes=40 * n + i)) for n in range(2) for i, k in enumerate(keys) for ref in ("a", None)]
    assert got == {(k, ref, "join", at) for k, ref, at in begun} | {(k, ref, "leave", at + timedelta(minutes=30)) for k, ref, at in begun}
    assert changes.schema["k"].dataType == T.LongType()
