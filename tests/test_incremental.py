"""Views kept up to date by pulls: equal to those made anew, and touching only what a pull changes."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardflow import schemas
from wardflow.plans import incremental
from wardflow.plans.census import daily_census
from wardflow.plans.history import build_history
from wardflow.plans.incremental import StoredViews
from wardflow.session import settle
from wardflow.sources import buckets
from wardflow.sources.adapter import AS_OF, SPINE, Tables
from wardflow.sources.buckets import BucketTable

CUTS = (datetime(2024, 1, 8), datetime(2024, 1, 19), AS_OF + timedelta(hours=5))


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def at(when):
    return F.lit(when).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def tables(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    return {"log": settle(t.program_log()), "types": settle(t.program_types()), "latest": {c: settle(t.latest(c) if c < AS_OF else t.latest()) for c in CUTS}}


def test_three_pulls_equal_a_full_refresh(spark, tables, tmp_path, monkeypatch):
    views = StoredViews(spark, str(tmp_path), tables["types"], *SPINE, buckets=8)
    since = datetime(2000, 1, 1)
    for n, until in enumerate(CUTS):
        fresh = tables["log"].filter((F.col("logged_at") >= at(since)) & (F.col("logged_at") < at(until)))
        state = tables["latest"][until]
        if n == 1:  # a refresh that dies before its commit, in another process
            with monkeypatch.context() as m:
                m.setattr(StoredViews, "_patch_census", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    views.refresh(fresh, state.filter(F.col("last_updated_at") >= at(since)), until)
            views = StoredViews(spark, str(tmp_path), tables["types"], *SPINE, buckets=8)
        views.refresh(fresh, state.filter(F.col("last_updated_at") >= at(since)), until)
        whole = build_history(tables["log"].filter(F.col("logged_at") < at(until)), tables["types"], state, as_of=until)
        assert rows(views.history()) == rows(whole)
        assert rows(views.census()) == rows(daily_census(whole, start=SPINE[0], end=SPINE[1]))
        since = until
    # Nothing new, and the clock stands still.
    none = tables["log"].limit(0)
    before = rows(views.census())
    views.refresh(none, state.limit(0), until)
    assert rows(views.census()) == before


def test_a_pull_of_one_case_reads_its_bucket_alone(spark, tables, tmp_path, monkeypatch):
    views = StoredViews(spark, str(tmp_path), tables["types"], *SPINE, buckets=64)
    state = tables["latest"][CUTS[2]]
    case = state.filter("casefile_id LIKE '%:2'").orderBy("casefile_id").first()["casefile_id"]
    early = tables["log"].filter((F.col("casefile_id") != case) | (F.col("logged_at") < at(CUTS[1])))
    views.refresh(early, state, AS_OF)
    asked = []
    plain = BucketTable.read
    monkeypatch.setattr(BucketTable, "read", lambda self, buckets=None, version=None: asked.append((self.folder.rsplit("/", 1)[1], buckets)) or plain(self, buckets, version))
    one = tables["log"].join(early, "program_history_pk", "left_anti").select(*tables["log"].columns)
    assert one.count() > 0
    views.refresh(one, state.limit(0), AS_OF)
    assert {n: len(b) for n, b in asked if n in ("log", "history", "open", "latest") and b} == {"log": 1, "history": 1, "open": 1, "latest": 1}
    listed = {r["bucket"]: r["version"] for r in spark.read.parquet(f"{tmp_path}/history/list/1").collect() if r["bucket"] >= 0}
    assert sum(v == 1 for v in listed.values()) == 1 < len(listed)
    whole = build_history(tables["log"], tables["types"], state, as_of=AS_OF)
    assert rows(views.history()) == rows(whole)
    assert rows(views.census()) == rows(daily_census(whole, start=SPINE[0], end=SPINE[1]))


def made(spark, schema, n, **values):
    return spark.range(n).select(*[F.expr(values.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in schema])


def test_a_pull_adds_its_log_rows_to_those_that_are_there(spark, tables, tmp_path):
    """A refresh writes the new log rows alone."""
    case, day = "concat(id % 7, ':0')", "TIMESTAMP_NTZ'2024-01-02 00:00:00' + make_interval(0, 0, 0, int(id) % 20, int(id))"
    log = made(spark, schemas.PROGRAM_HISTORY, 60, casefile_id=case, program_name="if(id % 3 = 0, 'error', 'view')", start_date=day, logged_at=day, program_history_pk="id")
    state = made(spark, schemas.LATEST, 7, casefile_id=case, last_updated_at=day)
    views, since = StoredViews(spark, str(tmp_path), tables["types"], *SPINE, buckets=4), datetime(2000, 1, 1)
    for n, until in enumerate(CUTS):
        fresh = log.filter((F.col("logged_at") >= at(since)) & (F.col("logged_at") < at(until)))
        views.refresh(fresh, state, AS_OF)
        assert spark.read.parquet(f"{tmp_path}/log/data/{n}").count() == fresh.count() > 0
        since = until
    assert rows(views.read("log")) == rows(log.select(*schemas.PROGRAM_HISTORY.names))
    assert rows(views.history()) == rows(build_history(log, tables["types"], state, as_of=AS_OF))


def test_pieces_of_a_bucket_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "PIECES", 3)
    table = BucketTable(spark, str(tmp_path), spark.range(1).schema, ["id"], 2)
    for n in range(7):
        table.append(spark.range(n * 10, n * 10 + 10))
        assert max(map(len, table._list(table.version)[0].values())) <= 3
    again = BucketTable(spark, str(tmp_path), spark.range(1).schema, ["id"], 2)
    assert again._list(6) == table._list(6) and again.buckets == 2
    again.append(spark.range(60, 70), 6)  # the same version once more
    assert sorted(rows(again.read())) == [(i,) for i in range(70)]
    again.write(again.read().filter("id >= 35"), [0, 1])
    assert sorted(rows(BucketTable(spark, str(tmp_path), spark.range(1).schema, ["id"], 2).read())) == [(i,) for i in range(35, 70)]
