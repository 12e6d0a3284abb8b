"""Ingest, merges, corrections, and the whole run."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from wardflow import schemas
from wardflow.functions.dates import duration_micros, localize, parse_time, to_local
from wardflow.functions.records import clean_text, first_item, flatten, split_key
from wardflow.operators import merge as M
from wardflow.operators.merge import delete_from, ignore_into, merge_into, upsert
from wardflow.operators.quality import error_log, split_valid
from wardflow.plans import nightly
from wardflow.queries import ingest as I
from wardflow.sources import landing as L, tables as S
from wardflow.sources.adapter import AS_OF, SPINE, Tables
from wardflow.sources.buckets import BucketTable


def texts(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def test_patients_from_files(spark, tmp_path):
    cases = [
        {"casefile_id": "1:2", "insurances": [{"insurance_company": "A"}, {"insurance_company": "B"}], "created_at": "2024-03-01T08:00:00Z"},
        {"casefile_id": "12", "insurances": [], "created_at": "2024-03-01T08:00:00+00:00"},
        {"casefile_id": "", "insurances": None, "created_at": "2024-03-01 08:00:00"},
        {"casefile_id": "a:b:c", "created_at": "garbage"},
    ]
    for i, page in enumerate([cases[:2], cases[2:]]):
        (tmp_path / f"{i}.json").write_text(json.dumps({"patients": page}, indent=1))
    rows = {r["casefile_id"]: r for r in L.patients(L.read_replies(spark, str(tmp_path))).collect()}
    assert rows["1:2"]["insurance_company"] == "A" and rows["12"]["insurance_company"] is None
    assert (rows["1:2"]["patient_id"], rows["1:2"]["patient_master_id"]) == ("1", "2")
    assert (rows["12"]["patient_id"], rows["12"]["patient_master_id"]) == ("12", None)
    assert rows["a:b:c"]["patient_master_id"] == "b"
    assert rows["1:2"]["created_at"] == rows["12"]["created_at"] == datetime(2024, 3, 1, 1)
    assert rows[""]["created_at"] == datetime(2024, 3, 1, 8) and rows["a:b:c"]["created_at"] is None


def test_pages_take_the_last_key(spark):
    raw = texts(
        spark,
        {"pagination": {"total_pages": 2}, "patient_evaluations": [{"id": 1, "patient_casefile_id": "1:2"}, {"id": 2}]},
        {"pagination": {"total_pages": 2}, "other": [], "forms": [{"id": 3}]},
        {"forms": []},
    )
    assert sorted(r["form_id"] for r in L.forms(raw).collect()) == [1, 2, 3]
    assert sorted(r[0] for r in raw.select(L.page_total(raw)).collect()) == [1, 2, 2]


def test_history_replies_are_checked(spark):
    entry = {"program": "detox", "start_date": "2024-01-01T10:00:00Z", "logged_by": "x", "logged_at": "2024-01-01 11:00:00"}
    raw = texts(
        spark,
        {"patient": {"casefile_id": "1:2", "first_name": "A", "program_history": [entry, {**entry, "program": "res"}]}},
        {"error": "x"},
        {"patient": {"first_name": "A"}},
        {"patient": {"casefile_id": "12", "program_history": [entry]}},
        {"patient": {"casefile_id": "3:4", "program_history": []}},
        "not json",
    )
    rows, bad = L.program_history(raw)
    assert [(r["casefile_id"], r["program_name"], r["last_name"], r["start_date"]) for r in rows.orderBy("program_name").collect()] == [
        ("1:2", "detox", "", datetime(2024, 1, 1, 3)), ("1:2", "res", "", datetime(2024, 1, 1, 3)),
    ]
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["malformed casefile_id", "missing casefile_id", "missing patient", "missing patient", "no program history"]


def test_step_down_answer_belongs_to_its_form(spark):
    """Two forms of one case keep their own answers, and no form's answer is lost."""
    form_rows = L.forms(texts(spark, {"forms": [{"id": i, "patient_casefile_id": "1:2"} for i in (1, 2, 3)]}))
    detail = lambda i, items: {"patient_evaluation": {"id": i, "patient_casefile_id": "1:2", "patient_evaluation_items": items}}
    details = L.step_down_values(
        texts(spark, detail(1, [{"name": "Step Down To", "value": "PHP"}]), detail(2, [{"name": "Other", "value": "x"}]), detail(3, [{"name": "Step Down To", "value": ""}]))
    )
    got = {r["form_id"]: (r["step_down_value"], r["transferred"]) for r in L.detox_forms(form_rows, details).collect()}
    assert got == {1: ("PHP", "Yes"), 2: (None, "No"), 3: (None, "No")}


def test_small_expressions(spark):
    df = spark.createDataFrame([("NA", "1 days 02:03:04.5", "2:30 PM"), ("", "5 h 30 min", "1430"), ("x", "soon", "late")], "a string, b string, c string")
    rows = df.select(clean_text(F.col("a")), duration_micros(F.col("b")), parse_time(F.col("c"))).collect()
    assert [tuple(r) for r in rows] == [(None, 93784500000, 52200), (None, 19800000000, 52200), ("x", None, None)]
    one = spark.range(1)
    items = F.from_json(F.lit('[{"name": "a", "value": null}]'), "array<struct<name: string, value: string>>")
    assert one.select(first_item(items, "a"), first_item(items, "b"), split_key(F.lit("x:y"), 2)).first() == (None, "NA", None)
    assert one.select(to_local(F.lit("2024-07-01T00:00:00Z"))).first()[0] == datetime(2024, 6, 30, 17)
    gap = one.select(localize(F.lit(datetime(2024, 3, 10, 2, 30)).cast("timestamp_ntz"), "America/New_York")).first()[0]
    assert gap == datetime(2024, 3, 10, 7)  # the first time after the gap
    nested = one.select(F.struct(F.lit(1).alias("x"), F.struct(F.lit(2).alias("z")).alias("y")).alias("s"))
    assert flatten(nested).columns == ["s.x", "s.y.z"] and flatten(nested, max_level=1).columns == ["s.x", "s.y"]


def test_upsert_takes_the_last_version_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "id long, v string, other string")
    source = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "in", 1), (None, "lost", 1)], "id long, v string, version int")
    once = M.upsert(target, source, keys=["id"], version=["version"])
    want = [(1, "a", "keep"), (2, "new", "keep"), (3, "in", None)]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, M.upsert(once, source, keys=["id"], version=["version"]).collect())) == want


def test_upsert_can_set_null(spark):
    target = spark.createDataFrame([(1, "a")], "id long, v string")
    source = spark.createDataFrame([(1, None)], "id long, v string")
    assert M.upsert(target, source, keys=["id"]).first()["v"] is None


def test_changed_keys_ignore_unknown_values(spark):
    staged = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("d", "z"), ("e", "q")], "k string, program string")
    current = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("e", None)], "k string, program string")
    got = M.changed_keys(staged, current, key="k", compare="program", columns=["k"])
    assert sorted(r["k"] for r in got.collect()) == ["b", "d"]


def test_new_rows_compare_types_and_nulls(spark):
    """Equal instants in another notation are not new; an empty table makes all rows new."""
    raw = texts(spark, {"patient": {"casefile_id": "1:2", "program_history": [{"program": "p", "start_date": "2024-01-01T10:00:00Z"}]}})
    incoming, _ = L.program_history(raw)
    stored = spark.createDataFrame([("1:2", "1", "2", "", "", "p", datetime(2024, 1, 1, 3), None, None)], schemas.PROGRAM_HISTORY)
    assert M.new_rows(incoming, stored).isEmpty()
    assert M.new_rows(incoming, stored.limit(0)).count() == 1


def test_error_rows_keep_their_own_key(spark):
    df = spark.createDataFrame([(5, -1.0), (6, 1.0)], "form_id long, v double")
    good, bad = split_valid(df, [("negative", F.col("v") < 0)])
    row = error_log(bad, "form_id", "upsert_ama_forms", AS_OF).first()
    assert good.count() == 1 and (row["record_key"], row["error_message"], row["error_time"]) == ("5", "negative", AS_OF)


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(' say "hi"', None)], "a string, b string")
    S.write_csv(df.coalesce(1), str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("part-*") for line in f.read_text().splitlines()]
    assert lines == ['"a","b"', '" say ""hi""","null"']


def test_failed_view_does_not_stop_the_next(spark, tmp_path):
    df = spark.range(3)
    views, status = S.refresh_views(spark, {"a": lambda v: df, "b": lambda v: v["none"], "c": lambda v: v["a"].limit(2)}, str(tmp_path))
    assert [(r["view_name"], r["status"], r["row_count"]) for r in status.orderBy("view_name").collect()] == [("a", "ok", 3), ("b", "failed", None), ("c", "ok", 2)]
    assert set(views) == {"a", "c"}


def test_a_run_reads_history_replies_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(value):
        seen.add(1)
        return value

    patients = [('{"patients": [{"casefile_id": "%d:0", "program": "view"}]}' % i,) for i in range(3)]
    entry = '{"program": "view", "start_date": "2024-01-03T10:00:00Z", "logged_by": "x", "logged_at": "2024-01-03 10:05:00"}'
    replies = [("0:0", '{"patient": {"casefile_id": "0:0", "first_name": "A", "last_name": "B", "program_history": [%s, %s]}}' % (entry, entry.replace("03T", "04T"))), ("1:0", '{"error": "none"}')]
    none = spark.createDataFrame([], "value string")
    landed = {n: none for n in ("ama_forms", "admin_discharge", "detox_forms", "detox_details")} | {
        "patients": spark.createDataFrame(patients, "value string"),
        "program_history": spark.createDataFrame(replies, "casefile_id string, value string").withColumn("value", told.asNondeterministic()("value")),
    }
    t = Tables(spark, "")
    refs = {"program_types": t.program_types(), "discharge_types": t.discharge_types()}
    tables, steps = nightly.run(spark, landed, I.empty_state(t), refs, str(tmp_path), as_of=AS_OF, start=SPINE[0], end=SPINE[1])
    assert seen.value == len(replies)
    assert {r["step"]: r["rows_after"] for r in steps.collect() if r["step"] in ("program_history", "error_log", "latest")} == {"program_history": 2, "error_log": 2, "latest": 3}
    assert sorted(r["error_message"] for r in spark.read.parquet(f"{tmp_path}/error_log").collect()) == ["missing patient", "no reply"]
    assert tables["history"].count() == 1


def test_second_run_changes_nothing(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    refs = {"program_types": t.program_types(), "discharge_types": t.discharge_types()}
    args = dict(as_of=AS_OF, start=SPINE[0], end=SPINE[1])
    first, _ = nightly.run(spark, I.landed(t), I.empty_state(t), refs, str(tmp_path / "one"), **args)
    current = {n: first[n] for n in nightly.TABLE_SCHEMAS}
    second, steps = nightly.run(spark, I.landed(t), current, refs, str(tmp_path / "two"), **args)
    for r in steps.filter("rows_before IS NOT NULL AND step <> 'error_log'").collect():
        assert r["rows_before"] == r["rows_after"] > 0, r
    for name in first:
        assert first[name].exceptAll(second[name]).isEmpty() and second[name].exceptAll(first[name]).isEmpty(), name


def test_pull_keeps_whole_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 9, 23, 59),), (datetime(2024, 1, 10),), (datetime(2024, 1, 20, 23, 59, 59),), (datetime(2024, 1, 21),)], "at timestamp_ntz")
    assert L.updated_between(df, "at", date(2024, 1, 10), date(2024, 1, 20)).count() == 2


def test_a_merge_of_one_key_touches_one_bucket(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("at", T.LongType())])
    table = BucketTable(spark, f"{tmp_path}/t", schema, ["id"], buckets=64)
    table.change(spark.range(5000).selectExpr("id", "'old' AS v", "0L AS at"), lambda _, rows: rows)
    listed = lambda v: {r["bucket"]: r["version"] for r in spark.read.parquet(f"{tmp_path}/t/list/{v}").collect()}
    assert len(listed(0)) == 65
    source = spark.createDataFrame([(7, "new", 1), (7, "newer", 2), (7, "older", 0), (None, "lost", 9)], schema)
    reads = []
    plain = BucketTable.read
    watch = lambda self, buckets=None, version=None: reads.append(buckets) or plain(self, buckets, version)
    BucketTable.read = watch
    try:
        assert merge_into(table, source, version=["at"]) == 1
    finally:
        BucketTable.read = plain
    assert [len(r) for r in reads] == [1]
    assert [b for b, v in listed(1).items() if b >= 0 and v == 1] == reads[0]
    assert merge_into(table, source, version=["at"]) == 2
    rows = {r["id"]: r["v"] for r in table.read().collect()}
    assert len(rows) == 5000 and rows[7] == "newer" and set(rows.values()) == {"old", "newer"}
    delete_from(table, spark.createDataFrame([(7,), (8,)], "id int"))
    ignore_into(table, spark.createDataFrame([(8, "again", 5), (9, "known", 5)], schema), version=["at"])
    rows = {r["id"]: r["v"] for r in table.read().collect()}
    assert len(rows) == 4999 and rows[8] == "again" and rows[9] == "old" and 7 not in rows


def test_equal_versions_pick_the_same_row(spark):
    rows = [(1, f"v{i}", 3) for i in range(40)]
    target = spark.createDataFrame([], "id long, v string")
    picked = {upsert(target, spark.createDataFrame(rows[::step], "id long, v string, at long").repartition(n), keys=["id"], version=["at"]).first()["v"] for n, step in ((1, 1), (7, 1), (3, -1))}
    picked |= {upsert(target, spark.createDataFrame(rows[::step], "id long, v string, at long").repartition(n), keys=["id"]).first()["v"] for n, step in ((5, 1), (2, -1))}
    assert len(picked) == 1
