"""Each rule of the stay history on hand-written logs."""

from datetime import date, datetime

import pytest

from wardflow.plans.census import daily_census, distinct_census
from wardflow.plans.discharges import discharges
from wardflow.plans.history import (
    build_history, drop_interim_by_anti_join, drop_interim_discharges, grouped_starts, keep_discharges_after_a_start,
    keep_discharges_by_semi_join,
)
from wardflow.sources.adapter import lookup

AS_OF = datetime(2024, 2, 1, 10, 30, 15, 500000)
LOG = "casefile_id string, first_name string, last_name string, program_name string, start_date timestamp_ntz, logged_at timestamp_ntz"
STATE = "casefile_id string, discharge_date timestamp_ntz, discharge_type_code string"
TYPES = [
    ("detox", "In", "Detox", "Program", "x"), ("res", "In", "Residential", "Program", "x"), ("iop", "Out", "SUD IOP", "Program", "x"),
    ("out", "In", "Discharge", "Discharge", "x"), ("hold", "Administrative", "Hold", "Program", "x"), ("blank", None, "Blank", "Program", "x"),
]


def day(d, h=8):
    return datetime(2024, 1, d, h)


@pytest.fixture(scope="module")
def types(spark):
    return lookup(spark, ["program", "program_level", "program_category", "program_class", "program_location"], TYPES)


def stays(spark, types, entries, discharge=None):
    log = spark.createDataFrame([("c", "A", "B", p, s, s) for p, s in entries], LOG)
    state = spark.createDataFrame([("c", discharge, None)], STATE)
    rows = build_history(log, types, state, as_of=AS_OF).orderBy("ph_version").collect()
    return [r.asDict() for r in rows]


def test_program_starts_are_grouped_to_the_first_and_discharges_to_the_last(spark, types):
    rows = stays(spark, types, [("detox", day(1)), ("detox", day(3)), ("out", day(5)), ("out", day(7))])
    assert [(r["program_category"], r["start_date"]) for r in rows] == [("Detox", day(1)), ("Discharge", day(7))]
    assert rows[0]["end_date"] == day(7) and rows[0]["discharged"] == 1


def test_administrative_unknown_and_unlevelled_programs_vanish(spark, types):
    rows = stays(spark, types, [("hold", day(1)), ("nowhere", day(2)), ("blank", day(2)), ("res", day(3))])
    assert [r["program_category"] for r in rows] == ["Residential"]


def test_discharge_needs_an_earlier_start_at_its_level(spark, types):
    assert [r["program_class"] for r in stays(spark, types, [("out", day(1)), ("detox", day(2))])] == ["Program"]
    assert [r["program_class"] for r in stays(spark, types, [("iop", day(1)), ("out", day(2))])] == ["Program"]
    # Equal times are not earlier.
    assert [r["program_class"] for r in stays(spark, types, [("detox", day(2)), ("out", day(2))])] == ["Program"]


@pytest.mark.parametrize("restart, kept", [(datetime(2024, 1, 6, 8), 1), (datetime(2024, 1, 6, 8, 0, 1), 2), (datetime(2024, 1, 5, 8), 1)])
def test_restart_within_a_day_removes_the_discharge(spark, types, restart, kept):
    rows = stays(spark, types, [("detox", day(1)), ("out", day(5)), ("iop", restart)])
    assert sum(r["program_class"] == "Discharge" for r in rows) == kept - 1


def test_end_at_discharge_before_the_next_start(spark, types):
    rows = stays(spark, types, [("detox", day(1)), ("res", day(10))], discharge=day(6))
    assert rows[0]["end_date"] == day(6) and rows[0]["discharged"] == 1 and rows[0]["transferred_out"] == 0
    # The later stay starts after the discharge: inverted, no measures, but it is a row.
    assert rows[1]["end_date"] == day(6) and rows[1]["admission"] == 0 and rows[1]["transferred_in"] == 0
    assert rows[1]["total_versions"] == 2


def test_last_discharge_row_ends_at_the_earlier_of_its_dates(spark, types):
    assert stays(spark, types, [("detox", day(1)), ("out", day(5))], discharge=day(9))[1]["end_date"] == day(5)
    assert stays(spark, types, [("detox", day(1)), ("out", day(5))], discharge=day(3))[1]["end_date"] == day(3)
    assert stays(spark, types, [("detox", day(1)), ("out", day(5))])[1]["end_date"] == day(5)


def test_last_program_ends_at_discharge_or_as_of(spark, types):
    ended = stays(spark, types, [("detox", day(1))], discharge=day(4))[0]
    assert (ended["end_date"], ended["is_active"], ended["discharged"]) == (day(4), 0, 1)
    assert (ended["days_in_program"], ended["hours_in_program"]) == (3, 72)
    active = stays(spark, types, [("detox", day(1))])[0]
    assert (active["end_date"], active["is_active"], active["discharged"]) == (datetime(2024, 2, 1, 10, 30, 15), 1, 0)


def test_transfers_between_programs(spark, types):
    a, b = stays(spark, types, [("detox", day(1)), ("res", day(5, 20))])
    assert (a["transferred_out"], a["transferred_in"], a["end_date"]) == (1, 0, day(5, 20))
    assert (b["transferred_out"], b["transferred_in"]) == (0, 1)
    assert a["hours_in_program"] == 108 and a["days_in_program"] == 4


def test_window_and_join_forms_agree(spark, types):
    log = spark.createDataFrame(
        [(f"c{i % 7}", "A", "B", ["detox", "res", "iop", "out"][i % 4], day(1 + i % 27, i % 24), day(1 + i % 27)) for i in range(120)], LOG
    )
    state = spark.createDataFrame([(f"c{i}", day(20), None) for i in range(7)], STATE)
    rows = grouped_starts(log, types, state)
    kept = keep_discharges_after_a_start(rows)
    assert sorted(map(str, kept.collect())) == sorted(map(str, keep_discharges_by_semi_join(rows).select(*kept.columns).collect()))
    left = drop_interim_discharges(kept)
    assert sorted(map(str, left.collect())) == sorted(map(str, drop_interim_by_anti_join(kept).select(*left.columns).collect()))


def test_census_counts_nights_and_a_case_once(spark, types):
    log = spark.createDataFrame(
        [("a", "A", "B", "detox", day(1), day(1)), ("a", "A", "C", "detox", day(3), day(3)), ("b", "A", "B", "detox", day(2), day(2))], LOG
    )
    # Case a is logged under two names, so it has two overlapping stays in one program.
    state = spark.createDataFrame([("a", day(5), None), ("b", day(2, 20), None)], STATE)
    hist = build_history(log, types, state, as_of=AS_OF)
    span = dict(start=date(2024, 1, 1), end=date(2024, 1, 31))
    census = {r["census_date"].day: r["census"] for r in daily_census(hist, **span).collect()}
    assert census == {1: 1, 2: 1, 3: 1, 4: 1}  # the day of leaving and the same-day stay do not count
    assert census == {r["census_date"].day: r["census"] for r in distinct_census(hist, **span).collect()}


def test_flow_on_a_day_without_census_is_kept_only_on_request(spark, types):
    log = spark.createDataFrame([("a", "A", "B", "detox", day(1), day(1))], LOG)
    state = spark.createDataFrame([("a", day(3), None)], STATE)
    hist = build_history(log, types, state, as_of=AS_OF)
    span = dict(start=date(2024, 1, 1), end=date(2024, 1, 31))
    assert {r["census_date"].day for r in daily_census(hist, **span).collect()} == {1, 2}
    rows = {r["census_date"].day: r for r in daily_census(hist, **span, keep_flow_only_days=True).collect()}
    assert rows[3]["census"] == 0 and rows[3]["discharges"] == 1


def test_spine_cuts_stays(spark, types):
    log = spark.createDataFrame([("a", "A", "B", "detox", datetime(2023, 12, 1), day(1))], LOG)
    hist = build_history(log, types, spark.createDataFrame([("a", None, None)], STATE), as_of=AS_OF)
    rows = daily_census(hist, start=date(2024, 1, 1), end=date(2024, 1, 10)).collect()
    assert len(rows) == 10 and all(r["census"] == 1 and r["admissions"] == 0 for r in rows)


def test_discharge_class_precedence(spark, types):
    cases = ["ama", "adm", "both", "none", "typed", "nocode"]
    log = spark.createDataFrame([(c, "A", None, "detox", day(1), day(1)) for c in cases], LOG)
    codes = {"ama": "T1", "adm": "T1", "both": "T1", "none": "T3", "typed": "T1"}
    state = spark.createDataFrame([(c, day(4), codes.get(c)) for c in cases], STATE)
    kinds = lookup(spark, ["discharge_type_code", "discharge_type", "discharge_class"], [("T1", "x", "Administrative"), ("T3", "x", None)])
    ama = spark.createDataFrame([("ama",), ("ama",), ("both",)], "casefile_id string")
    adm = spark.createDataFrame([("adm",), ("both",)], "casefile_id string")
    rows = discharges(build_history(log, types, state, as_of=AS_OF), state, kinds, ama, adm).collect()
    assert {r["casefile_id"]: r["discharge_class"] for r in rows} == {
        "ama": "AMA", "adm": "Admin", "both": "AMA", "none": "Successful", "typed": "Administrative", "nocode": "Successful",
    }
    assert {r["full_name"] for r in rows} == {"A "}


def test_history_properties_on_given_tables(spark):
    from pyspark.sql import functions as F

    from wardflow.queries import QUERIES

    rows = QUERIES["a_v1_program_history"](spark, "/root/testdata/sf0.01").cache()
    figures = rows.agg(
        F.sum("admission").alias("adm"), F.sum("transferred_out").alias("out"), F.sum("transferred_in").alias("in"), F.sum("discharged").alias("dis"),
        F.sum("is_active").alias("active"), F.count(F.lit(1)).alias("n"), F.count_if(F.expr("start_date >= end_date")).alias("inverted"),
    ).first()
    assert figures.asDict() == {"adm": 1764, "out": 1287, "in": 1287, "dis": 453, "active": 24, "n": 2186, "inverted": 393}
    per_case = rows.groupBy("casefile_id").agg(F.max("ph_version").alias("m"), F.count_distinct("ph_version").alias("d"), F.max("total_versions").alias("t"))
    assert per_case.filter("m <> d OR m <> t").isEmpty()
    census = QUERIES["a_v2_daily_census"](spark, "/root/testdata/sf0.01")
    assert census.agg(F.count(F.lit(1)), F.sum("census")).first() == (124, 3602)
    rows.unpersist()
