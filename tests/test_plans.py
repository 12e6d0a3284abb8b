"""Shape of the physical plans, with broadcasts off, as for tables beyond the limit."""

import re

import pytest

from wardflow.queries import QUERIES
from wardflow.session import SESSION_SETTINGS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain_plans(spark):
    """Final plans as planned, without adaptive changes and broadcasts."""
    saved = dict(SESSION_SETTINGS)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    SESSION_SETTINGS["spark.sql.adaptive.enabled"] = "false"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString().splitlines()
    SESSION_SETTINGS.update(saved)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def lines(plan, *words):
    return [x for x in plan if any(w in x for w in words)]


@pytest.mark.parametrize(
    "name",
    ["a_v1_program_history", "a_v2_daily_census", "a_v3_discharges", "a_j3_census_range_join", "b_j6_asof_backward", "b_j9_interval_closed_left", "b_j13_key_grid", "b_a23_quantile", "b_r4_crosstab_all", "b_o2_nlargest_all", "b_o3_sample_with_replacement", "b_d6_holiday_calendar_back"],
)
def test_no_pairing_of_everything_with_everything(plain_plans, name):
    assert not lines(plain_plans(name), "Cartesian", "BroadcastNestedLoop")


def test_windows_of_the_history_share_one_exchange(plain_plans):
    plan = plain_plans("a_v1_program_history")
    assert len(lines(plan, " Window [")) >= 3
    by_case = [x for x in plan if re.search(r"Exchange hashpartitioning\(casefile_id#\d+, \d+\)", x)]
    assert len(by_case) == 2  # the log's side and the state's side of their join


def test_a_running_result_shuffles_rows_once_and_joins_nothing(plain_plans):
    plan = plain_plans("b_a23_cumsum")
    assert not lines(plan, "Join")
    # Rows and heads, the bucket summary, and the scan of the summaries.
    assert len(lines(plan, "Exchange")) == 3


def test_first_rows_are_limited_before_the_shuffle(plain_plans):
    plan = plain_plans("b_w15_group_head")
    shuffle = next(i for i, x in enumerate(plan) if "Exchange" in x)
    assert lines(plan[shuffle:], "WindowGroupLimit")


def test_filters_and_columns_reach_the_scan(plain_plans):
    scan = lines(plain_plans("b_o10_truncate"), "FileScan")[0]
    assert "PushedFilters" in scan and "GreaterThanOrEqual(ts" in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in scan


def test_own_function_runs_without_shuffling_rows(plain_plans):
    plan = plain_plans("b_a15_own_group_function")
    python = next(i for i, x in enumerate(plan) if "MapInPandas" in x or "PythonMapInArrow" in x)
    assert not lines(plan[python:], "Exchange")
