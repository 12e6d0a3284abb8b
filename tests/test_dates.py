"""Calendar rules against pandas' own."""

from datetime import date

import pandas as pd
import pytest
from pandas.tseries import holiday as H
from pandas.tseries import offsets as O
from pyspark.sql import functions as F

from wardflow.functions import dates as D


@pytest.fixture(scope="module")
def days(spark):
    bounds = spark.createDataFrame([(date(2023, 1, 1), date(2025, 1, 15))], "low date, high date")
    return D.date_spine(bounds, "1 day", name="d").withColumn("d", F.col("d").cast("date")).cache()


RULES = ["nearest_workday", "sunday_to_monday", "next_monday", "weekend_to_monday", "next_monday_or_tuesday", "previous_friday", "previous_workday", "next_workday", "before_nearest_workday", "after_nearest_workday"]
OFFSETS = {
    "month_end": (lambda c: D.move_month_end(c, 2), O.MonthEnd(2)),
    "month_end_back": (lambda c: D.move_month_end(c, -1), O.MonthEnd(-1)),
    "month_begin": (lambda c: D.move_month_begin(c, 1), O.MonthBegin(1)),
    "month_begin_back": (lambda c: D.move_month_begin(c, -2), O.MonthBegin(-2)),
    "quarter_begin": (lambda c: D.move_period_begin(c, 1, 3, "QUARTER"), O.QuarterBegin(1, startingMonth=1)),
    "quarter_end": (lambda c: D.move_period_end(c, 2, 3, "QUARTER"), O.QuarterEnd(2, startingMonth=3)),
    "quarter_end_back": (lambda c: D.move_period_end(c, -1, 3, "QUARTER"), O.QuarterEnd(-1, startingMonth=3)),
    "year_begin_back": (lambda c: D.move_period_begin(c, -1, 12, "YEAR"), O.YearBegin(-1)),
    "year_end": (lambda c: D.move_period_end(c, 1, 12, "YEAR"), O.YearEnd(1)),
    "week": (lambda c: D.move_weekday(c, "Wed"), O.Week(weekday=2)),
    "semi_month": (D.semi_month_end, O.SemiMonthEnd()),
    "business": (lambda c: D.move_business_days(c, 7), O.BusinessDay(7)),
}


def test_observances_and_offsets(days):
    cols = [D.observed(F.col("d"), r).alias(r) for r in RULES] + [f(F.col("d")).alias(n) for n, (f, _) in OFFSETS.items()]
    cols += [D.roll(F.col("d")).alias("fwd"), D.roll(F.col("d"), "back").alias("bck")]
    got = days.select("d", *cols).toPandas()
    stamps = pd.to_datetime(got["d"])
    for r in RULES:
        assert (pd.to_datetime(got[r]) == stamps.map(getattr(H, r))).all(), r
    for n, (_, offset) in OFFSETS.items():
        assert (pd.to_datetime(got[n]) == stamps.map(lambda x, o=offset: x + o)).all(), n
    assert (pd.to_datetime(got["fwd"]) == stamps.map(O.BusinessDay().rollforward)).all()
    assert (pd.to_datetime(got["bck"]) == stamps.map(O.BusinessDay().rollback)).all()


def test_federal_holidays(spark):
    bounds = spark.createDataFrame([(date(1985, 1, 1), date(2030, 12, 31))], "low date, high date")
    got = D.holidays(bounds).toPandas()
    want = H.USFederalHolidayCalendar().holidays("1985-01-01", "2030-12-31", return_name=True)
    assert sorted(zip(pd.to_datetime(got["day"]), got["holiday"])) == sorted(zip(want.index, want))


@pytest.mark.parametrize("n", [1, 5, -1, -4, 0])
def test_custom_business_days(spark, days, n):
    closed = spark.createDataFrame([(date(2024, 7, 4),), (date(2024, 12, 25),), (date(2024, 7, 5),)], "day date")
    bounds = spark.createDataFrame([(date(2022, 12, 1), date(2025, 3, 1))], "low date, high date")
    got = D.add_business_days(days, "d", n, D.business_calendar(bounds, closed), "moved").toPandas()
    offset = O.CustomBusinessDay(n, holidays=["2024-07-04", "2024-07-05", "2024-12-25"])
    want = pd.to_datetime(got["d"]).map(lambda x: offset.rollforward(x) if n == 0 else x + offset)
    assert (pd.to_datetime(got["moved"]) == want).all()


def test_fields(days):
    got = days.select("d", *D.date_fields("d", ["day_of_week", "day_of_year", "quarter", "iso_week", "is_quarter_end", "is_leap_year", "days_in_month"])).toPandas()
    s = pd.to_datetime(got["d"]).dt
    for name, want in [("day_of_week", s.dayofweek), ("day_of_year", s.dayofyear), ("quarter", s.quarter), ("iso_week", s.isocalendar().week), ("is_quarter_end", s.is_quarter_end), ("is_leap_year", s.is_leap_year), ("days_in_month", s.days_in_month)]:
        assert (got[name].to_numpy() == want.to_numpy()).all(), name
