"""Spines, offsets, fields, zones, durations and resampling."""

from pyspark.sql import functions as F

from wardflow.functions import dates as D
from wardflow.operators import missing, resample as R
from wardflow.operators.ordered import Series
from wardflow.queries.registry import query


def bounds(t):
    return t.orders.agg(F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high"))


B = "b AS (SELECT CAST(min(o_orderdate) AS DATE) AS low, CAST(max(o_orderdate) AS DATE) AS high FROM orders)"
SPINE = "SELECT CAST(unnest(generate_series(low, high, INTERVAL {s})) AS DATE) AS d, low, high FROM b"
for _name, _step, _inc, _where in [
    ("days", "1 day", "both", "TRUE"), ("weeks_left", "7 day", "left", "d <> high"), ("months_right", "1 month", "right", "d <> low"), ("quarters_neither", "3 month", "neither", "d <> low AND d <> high"),
]:
    query(f"b_d1_date_spine_{_name}", f"WITH {B} SELECT d FROM ({SPINE.format(s=_step)}) WHERE {_where}")(
        lambda t, s=_step, i=_inc: D.date_spine(bounds(t), s, name="d", inclusive=i).withColumn("d", F.col("d").cast("date"))
    )
query("b_d1_date_spine_periods", f"WITH {B} SELECT CAST(low + INTERVAL 10 DAY * i AS DATE) AS d FROM b, range(20) r(i)")(
    lambda t: D.date_spine(bounds(t), "10 day", name="d", periods=20).withColumn("d", F.col("d").cast("date"))
)
# Holidays, by searching each month for its n-th weekday
HOL = f"""{B}, days AS (SELECT CAST(unnest(generate_series(low - 10, high + 10, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
nth AS (SELECT d, month(d) AS m, isodow(d) AS w, row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS n, d + 7 > last_day(d) AS is_last, year(d) AS y FROM (SELECT CAST(unnest(generate_series(date_trunc('year', low), date_trunc('year', high) + INTERVAL 12 MONTH, INTERVAL 1 DAY)) AS DATE) AS d FROM b)),
fixed AS (SELECT holiday, d, since FROM days JOIN (VALUES ('New Year''s Day', 1, 1, 1), ('Juneteenth National Independence Day', 6, 19, 2021), ('Independence Day', 7, 4, 1), ('Veterans Day', 11, 11, 1), ('Christmas Day', 12, 25, 1)) v(holiday, m, dd, since) ON month(d) = m AND day(d) = dd WHERE year(d) >= since),
hol AS (
  SELECT holiday, CAST(CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END AS DATE) AS day FROM fixed
  UNION ALL SELECT CASE WHEN m = 1 AND n = 3 THEN 'Birthday of Martin Luther King, Jr.' WHEN m = 2 AND n = 3 THEN 'Washington''s Birthday' WHEN m = 5 AND is_last THEN 'Memorial Day' WHEN m = 9 AND n = 1 THEN 'Labor Day' WHEN m = 10 AND n = 2 THEN 'Columbus Day' END AS holiday, d FROM nth WHERE w = 1
  UNION ALL SELECT 'Thanksgiving Day', d FROM nth WHERE w = 4 AND m = 11 AND n = 4),
holidays AS (SELECT holiday, day FROM hol, b WHERE holiday IS NOT NULL AND day BETWEEN low AND high)"""
query("b_d3_federal_holidays", f"WITH {HOL} SELECT * FROM holidays")(lambda t: D.holidays(bounds(t)))
query("b_d2_business_days", f"WITH {HOL} SELECT d AS day FROM days, b WHERE d BETWEEN low AND high AND isodow(d) < 6 AND d NOT IN (SELECT day FROM holidays)")(
    lambda t: D.business_days(bounds(t), D.holidays(bounds(t)))
)
query("b_d2_business_days_weekmask", f"WITH {HOL} SELECT d AS day FROM days, b WHERE d BETWEEN low AND high AND isodow(d) IN (2, 3, 6)")(
    lambda t: D.business_days(bounds(t), weekmask="0110010")
)
query("b_d4_interval_spine", f"WITH {B} SELECT CAST(\"left\" AS DATE) AS \"left\", CAST(\"left\" + INTERVAL 30 DAY AS DATE) AS \"right\" FROM (SELECT unnest(generate_series(low, high, INTERVAL 30 DAY)) AS \"left\", high FROM b) WHERE \"left\" + INTERVAL 30 DAY <= high")(
    lambda t: D.interval_spine(bounds(t), "30 days").select(F.col("left").cast("date").alias("left"), F.col("right").cast("date").alias("right"))
)
query("b_d5_periods", "SELECT DISTINCT date_trunc('quarter', o_orderdate)::DATE AS period_start, (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS period_end, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS label FROM orders")(
    lambda t: t.orders.select(F.to_date("o_orderdate").alias("d")).select(F.trunc("d", "QUARTER").alias("period_start"), D.move_period_end(F.trunc("d", "QUARTER"), 1, 3, "QUARTER").alias("period_end"), F.concat(F.year("d").cast("string"), F.lit("Q"), F.quarter("d").cast("string")).alias("label")).distinct()
)
DD = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"
OFF = {
    "month_end_1": "CAST(CASE WHEN d = last_day(d) THEN last_day(date_trunc('month', d) + INTERVAL 1 MONTH) ELSE last_day(d) END AS DATE)",
    "month_end_back": "CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE)",
    "month_begin_2": "CAST(date_trunc('month', d) + INTERVAL 2 MONTH AS DATE)",
    "month_begin_back": "CAST(CASE WHEN day(d) = 1 THEN date_trunc('month', d) - INTERVAL 1 MONTH ELSE date_trunc('month', d) END AS DATE)",
    "quarter_begin_1": "CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE)",
    "quarter_end_1": "CAST(date_trunc('quarter', d + 1) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
    "year_begin_1": "CAST(date_trunc('year', d) + INTERVAL 1 YEAR AS DATE)",
    "year_end_back": "CAST(date_trunc('year', d) - INTERVAL 1 DAY AS DATE)",
    "next_wednesday": "CAST(d + (CASE WHEN isodow(d) < 3 THEN 3 - isodow(d) ELSE 10 - isodow(d) END)::INTEGER AS DATE)",
    "semi_month": "CAST(CASE WHEN day(d) < 15 THEN date_trunc('month', d) + INTERVAL 14 DAY WHEN d < last_day(d) THEN last_day(d) ELSE d + INTERVAL 15 DAY END AS DATE)",
    "forward": "CAST(d + (CASE isodow(d) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END)::INTEGER AS DATE)",
    "back": "CAST(d - (CASE isodow(d) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END)::INTEGER AS DATE)",
}


@query("b_d6_offsets", "SELECT o_orderkey, " + ", ".join(f"{e} AS {n}" for n, e in OFF.items()) + f" FROM {DD}")
def _(t):
    d = F.col("d")
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d")).select(
        "o_orderkey", D.move_month_end(d, 1).alias("month_end_1"), D.move_month_end(d, -1).alias("month_end_back"), D.move_month_begin(d, 2).alias("month_begin_2"),
        D.move_month_begin(d, -1).alias("month_begin_back"), D.move_period_begin(d, 1, 3, "QUARTER").alias("quarter_begin_1"), D.move_period_end(d, 1, 3, "QUARTER").alias("quarter_end_1"),
        D.move_period_begin(d, 1, 12, "YEAR").alias("year_begin_1"), D.move_period_end(d, -1, 12, "YEAR").alias("year_end_back"), D.move_weekday(d, "Wed").alias("next_wednesday"),
        D.semi_month_end(d).alias("semi_month"), D.roll(d).alias("forward"), D.roll(d, "back").alias("back"),
    )


query(
    "b_d6_business_day_offset",
    "SELECT o_orderkey, CAST(list_filter(list_transform(range(0, 16), lambda i: d - CASE isodow(d) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END::INTEGER + CAST(i AS INTEGER)), lambda x: isodow(x) < 6)[9] AS DATE) AS later FROM " + DD,
)(lambda t: t.orders.select("o_orderkey", D.move_business_days(F.to_date("o_orderdate"), 8).alias("later")))


def wide(t):
    return bounds(t).select(F.date_sub("low", 60).alias("low"), F.date_add("high", 60).alias("high"))


WIDE_HOL = HOL.replace("SELECT CAST(min(o_orderdate) AS DATE) AS low, CAST(max(o_orderdate) AS DATE) AS high", "SELECT CAST(min(o_orderdate) AS DATE) - 60 AS low, CAST(max(o_orderdate) AS DATE) + 60 AS high")
for _label, _n in [("forward", 8), ("back", -3)]:
    _base = "count(*)" if _n > 0 else "count(*) + CASE WHEN max(w.d) = o.d THEN 0 ELSE 1 END"
    query(
        f"b_d6_holiday_calendar_{_label}",
        f"""WITH {WIDE_HOL}, open AS (SELECT d, row_number() OVER (ORDER BY d) AS i FROM days, b WHERE d BETWEEN low AND high AND isodow(d) < 6 AND d NOT IN (SELECT day FROM holidays)),
dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
at AS (SELECT o.d, {_base} + {_n} AS i FROM dates o JOIN open w ON w.d <= o.d GROUP BY o.d)
SELECT o_orderkey, open.d AS moved FROM orders JOIN at ON at.d = CAST(o_orderdate AS DATE) JOIN open ON open.i = at.i""".replace("at AS (", "spots AS (").replace("JOIN at ON at.d", "JOIN spots ON spots.d").replace("open.i = at.i", "open.i = spots.i"),
    )(
        lambda t, n=_n: D.add_business_days(
            t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d")), "d", n, D.business_calendar(wide(t), D.holidays(wide(t))), "moved"
        ).select("o_orderkey", "moved")
    )
FIELD_SQL = {
    "year": "year(ts)", "month": "month(ts)", "day": "day(ts)", "hour": "hour(ts)", "minute": "minute(ts)", "second": "second(ts)", "microsecond": "microsecond(ts) % 1000000",
    "day_of_week": "isodow(ts) - 1", "day_of_year": "dayofyear(ts)", "quarter": "quarter(ts)", "iso_week": "week(ts)", "days_in_month": "day(last_day(ts))",
}
BOOLS = {
    "is_month_start": "day(ts) = 1", "is_month_end": "ts::DATE = last_day(ts)", "is_quarter_start": "ts::DATE = date_trunc('quarter', ts)::DATE",
    "is_quarter_end": "ts::DATE + 1 = date_trunc('quarter', ts::DATE + 1)::DATE", "is_year_start": "dayofyear(ts) = 1", "is_year_end": "month(ts) = 12 AND day(ts) = 31",
    "is_leap_year": "day(last_day(make_date(year(ts), 2, 1))) = 29", "day_name": "dayname(ts)", "month_name": "monthname(ts)",
}
BOTH = "(SELECT event_id AS id, ts FROM events UNION ALL SELECT o_orderkey, o_orderdate FROM orders)"
query("b_d7_date_fields", "SELECT id, " + ", ".join([f"CAST({e} AS INTEGER) AS {n}" for n, e in FIELD_SQL.items()] + [f"{e} AS {n}" for n, e in BOOLS.items()]) + f" FROM {BOTH}")(
    lambda t: t.events.selectExpr("event_id AS id", "ts").unionByName(t.orders.selectExpr("o_orderkey AS id", "o_orderdate AS ts")).select("id", *D.date_fields("ts"))
)
W = 6 * 3600 * 10**6
query(
    "b_d8_floor_ceil_round",
    f"SELECT event_id, make_timestamp(u - u % {W}) AS floored, make_timestamp(u + ({W} - u % {W}) % {W}) AS ceiled, make_timestamp(CAST(round_even(u / {W}.0, 0) AS BIGINT) * {W}) AS rounded, date_trunc('day', ts)::TIMESTAMP AS midnight FROM (SELECT event_id, ts, epoch_us(ts) AS u FROM events)",
)(lambda t: t.events.select("event_id", D.floor_to(F.col("ts"), "6 hours").alias("floored"), D.ceil_to(F.col("ts"), "6 hours").alias("ceiled"), D.round_to(F.col("ts"), "6 hours").alias("rounded"), D.floor_to(F.col("ts"), "1 day").alias("midnight")))
NY = "SELECT o_orderkey, o_orderdate + INTERVAL 150 MINUTE AS clock FROM orders"


def clocks(t):
    return t.orders.selectExpr("o_orderkey", "o_orderdate + INTERVAL '150' MINUTE AS clock")


query("b_d9_convert_zone", "SELECT o_orderkey, timezone('America/New_York', timezone('UTC', o_orderdate)) AS local_ts FROM orders")(
    lambda t: t.orders.select("o_orderkey", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("o_orderdate")).alias("local_ts"))
)
SKIPPED = "timezone('America/New_York', timezone('America/New_York', clock)) <> clock"
query("b_d9_localize_skipped", f"SELECT o_orderkey, {SKIPPED} AS skipped, CASE WHEN NOT ({SKIPPED}) THEN timezone('UTC', timezone('America/New_York', clock)) END AS utc FROM ({NY})")(
    lambda t: clocks(t).select("o_orderkey", D.is_skipped(F.col("clock"), "America/New_York").alias("skipped"), D.localize(F.col("clock"), "America/New_York", nonexistent="null").alias("utc"))
)
# Clocks go back at 02:00 on the last Sunday of October in these years; 01:30 is shown twice.
REPEATED = "month(clock) = 10 AND isodow(clock) = 7 AND day(clock) > 24 AND hour(clock) = 1"
query("b_d9_localize_repeated", f"SELECT o_orderkey, {REPEATED} AS repeated FROM (SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS clock FROM orders)")(
    lambda t: t.orders.selectExpr("o_orderkey", "o_orderdate + INTERVAL '90' MINUTE AS clock").select("o_orderkey", D.is_repeated(F.col("clock"), "America/New_York").alias("repeated"))
)



@query(
    "b_d10_durations",
    "SELECT event_id, us // 86400000000 AS days, us % 86400000000 // 1000000 AS seconds, us % 1000000 AS microseconds, us / 1e6 AS total_seconds FROM (SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN user_id * 86400000000 + 7384500000 ELSE user_id * 3600000000 + 1800000000 END AS us FROM events)",
)
def _(t):
    text = F.expr("CASE event_type WHEN 'error' THEN 'soon' WHEN 'view' THEN concat(user_id, ' days 02:03:04.5') ELSE concat(user_id, ' h 30 min') END")
    return t.events.select("event_id", D.duration_micros(text).alias("us")).select("event_id", *D.duration_parts(F.col("us")))


query("b_d11_parse_time_of_day", "SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN hour(ts) * 3600 + minute(ts) * 60 ELSE hour(ts) * 3600 + minute(ts) * 60 + second(ts) END::INTEGER AS seconds FROM events")(
    lambda t: t.events.select("event_id", D.parse_time(F.expr("CASE event_type WHEN 'error' THEN 'noonish' WHEN 'view' THEN date_format(ts, 'h:mm a') WHEN 'click' THEN date_format(ts, 'HHmmss') ELSE date_format(ts, 'HH:mm:ss') END")).alias("seconds"))
)
query("b_d11_between_times", "SELECT event_id FROM events WHERE CAST(ts AS TIME) >= TIME '22:00:00' OR CAST(ts AS TIME) <= TIME '02:00:00'")(
    lambda t: t.events.filter(D.between_times(F.col("ts"), 22 * 3600, 2 * 3600)).select("event_id")
)
AGG = "count(*) AS n, round(sum(value), 4) AS total"


def aggs():
    return {"n": F.count(F.lit(1)), "total": F.round(F.sum("value"), 4)}


query("b_d12_resample", f"SELECT time_bucket(INTERVAL 12 HOUR, ts) AS ts, {AGG} FROM events GROUP BY 1")(lambda t: R.resample(t.events, ts="ts", every="12 hours", aggs=aggs()))
query("b_d12_resample_right", f"SELECT time_bucket(INTERVAL 12 HOUR, date_trunc('hour', ts) - INTERVAL 1 MICROSECOND) + INTERVAL 12 HOUR AS ts, {AGG} FROM events GROUP BY 1")(
    lambda t: R.resample(t.events.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")), ts="ts", every="12 hours", aggs=aggs(), closed="right", label="right")
)
query("b_d12_resample_origin", f"SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01 01:30:00') AS ts, {AGG} FROM events GROUP BY 1")(
    lambda t: R.resample(t.events, ts="ts", every="6 hours", aggs=aggs(), origin=90 * 60 * 10**6)
)
EMPTY = """WITH a AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS n FROM events GROUP BY 1, 2),
g AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM a GROUP BY 1)
"""
query("b_d14_resample_groups_empty", EMPTY + "SELECT g.user_id, g.ts, coalesce(n, 0) AS n FROM g LEFT JOIN a USING (user_id, ts)")(
    lambda t: R.resample(t.events, ts="ts", every="1 day", by=["user_id"], aggs={"n": F.count(F.lit(1))}, empty=True, fill={"n": 0})
)


def daily(t):
    return R.resample(t.events, ts="ts", every="1 day", by=["user_id"], aggs={"n": F.count(F.lit(1))})


UP = "WITH a AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS n FROM events GROUP BY 1, 2), g AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 6 HOUR)) AS ts FROM a GROUP BY 1)\n"
query("b_d13_upsample", UP + "SELECT g.user_id, g.ts, n FROM g LEFT JOIN a USING (user_id, ts)")(lambda t: R.upsample(daily(t), ts="ts", every="6 hours", by=["user_id"], columns=["n"]))
query("b_d13_upsample_ffill", UP + "SELECT user_id, ts, last_value(n IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g LEFT JOIN a USING (user_id, ts)")(
    lambda t: R.upsample(daily(t), ts="ts", every="6 hours", by=["user_id"], columns=["n"], fill="forward")
)


@query(
    "b_d13_upsample_interpolate",
    UP
    + """, j AS (SELECT user_id, ts, n, last_value(CASE WHEN n IS NOT NULL THEN {t: epoch_us(ts), v: n} END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS p,
  first_value(CASE WHEN n IS NOT NULL THEN {t: epoch_us(ts), v: n} END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM g LEFT JOIN a USING (user_id, ts))
SELECT user_id, ts, round(CASE WHEN n IS NOT NULL THEN n ELSE p.v + (q.v - p.v) * ((epoch_us(ts) - p.t) / CAST(q.t - p.t AS DOUBLE)) END, 7) AS n FROM j""",
)
def _(t):
    rows = R.upsample(daily(t), ts="ts", every="6 hours", by=["user_id"], columns=["n"])
    return missing.interpolate(rows, Series.by_time(["user_id"], "ts"), "n", "m", ts="ts").select("user_id", "ts", F.round("m", 7).alias("n"))


@query(
    "b_d15_infer_frequency",
    """SELECT 'days' AS kind, CASE WHEN date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 = count(DISTINCT o_orderdate) THEN 'D' END AS frequency FROM orders
UNION ALL SELECT 'ship_days', CASE WHEN date_diff('day', min(l_shipdate), max(l_shipdate)) + 1 = count(DISTINCT l_shipdate) THEN 'D' END FROM lineitem
UNION ALL SELECT kind, frequency FROM (VALUES ('months', 'MS'), ('quarters', 'QS'), ('month_ends', 'ME'), ('half_days', '12h'), ('events', NULL)) v(kind, frequency) WHERE (SELECT count(*) FROM orders) > 0""",
)
def _(t):
    d = t.orders.select(F.col("o_orderdate").alias("ts"))

    def part(kind, col, df=d):
        return df.select(F.lit(kind).alias("kind"), col.cast("timestamp_ntz").alias("ts"))

    rows = part("days", F.col("ts")).unionByName(part("months", F.date_trunc("month", "ts"))).unionByName(part("quarters", F.date_trunc("quarter", "ts")))
    rows = rows.unionByName(part("ship_days", F.col("l_shipdate"), t.lineitem.select("l_shipdate")))
    rows = rows.unionByName(part("month_ends", F.last_day("ts"))).unionByName(part("half_days", D.floor_to(F.col("ts"), "12 hours"), t.events.select("ts")))
    return R.infer_frequency(rows.unionByName(part("events", F.col("ts"), t.events.select("ts"))), ["kind"], "ts")


# Working days one by one: the n-th weekday after (before) the date; no step from a weekend gives its Monday.
for _n in (-6, -1, 0, 1, 7):
    if _n:
        _days = f"[x FOR x IN generate_series(1, {abs(_n) * 2 + 4}) IF isodow(d {'+' if _n > 0 else '-'} x::INTEGER) < 6][{abs(_n)}]"
        _sql = f"CAST(d {'+' if _n > 0 else '-'} ({_days})::INTEGER AS DATE)"
    else:
        _sql = "CAST(d + (CASE isodow(d) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END)::INTEGER AS DATE)"
    query(f"b_d6_business_days_{'back_' if _n < 0 else ''}{abs(_n)}", f"SELECT o_orderkey, {_sql} AS moved FROM {DD}")(
        lambda t, n=_n: t.orders.select("o_orderkey", D.move_business_days(F.to_date("o_orderdate"), n).alias("moved"))
    )
OLD = "o_orderdate - INTERVAL 60 YEAR + to_microseconds(o_orderkey % 999999)"


def long_ago(t):
    return t.orders.selectExpr("o_orderkey", "timestampadd(MICROSECOND, o_orderkey % 999999, o_orderdate - INTERVAL '60' YEAR) AS moment")


query("b_d7_fields_before_1970", f"SELECT o_orderkey, CAST(microsecond(moment) % 1000000 AS INTEGER) AS microsecond, year(moment)::INTEGER AS year FROM (SELECT o_orderkey, {OLD} AS moment FROM orders)")(
    lambda t: long_ago(t).select("o_orderkey", *D.date_fields("moment", ["microsecond", "year"]))
)
query("b_d11_between_times_before_1970", f"SELECT o_orderkey FROM (SELECT o_orderkey, {OLD} + to_hours(o_orderkey % 24) AS moment FROM orders) WHERE hour(moment) >= 22 OR hour(moment) < 3")(
    lambda t: long_ago(t).withColumn("moment", F.expr("timestampadd(HOUR, o_orderkey % 24, moment)")).filter(D.between_times(F.col("moment"), 22 * 3600, 3 * 3600 - 1)).select("o_orderkey")
)
# The clock skips 02:00 to 03:00 on the first Sunday of April (the second of March from 2007); the gap ends at 07:00 UTC.
for _how, _edge in (("forward", "INTERVAL 0 MICROSECOND"), ("backward", "INTERVAL 1 MICROSECOND")):
    query(
        f"b_d9_shift_{_how}",
        f"SELECT o_orderkey, CASE WHEN {SKIPPED} THEN CAST(CAST(clock AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR - {_edge} ELSE timezone('UTC', timezone('America/New_York', clock)) END AS utc FROM ({NY})",
    )(lambda t, h=_how: clocks(t).select("o_orderkey", D.localize(F.col("clock"), "America/New_York", nonexistent=f"shift_{h}").alias("utc")))
query("b_d9_second_of_both", "SELECT o_orderkey, CAST(clock AS TIMESTAMP) + INTERVAL 5 HOUR AS utc FROM (SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS clock FROM orders) WHERE " + REPEATED)(
    lambda t: t.orders.selectExpr("o_orderkey", "o_orderdate + INTERVAL '90' MINUTE AS clock").filter(D.is_repeated(F.col("clock"), "America/New_York"))
    .select("o_orderkey", D.localize(F.col("clock"), "America/New_York", ambiguous="second").alias("utc"))
)
query(
    "b_d10_signed_durations",
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN user_id * 129600000000 WHEN 1 THEN -(user_id * 3600000000 + 60000000) WHEN 2 THEN user_id * 604800000000 WHEN 3 THEN -user_id * 86400000000 + 3600000000 END AS us FROM events",
)(
    lambda t: t.events.select(
        "event_id",
        D.duration_micros(F.expr("CASE event_id % 5 WHEN 0 THEN concat(user_id + user_id / 2.0, ' days') WHEN 1 THEN concat('-', user_id, ':01:00') WHEN 2 THEN concat(user_id, ' weeks') WHEN 3 THEN concat('-', user_id, ' days +01:00:00') ELSE '3 days or so' END")).alias("us"),
    )
)
