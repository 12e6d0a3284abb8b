"""Calendar and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wardflow.operators.ordered import from_micros, micros, span_micros


def calendar_dimension(bounds: DataFrame) -> DataFrame:
    """One row per date between the columns ``low`` and ``high``; ISO weeks, Monday is 1."""
    days = bounds.select(F.explode(F.sequence("low", "high")).alias("date"))
    return days.selectExpr(
        "date", "year(date) AS year", "month(date) AS month", "day(date) AS day", "quarter(date) AS quarter",
        "CAST(weekofyear(date) AS BIGINT) AS week", "weekday(date) + 1 AS day_of_week",
        "date_format(date, 'EEEE') AS weekday_name", "date_format(date, 'MMMM') AS month_name",
        "CAST(weekday(date) >= 5 AS BIGINT) AS is_weekend",
    )


def to_local(text: Column, zone: str = "America/Phoenix") -> Column:
    """Text time to facility clock time.  UTC text is converted, other text is taken as local;
    text that is no time gives NULL."""
    clock = text.try_cast("timestamp_ntz")
    utc = text.endswith("Z") | text.contains("+00:00")
    return F.when(utc, F.convert_timezone(F.lit("UTC"), F.lit(zone), clock)).otherwise(clock)


# Spines


def date_spine(bounds: DataFrame, step: str, *, name: str = "at", inclusive: str = "both", periods: int | None = None) -> DataFrame:
    """Rows from ``low`` to ``high`` by an interval such as '1 month'.

    With ``periods``, that many rows from ``low``.  Other columns of ``bounds`` (keys) stay.
    """
    step_expr = f"INTERVAL {step}"
    if periods is not None:
        spread = f"transform(sequence(0, {periods - 1}), i -> low + i * {step_expr})"
    else:
        spread = f"CASE WHEN low <= high THEN sequence(low, high, {step_expr}) END"
    rows = bounds.withColumn(name, F.explode(F.expr(spread)))
    at = F.col(name)
    if periods is None and inclusive in ("right", "neither"):
        rows = rows.filter(at != F.col("low"))
    if periods is None and inclusive in ("left", "neither"):
        rows = rows.filter(at != F.col("high"))
    return rows.drop("low", "high")


def interval_spine(bounds: DataFrame, step: str) -> DataFrame:
    """Adjoining intervals of one length that lie between ``low`` and ``high``."""
    rows = bounds.withColumn("left", F.explode(F.expr(f"sequence(low, high, INTERVAL {step})")))
    rows = rows.withColumn("right", F.expr(f"left + INTERVAL {step}"))
    return rows.filter(F.col("right") <= F.col("high")).drop("low", "high")


def business_days(bounds: DataFrame, holidays: DataFrame | None = None, weekmask: str = "1111100", name: str = "day") -> DataFrame:
    """Working days between ``low`` and ``high``: weekdays by mask (Monday first), without holidays."""
    open_days = [i for i, m in enumerate(weekmask) if m == "1"]
    rows = date_spine(bounds, "1 day", name=name).withColumn(name, F.col(name).cast("date")).filter(F.weekday(name).isin(open_days))
    if holidays is None:
        return rows
    return rows.join(holidays.select(F.col("day").alias(name)), name, "left_anti")


# US federal holidays.  (name, month, day, observance, first year) for fixed
# dates; (name, month, weekday, which, first year) for floating ones, -1 being the last.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1, "nearest_workday", 1),
    ("Juneteenth National Independence Day", 6, 19, "nearest_workday", 2021),
    ("Independence Day", 7, 4, "nearest_workday", 1),
    ("Veterans Day", 11, 11, "nearest_workday", 1),
    ("Christmas Day", 12, 25, "nearest_workday", 1),
]
FLOATING_HOLIDAYS = [
    ("Birthday of Martin Luther King, Jr.", 1, "Mon", 3, 1986),
    ("Washington's Birthday", 2, "Mon", 3, 1),
    ("Memorial Day", 5, "Mon", -1, 1),
    ("Labor Day", 9, "Mon", 1, 1),
    ("Columbus Day", 10, "Mon", 2, 1),
    ("Thanksgiving Day", 11, "Thu", 4, 1),
]


def observed(day: Column, rule: str | None) -> Column:
    """A fixed holiday moved by an observance rule."""
    if rule is None:
        return day
    wd = F.weekday(day)  # Monday is 0
    nearest = F.when(wd == 5, -1).when(wd == 6, 1).otherwise(0)
    if rule in ("before_nearest_workday", "after_nearest_workday"):
        return _step_workday(F.date_add(day, nearest), -1 if rule.startswith("before") else 1)
    if rule in ("previous_workday", "next_workday"):
        return _step_workday(day, -1 if rule.startswith("previous") else 1)
    moves = {
        "nearest_workday": nearest,
        "sunday_to_monday": F.when(wd == 6, 1),
        "next_monday": F.when(wd == 5, 2).when(wd == 6, 1),
        "weekend_to_monday": F.when(wd == 5, 2).when(wd == 6, 1),
        "next_monday_or_tuesday": F.when(wd.isin(5, 6), 2).when(wd == 0, 1),
        "previous_friday": F.when(wd == 5, -1).when(wd == 6, -2),
    }
    return F.date_add(day, F.coalesce(moves[rule], F.lit(0)))


def _step_workday(day: Column, step: int) -> Column:
    """The weekday just before or after a date."""
    wd = F.weekday(day)
    if step > 0:
        return F.date_add(day, F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1))
    return F.date_sub(day, F.when(wd == 0, 3).when(wd == 6, 2).otherwise(1))


def nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n == -1:
        return F.next_day(F.date_sub(F.last_day(first), 7), weekday)
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def holidays(bounds: DataFrame, fixed=FIXED_HOLIDAYS, floating=FLOATING_HOLIDAYS) -> DataFrame:
    """Holidays between ``low`` and ``high``: every year with every rule."""
    years = bounds.select("low", "high", F.explode(F.sequence(F.year("low") - 1, F.year("high") + 1)).alias("y"))
    y = F.col("y")
    rules = [(n, observed(F.make_date(y, F.lit(m), F.lit(d)), o), since) for n, m, d, o, since in fixed]
    rules += [(n, nth_weekday(y, m, wd, which), since) for n, m, wd, which, since in floating]
    rows = [F.struct(F.lit(n).alias("holiday"), d.alias("day"), F.lit(since).alias("_since")) for n, d, since in rules]
    return (
        years.select("low", "high", "y", F.inline(F.array(*rows)))
        .filter((y >= F.col("_since")) & F.col("day").between(F.to_date("low"), F.to_date("high")))
        .select("holiday", "day")
    )


# Offsets of dates.  n > 0 moves forward, n < 0 back; a date that is not on the offset
# reaches the nearest one with its first step.


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def move_month_end(d: Column, n: int) -> Column:
    step = F.lit(n) if n <= 0 else n - F.when(d == F.last_day(d), 0).otherwise(1)
    return F.last_day(F.add_months(month_start(d), step))


def move_month_begin(d: Column, n: int) -> Column:
    step = F.lit(n) if n > 0 else n + F.when(d == month_start(d), 0).otherwise(1)
    return F.add_months(month_start(d), step)


def _period_start(d: Column, unit: str) -> Column:
    return F.trunc(d, unit)


def move_period_begin(d: Column, n: int, months: int, unit: str) -> Column:
    start = _period_start(d, unit)
    step = F.lit(n) if n > 0 else n + F.when(d == start, 0).otherwise(1)
    return F.add_months(start, step * months)


def move_period_end(d: Column, n: int, months: int, unit: str) -> Column:
    start = _period_start(d, unit)
    end = F.date_sub(F.add_months(start, months), 1)
    step = F.lit(n) if n <= 0 else n - F.when(d == end, 0).otherwise(1)
    return F.date_sub(F.add_months(start, (step + 1) * months), 1)


def move_weekday(d: Column, weekday: str) -> Column:
    """The next such weekday after the date."""
    return F.next_day(d, weekday)


def semi_month_end(d: Column) -> Column:
    """The next 15th or month end after the date."""
    return F.when(F.dayofmonth(d) < 15, F.date_add(month_start(d), 14)).when(d < F.last_day(d), F.last_day(d)).otherwise(F.date_add(d, 15))


def move_business_days(d: Column, n: int) -> Column:
    """By working days, weekends skipped.

    Forward a weekend counts from its Friday, backward from the Monday after it; no step moves a weekend to that Monday.
    """
    day = F.weekday(d)
    if n > 0:
        base = F.when(day == 5, F.date_sub(d, 1)).when(day == 6, F.date_sub(d, 2)).otherwise(d)
        weeks, rest = divmod(n, 5)
        return F.date_add(base, F.lit(7 * weeks + rest) + F.when(F.weekday(base) + rest > 4, 2).otherwise(0))
    base = F.when(day == 5, F.date_add(d, 2)).when(day == 6, F.date_add(d, 1)).otherwise(d)
    weeks, rest = divmod(-n, 5)
    return F.date_sub(base, F.lit(7 * weeks + rest) + F.when(F.weekday(base) - rest < 0, 2).otherwise(0))


def add_business_days(df: DataFrame, column: str, n: int, calendar: DataFrame, name: str) -> DataFrame:
    """Move dates by working days of a calendar: ``day`` and ``is_open``, one row per date.

    A closed date counts from the open day before it, and for n <= 0 from the one after it.
    Both lookups join the calendar, whose length is the number of days it spans.
    """
    days = W.orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    numbered = calendar.withColumn("_open", F.sum(F.col("is_open").cast("int")).over(days))
    start = numbered.select(F.col("day").alias(column), "_open", F.col("is_open").alias("_on"))
    goal = numbered.filter("is_open").select(F.col("_open").alias("_goal"), F.col("day").alias(name))
    shift = F.lit(n) + (F.when(~F.col("_on"), 1).otherwise(0) if n <= 0 else F.lit(0))
    return (
        df.join(start, column, "left").withColumn("_goal", F.col("_open") + shift).join(goal, "_goal", "left").drop("_goal", "_open", "_on")
    )


def business_calendar(bounds: DataFrame, closed: DataFrame | None = None, weekmask: str = "1111100") -> DataFrame:
    """Every date between ``low`` and ``high`` with whether it is a working day."""
    days = date_spine(bounds, "1 day", name="day").withColumn("day", F.col("day").cast("date"))
    if closed is not None:
        days = days.join(closed.select("day").distinct().withColumn("_closed", F.lit(True)), "day", "left")
    else:
        days = days.withColumn("_closed", F.lit(None).cast("boolean"))
    open_days = [i for i, m in enumerate(weekmask) if m == "1"]
    return days.select("day", (F.weekday("day").isin(open_days) & F.col("_closed").isNull()).alias("is_open"))


def roll(d: Column, direction: str = "forward") -> Column:
    """A weekend date to the next or previous working day."""
    wd = F.weekday(d)
    if direction == "forward":
        return F.when(wd == 5, F.date_add(d, 2)).when(wd == 6, F.date_add(d, 1)).otherwise(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_sub(d, 2)).otherwise(d)


# Fields

FIELDS = {
    "year": "year({c})", "month": "month({c})", "day": "day({c})", "hour": "hour({c})", "minute": "minute({c})",
    "second": "second({c})", "microsecond": "CAST(pmod(unix_micros(CAST({c} AS TIMESTAMP)), 1000000) AS INT)",
    "day_of_week": "weekday({c})", "day_of_year": "dayofyear({c})", "quarter": "quarter({c})", "iso_week": "weekofyear({c})",
    "is_month_start": "day({c}) = 1", "is_month_end": "to_date({c}) = last_day({c})",
    "is_quarter_start": "to_date({c}) = trunc({c}, 'QUARTER')", "is_quarter_end": "date_add(to_date({c}), 1) = trunc(date_add(to_date({c}), 1), 'QUARTER')",
    "is_year_start": "month({c}) = 1 AND day({c}) = 1", "is_year_end": "month({c}) = 12 AND day({c}) = 31",
    "is_leap_year": "day(last_day(make_date(year({c}), 2, 1))) = 29", "days_in_month": "day(last_day({c}))",
    "day_name": "date_format({c}, 'EEEE')", "month_name": "date_format({c}, 'MMMM')",
}


def date_fields(column: str, names: list[str] | None = None) -> list[Column]:
    return [F.expr(FIELDS[n].format(c=column)).alias(n) for n in names or FIELDS]


def floor_to(col: Column, width: str) -> Column:
    w = span_micros(width)
    m = micros(col)
    return from_micros(m - F.pmod(m, F.lit(w)))


def ceil_to(col: Column, width: str) -> Column:
    w = span_micros(width)
    m = micros(col)
    return from_micros(m + F.pmod(-m, F.lit(w)))


def round_to(col: Column, width: str) -> Column:
    """Nearest multiple; halfway goes to the even multiple."""
    w = span_micros(width)
    m = micros(col)
    rest, whole = F.pmod(m, F.lit(w)), F.floor(m / w)
    up = (rest * 2 > w) | ((rest * 2 == w) & (F.pmod(whole, F.lit(2)) == 1))
    return from_micros(m - rest + F.when(up, w).otherwise(0))


# Zones


def localize(col: Column, zone: str, *, ambiguous: str = "first", nonexistent: str = "shift_forward") -> Column:
    """Clock time in a zone to UTC clock time.

    ``ambiguous`` is for a time the clock shows twice: the ``first`` or ``second`` of both, ``null`` or ``raise``.  ``nonexistent`` is
    for one it skips: ``shift_forward`` to the first time after the gap, ``shift_backward`` to the last before it, ``null`` or ``raise``.
    """
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), col)
    skipped, repeated = is_skipped(col, zone), is_repeated(col, zone)
    out = utc
    if nonexistent in ("shift_forward", "shift_backward"):
        edge = _gap_end(col, zone) - (0 if nonexistent == "shift_forward" else 1)
        out = F.when(skipped, from_micros(edge)).otherwise(out)
    else:
        out = F.when(skipped, None if nonexistent == "null" else F.raise_error(F.concat(F.lit("no such time: "), col.cast("string")))).otherwise(out)
    if ambiguous in ("first", "second"):
        hour = F.expr("INTERVAL '1' HOUR")
        for step in [utc - hour] if ambiguous == "first" else [utc + hour]:
            out = F.when(repeated & (F.convert_timezone(F.lit("UTC"), F.lit(zone), step) == col), step).otherwise(out)
    else:
        out = F.when(repeated, None if ambiguous == "null" else F.raise_error(F.concat(F.lit("shown twice: "), col.cast("string")))).otherwise(out)
    return out.cast("timestamp_ntz")


def _gap_end(col: Column, zone: str) -> Column:
    """UTC microseconds at which the zone's clock jumped over a skipped time, by halving down to a second."""
    offset = lambda t: micros(F.convert_timezone(F.lit("UTC"), F.lit(zone), from_micros(t * 1_000_000))) - t * 1_000_000
    high = F.floor(micros(F.convert_timezone(F.lit(zone), F.lit("UTC"), col)) / 1_000_000)
    span = F.struct((high - 86_400).alias("low"), high.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2)
        after = offset(middle) == offset(s["high"])
        return F.struct(F.when(after, s["low"]).otherwise(middle).alias("low"), F.when(after, middle).otherwise(s["high"]).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(17)), span, halve)["high"] * 1_000_000


def is_skipped(col: Column, zone: str) -> Column:
    """The zone's clock never shows this time."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), col)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc) != col


def is_repeated(col: Column, zone: str) -> Column:
    """The zone's clock shows this time twice."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), col)
    hour = F.expr("INTERVAL '1' HOUR")
    again = [F.convert_timezone(F.lit("UTC"), F.lit(zone), u) == col for u in (utc + hour, utc - hour)]
    return again[0] | again[1]


# Durations and times of day

_NUMBER = r"(\d+(?:\.\d+)?|\.\d+)"
_UNITS = [(604_800, r"weeks?|w"), (86_400, r"days?|d"), (3600, r"hours?|hrs?|h"), (60, r"minutes?|mins?|m(?!s)"), (1, r"seconds?|secs?|s"), (0.001, r"milliseconds?|millis?|ms"), (0.000001, r"microseconds?|micros?|us")]
_DURATION = r"\A\s*([+-]?)\s*" + "".join(rf"(?:{_NUMBER}\s*(?:{u})(?![a-z])[\s,]*)?" for _, u in _UNITS) + r"(?:([+-]?)\s*(\d+):(\d{1,2})(?::(\d{1,2}(?:\.\d+)?))?)?\s*\z"


def duration_micros(text: Column) -> Column:
    """'1 days 02:03:04.5', '-1.5 h', '2 weeks' or '5 h 30 min' to microseconds; NULL if anything of the text is left over.

    A sign at the front holds for all that follows, unless the clock part has its own.
    """
    low = F.lower(text)

    def number(group: int) -> Column:
        part = F.regexp_extract(low, _DURATION, group)
        return F.coalesce(F.nullif(part, F.lit("")).cast("decimal(24,9)"), F.lit(0).cast("decimal(24,9)"))

    def sign(group: int, default: Column) -> Column:
        mark = F.regexp_extract(low, _DURATION, group)
        return F.when(mark == "-", -1).when(mark == "+", 1).otherwise(default)

    units, first = len(_UNITS), sign(1, F.lit(1))
    total = sum((number(i + 2) * F.lit(str(int(round(s * 1_000_000)))).cast("decimal(15,0)") for i, (s, _) in enumerate(_UNITS)), F.lit(0))
    clock = (number(units + 3) * 3600 + number(units + 4) * 60 + number(units + 5)) * 1_000_000
    known = low.rlike(_DURATION) & low.rlike(r"\d")
    return F.when(known, (first * total + sign(units + 2, first) * clock).cast("bigint"))


def duration_parts(us: Column) -> list[Column]:
    """Days, seconds within the day, microseconds, total seconds."""
    day, second = 86_400_000_000, 1_000_000
    return [
        F.floor(us / day).alias("days"), F.floor(F.pmod(us, F.lit(day)) / second).cast("bigint").alias("seconds"),
        F.pmod(us, F.lit(second)).alias("microseconds"), (us / second).alias("total_seconds"),
    ]


def seconds_of_day(col: Column) -> Column:
    return F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def parse_time(text: Column) -> Column:
    """'14:30', '2:30 PM' or '143000' to seconds since midnight; other text to NULL."""
    forms = ["HH:mm:ss", "HH:mm", "h:mm a", "h:mm:ss a", "HHmmss", "HHmm"]
    return seconds_of_day(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in forms]))


def between_times(col: Column, low: int, high: int) -> Column:
    """Time of day within [low, high] seconds; a low above the high goes over midnight."""
    s = F.pmod(micros(col), F.lit(86_400_000_000)) / F.lit(1_000_000)
    return s.between(low, high) if low <= high else (s >= low) | (s <= high)
