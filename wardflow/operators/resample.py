"""Resampling of time series per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.keys import join_null_safe
from wardflow.operators.ordered import dealt, from_micros, micros, row_frame, running, span_micros, steps
from wardflow.session import settle


def bucket_start(ts: str, every: str, *, closed: str = "left", origin: int = 0) -> Column:
    """Start of the bucket in microseconds.  ``origin`` shifts all edges.  Closed on the right,
    a time on an edge belongs to the bucket that ends there."""
    w = span_micros(every)
    at = micros(ts) - origin
    if closed == "right":
        at = at - 1
    return at - F.pmod(at, F.lit(w)) + origin


def resample(
    df: DataFrame, *, ts: str, every: str, aggs: dict[str, Column], by: list[str] = (), closed: str = "left", label: str = "left",
    origin: int = 0, empty: bool = False, fill: dict | None = None,
) -> DataFrame:
    """Aggregate by time bucket.  With ``empty``, buckets without rows between a key's first
    and last one are there too, with NULL or the ``fill`` value.  Rows without a time have no bucket."""
    w = span_micros(every)
    rows = df.filter(F.col(ts).isNotNull()).groupBy(*by, bucket_start(ts, every, closed=closed, origin=origin).alias("_at")).agg(*[a.alias(n) for n, a in aggs.items()])
    if empty:
        spans = rows.groupBy(*by).agg(F.min("_at").alias("_a"), F.max("_at").alias("_z"))
        grid = steps(spans, F.col("_a"), F.col("_z"), w, "_at").select(*by, "_at")
        rows = join_null_safe(grid, rows, [*by, "_at"], "left")
        if fill:
            rows = rows.fillna(fill)
    at = F.col("_at") + (w if label == "right" else 0)
    return rows.select(*by, from_micros(at).alias(ts), *aggs)


def upsample(df: DataFrame, *, ts: str, every: str, by: list[str], columns: list[str], fill: str | None = None) -> DataFrame:
    """A finer regular grid between a key's first and last time: values at equal times, gaps
    left NULL, or filled forward or backward from the series."""
    w = span_micros(every)
    spans = df.groupBy(*by).agg(F.min(micros(ts)).alias("_a"), F.max(micros(ts)).alias("_z"))
    grid = steps(spans, F.col("_a"), F.col("_z"), w, "_us").select(*by, from_micros(F.col("_us")).alias(ts))
    rows = join_null_safe(grid, df.select(*by, ts, *columns), [*by, ts], "left")
    if fill is None:
        return rows
    rows, series = dealt(rows, by, [ts], descending=fill == "backward")
    return running(rows, series, {c: ("last", F.col(c)) for c in columns}).drop("_vb")


def sessions(df: DataFrame, *, ts: str, by: list[str], gap: str) -> DataFrame:
    """Runs of rows with less than ``gap`` between them: start, end (last time plus gap), rows.

    The session of a row is its key and its latest start so far, from two ordered scans; a
    session is then an aggregate, so a busy key is no single task.
    """
    g = span_micros(gap)
    at = micros(ts)  # rows without a time are in no session
    timed, series = dealt(df.select(*by, ts).filter(F.col(ts).isNotNull()), by, [ts])
    rows = settle(running(timed, series, {"_before": ("last", at)}, exclusive=True))
    starts = F.when(F.col("_before").isNull() | (at - F.col("_before") >= g), at)
    marked = running(rows, series, {"_start": ("last", starts)})
    out = marked.groupBy(*by, "_start").agg(F.max(at).alias("_last"), F.count(F.lit(1)).alias("n"))
    return out.select(*by, from_micros(F.col("_start")).alias("start"), from_micros(F.col("_last") + g).alias("end"), "n")


# Names of regular steps, in microseconds.
STEPS = [("W", 7 * 86_400_000_000), ("D", 86_400_000_000), ("h", 3_600_000_000), ("min", 60_000_000), ("s", 1_000_000)]


def infer_frequency(df: DataFrame, by: list[str], ts: str) -> DataFrame:
    """Name of the one step between the times of a key, such as D, 2h, MS or QS; NULL if there is none."""
    times, series = dealt(df.select(*by, ts).distinct(), by, [ts])
    frame = row_frame(times, series, before=1)
    before = F.lag(ts).over(frame.window())
    steps = frame.close(
        frame.rows.withColumn("_step", micros(ts) - micros(before)).withColumn(
            "_months", (F.year(ts) * 12 + F.month(ts)) - (F.year(before) * 12 + F.month(before))
        )
    )
    stats = steps.groupBy(*by).agg(
        F.min("_step").alias("a"), F.max("_step").alias("z"), F.min("_months").alias("ma"), F.max("_months").alias("mz"),
        F.bool_and(F.dayofmonth(ts) == 1).alias("starts"), F.bool_and(F.to_date(ts) == F.last_day(ts)).alias("ends"),
    )
    even = F.col("a") == F.col("z")
    name = F.when(F.lit(False), F.lit(""))
    for label, us in STEPS:
        count = (F.col("a") / us).cast("bigint")
        name = name.when(even & (F.col("a") % us == 0), F.concat(F.when(count == 1, "").otherwise(count.cast("string")), F.lit(label)))
    regular = (F.col("ma") == F.col("mz")) & (F.col("ma") > 0)
    n = F.col("ma")
    unit = F.when(n % 12 == 0, "Y").when(n % 3 == 0, "Q").otherwise("M")
    base = F.when(n % 12 == 0, (n / 12).cast("int")).when(n % 3 == 0, (n / 3).cast("int")).otherwise(n)
    count = F.when(base == 1, "").otherwise(base.cast("string"))
    name = name.when(regular & F.col("starts"), F.concat(count, unit, F.lit("S"))).when(regular & F.col("ends"), F.concat(count, unit, F.lit("E")))
    return stats.select(*by, name.alias("frequency"))
