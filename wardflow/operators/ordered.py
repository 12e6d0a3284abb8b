"""Ordered work on keyed series, without one task per key.

A plain window puts all rows of a key into one task, which fails when one key
holds a large share of the table.  Everything here splits a key's rows first:

* ``running``  - prefix results.  Each (key, bucket) is scanned on its own; one
  summary row per bucket is scanned per key and handed to its bucket as a head row.
  The rows are shuffled once.
* ``position`` - the row number inside a key, from bucket counts.
* ``RowFrame`` - frames of a few rows.  Rows are cut into blocks of equal size by
  position; a block also receives the few neighbouring rows its frames reach.
* ``TimeFrame`` - frames of a time span.  Rows are cut into time blocks; a block
  also receives the rows within reach of its edges.

A bucket must not decrease along the order, for example a day number for
a series ordered by time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from wardflow.session import settle

MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def span_micros(span: str | int) -> int:
    """'90 minutes' -> microseconds; an int passes through."""
    if isinstance(span, int):
        return span
    number, unit = span.split()
    return int(number) * MICROS[unit.rstrip("s")]


def micros(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def from_micros(col: Column) -> Column:
    return F.timestamp_micros(col).cast("timestamp_ntz")


def time_bucket(col: Column | str, width: str | int = "1 day") -> Column:
    w = span_micros(width)
    m = micros(col)
    return (m - F.pmod(m, F.lit(w))) / F.lit(w)


def edges_below(col: str, edges: list[float], strict: bool = False) -> Column:
    """How many of the sorted edges are <= the value (< with ``strict``); NULL for NULL.

    Every so many edges, as the root of their number, the list has a mark.  The marks are counted first,
    then the edges after the last one passed.
    """
    if not edges:
        return F.when(F.col(col).isNotNull(), 0)
    x = F.col(col).cast("double")
    passed = (lambda e: e < x) if strict else (lambda e: e <= x)
    step = math.ceil(math.sqrt(len(edges)))
    marks = F.size(F.filter(F.lit(np.array(edges[::step], float)), passed))
    block = F.slice(F.lit(np.array(edges, float)), (F.greatest(marks, F.lit(1)) - 1) * step + 1, step)
    found = F.when(marks == 0, 0).otherwise((marks - 1) * step + F.size(F.filter(block, passed)))
    return F.when(x.isNotNull(), found.cast("int"))


def dealt(df: DataFrame, by: list[str], order: list[str], *, descending: bool = False) -> tuple[DataFrame, "Series"]:
    """Rows dealt by ranges of key and order, and a series whose bucket is the range.

    Any orderable types will do, and a value that most rows share is cut by the columns after it.  The ranges come from
    a sample, so the rows are written once with their range: all later reads agree.  The column ``_vb`` is left to be dropped.
    """
    rows = settle(df.repartitionByRange(*by, *order).withColumn("_vb", F.spark_partition_id()))
    return rows, Series(by, order, F.col("_vb"), descending)


def fitted_width(df: DataFrame, by: list[str], ts: str, *, rows: int = 5_000_000, width: str | int = "1 day", least: int = MICROS["second"]) -> int:
    """Microseconds of time buckets narrow enough that the busiest key and bucket hold about ``rows`` rows, but never below ``least``.

    One number per try reaches the driver: the size of the largest bucket, counted map-side.
    """
    wide, before = max(span_micros(width), least), None
    while wide > least:
        sizes = df.filter(F.col(ts).isNotNull()).groupBy(*by, time_bucket(ts, wide).alias("_b")).agg(F.count(F.lit(1)).alias("n"))
        peak = sizes.agg(F.max("n")).first()[0] or 0
        if peak <= rows or peak == before:  # rows of one time cannot be told apart by time
            break
        before, wide = peak, max(wide // -(-peak // rows), least)
    return wide


CHUNK = 4096


def steps(df: DataFrame, low: Column, high: Column, width: int, name: str) -> DataFrame:
    """A row for each step from low to high, both included.

    The steps are listed in chunks, so that no row holds a list as long as a whole interval.
    """
    wide = F.lit(width * CHUNK)
    chunks = df.withColumns({"_high": high, "_chunk": F.explode(F.sequence(low, high, wide))})
    last = F.least(F.col("_high"), F.col("_chunk") + wide - width)
    return chunks.withColumn(name, F.explode(F.sequence(F.col("_chunk"), last, F.lit(width)))).drop("_chunk", "_high")


@dataclass(frozen=True)
class Series:
    """Key columns, order columns and the bucket that cuts long keys into pieces."""

    by: list[str]
    order: list[str]
    bucket: Column
    descending: bool = False

    @staticmethod
    def by_time(by: list[str], ts: str, *ties: str, width: str | int = "1 day") -> "Series":
        return Series(by, [ts, *ties], time_bucket(ts, width).cast("long"))

    @staticmethod
    def fitted(df: DataFrame, by: list[str], ts: str, *ties: str, rows: int = 5_000_000, width: str = "1 day") -> "Series":
        """Buckets narrow enough that the busiest key and bucket hold about ``rows`` rows."""
        micros_wide = fitted_width(df, by, ts, rows=rows, width=width)
        return Series.by_time(by, ts, *ties, width=micros_wide)

    def reversed(self) -> "Series":
        return replace(self, descending=not self.descending)

    def sort(self) -> list[Column]:
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in self.order]

    def bucket_sort(self) -> Column:
        return F.col("_b").desc() if self.descending else F.col("_b").asc()

    def row_key(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])


def _partial(kind: str, col: Column, series: Series) -> Column:
    if kind == "last":
        pick = F.min_by if series.descending else F.max_by
        return pick(col, F.when(col.isNotNull(), series.row_key()))
    if kind == "first":
        pick = F.max_by if series.descending else F.min_by
        return pick(col, F.when(col.isNotNull(), series.row_key()))
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "product": F.product}[kind](col)


def _scan(kind: str, col: Column) -> Column:
    if kind == "last":
        return F.last(col, ignorenulls=True)
    if kind == "first":
        return F.first(col, ignorenulls=True)
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "product": F.product}[kind](col)


def _merge(kind: str, carried: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried + here, carried, here)
    if kind == "product":
        return F.coalesce(carried * here, carried, here)
    if kind == "count":
        return F.coalesce(carried, F.lit(0)) + here
    if kind == "min":
        return F.least(carried, here)
    if kind == "max":
        return F.greatest(carried, here)
    if kind == "first":
        return F.coalesce(carried, here)
    return F.coalesce(here, carried)


def with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Add head rows, one per window partition; ``_head`` is 0 for them and 1 for rows.

    A window ordered by ``_head`` first then hands the head's values to its rows.  So a small
    table of carried values reaches a large one without a join: the large one is shuffled once,
    for the window.
    """
    return rows.withColumn("_head", F.lit(1)).unionByName(heads.withColumn("_head", F.lit(0)), allowMissingColumns=True)


def running(
    df: DataFrame, series: Series, what: dict[str, tuple[str, Column]], *, exclusive: bool = False
) -> DataFrame:
    """Add prefix results: ``{"total": ("sum", F.col("x"))}``.

    Kinds: sum, count, min, max, product, first and last, and next, the value at or after the
    row (these three skip NULL).  With ``exclusive`` the current row is left out.

    The frame is read twice, once for the summary in the columns that needs.  Chained scans
    should therefore write the result between them (``settle``), or each one doubles the work
    of all before it.
    """
    keys = [*series.by, "_b"]
    rows = df.withColumn("_b", series.bucket)
    # "next" is "last" along the reversed series: another sort of the same partitions, no shuffle.
    along = {n: series.reversed() if k == "next" else series for n, (k, _) in what.items()}
    kinds = {n: "last" if k == "next" else k for n, (k, _) in what.items()}
    summary = rows.groupBy(*keys).agg(*[_partial(kinds[n], c, along[n]).alias(f"_p_{n}") for n, (_, c) in what.items()])
    second = {"count": "sum"}

    def over_buckets(s: Series) -> WindowSpec:
        # One row per bucket: their number per key is bounded by the range of the order.
        w = W.partitionBy(*[F.col(c) for c in s.by] or [F.lit(0)]).orderBy(s.bucket_sort())
        return w.rowsBetween(W.unboundedPreceding, -1)

    carry = summary.select(
        *keys,
        *[_scan(second.get(kinds[n], kinds[n]), F.col(f"_p_{n}")).over(over_buckets(along[n])).alias(f"_c_{n}") for n in what],
    )
    both = with_heads(rows, carry)
    is_row = F.col("_head") == 1

    def result(name: str, col: Column) -> Column:
        w = W.partitionBy(*keys).orderBy("_head", *along[name].sort())
        local = w.rowsBetween(W.unboundedPreceding, -1 if exclusive else 0)
        head = F.first(f"_c_{name}").over(w.rowsBetween(W.unboundedPreceding, 0))
        return _merge(kinds[name], head, _scan(kinds[name], F.when(is_row, col)).over(local)).alias(name)

    kept = [F.col(c) for c in df.columns if c not in what]
    return both.select(*kept, *[result(n, c) for n, (_, c) in what.items()], "_head").filter(is_row).drop("_head")


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int, name: str = "_p") -> DataFrame:
    """The first n rows of each key, with their 1-based number.

    Spark cuts each task's rows to n per key before the shuffle, for any n up to the limit in the session settings.
    """
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def position(df: DataFrame, series: Series, name: str = "_pos") -> DataFrame:
    """Add the 1-based row number inside the key."""
    return running(df, series, {name: ("count", F.lit(1))})


@dataclass
class RowFrame:
    """Rows prepared for frames of ``before`` preceding and ``after`` following rows.

    Use ``rows`` with windows from ``window()``, then ``close()``.
    """

    rows: DataFrame
    by: list[str]
    columns: list[str] = field(default_factory=list)

    def window(self, start: int | None = None, end: int | None = None) -> WindowSpec:
        w = W.partitionBy(*self.by, "_blk").orderBy("_pos")
        return w if start is None else w.rowsBetween(start, end)

    def close(self, df: DataFrame, keep_position: bool = False) -> DataFrame:
        out = df.filter(F.col("_own")).drop("_blk", "_own")
        return out if keep_position else out.drop("_pos")


def row_frame(df: DataFrame, series: Series, before: int = 0, after: int = 0, block: int = 65536) -> RowFrame:
    numbered = df if "_pos" in df.columns else position(df, series)
    low = F.floor((F.col("_pos") - 1 - after) / block)
    high = F.floor((F.col("_pos") - 1 + before) / block)
    rows = (
        numbered.withColumn("_home", F.floor((F.col("_pos") - 1) / block))
        .withColumn("_blk", F.explode(F.sequence(F.greatest(low, F.lit(0)), high)))
        .withColumn("_own", F.col("_blk") == F.col("_home"))
        .drop("_home")
    )
    return RowFrame(rows, list(series.by))


@dataclass
class TimeFrame:
    rows: DataFrame
    by: list[str]
    order: list[str]

    def window(self, start: int, end: int) -> WindowSpec:
        """Frame in microseconds relative to the row's time."""
        return W.partitionBy(*self.by, "_blk").orderBy("_us").rangeBetween(start, end)

    def row_window(self) -> WindowSpec:
        return W.partitionBy(*self.by, "_blk").orderBy(*self.order)

    def close(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("_own")).drop("_blk", "_own", "_us")


def time_frame(
    df: DataFrame, by: list[str], ts: str, before: str | int = 0, after: str | int = 0, width: str | int | None = None, ties: tuple[str, ...] = (), rows: int | None = None
) -> TimeFrame:
    """Cut each key into time blocks at least as wide as the frame reaches, and otherwise narrow enough for the busiest key to have about ``rows`` in one.

    Rows without a time stay, in a block of their own.
    """
    b, a = span_micros(before), span_micros(after)
    reach = max(b, a, 1)
    w = fitted_width(df, by, ts, rows=rows or 5_000_000, least=reach) if width is None else max(span_micros(width), reach)
    us = F.col("_us")
    cut = (
        df.withColumn("_us", micros(ts))
        .withColumn("_home", F.floor(us / w))
        .withColumn("_blk", F.explode_outer(F.sequence(F.floor((us - a) / w), F.floor((us + b) / w))))
        .withColumn("_own", F.col("_blk").eqNullSafe(F.col("_home")))
        .drop("_home")
    )
    return TimeFrame(cut, list(by), [ts, *ties])
