"""Rolling, expanding, cumulative and exponentially weighted results per key.

All of them split long keys (see ``ordered``).  ``col`` is a column name; results are
NULL where fewer than ``min_periods`` values are in the frame.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardflow.operators.aggregates import correlation, transform_groups, unbiased_kurtosis, unbiased_skew
from wardflow.operators.keys import join_null_safe
from wardflow.operators.frames import ORDERED, PLAIN, block_statistics
from wardflow.operators.order_statistics import block_answers, within_range
from wardflow.operators.ordered import Series, first_rows, position, row_frame, running, span_micros, time_frame, with_heads
from wardflow.session import settle

Kernel = Callable[[str, WindowSpec], Column]


@dataclass(frozen=True)
class Statistic:
    """A kernel that ``frames`` knows as well, by its name and, for a quantile, its share."""

    name: str
    over: Kernel
    q: float | None = None

    def __call__(self, col: str, w: WindowSpec) -> Column:
        return self.over(col, w)


def _moment(make, correct) -> Kernel:
    return lambda c, w: correct(make(F.col(c)).over(w), F.count(c).over(w))


def quantile_kernel(q: float) -> Statistic:
    return Statistic("quantile", lambda c, w: F.percentile(c, F.lit(q)).over(w), q)


def _rank(c: str, w: WindowSpec) -> Column:
    seen = F.collect_list(c).over(w)
    below = F.size(F.filter(seen, lambda e: e < F.col(c)))
    equal = F.size(F.filter(seen, lambda e: e == F.col(c)))
    return F.when(F.col(c).isNotNull(), below + (equal + 1) / 2)


#: Average rank of the row's value in its frame.
rank_kernel = Statistic("rank", _rank)


def window_sem(std: Column, n: Column) -> Column:
    """Standard error in a frame.  The divisor is n - 1, unlike that of the grouped form."""
    return F.when(n > 1, std / F.sqrt(n - 1))


_OVER: dict[str, Kernel] = {
    "sum": lambda c, w: F.sum(c).over(w),
    "mean": lambda c, w: F.avg(c).over(w),
    "var": lambda c, w: F.var_samp(c).over(w),
    "std": lambda c, w: F.stddev_samp(c).over(w),
    "sem": lambda c, w: window_sem(F.stddev_samp(c).over(w), F.count(c).over(w)),
    "min": lambda c, w: F.min(c).over(w),
    "max": lambda c, w: F.max(c).over(w),
    "count": lambda c, w: F.count(c).over(w),
    "skew": _moment(F.skewness, unbiased_skew),
    "kurt": _moment(F.kurtosis, unbiased_kurtosis),
}
KERNELS: dict[str, Statistic] = {n: Statistic(n, k) for n, k in _OVER.items()} | {"median": quantile_kernel(0.5), "rank": rank_kernel}


def _enough(value: Column, col: str, w: WindowSpec, min_periods: int) -> Column:
    return F.when(F.count(col).over(w) >= min_periods, value)


#: Frames of more rows than this are put together from pieces; a plain window goes through the whole frame for each row.
SHORT = 64
#: Rows of a time block that goes to Python, unless one frame holds more.
BLOCK_ROWS = 500_000


def _by_pieces(df: DataFrame, col: str, kernels: dict[str, Kernel], always: bool) -> dict[str, Statistic]:
    """The kernels that ``frames`` computes: quantiles and ranks of any frame, the others of long ones, on numbers."""
    kind = df.schema[col].dataType
    if not isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType)):
        return {}
    return {n: k for n, k in kernels.items() if isinstance(k, Statistic) and (always or k.name in ORDERED)}


def _add_statistics(rows: DataFrame, groups: list[str], at: str, col: str, kernels: dict[str, Statistic], low: int, high: int, by_rows: bool, least: int) -> DataFrame:
    kind = rows.schema[col].dataType
    whole = isinstance(kind, T.IntegralType)
    types = []
    for k in kernels.values():
        types.append(T.LongType() if k.name == "count" or (k.name == "sum" and whole) else kind if k.name in PLAIN[1:] else T.DoubleType())
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, t) for n, t in zip(kernels, types)]])
    run = block_statistics(col, at, "_nr", [(n, k.name, k.q) for n, k in kernels.items()], low, high, by_rows, least, to_arrow_schema(schema))
    # The window brings the rows of a block together and in order, and its number tells where a block begins.
    numbered = rows.withColumn("_nr", F.row_number().over(W.partitionBy(*groups).orderBy(at)))
    return numbered.mapInArrow(run, schema)


def rolling(
    df: DataFrame, series: Series, col: str, n: int, kernels: dict[str, Kernel], *, min_periods: int | None = None,
    center: bool = False, forward: bool = False, step: int = 1, block: int = 65536,
) -> DataFrame:
    """Frames of ``n`` rows ending at the row, around it (center) or starting at it (forward).

    ``step`` keeps every step-th row of a key.  Quantiles, ranks and everything over more than ``SHORT`` rows take time that grows with the logarithm of ``n``;
    a task then holds a block of rows and the frames that reach into it.
    """
    m = n if min_periods is None else min_periods
    ahead = n - 1 if forward else ((n - 1) // 2 if center else 0)
    behind = n - 1 - ahead
    frame = row_frame(df, series, before=behind, after=ahead, block=block)
    w = frame.window(-behind, ahead)
    pieces = _by_pieces(df, col, kernels, n > SHORT)
    out = frame.rows.select("*", *[_enough(k(col, w), col, w, m).alias(name) for name, k in kernels.items() if name not in pieces])
    if pieces:
        out = _add_statistics(out, [*series.by, "_blk"], "_pos", col, pieces, -behind, ahead, True, m)
    kept = frame.close(out, keep_position=True)
    if step > 1:
        kept = kept.filter((F.col("_pos") - 1) % step == 0)
    return kept.select(*df.columns, *kernels)


CLOSED = {"right": (1, 0), "both": (0, 0), "left": (0, -1), "neither": (1, -1)}


def rolling_time(
    df: DataFrame, by: list[str], ts: str, col: str, span: str, kernels: dict[str, Kernel], *, closed: str = "right",
    min_periods: int = 1, width: str | None = None,
) -> DataFrame:
    """Frames of a time span before the row.  ``closed`` says which ends belong to the frame.

    Rows of equal time see each other.  A task holds a block of rows at least as wide as a frame; where one frame holds more than fits a task,
    ``rolling_time_sums`` has no such bound.
    """
    us = span_micros(span)
    open_low, high = CLOSED[closed]
    pieces = _by_pieces(df, col, kernels, True)
    frame = time_frame(df, by, ts, before=us, width=width, rows=BLOCK_ROWS if pieces else None)
    w = frame.window(-us + open_low, high)
    out = frame.rows.select("*", *[_enough(k(col, w), col, w, min_periods).alias(n) for n, k in kernels.items() if n not in pieces])
    if pieces:
        out = _add_statistics(out, [*by, "_blk"], "_us", col, pieces, -us + open_low, high, False, min_periods)
    return frame.close(out).select(*df.columns, *kernels)


def rolling_time_sums(df: DataFrame, series: Series, ts: str, col: str, span: str, *, closed: str = "right") -> DataFrame:
    """Count, sum, mean, least and greatest value over a time span, however many rows a frame holds.

    Time is cut into stretches exactly as long as a frame, so a frame is a suffix of one stretch and a prefix of the next, or one whole stretch. Each row sends a
    probe to either end of its frame; one scan forwards and one backwards give the probes what lies between them and the border, and both meet again by the row's
    key.  Nothing is subtracted: a huge value or a NaN is felt by the frames that hold it alone.
    """
    by, us = series.by, span_micros(span)
    open_low, high = CLOSED[closed]
    row_id = F.struct(*[F.col(c).alias(c) for c in [*by, *series.order]])
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    first, last, width = at - us + open_low, at + high, us - open_low + high + 1

    def stretch(moment: Column) -> Column:
        return F.floor(moment / F.lit(width)).cast("long")

    what = {"_n": ("count", F.col("_v")), "_s": ("sum", F.col("_v")), "_l": ("min", F.col("_v")), "_g": ("max", F.col("_v"))}
    facts = df.select(*by, at.alias("_us"), stretch(at).alias("_st"), F.col(col).alias("_v"), F.lit(0).alias("_probe"))

    def scanned(moment: Column, probed: DataFrame, descending: bool) -> DataFrame:
        # At equal times a scan meets facts before probes, so that a probe sees them.
        probe = F.lit(-1 if descending else 1)
        probes = probed.select(*by, row_id.alias("_id"), moment.alias("_us"), stretch(moment).alias("_st"), probe.alias("_probe"))
        both = facts.unionByName(probes, allowMissingColumns=True).withColumn(ts, F.timestamp_micros("_us").cast("timestamp_ntz"))
        along = Series([*by, "_st"], ["_us", "_probe", "_id"], series.bucket, descending)
        return running(both, along, what).filter(F.col("_probe") != 0).select("_id", *what)

    ends = scanned(last, df, False)
    # A frame that is one whole stretch is all prefix.
    starts = scanned(first, df.filter(stretch(first) < stretch(last)), True)
    frames = ends.unionByName(starts).groupBy("_id").agg(F.sum("_n").alias("count"), F.sum("_s").alias("sum"), F.min("_l").alias("min"), F.max("_g").alias("max"))
    some = F.col("count") > 0
    return frames.select(
        "_id.*", F.when(some, F.col("count")).alias("count"), F.when(some, F.col("sum")).alias("sum"), F.when(some, F.col("sum") / F.col("count")).alias("mean"), "min", "max"
    )


def rolling_pair(df: DataFrame, series: Series, x: str, y: str, n: int, *, block: int = 65536) -> DataFrame:
    """Covariance and correlation over frames of ``n`` rows with both values.  The correlation is NaN where a value stays the same throughout the frame."""
    frame = row_frame(df, series, before=n - 1, block=block)
    w = frame.window(-n + 1, 0)
    both = F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)
    ok = F.count(both).over(w) >= n
    out = frame.rows.select(
        "*", F.when(ok, F.covar_samp(x, y).over(w)).alias("cov"), F.when(ok, correlation(x, y, lambda c: c.over(w))).alias("corr")
    )
    return frame.close(out)


def window_weights(shape: str, n: int, std: float = 1.0) -> list[float]:
    """Weights of the common window shapes, symmetric."""
    if shape == "boxcar" or n == 1:
        return [1.0] * n
    k = range(n)
    if shape == "triang":
        if n % 2:
            half = [2 * (i + 1) / (n + 1) for i in range((n + 1) // 2)]
            return half + half[-2::-1]
        half = [(2 * i + 1) / n for i in range(n // 2)]
        return half + half[::-1]
    if shape == "hann":
        return [0.5 - 0.5 * math.cos(2 * math.pi * i / (n - 1)) for i in k]
    if shape == "hamming":
        return [0.54 - 0.46 * math.cos(2 * math.pi * i / (n - 1)) for i in k]
    if shape == "gaussian":
        return [math.exp(-0.5 * ((i - (n - 1) / 2) / std) ** 2) for i in k]
    raise ValueError(shape)


def rolling_weighted(df: DataFrame, series: Series, col: str, weights: list[float], *, block: int = 65536) -> DataFrame:
    """Weighted sum, mean and variance of full frames; the last weight is the row's own."""
    n = len(weights)
    frame = row_frame(df, series, before=n - 1, block=block)
    order = frame.window()
    lags = [F.lag(col, n - 1 - i).over(order).alias(f"_v{i}") for i in range(n)]
    rows = frame.rows.select("*", *lags)
    total = sum(weights)

    def add(items: list[Column]) -> Column:
        out = items[0]
        for i in items[1:]:
            out = out + i
        return out

    rows = rows.withColumn("wsum", add([F.col(f"_v{i}") * w for i, w in enumerate(weights)]))
    rows = rows.withColumn("wmean", F.col("wsum") / total)
    squares = add([F.lit(w) * (F.col(f"_v{i}") - F.col("wmean")) ** 2 for i, w in enumerate(weights)])
    rows = rows.withColumn("wvar", squares * n / ((n - 1) * total))
    return frame.close(rows.drop(*[f"_v{i}" for i in range(n)]))


def rolling_apply(df: DataFrame, series: Series, col: str, n: int, fn: Callable[[pd.Series], float], name: str, *, block: int = 65536) -> DataFrame:
    """An own function of the frame's values, as a vectorised aggregate."""

    @F.pandas_udf("double")
    def call(values: pd.Series) -> float:
        return fn(values)

    frame = row_frame(df, series, before=n - 1, block=block)
    w = frame.window(-n + 1, 0)
    out = frame.rows.withColumn(name, call(F.col(col)).over(w)).withColumn("_k", F.count(col).over(w))
    return frame.close(out.withColumn(name, F.when(F.col("_k") >= n, F.col(name))).drop("_k"))


# Expanding


def expanding(df: DataFrame, series: Series, col: str, kinds: list[str], *, min_periods: int = 1) -> DataFrame:
    """Results over all rows of the key so far: count, sum, min, max, mean, var, std, sem, skew, kurt.

    Higher moments come from running power sums about the key's mean, which keeps them
    accurate for values far from zero.
    """
    by = series.by
    moments = {"var", "std", "sem", "skew", "kurt"} & set(kinds)
    base = settle(transform_groups(df, by, {"_m": F.avg(col)})) if moments else df
    d = F.col(col) - F.col("_m")
    what = {"_n": ("count", F.col(col))}
    if {"sum", "mean"} & set(kinds):
        what["_s"] = ("sum", F.col(col))
    what |= {f"_{k}": (k, F.col(col)) for k in ("min", "max") if k in kinds}
    if moments:
        top = 4 if "kurt" in kinds else 3 if "skew" in kinds else 2
        what |= {f"_p{i}": ("sum", d**i) for i in range(1, top + 1)}
    rows = running(base, series, what)
    n, c = F.col("_n"), F.col
    mean = c("_p1") / n if moments else None
    out = {"count": n, "sum": c("_s") if "_s" in what else None, "min": c("_min") if "min" in kinds else None, "max": c("_max") if "max" in kinds else None}
    out["mean"] = c("_s") / n if "_s" in what else None
    if moments:
        m2 = F.greatest(c("_p2") / n - mean**2, F.lit(0.0))
        out["var"] = F.when(n > 1, m2 * n / (n - 1))
        out["std"] = F.sqrt(out["var"])
        out["sem"] = window_sem(out["std"], n)
        if "_p3" in what:
            m3 = c("_p3") / n - 3 * mean * c("_p2") / n + 2 * mean**3
            out["skew"] = unbiased_skew(F.try_divide(m3, F.pow(m2, F.lit(1.5))), n)
        if "_p4" in what:
            m4 = c("_p4") / n - 4 * mean * c("_p3") / n + 6 * mean**2 * c("_p2") / n - 3 * mean**4
            out["kurt"] = unbiased_kurtosis(F.try_divide(m4, m2 * m2) - 3, n)
    return rows.select(*df.columns, *[F.when(n >= (0 if k == "count" else min_periods), out[k]).alias(k) for k in kinds])


def expanding_pair(df: DataFrame, series: Series, x: str, y: str) -> DataFrame:
    """Covariance and correlation over all rows so far."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    base = settle(transform_groups(both, series.by, {"_mx": F.avg(x), "_my": F.avg(y)}))
    a, b = F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")
    rows = running(
        base, series,
        {"_n": ("count", F.col(x)), "_a": ("sum", a), "_b": ("sum", b), "_ab": ("sum", a * b), "_aa": ("sum", a * a), "_bb": ("sum", b * b)},
    )
    c, n = F.col, F.col("_n")
    sab, saa, sbb = c("_ab") - c("_a") * c("_b") / n, c("_aa") - c("_a") ** 2 / n, c("_bb") - c("_b") ** 2 / n
    return rows.select(*df.columns, F.when(n > 1, sab / (n - 1)).alias("cov"), F.when(n > 1, F.try_divide(sab, F.sqrt(F.greatest(saa * sbb, F.lit(0.0))))).alias("corr"))


def expanding_order_statistics(df: DataFrame, by: list[str], period: str, col: str, kernels: dict[str, Kernel]) -> DataFrame:
    """Median, quantile and rank so far, over a series with one row per key and period.

    A resampled series is short: its length per key is the number of periods in the calendar.  ``expanding_quantiles`` takes raw rows of any number.
    """
    w = W.partitionBy(*by).orderBy(period).rowsBetween(W.unboundedPreceding, 0)
    return df.select("*", *[k(col, w).alias(n) for n, k in kernels.items()])


PIECES = 8  # parts of a block of positions of which each tells the ranges that quantiles can lie in
RANGES = 4  # ranges of values per block of positions
BLOCKS_A_KEY = 1024


def _code(col: str, kind: T.DataType) -> tuple[Column, float]:
    """A whole or double number in the order of the values, and how many make one."""
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (F.col(col) * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long"), float(10**kind.scale)
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.col(col).cast("long" if whole else "double"), 1.0


def _range_of(code: Column) -> Column:
    """The range of a value among the sorted ``_edges``: even between two edges, odd for a value that is an edge itself."""
    edges, marks, step = F.col("_edges"), F.col("_marks"), F.col("_step")
    passed = F.size(F.filter(marks, lambda e: e < code))
    near = F.slice(edges, (F.greatest(passed, F.lit(1)) - 1) * step + 1, step)
    below = F.when(passed == 0, 0).otherwise((passed - 1) * step + F.size(F.filter(near, lambda e: e < code)))
    return 2 * below + F.coalesce(F.get(edges, below) == code, F.lit(False)).cast("int")


def expanding_quantiles(
    df: DataFrame, series: Series, col: str, quantiles: dict[str, float], *, rank: str | None = None, min_periods: int = 1, block: int = 1 << 18
) -> DataFrame:
    """Quantiles of all values of the key so far, and the average rank of the row's value among them, over raw rows.

    Keys of up to ``block`` rows are answered whole, several at a time.  A longer key is cut into blocks of positions and into ranges of values.  The counts by block and range, added up
    over the blocks and over the ranges, tell where the quantiles of a block can lie; of these ranges alone the block gets the earlier values, of all others their number.
    The rank within a range is counted in the range and handed to the row's block.  Cuts between ranges come from approximate quantiles and change no result; a value
    that is a cut has a range of its own, which may hold any number of rows, since equal values need no order.  A key has at most ``BLOCKS_A_KEY`` blocks, so the number of counts is bounded; its
    blocks and ranges grow beyond that.  A NULL value takes no part, and gets quantiles but no rank.  Decimals of more than 18 digits are compared as doubles.
    """
    given, by = df.columns, series.by or ["_all"]
    df = df if series.by else df.withColumn("_all", F.lit(0))
    code, unit = _code(col, df.schema[col].dataType)
    sizes = settle(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")))
    total, most = sizes.agg(F.sum("_rows"), F.max("_rows")).first()
    wide = max(block, -(-(most or 0) // BLOCKS_A_KEY))
    long = sizes.filter(F.col("_rows") > wide).select(*by)
    cuts = -(-RANGES * (most or 0) // wide)
    shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
    ends = F.coalesce(F.percentile_approx(code, shares, 8 * max(cuts, 128)), F.array().cast(f"array<{'long' if df.select(code).dtypes[0][1] == 'bigint' else 'double'}>"))
    edges = join_null_safe(df, long, by).groupBy(*by).agg(F.array_sort(F.array_distinct(ends)).alias("_edges"))
    edges = edges.withColumn("_step", F.greatest(F.ceil(F.sqrt(F.size("_edges"))), F.lit(1)).cast("int"))
    edges = settle(edges.withColumn("_marks", F.filter("_edges", lambda e, i: i % F.col("_step") == 0)))
    numbered = running(df, replace(series, by=by), {"_pos": ("count", F.lit(1)), "_n": ("count", F.col(col))})
    cut = join_null_safe(numbered.withColumn("_code", code), edges, by, "left")
    is_long = F.col("_edges").isNotNull()
    group = F.when(is_long, F.xxhash64(*by, "_block")).otherwise(F.pmod(F.xxhash64(*by), F.lit(max(1, -(-(total or 0) // wide)))))
    cut = cut.withColumns({"_block": F.when(is_long, F.floor((F.col("_pos") - 1) / wide)).otherwise(-1).cast("long"), "_range": F.when(is_long & F.col("_code").isNotNull(), _range_of(F.col("_code"))).otherwise(0)})
    rows = settle(cut.select(*df.columns, "_pos", "_n", "_code", "_block", "_range", (is_long & F.col("_code").isNotNull() & (F.col("_range") % 2 == 0)).alias("_inside"), group.alias("_group")))

    names, shape = [*given, "_group", "_block", "_n", "_code", "_range", "_inside"], rows.select(*given).schema
    made = T.StructType([*shape.fields, *[T.StructField(f"_a{i}", T.DoubleType()) for i in range(len(quantiles) + 1)]])
    args = (by, given, list(quantiles.values()), min_periods, unit)
    taken = rows.select(*names, *[c for c in by if c not in names]).groupBy("_group")
    if (most or 0) > wide:
        more = _before_blocks(rows.filter(F.col("_block") >= 0), edges, by, list(quantiles.values()), wide)
        answers = taken.cogroup(more.groupBy("_group")).applyInArrow(lambda r, m: block_answers(r, m, *args), made)
    else:
        kinds = {"_code": rows.schema["_code"].dataType, "_range": T.IntegerType()} | dict.fromkeys(["_block", "_weight", "_n", "_less", "_same"], T.LongType())
        none = to_arrow_schema(T.StructType([*[rows.schema[c] for c in by], *[T.StructField(n, k) for n, k in kinds.items()]])).empty_table()
        answers = taken.applyInArrow(lambda r: block_answers(r, none.cast(pa.schema([r.schema.field(f.name) if f.name in by else f for f in none.schema])), *args), made)
    new = [F.col(f"_a{i}").alias(n) for i, n in enumerate([*quantiles, *([rank] if rank else [])])]
    return answers.select(*given, *new)


def _before_blocks(rows: DataFrame, edges: DataFrame, by: list[str], quantiles: list[float], wide: int) -> DataFrame:
    """What each block of a long key has to know of the rows before it."""
    piece = F.floor((F.col("_pos") - 1) * PIECES / wide).cast("long")
    parts = rows.groupBy(*by, "_block", piece.alias("_piece")).agg(F.min("_n").alias("_from"), F.max("_n").alias("_to"))
    there = rows.filter(F.col("_code").isNotNull()).groupBy(*by, piece.alias("_piece"), "_range").agg(F.count(F.lit(1)).alias("_here"))
    every = join_null_safe(parts, edges.select(*by, F.explode(F.sequence(F.lit(0), 2 * F.size("_edges"))).alias("_range")), by)
    cells = settle(join_null_safe(every, there, [*by, "_piece", "_range"], "left").withColumn("_here", F.coalesce("_here", F.lit(0))))
    # Counts added up over the pieces before, for each range, and then over the ranges, for each piece.
    whole = F.lit(0).cast("long")
    before = running(cells.withColumn("_node", F.col("_range")), Series([*by, "_node"], ["_piece"], whole), {"_before": ("sum", F.col("_here"))}).withColumn("_before", F.col("_before") - F.col("_here"))
    before = settle(before.withColumn("_node", F.col("_piece")))
    upto = running(before, Series([*by, "_node"], ["_range"], whole), {"_start": ("sum", F.col("_before")), "_end": ("sum", F.col("_before") + F.col("_here"))})
    first, last = F.greatest("_from", F.lit(1)) - 1, F.col("_to") - 1
    met = F.lit(False)
    for q in quantiles:
        met |= (F.col("_end") > F.floor(first * F.lit(q))) & (F.col("_start") - F.col("_before") <= F.least(F.floor(last * F.lit(q)) + 1, last))
    states = upto.groupBy(*by, "_block", "_range").agg(F.min("_before").alias("_weight"), (F.max(met) & (F.col("_range") % 2 == 0)).alias("_wanted"))
    states = settle(states.filter(F.col("_weight") > 0))
    own = F.get("_edges", ((F.col("_range") - 1) / 2).cast("int"))
    counts = join_null_safe(states.filter("NOT _wanted"), edges, by).select(*by, "_block", "_range", F.when(F.col("_range") % 2 == 1, own).alias("_code"), "_weight")
    wanted = states.filter("_wanted").select(*by, "_range", F.col("_block").alias("_for"))
    inside = rows.filter("_inside").select(*by, "_block", "_range", "_n", "_code")
    values = join_null_safe(inside, wanted, [*by, "_range"]).filter(F.col("_block") < F.col("_for")).select(*by, F.col("_for").alias("_block"), "_range", "_code", F.lit(1).cast("long").alias("_weight"))
    kinds = T.StructType([*[rows.schema[c] for c in [*by, "_block", "_n"]], T.StructField("_less", T.LongType()), T.StructField("_same", T.LongType())])
    ranked = inside.select(*kinds.names[:-2], "_range", "_code").groupBy(*by, "_range").applyInArrow(within_range, kinds)
    return counts.unionByName(values).unionByName(ranked, allowMissingColumns=True).withColumn("_group", F.xxhash64(*by, "_block"))


# Cumulative and neighbours


def cumulative(df: DataFrame, series: Series, col: str, kinds: dict[str, str]) -> DataFrame:
    """``{"cumsum": "sum"}``; a NULL row stays NULL and does not end the run."""
    rows = running(df, series, {n: (k, F.col(col)) for n, k in kinds.items()})
    return rows.withColumns({n: F.when(F.col(col).isNotNull(), F.col(n)) for n in kinds})


def shifts(df: DataFrame, series: Series, moves: dict[str, tuple[str, int] | tuple[str, int, object]], *, block: int = 65536) -> DataFrame:
    """Values some rows earlier (later when negative), several at once: ``{"back": ("value", 2)}``, with a fill as third item.

    All share one numbering and one frame.
    """
    steps = [m[1] for m in moves.values()]
    frame = row_frame(df, series, before=max(0, *steps), after=max(0, *[-n for n in steps]), block=block)

    def moved(col: str, n: int, fill=None) -> Column:
        return F.lag(col, n, fill).over(frame.window()) if n >= 0 else F.lead(col, -n, fill).over(frame.window())

    return frame.close(frame.rows.select("*", *[moved(*m).alias(name) for name, m in moves.items()]))


def shift(df: DataFrame, series: Series, col: str, n: int, name: str, fill=None, *, block: int = 65536) -> DataFrame:
    """The value ``n`` rows earlier (later when negative)."""
    return shifts(df, series, {name: (col, n, fill)}, block=block)


def difference(df: DataFrame, series: Series, col: str, n: int = 1, name: str = "diff") -> DataFrame:
    return shift(df, series, col, n, "_s").withColumn(name, F.col(col) - F.col("_s")).drop("_s")


def percent_change(df: DataFrame, series: Series, col: str, n: int = 1, name: str = "pct_change") -> DataFrame:
    return shift(df, series, col, n, "_s").withColumn(name, F.try_divide(F.col(col), F.col("_s")) - 1).drop("_s")


def head(df: DataFrame, series: Series, n: int) -> DataFrame:
    """First ``n`` rows of each key; a negative n leaves out the last -n."""
    if n >= 0 and series.by:
        return first_rows(df, series.by, series.sort(), n).drop("_p")
    if n >= 0:
        return position(df, series, "_p").filter(F.col("_p") <= n).drop("_p")
    return position(df, series.reversed(), "_p").filter(F.col("_p") > -n).drop("_p")


def tail(df: DataFrame, series: Series, n: int) -> DataFrame:
    return head(df, series.reversed(), n)


def rows_between(df: DataFrame, series: Series, start: int, stop: int, step: int = 1) -> DataFrame:
    """Rows start..stop-1 of each key, from 0."""
    p = F.col("_p") - 1
    return position(df, series, "_p").filter((p >= start) & (p < stop) & ((p - start) % step == 0)).drop("_p")


def autocorrelation(df: DataFrame, series: Series, col: str, lag: int) -> DataFrame:
    return shift(df, series, col, lag, "_s").groupBy(*series.by).agg(correlation(col, "_s").alias("autocorr"))


def trapezoid(df: DataFrame, series: Series, x: str, y: str) -> DataFrame:
    """Area under y over x, per key."""
    frame = row_frame(df, series, before=1)
    w = frame.window()
    step = (F.col(x) - F.lag(x).over(w)) * (F.col(y) + F.lag(y).over(w)) / 2
    return frame.close(frame.rows.withColumn("_a", step)).groupBy(*series.by).agg(F.sum("_a").alias("area"))


def gradient(df: DataFrame, series: Series, x: str, y: str, name: str = "gradient") -> DataFrame:
    """Slope of y over x: second order inside, one-sided at the ends, uneven steps allowed."""
    frame = row_frame(df, series, before=1, after=1)
    w = frame.window()
    back, ahead = F.col(x) - F.lag(x).over(w), F.lead(x).over(w) - F.col(x)
    before, after = F.lag(y).over(w), F.lead(y).over(w)
    left, right = F.try_divide(F.col(y) - before, back), F.try_divide(after - F.col(y), ahead)
    inside = F.try_divide(ahead * left + back * right, back + ahead)
    value = F.when(back.isNull(), right).when(ahead.isNull(), left).otherwise(inside)
    return frame.close(frame.rows.withColumn(name, value))


# Exponentially weighted

NATS = 40.0  # decay within a block; its inverse weights stay within double precision
BLOCKS = 18  # blocks after which a weight is below the smallest number of double precision


def decay_rate(*, com: float | None = None, span: float | None = None, halflife: float | None = None, alpha: float | None = None) -> float:
    """Smoothing factor from exactly one of the four."""
    if sum(v is not None for v in (com, span, halflife, alpha)) != 1:
        raise ValueError("give exactly one of com, span, halflife, alpha")
    if com is not None:
        if com < 0:
            raise ValueError("com must be at least 0")
        return 1 / (1 + com)
    if span is not None:
        if span < 1:
            raise ValueError("span must be at least 1")
        return 2 / (span + 1)
    if halflife is not None:
        if halflife <= 0:
            raise ValueError("halflife must be above 0")
        return 1 - math.exp(-math.log(2) / halflife)
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    return alpha


def decayed_sums(df: DataFrame, series: Series, decay: Column, sums: dict[str, tuple[Column, float]]) -> DataFrame:
    """For each row the sum over earlier rows and itself of ``value * exp(-rate * (decay - decay_i))``.

    ``decay`` grows along the series, in nats; ``sums`` gives value and rate.  Rows are cut where the decay passes a multiple of NATS,
    and a block again by the series' bucket, however slow the decay.  A piece is handed, as its head row, the sums of the
    pieces before it in its block, and of all earlier blocks, aged.
    """
    block, keys = [*series.by, "_blk"], [*series.by, "_blk", "_b"]
    rows = (
        df.withColumn("_b", series.bucket).withColumn("_d", decay).withColumn("_blk", F.floor(F.col("_d") / NATS)).withColumn("_d", F.col("_d") - F.col("_blk") * NATS)
    )
    pieces = rows.groupBy(*keys).agg(*[F.sum(v * F.exp(F.lit(r) * F.col("_d"))).alias(f"_s_{n}") for n, (v, r) in sums.items()])
    earlier = W.partitionBy(*block).orderBy(series.bucket_sort()).rowsBetween(W.unboundedPreceding, -1)
    inside = pieces.select(*keys, *[F.sum(f"_s_{n}").over(earlier).alias(f"_i_{n}") for n in sums])
    later = (
        pieces.groupBy(*block).agg(*[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in sums])
        .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(BLOCKS))))
        .select(*series.by, (F.col("_blk") + F.col("_k")).alias("_blk"), *[(F.col(f"_s_{n}") * F.exp(F.lit(-r * NATS) * F.col("_k"))).alias(f"_s_{n}") for n, (_, r) in sums.items()])
        .groupBy(*block).agg(*[F.sum(f"_s_{n}").alias(f"_e_{n}") for n in sums])
    )
    zero = F.lit(0.0)
    heads = join_null_safe(inside, later, block, "left").select(*keys, *[(F.coalesce(f"_i_{n}", zero) + F.coalesce(f"_e_{n}", zero)).alias(f"_t_{n}") for n in sums])
    both = with_heads(rows, heads)
    scan = W.partitionBy(*keys).orderBy("_head", *series.sort()).rowsBetween(W.unboundedPreceding, 0)
    here = F.coalesce(F.col("_d"), zero)

    def aged(name: str, value: Column, rate: float) -> Column:
        grown = F.sum(F.when(F.col("_head") == 1, value) * F.exp(F.lit(rate) * here)).over(scan)
        return (F.coalesce(grown, zero) + F.first(f"_t_{name}").over(scan)) * F.exp(F.lit(-rate) * here)

    out = both.select(*df.columns, *[aged(n, v, r).alias(n) for n, (v, r) in sums.items()], "_head")
    return out.filter(F.col("_head") == 1).drop("_head")


def ewm(
    df: DataFrame, series: Series, col: str, outputs: list[str], *, alpha: float | None = None, adjust: bool = True,
    ignore_na: bool = False, halflife_time: str | None = None, ts: str | None = None, other: str | None = None,
    min_periods: int = 1, bias: bool = False,
) -> DataFrame:
    """Exponentially weighted mean, sum, var, std, and with ``other`` cov and corr.

    NULL rows repeat the last result.  With ``ignore_na`` they do not age the weights.  With
    ``halflife_time`` weights age by time, not by row.
    """
    if halflife_time is not None and not adjust:
        raise ValueError("a half-life in time needs adjust=True")
    if halflife_time is None and not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    by = series.by
    both = F.col(col).isNotNull() if other is None else F.col(col).isNotNull() & F.col(other).isNotNull()
    if alpha == 1 and halflife_time is None:
        return _last_value_only(df, series, col, outputs, both, min_periods, bias)
    if set(outputs) <= {"mean", "sum"}:
        base = df.withColumn("_mx", F.lit(0.0))
    else:  # second moments are taken about the key's mean, for accuracy
        means = {"_mx": F.avg(F.when(both, F.col(col)))}
        base = settle(transform_groups(df, by, means | ({"_my": F.avg(F.when(both, F.col(other)))} if other else {})))
    counted = settle(running(base, series, {"_all": ("count", F.lit(1)), "_ok": ("count", F.when(both, 1))}))
    present = counted.filter(both)
    if halflife_time is not None:
        per_micro = math.log(2) / span_micros(halflife_time)
        decay = F.unix_micros(F.col(ts).cast("timestamp")) * F.lit(per_micro)
    else:
        decay = F.col("_ok" if ignore_na else "_all") * F.lit(-math.log1p(-alpha))
    if adjust:
        weight = F.lit(1.0)
    elif ignore_na or halflife_time is not None:
        weight = F.when(F.col("_ok") == 1, 1.0).otherwise(alpha)
    else:
        # A gap of k rows weighs the old mean (1-alpha)^k against alpha.  Scaled to a weight of one
        # for each new mean, that is a further, row-dependent ageing.
        present, decay, weight = _gap_ageing(present, series, alpha)
    x = F.col(col) - F.col("_mx")
    sums = {"_w": (weight, 1.0), "_wx": (weight * x, 1.0)}
    if {"var", "std", "corr"} & set(outputs):
        sums["_wxx"] = (weight * x * x, 1.0)
    if {"var", "std", "cov", "corr"} & set(outputs):
        sums["_ww"] = (weight * weight, 2.0)
    if other is not None:
        y = F.col(other) - F.col("_my")
        sums |= {"_wy": (weight * y, 1.0), "_wxy": (weight * x * y, 1.0), "_wyy": (weight * y * y, 1.0)}
    s = decayed_sums(present, series, decay, sums)
    c, w = F.col, F.col("_w")
    mean = c("_wx") / w
    unbias = F.lit(1.0) if bias else F.when(w * w - c("_ww") > 1e-12 * w * w, w * w / (w * w - c("_ww")))
    made = {"mean": mean + c("_mx"), "sum": c("_wx") + c("_mx") * w}
    if "_wxx" in sums:
        vx = F.greatest(c("_wxx") / w - mean**2, F.lit(0.0))
        if "_ww" in sums:
            made["var"] = vx * unbias
            made["std"] = F.sqrt(made["var"])
    if other is not None:
        my = c("_wy") / w
        cov = c("_wxy") / w - mean * my
        made["cov"] = cov * unbias if "_ww" in sums else None
        if "_wxx" in sums:
            vy = F.greatest(c("_wyy") / w - my**2, F.lit(0.0))
            # A variance below the rounding error of its terms is that of equal values.
            spread = (vx > 1e-13 * c("_wxx") / w) & (vy > 1e-13 * c("_wyy") / w)
            made["corr"] = F.when((c("_ok") > 1) & spread, F.try_divide(cov, F.sqrt(vx * vy)))
    made = {n: F.when(c("_ok") >= min_periods, made[n]).alias(n) for n in outputs}
    results = s.select(*df.columns, *made.values())
    # NULL rows take the last result before them.
    gaps = counted.filter(~both).select(*df.columns, *[F.lit(None).cast("double").alias(n) for n in outputs])
    return running(settle(results.unionByName(gaps)), series, {n: ("last", F.col(n)) for n in outputs})


def _gap_ageing(present: DataFrame, series: Series, alpha: float):
    moved = shift(present, series, "_all", 1, "_before")
    k = F.col("_all") - F.col("_before")
    log_old = k * F.lit(math.log1p(-alpha))
    old = F.exp(log_old)
    # ln((old + alpha) / old) is what this row adds to the age of all earlier ones; old itself may be below the least double.
    rows = moved.withColumn("_age", F.coalesce(F.log(old + alpha) - log_old, F.lit(0.0)))
    rows = rows.withColumn("_share", F.coalesce(F.lit(alpha) / (old + alpha), F.lit(1.0)))
    rows = settle(running(settle(rows), series, {"_aged": ("sum", F.col("_age"))}))
    return rows, F.col("_aged"), F.col("_share")


def _last_value_only(df: DataFrame, series: Series, col: str, outputs: list[str], both: Column, min_periods: int, bias: bool) -> DataFrame:
    """Smoothing by a factor of one: a result is that of the last row alone."""
    counted = settle(running(df, series, {"_ok": ("count", F.when(both, 1))}))
    one = {"mean": F.col(col).cast("double"), "sum": F.col(col).cast("double"), "corr": F.lit(None).cast("double")}
    none = F.lit(0.0) if bias else F.lit(None).cast("double")
    ready = both & (F.col("_ok") >= min_periods)
    rows = counted.withColumns({n: F.when(ready, one.get(n, none)) for n in outputs}).drop("_ok")
    return running(settle(rows), series, {n: ("last", F.col(n)) for n in outputs})
