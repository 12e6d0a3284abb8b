"""Ranks and quantiles inside groups of any size.

Equal values are counted first (map-side combined).  The distinct values are then dealt by ranges and
scanned with ``running``, so no group is ever in one task.  Any orderable type will do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.keys import join_null_safe, with_one_row
from wardflow.operators.ordered import Series, dealt, position, running


def value_counts(df: DataFrame, by: list[str], col: str, *, ascending: bool = True) -> tuple[DataFrame, Series]:
    """Distinct non-NULL values per group with ``_n`` copies, counted once and written, and their series."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    return dealt(counts, by, [col], descending=not ascending)


def value_counts_running(df: DataFrame, by: list[str], col: str, *, ascending: bool = True) -> DataFrame:
    """Distinct non-NULL values per group: ``_n`` copies, ``_cum`` rows and ``_distinct`` values up to it."""
    counts, series = value_counts(df, by, col, ascending=ascending)
    return running(counts, series, {"_cum": ("sum", F.col("_n")), "_distinct": ("count", F.lit(1))}).drop("_vb")


def ranks(
    df: DataFrame, by: list[str], col: str, name: str = "rank", *, method: str = "average", ascending: bool = True,
    pct: bool = False, nulls: str = "keep", ties: list[str] = (),
) -> DataFrame:
    """Rank within the group: average, min, max, first or dense.

    ``nulls``: keep gives NULL; top and bottom rank NULLs together before or after all values.
    ``first`` breaks ties by the ``ties`` columns.
    """
    if method == "first":
        rows, series = dealt(df.filter(F.col(col).isNotNull()), by, [col, *ties], descending=not ascending)
        numbered = position(rows, series, "_r").drop("_vb")
        rest = df.filter(F.col(col).isNull()).withColumn("_r", F.lit(None).cast("long"))
        out = numbered.unionByName(rest).withColumn("_r", F.col("_r").cast("double"))
    else:
        scan = value_counts_running(df, by, col, ascending=ascending)
        lower, upper = F.col("_cum") - F.col("_n") + 1, F.col("_cum")
        value = {"min": lower, "max": upper, "average": (lower + upper) / 2, "dense": F.col("_distinct")}[method]
        table = scan.select(*by, col, value.cast("double").alias("_r"))
        out = join_null_safe(df, table, [*by, col], "left")
    if nulls != "keep" or pct:
        sizes = df.groupBy(*by).agg(
            F.count(col).cast("double").alias("_present"),
            F.count_if(F.col(col).isNull()).cast("double").alias("_nulls"),
            F.count_distinct(col).cast("double").alias("_values"),
        )
        out = join_null_safe(out, sizes, by) if by else with_one_row(out, sizes)
    if nulls != "keep":
        missing = F.when(F.col("_nulls") > 0, 1).otherwise(0)
        block = {"min": F.lit(1.0), "max": F.col("_nulls"), "average": (F.col("_nulls") + 1) / 2, "dense": F.lit(1.0)}[method]
        count = F.col("_values") if method == "dense" else F.col("_present")
        if nulls == "top":
            before = missing if method == "dense" else F.col("_nulls")
            out = out.withColumn("_r", F.coalesce(F.col("_r") + before, block))
        else:
            out = out.withColumn("_r", F.coalesce(F.col("_r"), count + block))
    if pct:
        base = F.col("_values") if method == "dense" else F.col("_present")
        if nulls != "keep":
            base = base + (F.when(F.col("_nulls") > 0, 1).otherwise(0) if method == "dense" else F.col("_nulls"))
        out = out.withColumn("_r", F.col("_r") / base)
    return out.withColumnRenamed("_r", name).drop("_present", "_nulls", "_values")


def _index_weights(interpolation: str, h: Column):
    """Lower index, upper index and weight of the upper one."""
    low, high = F.floor(h), F.ceil(h)
    if interpolation == "linear":
        return low, high, h - low
    if interpolation == "lower":
        return low, low, F.lit(0.0)
    if interpolation == "higher":
        return high, high, F.lit(0.0)
    if interpolation == "midpoint":
        return low, high, F.when(low == high, 0.0).otherwise(0.5)
    if interpolation == "nearest":  # half to even, as in numpy
        near = F.bround(h, 0).cast("bigint")
        return near, near, F.lit(0.0)
    raise ValueError(interpolation)


def quantiles(df: DataFrame, by: list[str], col: str, qs: dict[str, float], *, interpolation: str = "linear") -> DataFrame:
    """Exact quantiles per group, ``{"p90": 0.9}``; NULLs are left out."""
    counts, series = value_counts(df, by, col)
    scan = running(counts, series, {"_cum": ("sum", F.col("_n"))})
    sizes = counts.groupBy(*by).agg(F.sum("_n").alias("_size"))
    rows = join_null_safe(scan, sizes, by) if by else with_one_row(scan, sizes)
    aggs, outs = [], []
    for name, q in qs.items():
        h = (F.col("_size") - 1) * F.lit(float(q))
        low, high, weight = _index_weights(interpolation, h)
        at_low = (low >= F.col("_cum") - F.col("_n")) & (low < F.col("_cum"))
        at_high = (high >= F.col("_cum") - F.col("_n")) & (high < F.col("_cum"))
        value = F.col(col).cast("double")
        aggs += [
            F.max(F.when(at_low, value)).alias(f"_l_{name}"),
            F.max(F.when(at_high, value)).alias(f"_h_{name}"),
            F.max(weight).alias(f"_w_{name}"),
        ]
        outs.append((F.col(f"_l_{name}") + (F.col(f"_h_{name}") - F.col(f"_l_{name}")) * F.col(f"_w_{name}")).alias(name))
    grouped = rows.groupBy(*by).agg(*aggs)
    return grouped.select(*by, *outs)


def median(df: DataFrame, by: list[str], col: str, name: str = "median") -> DataFrame:
    return quantiles(df, by, col, {name: 0.5})

