"""Grouped aggregation."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardflow.operators.group_streams import GroupFunction, over_groups
from wardflow.operators.keys import join_null_safe, with_one_row
from wardflow.operators.ordered import Series, dealt, edges_below, first_rows, position
from wardflow.operators.ranks import quantiles, ranks
from wardflow.session import settle


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_min_count(result: Column, col: Column | str, min_count: int) -> Column:
    """NULL when fewer than ``min_count`` values are there."""
    return F.when(F.count(_c(col)) >= min_count, result)


def sum_of(col, min_count: int = 0) -> Column:
    """The sum of nothing is 0 unless ``min_count`` asks for values."""
    return with_min_count(F.coalesce(F.sum(_c(col)), F.lit(0)), col, min_count)


def product_of(col, min_count: int = 0) -> Column:
    return with_min_count(F.coalesce(F.product(_c(col)), F.lit(1.0)), col, min_count)


def variance(col, ddof: int = 1) -> Column:
    n = F.count(_c(col))
    return F.when(n > ddof, F.var_pop(_c(col)) * n / (n - ddof))


def std(col, ddof: int = 1) -> Column:
    return F.sqrt(variance(col, ddof))


def sem(col, ddof: int = 1) -> Column:
    return std(col, ddof) / F.sqrt(F.count(_c(col)))


def unbiased_skew(skew: Column, n: Column) -> Column:
    """Population skewness to the bias-corrected one; needs three values."""
    return F.when(n >= 3, skew * F.sqrt(n * (n - 1)) / (n - 2))


def unbiased_kurtosis(kurt: Column, n: Column) -> Column:
    """Population excess kurtosis to the bias-corrected one; needs four values."""
    return F.when(n >= 4, ((n + 1) * kurt + 6) * (n - 1) / ((n - 2) * (n - 3)))


def skew(col) -> Column:
    return unbiased_skew(F.skewness(_c(col)), F.count(_c(col)))


def kurtosis(col) -> Column:
    return unbiased_kurtosis(F.kurtosis(_c(col)), F.count(_c(col)))


def first_by(col, order: list[str]) -> Column:
    return F.min_by(_c(col), F.when(_c(col).isNotNull(), F.struct(*order)))


def last_by(col, order: list[str]) -> Column:
    return F.max_by(_c(col), F.when(_c(col).isNotNull(), F.struct(*order)))


def label_of_min(label: str, col: str, ties: list[str]) -> Column:
    """The label of the smallest value; the first of equal ones."""
    return F.min_by(label, F.when(F.col(col).isNotNull(), F.struct(col, *ties)))


def label_of_max(label: str, col: str, ties: list[str]) -> Column:
    return F.min_by(label, F.when(F.col(col).isNotNull(), F.struct((-F.col(col)).alias("_neg"), *ties)))


def ohlc(col: str, order: list[str]) -> list[Column]:
    return [
        first_by(col, order).alias("open"), F.max(col).alias("high"), F.min(col).alias("low"), last_by(col, order).alias("close"),
    ]


def weighted_mean(col: str, weight: str) -> Column:
    used = F.when(F.col(col).isNotNull(), F.col(weight))
    return F.sum(F.col(col) * F.col(weight)) / F.sum(used)


def correlation(x: str, y: str, over: Callable[[Column], Column] = lambda c: c) -> Column:
    """Correlation over rows that have both values: NaN where one of them does not vary, NULL for fewer than two rows.  ``over`` puts each aggregate over a window."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    spread = over(F.stddev_pop(F.when(both, a))) * over(F.stddev_pop(F.when(both, b)))
    return F.when(over(F.count(F.when(both, 1))) > 1, F.coalesce(F.try_divide(over(F.covar_pop(a, b)), spread), F.lit(float("nan"))))


def straight_line(y: str, x: str) -> list[Column]:
    return [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")]


def nth(df: DataFrame, series: Series, n: int) -> DataFrame:
    """The n-th row of each group, from 0; negative counts from the end."""
    order = series if n >= 0 else series.reversed()
    want = n + 1 if n >= 0 else -n
    found = first_rows(df, series.by, order.sort(), want, "_nth") if series.by else position(df, order, "_nth")
    return found.filter(F.col("_nth") == want).drop("_nth")


def value_shares(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Count and share of each value within its group."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(*by).agg(F.sum("count").alias("_total"))
    return join_null_safe(counts, totals, by).withColumn("proportion", F.col("count") / F.col("_total")).drop("_total")


def transform_groups(df: DataFrame, by: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Group results on every row, as an aggregate joined back.

    Unlike a window, the aggregate combines map-side and the join may split a large group.
    """
    results = df.groupBy(*by).agg(*[a.alias(n) for n, a in aggs.items()])
    return join_null_safe(df, results, by)


def keep_groups(df: DataFrame, by: list[str], condition: Column) -> DataFrame:
    """All rows of the groups for which an aggregate condition holds."""
    kept = df.groupBy(*by).agg(condition.alias("_keep")).filter("_keep").select(*by)
    return join_null_safe(df, kept, by, "left_semi")


def group_numbers(df: DataFrame, keys: str | list[str], name: str = "ngroup") -> DataFrame:
    """0-based number of the group in the order of one or several keys."""
    keys = [keys] if isinstance(keys, str) else keys
    rows, series = dealt(df.select(*keys).distinct(), [], keys)
    numbered = position(rows, series, name).withColumn(name, F.col(name) - 1).drop("_vb")
    return join_null_safe(df, numbered, keys)


def apply_groups(
    df: DataFrame, by: list[str], partial: Callable[[pd.DataFrame], dict], partial_schema: str, combine: list[Column]
) -> DataFrame:
    """An own function per group, as partial results that Spark combines.

    ``partial`` sees the rows of one group in one batch of rows, and returns one row of figures;
    ``combine`` are aggregates over those.  Rows are not shuffled, and a batch has a bounded size
    however large its group is.
    """
    fields = [f"{c} {df.schema[c].dataType.simpleString()}" for c in by]
    columns = [c.strip().split(" ")[0] for c in partial_schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{**dict(zip(by, key)), **partial(part)} for key, part in pdf.groupby(by, dropna=False)]
            yield pd.DataFrame(rows, columns=[*by, *columns])

    return df.mapInPandas(run, ", ".join([*fields, partial_schema])).groupBy(*by).agg(*combine)


def apply_whole_groups(df: DataFrame, by: list[str], order: list[str], fn: GroupFunction, schema: str) -> DataFrame:
    """An own function of each whole group, in order.

    ``fn`` gets the group's key and its rows as an iterator of pandas batches, ordered by ``order``, and returns a frame or yields frames of the columns of ``schema``, to which the key
    is added.  A group is never held as a whole: one batch at a time is in memory, so a function that keeps little needs little, however large the group.
    It is read by one task, as its order demands; ``apply_groups`` spreads a group over tasks where partial results will do.
    """
    out = T.StructType([*[df.schema[c] for c in by], *T.StructType.fromDDL(schema).fields])
    numbered = df.withColumn("_nr", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return numbered.mapInArrow(over_groups(fn, by, "_nr", to_arrow_schema(out)), out)


def spearman(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Correlation of average ranks over rows that have both values."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = ranks(settle(ranks(both, by, x, "_rx")), by, y, "_ry")
    return ranked.groupBy(*by).agg(correlation("_rx", "_ry").alias("spearman"))


def describe_numbers(df: DataFrame, col: str) -> DataFrame:
    quartiles = quantiles(df, [], col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    stats = df.agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), std(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max")
    )
    return with_one_row(stats, quartiles).select("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_text(df: DataFrame, col: str) -> DataFrame:
    """Count, distinct values, most frequent one (smallest of equals) and its count."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.sum("_n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(col, F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))).alias("top"), F.max("_n").alias("freq"),
    )


def describe_times(df: DataFrame, col: str) -> DataFrame:
    us = df.select(F.unix_micros(F.col(col).cast("timestamp")).alias("_us"))
    quartiles = quantiles(us, [], "_us", {"q25": 0.25, "q50": 0.5, "q75": 0.75})

    def clock(name: str) -> Column:
        return F.timestamp_micros(F.floor(F.col(name)).cast("bigint")).cast("timestamp_ntz").alias(name)

    stats = us.agg(F.count("_us").alias("count"), F.avg("_us").alias("mean"), F.min("_us").alias("min"), F.max("_us").alias("max"))
    both = with_one_row(stats, quartiles)
    return both.select("count", *[clock(n) for n in ["mean", "min", "q25", "q50", "q75", "max"]])


def categories_with_zero(df: DataFrame, by: list[str], category: str, values: list) -> DataFrame:
    """Counts by group for every listed category, absent ones as zero."""
    listed = F.array(*[F.lit(v) for v in values])
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(category) == v).alias(f"_{i}") for i, v in enumerate(values)])
    pairs = F.arrays_zip(listed.alias("v"), F.array(*[F.col(f"_{i}") for i in range(len(values))]).alias("n"))
    return counts.select(*by, F.explode(pairs).alias("p")).select(
        *by, F.col("p.v").alias(category), F.col("p.n").alias("count")
    )


# Histograms


def _stats(df: DataFrame, col: str, with_iqr: bool) -> dict:
    """One row of statistics on the driver."""
    aggs = [
        F.count(col).alias("n"), F.min(col).cast("double").alias("low"), F.max(col).cast("double").alias("high"),
        F.stddev_pop(col).alias("sd"), F.skewness(col).alias("skew"),
    ]
    out = df.agg(*aggs).first().asDict()
    if with_iqr:
        q = quantiles(df, [], col, {"a": 0.25, "b": 0.75}).first()
        out["iqr"] = q["b"] - q["a"]
    return out


def bin_width(rule: str, s: dict) -> float:
    n, spread = s["n"], s["high"] - s["low"]
    if rule == "sqrt":
        return spread / math.sqrt(n)
    if rule == "sturges":
        return spread / (math.log2(n) + 1)
    if rule == "rice":
        return spread / (2 * n ** (1 / 3))
    if rule == "scott":
        return (24 * math.sqrt(math.pi) / n) ** (1 / 3) * s["sd"]
    if rule == "doane":
        if n <= 2 or not s["sd"]:
            return 0.0
        error = math.sqrt(6 * (n - 2) / ((n + 1) * (n + 3)))
        return spread / (1 + math.log2(n) + math.log2(1 + abs(s["skew"]) / error))
    if rule == "fd":
        return 2 * s["iqr"] / n ** (1 / 3)
    if rule == "auto":
        fd, sturges = bin_width("fd", s), bin_width("sturges", s)
        return min(fd, sturges) if fd else sturges
    raise ValueError(rule)


@dataclass(frozen=True)
class EqualBins:
    """Bins of equal width; an edge follows from its number, so no list is needed however many there are."""

    low: float
    high: float
    bins: int

    def edge(self, number: Column) -> Column:
        return F.when(number == self.bins, F.lit(self.high)).otherwise(F.lit(self.low) + number * F.lit((self.high - self.low) / self.bins))

    def number(self, col: str) -> Column:
        """The bin by arithmetic, moved by one where rounding put the value beyond the bin's own edges."""
        x = F.col(col).cast("double")
        guess = F.least(F.floor((x - self.low) / F.lit(self.high - self.low) * self.bins), F.lit(self.bins - 1))
        moved = guess - F.when(x < self.edge(guess), 1).otherwise(0) + F.when((x >= self.edge(guess + 1)) & (guess < self.bins - 1), 1).otherwise(0)
        return F.when(x.between(self.low, self.high), moved)


def bin_edges(df: DataFrame, col: str, rule: str | int) -> EqualBins:
    """Bins by a rule or of a given number; one pass over the column."""
    s = _stats(df, col, with_iqr=rule in ("fd", "auto"))
    if isinstance(rule, int):
        bins = rule
    else:
        width = bin_width(rule, s)
        bins = max(1, math.ceil((s["high"] - s["low"]) / width)) if width else 1
    low, high = s["low"], s["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    return EqualBins(float(low), float(high), bins)


def bin_number(col: str, edges: list[float] | EqualBins) -> Column:
    """0-based bin, closed on the left, the last one on both sides; NULL outside."""
    if isinstance(edges, EqualBins):
        return edges.number(col)
    edges = [float(e) for e in edges]
    inside = F.col(col).between(edges[0], edges[-1])
    return F.when(inside, edges_below(col, edges[1:-1]))


def histogram(df: DataFrame, col: str, edges: list[float] | EqualBins, *, by: list[str] = (), weight: str | None = None, density: bool = False) -> DataFrame:
    """One row per non-empty bin: number, edges, and count, weight or density."""
    w = F.col(weight) if weight else F.lit(1)
    counts = (
        df.withColumn("bin", bin_number(col, edges))
        .filter(F.col("bin").isNotNull())
        .groupBy(*by, "bin")
        .agg(F.sum(w).alias("count"))
    )
    if isinstance(edges, EqualBins):
        out = counts.withColumns({"low": edges.edge(F.col("bin")), "high": edges.edge(F.col("bin") + 1)})
    else:
        array = F.lit(np.array(edges, float))
        out = counts.withColumns({"low": F.element_at(array, F.col("bin") + 1), "high": F.element_at(array, F.col("bin") + 2)})
    if density:
        totals = counts.groupBy(*by).agg(F.sum("count").alias("_t"))
        out = join_null_safe(out, totals, by) if by else with_one_row(out, totals)
        out = out.withColumn("density", F.col("count") / F.col("_t") / (F.col("high") - F.col("low"))).drop("_t")
    return out


def histogram_nd(df: DataFrame, edges: dict[str, list[float]], weight: str | None = None) -> DataFrame:
    """Counts over the bins of several columns."""
    bins = {f"{c}_bin": bin_number(c, e) for c, e in edges.items()}
    present = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in bins])
    return df.withColumns(bins).filter(present).groupBy(*bins).agg(F.sum(F.col(weight) if weight else F.lit(1)).alias("count"))
