"""Order, top-n, sampling, value sets and lookups in sorted edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wardflow.operators.keys import join_null_safe, with_one_row
from wardflow.operators.ordered import Series, dealt, edges_below, first_rows, position
from wardflow.operators.ranks import value_counts_running
from wardflow.session import settle


def sort_order(keys: list[tuple[str, bool]], ties: list[str], *, nulls_last: bool = True, key: dict[str, Column] | None = None) -> list[Column]:
    """Sort columns of ``(column, ascending)`` pairs; ``ties`` make the order total, so it is stable."""
    order = []
    for name, ascending in keys:
        col = (key or {}).get(name, F.col(name))
        if ascending:
            order.append(col.asc_nulls_last() if nulls_last else col.asc_nulls_first())
        else:
            order.append(col.desc_nulls_last() if nulls_last else col.desc_nulls_first())
    return [*order, *[F.col(c) for c in ties]]


def sort_rows(df: DataFrame, keys: list[tuple[str, bool]], ties: list[str], **options) -> DataFrame:
    return df.orderBy(*sort_order(keys, ties, **options))


def sorted_positions(df: DataFrame, keys: list[tuple[str, bool]], ties: list[str], name: str = "place", **options) -> DataFrame:
    """Every row with its 1-based place in the whole sorted table.

    The rows are dealt by ranges of the order; a range numbers its own rows and adds the sizes of the ranges before it.
    """
    order = sort_order(keys, ties, **options)
    rows = settle(df.repartitionByRange(*order).withColumn("_vb", F.spark_partition_id()))
    sizes = rows.groupBy("_vb").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_vb", F.coalesce(F.sum("_n").over(W.orderBy("_vb").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = rows.withColumn(name, F.row_number().over(W.partitionBy("_vb").orderBy(*order)))
    return numbered.join(before, "_vb").withColumn(name, F.col(name) + F.col("_before")).drop("_vb", "_before")


def n_largest(df: DataFrame, n: int, col: str, ties: list[str], *, keep: str = "first", smallest: bool = False) -> DataFrame:
    """The n rows with the largest (smallest) values.

    ``keep`` first or last decides between equal values by ``ties``; all keeps every row as
    good as the n-th.  Each task hands on its own n rows at most.
    """
    rows = df.filter(F.col(col).isNotNull())
    value = F.col(col).asc() if smallest else F.col(col).desc()
    if keep != "all":
        return rows.orderBy(value, *[F.col(c).asc() if keep == "first" else F.col(c).desc() for c in ties]).limit(n)
    top = rows.select(col).orderBy(value).limit(n)
    edge = top.agg((F.max(col) if smallest else F.min(col)).alias("_edge"))
    good = F.col(col) <= F.col("_edge") if smallest else F.col(col) >= F.col("_edge")
    return with_one_row(rows, edge).filter(good).drop("_edge")


# Sampling.  The random number of a row comes from its key and the seed, so a rerun, a lost
# executor or another partitioning give the same sample.


def uniform(keys: list[str], seed: str) -> Column:
    """A number in [0, 1) from a row's key."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def sample_fraction(df: DataFrame, fraction: float, keys: list[str], seed: str) -> DataFrame:
    return df.filter(uniform(keys, seed) < fraction)


CELLS = 4096
#: Rows that may be sorted by one task to cut the sample to its size.
LAST_ROWS = 100_000


def sample_n(df: DataFrame, n: int, keys: list[str], seed: str, weight: str | None = None) -> DataFrame:
    """n rows without replacement; with ``weight``, heavier rows are likelier (exponential keys).

    They are the rows with the smallest scores.  Counts by cells of the score tell in which cell the n-th lies, and that cell is cut again until few rows are left to be
    sorted; all rows below are taken where they are.  A round gives the driver ``CELLS`` counts.
    """
    u = uniform(keys, seed)
    score = u if weight is None else -F.log1p(-u) / F.col(weight)
    rows = df if weight is None else df.filter(F.col(weight) > 0)
    scored = rows.withColumn("_u", score).withColumn("_x", F.least(F.col("_u") / (1 + F.col("_u")), F.lit(1 - 2.0**-52)))
    low, width, taken = 0.0, 1.0, 0
    while True:
        inside = (F.col("_x") >= low) & (F.col("_x") < low + width)
        counted = scored.filter(inside).groupBy(F.floor((F.col("_x") - low) * (CELLS / width)).alias("c")).count().collect()
        cells = sorted((r["c"], r["count"]) for r in counted)
        crossed = None
        for cell, rows_in in cells:
            if taken + rows_in > n:
                crossed = (cell, rows_in)
                break
            taken += rows_in
        if crossed is None:
            return scored.filter(F.col("_x") < low + width).drop("_u", "_x")
        low, width = low + crossed[0] * width / CELLS, width / CELLS
        if crossed[1] <= LAST_ROWS or width < 2.0**-50:
            break
    sure = scored.filter(F.col("_x") < low)
    cut = scored.filter((F.col("_x") >= low) & (F.col("_x") < low + width)).orderBy("_u", *keys).limit(n - taken)
    return sure.unionByName(cut).drop("_u", "_x")


def sample_by_group(df: DataFrame, by: list[str], n: int, keys: list[str], seed: str) -> DataFrame:
    """n rows of each group; each task hands on n rows per group at most."""
    rows = df.withColumn("_u", uniform(keys, seed))
    return first_rows(rows, by, [F.col(c) for c in ["_u", *keys]], n).drop("_u", "_p")


def sample_with_replacement(df: DataFrame, n: int, keys: list[str], seed: str) -> DataFrame:
    """n draws; a row may come up several times.  Each draw picks a row number."""
    numbered = numbered_by_value(df, keys[0], keys[1:], "_p")
    draws = df.sparkSession.range(n).withColumn("_u", uniform(["id"], seed))
    size = df.agg(F.count(F.lit(1)).alias("_n"))
    picks = with_one_row(draws, size).select(F.col("id").alias("draw"), (F.floor(F.col("_u") * F.col("_n")) + 1).alias("_p"))
    return picks.join(numbered, "_p").drop("_p")


# Value sets


def unique_values(df: DataFrame, col: str, place: str) -> DataFrame:
    """Distinct values with count, first place and 0-based code in value order."""
    seen = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("first_place"))
    codes = value_counts_running(df, [], col).select(col, (F.col("_distinct") - 1).alias("code"))
    return seen.join(codes, col)


def inverse_codes(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    codes = value_counts_running(df, [], col).select(col, (F.col("_distinct") - 1).alias(name))
    return join_null_safe(df, codes, [col], "left")


def union_of(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def intersection_of(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def difference_of(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Values on one side only: one aggregate over both, not two differences."""
    marked = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(b.toDF(*a.columns).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    return marked.groupBy(*a.columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b")).filter("_a + _b = 1").select(*a.columns)


def row_hash(cols: list[str]) -> Column:
    """A hash over a row's columns, NULLs counted by place."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in cols])


def changed_by_hash(old: DataFrame, new: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Keys whose rows differ.  Only keys and hashes are shuffled."""
    a = old.select(*key, row_hash(cols).alias("_old"))
    b = new.select(*key, row_hash(cols).alias("_new"))
    return a.join(b, key).filter(F.col("_old") != F.col("_new")).select(*key)


def search_sorted(col: str, edges: list[float], side: str = "left") -> Column:
    """Where a value would go into sorted edges: before equal ones (left) or after (right)."""
    return edges_below(col, [float(e) for e in edges], strict=side == "left")


def digitize(col: str, edges: list[float], right: bool = False) -> Column:
    """Bin of a value: edges[i-1] <= x < edges[i], or with ``right`` edges[i-1] < x <= edges[i]."""
    return search_sorted(col, edges, "left" if right else "right")


def linear_lookup(col: str, points: list[tuple[float, float]]) -> Column:
    """Piecewise-linear table lookup; values beyond the ends take the end value."""
    points = sorted(points)
    xs, ys = [float(x) for x, _ in points], [float(y) for _, y in points]
    x = F.col(col).cast("double")
    i = edges_below(col, xs)
    ax, ay = F.array(*[F.lit(v) for v in xs]), F.array(*[F.lit(v) for v in ys])
    x0, x1, y0, y1 = F.get(ax, i - 1), F.get(ax, i), F.get(ay, i - 1), F.get(ay, i)
    inner = y0 + (y1 - y0) * ((x - x0) / (x1 - x0))
    return F.when(i == 0, ys[0]).when(i >= len(xs), ys[-1]).otherwise(inner)


def select_types(df: DataFrame, include: tuple[type, ...] = (), exclude: tuple[type, ...] = ()) -> DataFrame:
    def keep(kind) -> bool:
        return (not include or isinstance(kind, include)) and not isinstance(kind, exclude)

    return df.select(*[f.name for f in df.schema.fields if keep(f.dataType)])


def rename(df: DataFrame, names: dict[str, str] | None = None, function=None) -> DataFrame:
    mapping = names or {c: function(c) for c in df.columns}
    return df.withColumnsRenamed(mapping)


def truncate(df: DataFrame, col: str, before=None, after=None) -> DataFrame:
    conditions = ([F.col(col) >= F.lit(before)] if before is not None else []) + ([F.col(col) <= F.lit(after)] if after is not None else [])
    return df.filter(reduce(lambda a, b: a & b, conditions, F.lit(True)))


def numbered_by_value(df: DataFrame, col: str, ties: list[str], name: str) -> DataFrame:
    """Row number over the whole table in value order, without one task for all rows."""
    rows, series = dealt(df, [], [col, *ties])
    return position(rows, series, name).drop("_vb")
