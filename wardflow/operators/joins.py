"""Joins beyond the plain equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.keys import join_null_safe
from wardflow.operators.ordered import dealt, micros, running, span_micros, steps
from wardflow.session import settle


def hash_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Equi-join in which NULL keys match each other; clashing names get suffixes.

    A full outer join is the left join plus the unmatched right rows: adaptive execution can
    split a skewed key of those two, but not one of a full outer join.
    """
    clash = (set(left.columns) & set(right.columns)) - set(on)
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    if how != "full":
        return join_null_safe(left, right, on, how)
    return join_null_safe(left, right, on, "left").unionByName(
        join_null_safe(right, left, on, "left_anti"), allowMissingColumns=True
    )


def join_with_origin(left: DataFrame, right: DataFrame, on: list[str], column: str = "_merge") -> DataFrame:
    """Full outer join with ``left_only``, ``right_only`` or ``both``."""
    joined = hash_join(left.withColumn("_l", F.lit(1)), right.withColumn("_r", F.lit(1)), on, "full")
    origin = F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both")
    return joined.withColumn(column, origin).drop("_l", "_r")


def join_cardinality(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """One row: whether the keys are unique on each side, and the kind of join that makes."""

    def side(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
        return counts.agg((F.coalesce(F.max("n"), F.lit(0)) <= 1).alias("unique")).select(F.lit(name).alias("side"), "unique")

    both = side(left, "left").unionByName(side(right, "right"))
    kind = F.concat(F.when(F.col("left_unique"), "1").otherwise("m"), F.lit(":"), F.when(F.col("right_unique"), "1").otherwise("m"))
    return both.agg(
        F.bool_and(F.when(F.col("side") == "left", F.col("unique"))).alias("left_unique"),
        F.bool_and(F.when(F.col("side") == "right", F.col("unique"))).alias("right_unique"),
    ).withColumn("kind", kind)


def _asof_one_way(left, right, on, by, ties, backward: bool, exact: bool, carry: list[str]) -> DataFrame:
    # Where times are equal, a right row must be scanned before the left row it may match.
    right_first = exact == backward
    l_side, r_side = (1, 0) if right_first else (0, 1)
    payload = F.struct(F.col(on).alias("on"), *[F.col(c) for c in carry])
    tie = [F.col(c).alias(f"_t{i}") for i, c in enumerate(ties)]
    none = [F.lit(None).cast(right.schema[c].dataType).alias(f"_t{i}") for i, c in enumerate(ties)]
    struct_type = right.select(payload.alias("p")).schema["p"].dataType
    r = right.select(*by, F.col(on), F.lit(r_side).alias("_side"), *tie, payload.alias("_p"), F.lit(None).cast(left.select(F.struct("*").alias("x")).schema["x"].dataType).alias("_left"))
    l = left.select(*by, F.col(on), F.lit(l_side).alias("_side"), *none, F.lit(None).cast(struct_type).alias("_p"), F.struct("*").alias("_left"))
    rows, series = dealt(r.unionByName(l), by, [on, "_side", *[f"_t{i}" for i in range(len(ties))]], descending=not backward)
    out = running(rows, series, {"_match": ("last", F.col("_p"))}).drop("_vb")
    return out.filter(F.col("_left").isNotNull())


def asof_join(
    left: DataFrame, right: DataFrame, *, on: str, by: list[str], columns: list[str], direction: str = "backward",
    tolerance: str | int | None = None, exact: bool = True, ties: list[str] = (),
) -> DataFrame:
    """Each left row with the ``columns`` of the nearest right row in time, per key.

    Both sides go through one ordered scan, dealt by ranges of key and time; nothing is paired.  ``ties`` orders
    right rows of equal time: the last is taken backward, the first forward.  Nearest takes the
    smaller gap, and backward when both gaps are equal.  The match's time is ``<on>_right``.
    """
    right = right.filter(F.col(on).isNotNull())
    args = dict(on=on, by=by, ties=list(ties), exact=exact, carry=list(columns))
    if direction == "nearest":
        # The left rows of the first scan, with their match, are the left side of the second.
        first = settle(_asof_one_way(left, right, backward=True, **args).select("_left.*", F.col("_match").alias("_before")))
        both = _asof_one_way(first, right, backward=False, **args).select(
            *[F.col(f"_left.{c}").alias(c) for c in left.columns], F.col("_left._before").alias("_before"), F.col("_match").alias("_after")
        )
        before, after = micros(F.col(on)) - micros(F.col("_before.on")), micros(F.col("_after.on")) - micros(F.col(on))
        pick = F.when(F.col("_before").isNull() | (after < before), F.col("_after")).otherwise(F.col("_before"))
        out = both.withColumn("_match", pick).drop("_before", "_after")
    else:
        out = _asof_one_way(left, right, backward=direction == "backward", **args).select("_left.*", "_match")
    if tolerance is not None:
        gap = F.abs(micros(F.col(on)) - micros(F.col("_match.on")))
        out = out.withColumn("_match", F.when(gap <= span_micros(tolerance), F.col("_match")))
    return out.select(*left.columns, F.col("_match.on").alias(f"{on}_right"), *[F.col(f"_match.{c}").alias(c) for c in columns])


def asof_last_complete(left: DataFrame, right: DataFrame, *, subset: list[str], **options) -> DataFrame:
    """As-of lookup of the last right row without NULL in ``subset``."""
    return asof_join(left, right.dropna(subset=subset), direction="backward", **options)


def ordered_join(
    left: DataFrame, right: DataFrame, *, on: str, by: list[str], fill: list[str]
) -> DataFrame:
    """Full outer join on key and time, then ``fill`` columns carried forward per key."""
    joined = hash_join(left, right, [*by, on], "full")
    rows, series = dealt(joined, by, [on])
    return running(rows, series, {c: ("last", F.col(c)) for c in fill}).drop("_vb")


def _inside(point: Column, low: Column, high: Column, closed: str) -> Column:
    lower = point >= low if closed in ("left", "both") else point > low
    upper = point <= high if closed in ("right", "both") else point < high
    return lower & upper


#: Cells of a level are this many bits wider than those of the next finer one.
LEVEL_BITS = 2


def interval_join(points: DataFrame, intervals: DataFrame, *, point: str, low: str, high: str, by: list[str] = (), closed: str = "left") -> DataFrame:
    """Points with the intervals they lie in, whatever the intervals' lengths.

    Time is cut into cells at several levels, each ``2 ** LEVEL_BITS`` times as wide as the one below.  An interval goes to the level whose cells are about as long as
    itself and touches at most three of them; a point is in one cell of each level that some interval is at.  They meet by equal key, level and cell, so
    neither is an interval listed by day nor a point compared with all intervals.  The levels, at most 32 numbers, come to the driver.
    """
    spans = intervals.filter(F.col(low) <= F.col(high)).withColumns({"_lo": micros(low), "_hi": micros(high)})
    bits = F.ceil(F.log2(F.greatest(F.col("_hi") - F.col("_lo"), F.lit(2)) / 2) / LEVEL_BITS) * LEVEL_BITS
    spans = spans.withColumn("_level", bits.cast("int"))
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())

    def cell(moment: str, level: Column) -> Column:
        return F.call_function("shiftright", F.col(moment), level)

    cells = spans.withColumn("_cell", F.explode(F.sequence(cell("_lo", F.col("_level")), cell("_hi", F.col("_level"))))).drop("_lo", "_hi")
    probes = points.withColumn("_us", micros(point)).withColumn("_level", F.explode(F.lit(levels).cast("array<int>"))).withColumn("_cell", cell("_us", F.col("_level"))).drop("_us")
    met = join_null_safe(probes, cells, [*by, "_level", "_cell"])
    return met.filter(_inside(F.col(point), F.col(low), F.col(high), closed)).drop("_level", "_cell")


def overlaps_earlier(df: DataFrame, *, low: str, high: str, by: list[str], ties: list[str], closed: bool = False) -> DataFrame:
    """Flag intervals that begin before an earlier one of the same key has ended."""
    rows, series = dealt(df, by, [low, *ties])
    out = running(rows, series, {"_reach": ("max", F.col(high))}, exclusive=True).drop("_vb")
    hit = F.col("_reach") >= F.col(low) if closed else F.col("_reach") > F.col(low)
    return out.withColumn("overlaps", F.coalesce(hit, F.lit(False))).drop("_reach")


def combine_first(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Values of ``left``, gaps and missing keys filled from ``right``."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    joined = hash_join(left, right, on, "full", ("_l", "_r"))
    cols = [c for c in left.columns if c not in on] + [c for c in right.columns if c not in left.columns]
    return joined.select(*on, *[F.coalesce(f"{c}_l", f"{c}_r").alias(c) if c in shared else F.col(c) for c in cols])


def update_from(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Known keys take the non-NULL values of ``right``."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    joined = hash_join(left, right.select(*on, *shared), on, "left", ("_l", "_r"))
    return joined.select(*on, *[F.coalesce(f"{c}_r", f"{c}_l").alias(c) if c in shared else F.col(c) for c in left.columns if c not in on])


def compare(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Cells that differ between two tables of one shape: key, column, both values as text."""
    cells = [c for c in left.columns if c not in on]
    joined = hash_join(left, right, on, "inner", ("_l", "_r"))
    diffs = [
        F.when(
            ~F.col(f"{c}_l").eqNullSafe(F.col(f"{c}_r")),
            F.struct(F.lit(c).alias("column"), F.col(f"{c}_l").cast("string").alias("self"), F.col(f"{c}_r").cast("string").alias("other")),
        )
        for c in cells
    ]
    return joined.select(*on, F.inline(F.array_compact(F.array(*diffs))))


def distinct_values(df: DataFrame, column: str) -> list:
    """The distinct values of a category column, for results with one column for each of them.

    Such a result is as wide as the list is long; where categories are many, use a long form (``pivot_long``, ``dummies_long``).
    """
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of one set with every one of another.

    The right rows are dealt by a hash to as many numbers as there are shuffle partitions, and each left row is sent to every number:
    an equal join, whose tasks hold a part of the right rows each.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = right.distinct().withColumn("_part", F.pmod(F.xxhash64(*right.columns), F.lit(parts)).cast("int"))
    return left.distinct().withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(dealt, "_part").drop("_part")
