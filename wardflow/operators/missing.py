"""Missing values, duplicates and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.keys import join_null_safe
from wardflow.operators.ordered import Series, micros, position, running
from wardflow.session import settle


def _neighbours(df: DataFrame, series: Series, col: str, at: Column, *, number: bool, prev: bool = True, nxt: bool = True) -> DataFrame:
    """Add ``_prev`` and ``_next``: place and value of the nearest values on either side (or the row's own)."""
    rows = settle(position(df, series)) if number else df.withColumn("_pos", F.lit(0))
    mark = F.when(F.col(col).isNotNull(), F.struct(at.alias("at"), F.col("_pos").alias("pos"), F.col(col).alias("v")))
    wanted = ({"_prev": ("last", mark)} if prev else {}) | ({"_next": ("next", mark)} if nxt else {})
    return running(rows, series, wanted)


def _area(area: str | None) -> Column:
    inside = F.col("_prev").isNotNull() & F.col("_next").isNotNull()
    return F.lit(True) if area is None else inside if area == "inside" else ~inside


def fill(
    df: DataFrame, series: Series, col: str, name: str | None = None, *, backward: bool = False, limit: int | None = None, area: str | None = None
) -> DataFrame:
    """Carry the last (or next) value into gaps, at most ``limit`` rows far, inside or outside the known range."""
    rows = _neighbours(
        df, series, col, F.col("_pos"), number=limit is not None, prev=area is not None or not backward, nxt=area is not None or backward
    )
    source = F.col("_next" if backward else "_prev")
    ok = _area(area) if area else F.lit(True)
    if limit is not None:
        ok = ok & (F.abs(source["pos"] - F.col("_pos")) <= limit)
    value = F.coalesce(F.col(col), F.when(ok, source["v"]))
    return rows.withColumn(name or col, value).drop("_pos", "_prev", "_next")


def carry_forward(df: DataFrame, series: Series, cols: list[str]) -> DataFrame:
    """The plain forward fill of several columns in one scan."""
    return running(df, series, {c: ("last", F.col(c)) for c in cols})


def interpolate(
    df: DataFrame, series: Series, col: str, name: str, *, ts: str | None = None, limit: int | None = None, direction: str = "forward", area: str | None = None
) -> DataFrame:
    """Straight lines between known values, by row or by time.

    Rows after the last value take it (forward or both), rows before the first take that one
    (backward or both), unless ``area`` is inside.
    """
    at = micros(ts) if ts else F.col("_pos")
    rows = _neighbours(df, series, col, at, number=ts is None or limit is not None)
    prev, nxt = F.col("_prev"), F.col("_next")
    line = prev["v"] + (nxt["v"] - prev["v"]) * F.try_divide(at - prev["at"], nxt["at"] - prev["at"])
    value = F.when(prev.isNotNull() & nxt.isNotNull(), line).otherwise(F.coalesce(prev["v"], nxt["v"]))
    far = 2**62 if limit is None else limit
    from_prev = prev.isNotNull() & (F.col("_pos") - prev["pos"] <= far)
    from_next = nxt.isNotNull() & (nxt["pos"] - F.col("_pos") <= far)
    ok = {"forward": from_prev, "backward": from_next, "both": from_prev | from_next}[direction] & _area(area)
    return rows.withColumn(name, F.coalesce(F.col(col).cast("double"), F.when(ok, value))).drop("_pos", "_prev", "_next")


def first_last_valid(df: DataFrame, by: list[str], key: str, col: str) -> DataFrame:
    present = F.when(F.col(col).isNotNull(), F.col(key))
    return df.groupBy(*by).agg(F.min(present).alias("first_valid"), F.max(present).alias("last_valid"))


def replace_values(col: Column, mapping: dict) -> Column:
    """Exact values by a map; other values stay."""
    out = F.when(F.lit(False), col)
    for old, new in mapping.items():
        out = out.when(col == F.lit(old), F.lit(new))
    return out.otherwise(col)


def replace_patterns(col: Column, patterns: dict[str, str]) -> Column:
    for pattern, new in patterns.items():
        col = F.regexp_replace(col, pattern, new)
    return col


def mark_duplicates(df: DataFrame, subset: list[str], order: list[str], keep: str = "first", name: str = "duplicated") -> DataFrame:
    """Flag copies beyond the kept one.  The kept row's key comes from an aggregate, joined back."""
    key = F.struct(*order)
    picked = df.groupBy(*subset).agg(
        (F.max(key) if keep == "last" else F.min(key)).alias("_keep"), F.count(F.lit(1)).alias("_n")
    )
    rows = join_null_safe(df, picked, subset)
    flag = F.col("_n") > 1 if keep == "none" else ~F.col("_keep").eqNullSafe(key)
    return rows.withColumn(name, flag).drop("_keep", "_n")


def drop_duplicates(df: DataFrame, subset: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row per subset value (none of the copied ones with keep none), by aggregate alone."""
    pick = F.max_by if keep == "last" else F.min_by
    rest = [c for c in df.columns if c not in subset]
    rows = df.groupBy(*subset).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    if keep == "none":
        rows = rows.filter(F.col("_n") == 1)
    return rows.select(*subset, "_r.*").select(*df.columns)


def to_number(col: Column, kind: str = "double") -> Column:
    """Text to number; text that is none gives NULL."""
    return F.trim(col).try_cast(kind)


INTEGERS = [("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)]


def narrowest_integer(df: DataFrame, cols: list[str]) -> DataFrame:
    """Narrowest integer type that holds each column, from its range."""
    aggs = [F.struct(F.lit(c).alias("column"), F.min(c).cast("bigint").alias("low"), F.max(c).cast("bigint").alias("high")) for c in cols]
    rows = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    fits = F.when(F.lit(False), F.lit(""))
    for name, bits in INTEGERS[:-1]:
        fits = fits.when((F.col("low") >= -(2**bits)) & (F.col("high") < 2**bits), name)
    return rows.withColumn("narrowest", fits.otherwise("bigint"))


CANDIDATES = ["int", "bigint", "double", "boolean", "date", "timestamp_ntz"]


def infer_types(df: DataFrame, cols: list[str]) -> DataFrame:
    """Narrowest type that every text of a column can be read as, from one pass."""

    def misses(c: str, kind: str) -> Column:
        reads = F.col(c).try_cast(kind).isNotNull()
        if kind == "date":  # the cast would drop a time of day
            reads = reads & ~F.col(c).contains(":")
        return F.count_if(F.col(c).isNotNull() & ~reads)

    aggs = []
    for c in cols:
        order = F.when(F.count(c) == 0, "string")
        for kind in CANDIDATES:
            order = order.when(misses(c, kind) == 0, kind)
        aggs.append(F.struct(F.lit(c).alias("column"), order.otherwise("string").alias("inferred")))
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def clip(col: Column, low=None, high=None) -> Column:
    """Bounds kept; NULL stays NULL."""
    out = col
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(col.isNotNull(), out)

