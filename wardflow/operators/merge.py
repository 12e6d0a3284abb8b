"""Upserts, change detection and table mutations without a MERGE-capable format.

Each function on frames returns the new state of the table; a run writes it to a new
folder and never over the one it reads.  ``merge_into`` and its like change a stored table of key buckets and touch
only the buckets that a source key hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.keys import join_null_safe, with_one_row
from wardflow.operators.ordered import dealt, position
from wardflow.sources.buckets import BucketTable


def last_by_key(source: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row per key, the one with the highest version; of several, the one of the greatest row hash, so that a task that runs again picks the same.

    An aggregate, not a window: copies of a key combine before the shuffle.
    """
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.dropDuplicates(keys)
    picked = source.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version, F.xxhash64(*rest))).alias("_row"))
    return picked.select(*keys, "_row.*").select(*source.columns)


def upsert(
    target: DataFrame, source: DataFrame, *, keys: list[str], cols: list[str] | None = None, version: list[str] | None = None
) -> DataFrame:
    """Insert new keys, update ``cols`` of known ones.

    Without ``cols`` all columns the source shares with the target are set.  A column the
    source does not set keeps its old value, and is NULL on insert.  Source rows without a
    key are the caller's to set aside (``split_valid``); here they are left out.
    """
    cols = [c for c in (cols or source.columns) if c not in keys and c in target.columns]
    given = source.dropna(subset=keys)
    given = last_by_key(given, keys, version or [])
    given = given.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_given"))
    joined = target.join(given, keys, "full_outer")
    return joined.select(
        *[
            F.when(F.col("_given"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )


def merge_into(table: BucketTable, source: DataFrame, *, cols: list[str] | None = None, version: list[str] | None = None) -> int:
    """``upsert`` on a stored table; gives its new version.

    Buckets without a key of the source are neither read nor written, so the cost is that of the rows that may change.  A merge that is run twice
    gives the same rows.
    """
    given = source.dropna(subset=table.key)
    return table.change(given, lambda rows, new: upsert(rows, new, keys=table.key, cols=cols, version=version))


def ignore_into(table: BucketTable, source: DataFrame, *, version: list[str]) -> int:
    """``insert_ignore`` on a stored table; gives its new version."""
    return table.change(source, lambda rows, new: insert_ignore(rows, new, keys=table.key, version=version))


def delete_from(table: BucketTable, keys: DataFrame) -> int:
    """Remove the rows of some keys from a stored table; gives its new version."""
    return table.change(keys.select(*table.key), lambda rows, gone: join_null_safe(rows, gone.distinct(), table.key, "left_anti"))


def insert_ignore(target: DataFrame, source: DataFrame, *, keys: list[str], version: list[str]) -> DataFrame:
    """Add rows whose key is not there yet."""
    fresh = last_by_key(source, keys, version).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*[c for c in target.columns if c in fresh.columns]), allowMissingColumns=True)


def update_where(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """Rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def changed_keys(staged: DataFrame, current: DataFrame, *, key: str, compare: str, columns: list[str]) -> DataFrame:
    """Staged rows with a new key or another value; an unknown value on either side is no change."""
    old = current.select(F.col(key).alias("_key"), F.col(compare).alias("_old"))
    return (
        staged.join(old, staged[key] == old["_key"], "left")
        .filter(F.col("_key").isNull() | (F.col(compare) != F.col("_old")))
        .select(*columns)
    )


def new_rows(incoming: DataFrame, existing: DataFrame, *, cols: list[str] | None = None) -> DataFrame:
    """Rows that differ from every existing row in some shared column; NULL equals NULL."""
    cols = cols or [c for c in incoming.columns if c in existing.columns]
    return join_null_safe(incoming, existing.select(*cols).distinct(), cols, "left_anti")


def high_water_day(df: DataFrame, column: str) -> DataFrame:
    """The last day of a time column as text; the next run reads that day again."""
    return df.agg(F.date_format(F.max(column), "yyyy-MM-dd").alias("high_water"))


def hashed_key(cols: list[str]) -> Column:
    """A surrogate key of 128 bits, as hex text, that stays the same on every run; NULLs count by place.

    64 bits would be expected to repeat from about ten thousand million rows on.
    """
    parts = [F.concat(F.length(t), F.lit(":"), t) for t in (F.col(c).cast("string") for c in cols)]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("-")) for p in parts]))


def sequence_key(df: DataFrame, order: list[str], name: str, after: DataFrame) -> DataFrame:
    """Number rows in order after the largest key of ``after`` (one row, column ``top``)."""
    rows, series = dealt(df, [], order)
    numbered = position(rows, series, "_n").drop("_vb")
    return with_one_row(numbered, after.select("top")).withColumn(name, F.coalesce("top", F.lit(0)) + F.col("_n")).drop("top", "_n")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
