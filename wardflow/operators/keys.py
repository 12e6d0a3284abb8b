"""Joins on key lists where NULL keys match each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL equals NULL; keeps one copy of the key columns.

    ``<=>`` is still a hashable key for Spark, so this shuffles like a plain
    equi-join and adaptive execution may split a skewed side.
    """
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    marked = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    joined = left.join(marked, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{k}" for k in keys])


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Add the columns of a one-row result, such as a total, to every row.

    A scalar subquery: it runs once and its value is put into the plan.
    """
    value = one.select(F.struct(*one.columns)).scalar()
    return df.select("*", value.alias("_one")).select(*df.columns, "_one.*")
