"""Column rules, quarantine and key checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

Rule = tuple[str, Column]


def gt(name: str, bound) -> Rule:
    return f"{name} > {bound}", ~(F.col(name) > bound)


def ge(name: str, bound) -> Rule:
    return f"{name} >= {bound}", ~(F.col(name) >= bound)


def lt(name: str, bound) -> Rule:
    return f"{name} < {bound}", ~(F.col(name) < bound)


def le(name: str, bound) -> Rule:
    return f"{name} <= {bound}", ~(F.col(name) <= bound)


def interval(name: str, low, high) -> Rule:
    return f"{name} in [{low}, {high}]", ~F.col(name).between(low, high)


def multiple_of(name: str, step) -> Rule:
    return f"{name} multiple of {step}", (F.col(name) % step) != 0


def length_between(name: str, low: int, high: int) -> Rule:
    return f"length of {name} in [{low}, {high}]", ~F.length(name).between(low, high)


def zoned(name: str) -> Rule:
    """Text time with an explicit zone."""
    return f"{name} has a zone", ~F.col(name).rlike(r"(Z|[+-]\d{2}:?\d{2})$")


def negate(rule: Rule) -> Rule:
    name, broken = rule
    return f"not ({name})", ~broken


def broken_rules(rules: list[Rule]) -> Column:
    """Names of the rules a row breaks; a NULL value breaks no value rule."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def split_valid(df: DataFrame, rules: list[Rule], column: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the first rule they break."""
    first = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])
    marked = df.withColumn(column, first)
    return marked.filter(F.col(column).isNull()).drop(column), marked.filter(F.col(column).isNotNull())


def error_log(bad: DataFrame, key: str, procedure: str, as_of, reason: str = "reason") -> DataFrame:
    return bad.select(
        F.col(key).cast("string").alias("record_key"),
        F.col(reason).alias("error_message"),
        F.lit(as_of).cast("timestamp_ntz").alias("error_time"),
        F.lit(procedure).alias("procedure_name"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def each(names: list[str], make: Callable[[str], Rule]) -> list[Rule]:
    return [make(n) for n in names]
