"""Census, trend and discharge reports over the stored views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.plans.census import FLOWS

# Display order of programs, discharge classes, page sizes.
PROGRAM_ORDER = ["Detox", "Residential", "SUD IOP", "Psych IOP", "Aftercare"]
DISCHARGE_CLASSES = ["AMA", "Admin", "Successful"]
PAGE_SIZES = [10, 25, 50]


def list_index(col: Column | str, values: list[str]) -> Column:
    """0-based place in a fixed list; -1 when absent, so unknown values sort first."""
    col = F.col(col) if isinstance(col, str) else col
    return (F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), col), F.lit(0)) - 1).cast("int")


def on_day(df: DataFrame, column: str, day: date) -> DataFrame:
    return df.filter(F.col(column) == F.lit(day))


def between(df: DataFrame, column: str, low: date, high: date) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def among(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Membership; an empty list means no filter."""
    return df.filter(F.col(column).isin(values)) if values else df


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """One page of a total order."""
    return df.orderBy(*order).offset(number * size).limit(size)


def choices(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def presets(as_of: Column, n_days: int = 8) -> Column:
    """Array of named date ranges ending yesterday."""
    yesterday = F.date_sub(as_of, 1)

    def row(name: str, low: Column) -> Column:
        return F.struct(F.lit(name).alias("preset"), low.alias("start_date"), yesterday.alias("end_date"))

    return F.array(
        row("yesterday", yesterday),
        row("initial", F.date_sub(as_of, 7)),
        row("last_n_days", F.date_sub(as_of, n_days)),
        row("month_to_date", F.trunc(as_of, "MM").cast("date")),
    )


def _sums(names: list[str]) -> list[Column]:
    return [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]


def day_totals(census: DataFrame, day: date) -> DataFrame:
    return on_day(census, "census_date", day).agg(*_sums(["census", *FLOWS]))


def census_report(census: DataFrame, *, day: date) -> DataFrame:
    """Cards per program in display order, then the total; one pass over the day."""
    rolled = (
        on_day(census, "census_date", day)
        .rollup("program_category")
        .agg(*_sums(["census", *FLOWS]), F.grouping("program_category").alias("_all"))
    )
    is_total = F.col("_all") == 1
    return (
        rolled.withColumn("place", F.when(is_total, 99).otherwise(list_index("program_category", PROGRAM_ORDER)))
        .withColumn("program_category", F.when(is_total, "Total").otherwise(F.col("program_category")))
        .select("program_category", "census", *FLOWS, "place")
        .orderBy("place", "program_category")
    )


def period_totals(census: DataFrame, low: date, high: date) -> DataFrame:
    """Mean of the daily sums of census; sums of the flows."""
    daily = between(census, "census_date", low, high).groupBy("census_date").agg(
        F.sum("census").alias("census"), *[F.sum(n).alias(n) for n in FLOWS]
    )
    return daily.agg(F.coalesce(F.round(F.avg("census"), 6), F.lit(0.0)).alias("average_census"), *_sums(FLOWS))


def period_by_program(census: DataFrame, low: date, high: date) -> DataFrame:
    """Mean over the rows a program has; days without a row do not count as zero."""
    return (
        between(census, "census_date", low, high)
        .groupBy("program_category")
        .agg(F.round(F.avg("census"), 6).alias("average_census"), *_sums(FLOWS))
        .withColumn("place", list_index("program_category", PROGRAM_ORDER))
        .orderBy("place", "program_category")
    )


def census_trends(census: DataFrame, *, start: date, end: date) -> DataFrame:
    total = period_totals(census, start, end)
    return period_by_program(census, start, end).unionByName(
        total.select(F.lit("Total").alias("program_category"), "*", F.lit(99).alias("place"))
    )


def select_discharges(dis: DataFrame, start: date, end: date, programs: list[str]) -> DataFrame:
    return among(between(dis, "discharge_date", start, end), "program_category", programs)


def discharge_totals(dis: DataFrame) -> DataFrame:
    """Count and percentage by class; a percentage of nothing is NULL."""
    counts = [F.count_if(F.col("discharge_class") == c).alias(c.lower()) for c in DISCHARGE_CLASSES]
    total = dis.agg(F.count(F.lit(1)).alias("total"), *counts)
    return total.select(
        "*",
        *[F.round(F.try_divide(F.col(c.lower()) * 100, F.col("total")), 1).alias(f"{c.lower()}_pct") for c in DISCHARGE_CLASSES],
    )


def discharge_matrix(dis: DataFrame) -> DataFrame:
    """Percentage of each class within a program; the base counts all classes."""
    counts = dis.groupBy("program_category").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("discharge_class") == c).alias(c.lower()) for c in DISCHARGE_CLASSES],
    )
    return counts.select(
        "program_category",
        "total",
        *[F.round(F.col(c.lower()) * 100 / F.col("total"), 6).alias(f"{c.lower()}_pct") for c in DISCHARGE_CLASSES],
    )


DISCHARGE_ORDER = ["discharge_date", "casefile_id", "program_category", "discharge_class", "full_name"]


def discharge_trends(dis: DataFrame, *, start: date, end: date, programs: list[str] = (), number: int = 0, size: int = 10):
    """Totals, matrix and one table page of the selected discharges."""
    chosen = select_discharges(dis, start, end, list(programs))
    return discharge_totals(chosen), discharge_matrix(chosen), page(chosen, DISCHARGE_ORDER, number, size)
