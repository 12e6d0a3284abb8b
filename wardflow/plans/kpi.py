"""Daily figures of the older model: admissions, transfers and discharges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

COLUMNS = ["id", "organization_id", "program", "created_at", "patient_id"]


def tagged_union(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.select(*COLUMNS, F.lit(name).alias("source")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def daily_kpi(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct ids by source and distinct patients, per organisation, program and day.

    Each row gives an id token and a patient token.  Tokens are made distinct once, map-side
    first, and then counted; several distinct counts in one aggregate would copy each row for
    every one of them.
    """
    day = F.to_date("created_at").alias("date")
    tokens = F.array(
        F.struct(F.col("source").alias("kind"), F.col("id").cast("string").alias("token")),
        F.struct(F.lit("patient").alias("kind"), F.col("patient_id").cast("string").alias("token")),
    )
    distinct = (
        tagged_union(tables)
        .select("organization_id", "program", day, F.inline(tokens))
        .filter(F.col("token").isNotNull() | (F.col("kind") == "patient"))
        .distinct()
    )
    seen = F.col("token").isNotNull()
    return distinct.groupBy("organization_id", "program", "date").agg(
        *[F.count_if((F.col("kind") == s) & seen).alias(s) for s in tables], F.count_if((F.col("kind") == "patient") & seen).alias("census")
    )


def discharge_counts(discharges: DataFrame) -> DataFrame:
    return discharges.groupBy(
        "organization_id", "program", F.to_date("created_at").alias("date"), "discharge_type"
    ).agg(F.count(F.lit(1)).alias("count"))


def trend_matrix(counts: DataFrame, types: list[str]) -> DataFrame:
    """Every date against every type, absent pairs as zero."""
    return counts.groupBy("date").pivot("discharge_type", types).agg(F.sum("count")).fillna(0, subset=types)
