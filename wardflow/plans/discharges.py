"""Discharged stays with their class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def case_flag(forms: DataFrame, name: str) -> DataFrame:
    """The distinct cases of a form table, as a membership flag."""
    return forms.select("casefile_id").distinct().withColumn(name, F.lit(True))


def discharges(
    history: DataFrame, latest: DataFrame, discharge_types: DataFrame, ama_forms: DataFrame, admin_discharge: DataFrame
) -> DataFrame:
    name = F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit("")))
    out = (
        history.filter(F.col("discharged") == 1)
        .join(latest.select("casefile_id", "discharge_type_code"), "casefile_id", "left")
        .join(case_flag(ama_forms, "_ama"), "casefile_id", "left")
        .join(case_flag(admin_discharge, "_admin"), "casefile_id", "left")
        .join(discharge_types.select("discharge_type_code", "discharge_class"), "discharge_type_code", "left")
    )
    outcome = (
        F.when(F.col("_ama"), "AMA")
        .when(F.col("_admin"), "Admin")
        .otherwise(F.coalesce("discharge_class", F.lit("Successful")))
    )
    return out.select(
        "casefile_id",
        name.alias("full_name"),
        "program_level",
        "program_category",
        "program_class",
        F.to_date("end_date").alias("discharge_date"),
        outcome.alias("discharge_class"),
    )
