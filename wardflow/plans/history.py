"""From the program log to versioned stays.

The log is reduced first (map-side combined), so that what is shuffled by
case afterwards is at most one row per case and program, however
many log rows a case has.  All windows then share that one
partitioning by case.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wardflow.operators.ordered import micros

PROGRAM, DISCHARGE = "Program", "Discharge"


def _is_program() -> Column:
    return F.col("program_class") == PROGRAM


def _is_discharge() -> Column:
    return F.col("program_class") == DISCHARGE


def grouped_starts(log: DataFrame, program_types: DataFrame, latest: DataFrame) -> DataFrame:
    """One row per case, person and program: first start, or last one for discharges."""
    reduced = (
        log.join(program_types, log["program_name"] == program_types["program"])
        .filter(F.col("program_level") != "Administrative")
        .groupBy("casefile_id", "first_name", "last_name", "program_category", "program_class", "program_level")
        .agg(
            F.min("start_date").alias("_first"),
            F.max("start_date").alias("_last"),
            F.min("logged_at").alias("_log_first"),
            F.max("logged_at").alias("_log_last"),
        )
    )
    state = latest.select("casefile_id", "discharge_date")
    return reduced.join(state, "casefile_id").select(
        "casefile_id", "first_name", "last_name", "program_category", "program_class", "program_level",
        F.when(_is_discharge(), F.col("_last")).otherwise(F.col("_first")).alias("start_date"),
        F.when(_is_discharge(), F.col("_log_last")).otherwise(F.col("_log_first")).alias("logged_date"),
        "discharge_date",
    )


def keep_discharges_after_a_start(df: DataFrame) -> DataFrame:
    """A discharge counts only after an earlier program start at the same level."""
    level = W.partitionBy("casefile_id", "program_level")
    return (
        df.withColumn("_begun", F.min(F.when(_is_program(), F.col("start_date"))).over(level))
        .filter(_is_program() | (_is_discharge() & (F.col("_begun") < F.col("start_date"))))
        .drop("_begun")
    )


def drop_interim_discharges(df: DataFrame, hours: int = 24) -> DataFrame:
    """Drop a discharge that is followed by a program start within ``hours``."""
    ahead = W.partitionBy("casefile_id").orderBy("_us").rangeBetween(0, hours * 3_600_000_000)
    return (
        df.withColumn("_us", micros("start_date"))
        .withColumn("_restarts", F.count(F.when(_is_program(), 1)).over(ahead))
        .filter(~_is_discharge() | (F.col("_restarts") == 0))
        .drop("_us", "_restarts")
    )


def _case_order():
    names = ["start_date", "logged_date", "program_category", "program_class", "program_level"]
    return W.partitionBy("casefile_id").orderBy(*[F.col(n).asc_nulls_last() for n in names])


def number_stays(df: DataFrame) -> DataFrame:
    """Version number, version count, and the start of the following stay."""
    order = _case_order()
    return df.select(
        "*",
        F.lead("start_date").over(order).alias("next_start"),
        F.row_number().over(order).alias("ph_version"),
        F.count(F.lit(1)).over(W.partitionBy("casefile_id")).cast("int").alias("total_versions"),
        F.lead("program_class").over(order).alias("next_class"),
        F.lag("program_class").over(order).alias("previous_class"),
    )


def stay_end(as_of: Column) -> Column:
    """End of a stay; the first rule that holds wins."""
    last, discharged = F.col("next_start").isNull(), F.col("discharge_date")
    return (
        F.when(discharged < F.col("next_start"), discharged)
        .when(last & _is_discharge(), F.least(discharged, F.col("start_date")))
        .when(last & _is_program(), F.coalesce(discharged, F.date_trunc("second", as_of).cast("timestamp_ntz")))
        .otherwise(F.col("next_start"))
    )


def close_stays(df: DataFrame, as_of: datetime) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz")
    active = F.col("next_start").isNull() & _is_program() & F.col("discharge_date").isNull() & (F.col("start_date") < now)
    return df.withColumn("end_date", stay_end(now)).withColumn("is_active", active.cast("int"))


def add_measures(df: DataFrame) -> DataFrame:
    """Flags and lengths; only a program stay with start before end has any."""
    real = F.coalesce((F.col("start_date") < F.col("end_date")) & _is_program(), F.lit(False))
    at_discharge = F.col("end_date") == F.col("discharge_date")

    def flag(condition: Column) -> Column:
        return F.when(real & F.coalesce(condition, F.lit(False)), 1).otherwise(0)

    hours = F.round((micros("end_date") - micros("start_date")) / F.lit(3.6e9)).cast("bigint")
    return df.select(
        "casefile_id", "first_name", "last_name", "program_level", "program_category", "program_class",
        "start_date", "end_date", "discharge_date", "ph_version", "total_versions",
        F.coalesce("is_active", F.lit(0)).alias("is_active"),
        F.to_date("start_date").alias("start_day"),
        F.to_date("end_date").alias("end_day"),
        F.to_date("discharge_date").alias("discharge_day"),
        flag(F.lit(True)).alias("admission"),
        F.when(real, F.datediff("end_date", "start_date")).otherwise(0).alias("days_in_program"),
        F.when(real, hours).otherwise(F.lit(0).cast("bigint")).alias("hours_in_program"),
        flag((F.col("next_class") == PROGRAM) & ~F.coalesce(at_discharge, F.lit(False))).alias("transferred_out"),
        flag(F.col("previous_class") == PROGRAM).alias("transferred_in"),
        flag((F.col("next_class").eqNullSafe(DISCHARGE)) | F.coalesce(at_discharge, F.lit(False))).alias("discharged"),
    )


def build_history(
    log: DataFrame, program_types: DataFrame, latest: DataFrame, *, as_of: datetime, interim_hours: int = 24
) -> DataFrame:
    return (
        grouped_starts(log, program_types, latest)
        .transform(keep_discharges_after_a_start)
        .transform(drop_interim_discharges, interim_hours)
        .transform(number_stays)
        .transform(close_stays, as_of)
        .transform(add_measures)
    )


# The same two rules as joins; the windows above need no second copy of the rows.


def keep_discharges_by_semi_join(df: DataFrame) -> DataFrame:
    programs = df.filter(_is_program()).select(
        "casefile_id", "program_level", F.col("start_date").alias("_begun")
    )
    ended = df.filter(_is_discharge())
    found = ended.join(
        programs,
        (ended["casefile_id"] == programs["casefile_id"])
        & (ended["program_level"] == programs["program_level"])
        & (programs["_begun"] < ended["start_date"]),
        "left_semi",
    )
    return df.filter(_is_program()).unionByName(found)


def drop_interim_by_anti_join(df: DataFrame, hours: int = 24) -> DataFrame:
    programs = df.filter(_is_program()).select("casefile_id", micros("start_date").alias("_begun"))
    ended = df.filter(_is_discharge())
    gap = programs["_begun"] - micros(ended["start_date"])
    left = ended.join(
        programs,
        (ended["casefile_id"] == programs["casefile_id"]) & gap.between(0, hours * 3_600_000_000),
        "left_anti",
    )
    return df.filter(_is_program()).unionByName(left)
