"""One whole run: landed replies to tables, then views.

A run reads one generation of tables and writes the next one to a new folder, so that a
failed run leaves the tables in use as they were.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow import schemas
from wardflow.operators.merge import changed_keys, hashed_key, merge_into, new_rows, upsert
from wardflow.operators.quality import error_log, split_valid
from wardflow.plans.census import daily_census
from wardflow.plans.discharges import discharges
from wardflow.plans.history import build_history
from wardflow.sources import landing
from wardflow.sources.buckets import BUCKETS, BucketTable
from wardflow.sources.tables import load_staging, refresh_views, report, write_counted

FORM_TABLES = ["ama_forms", "admin_discharge", "detox_forms"]
KEYS = {"latest": "casefile_id", "ama_forms": "form_id", "admin_discharge": "form_id", "detox_forms": "form_id"}
VERSION = {"latest": "last_updated_at", "ama_forms": "updated_at", "admin_discharge": "updated_at", "detox_forms": "updated_at"}
TABLE_SCHEMAS = {
    "latest": schemas.LATEST,
    "program_history": schemas.PROGRAM_HISTORY,
    "ama_forms": schemas.FORMS,
    "admin_discharge": schemas.FORMS,
    "detox_forms": schemas.DETOX_FORMS,
}


def merge_table(name: str, current: DataFrame, staged: DataFrame, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """The next state of a keyed table, and the rows set aside."""
    key = KEYS[name]
    good, bad = split_valid(staged, [(f"{key} is missing", F.col(key).isNull())])
    return (
        upsert(current, good, keys=[key], version=[VERSION[name]]),
        error_log(bad, key, f"upsert_{name}", as_of),
    )


def merge_stored(name: str, table: BucketTable, staged: DataFrame, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """The same on a stored table, of which only the buckets of the staged keys are read and written."""
    key = KEYS[name]
    good, bad = split_valid(staged, [(f"{key} is missing", F.col(key).isNull())])
    merge_into(table, good, version=[VERSION[name]])
    return table.read(), error_log(bad, key, f"upsert_{name}", as_of)


def stored_tables(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> dict[str, BucketTable]:
    """The keyed tables of a run as stored tables below a folder."""
    return {n: BucketTable(spark, f"{folder}/{n}", TABLE_SCHEMAS[n], [k], buckets) for n, k in KEYS.items()}


def run(
    spark: SparkSession,
    landed: dict[str, DataFrame],
    current: dict[str, DataFrame | BucketTable],
    references: dict[str, DataFrame],
    folder: str,
    *,
    as_of: datetime,
    start,
    end,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Returns the next generation of tables and views, and a summary by step.

    A keyed table given as a stored table is merged where it is, by the buckets of the keys that came; one given as a frame is written anew.
    """
    stored = {n: t for n, t in current.items() if isinstance(t, BucketTable)}
    current = {n: t.read() if n in stored else t for n, t in current.items()}
    staged = {"latest": landing.patients(landed["patients"])}
    for name in FORM_TABLES:
        rows = landing.forms(landed[name])
        if name == "detox_forms":
            rows = landing.detox_forms(rows, landing.step_down_values(landed["detox_details"]))
        staged[name] = rows
    # Several steps read a pull; staged as a table, its JSON is parsed once.
    staged = {name: load_staging(df, f"{folder}/staging/{name}") for name, df in staged.items()}
    # Changed cases are found against the old state, before it is merged.
    work = changed_keys(
        staged["latest"], current["latest"], key="casefile_id", compare="program", columns=["casefile_id"]
    )
    # The log and two parts of the error log read the matched replies; staged, they are matched and parsed once.
    found, unanswered = landing.replies_for(
        work, landed["program_history"], "casefile_id",
        lambda df: load_staging(landing.history_patients(df).select("casefile_id", "patient", "_found"), f"{folder}/staging/replies"),
    )
    log_rows, bad_replies = landing.program_history(found)
    fresh = new_rows(log_rows, current["program_history"])

    tables: dict[str, DataFrame] = {}
    summary, errors = [], [
        error_log(unanswered, "casefile_id", "program_history", as_of),
        error_log(bad_replies, "casefile_id", "program_history", as_of),
    ]
    plans = {"program_history": current["program_history"].unionByName(fresh)}
    for name in ["latest", *FORM_TABLES]:
        if name in stored:
            before = current[name].count()
            tables[name], bad = merge_stored(name, stored[name], staged[name], as_of)
            summary.append((name, "ok", before, tables[name].count()))
        else:
            plans[name], bad = merge_table(name, current[name], staged[name], as_of)
        errors.append(bad)
    for name, df in plans.items():
        after = write_counted(df, f"{folder}/{name}")
        tables[name] = spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}")
        summary.append((name, "ok", current[name].count(), after))
    log = errors[0]
    for more in errors[1:]:
        log = log.unionByName(more)
    summary.append(("error_log", "ok", 0, write_counted(log.withColumn("error_log_id", hashed_key(log.columns)), f"{folder}/error_log")))

    views, status = refresh_views(
        spark,
        {
            "history": lambda _: build_history(
                tables["program_history"], references["program_types"], tables["latest"], as_of=as_of
            ),
            "census": lambda v: daily_census(v["history"], start=start, end=end),
            "discharges": lambda v: discharges(
                v["history"], tables["latest"], references["discharge_types"], tables["ama_forms"], tables["admin_discharge"]
            ),
        },
        f"{folder}/views",
    )
    steps = report(spark, summary, "step string, status string, rows_before long, rows_after long").unionByName(
        status.selectExpr("view_name AS step", "status", "CAST(NULL AS BIGINT) AS rows_before", "row_count AS rows_after")
    )
    return {**tables, **views}, steps
