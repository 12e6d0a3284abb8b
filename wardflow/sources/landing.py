"""Landed JSON replies to typed rows.

A landing folder holds one reply per file.  Readers take a frame with the reply text in
``value``, so that files, streams and tables of replies go through the same code.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wardflow import schemas
from wardflow.functions.dates import to_local
from wardflow.functions.records import clean_text, first_item, split_key
from wardflow.operators.quality import split_valid


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """All reply files below a folder, one row per file."""
    return spark.read.text(path, wholetext=True)


def land(replies: DataFrame, path: str) -> DataFrame:
    """Write replies below a folder, one to a line, and read them from there; a JSON reply has no line breaks of its own."""
    replies.select("value").write.text(path)
    return replies.sparkSession.read.text(path)


def missing_pages(raw: DataFrame) -> DataFrame:
    """Pages that a paged pull announced and that have not come.

    A reply tells its page and how many there are; without a single reply nothing is known to be missing.
    """
    told = raw.select(F.get_json_object("value", "$.pagination.page").cast("int").alias("page"), page_total(raw).alias("total"))
    total = told.agg(F.max("total").alias("total"))
    due = total.filter("total IS NOT NULL").select(F.explode(F.sequence(F.lit(1), F.col("total"))).alias("page"))
    return due.join(told.select("page").distinct(), "page", "left_anti")


def _localise(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: to_local(F.col(n)) for n in names})


def patients(raw: DataFrame) -> DataFrame:
    """Patient replies to the columns of the current-state table."""
    reply = T.StructType([T.StructField("patients", T.ArrayType(schemas.PATIENT_REPLY))])
    rows = raw.select(F.inline(F.from_json("value", reply)["patients"]))
    rows = rows.withColumns(
        {
            "insurance_company": F.get("insurances", F.lit(0))["insurance_company"],
            "patient_id": split_key(F.col("casefile_id"), 0),
            "patient_master_id": split_key(F.col("casefile_id"), 1),
        }
    )
    times = ["created_at", "last_updated_at", "admission_date", "discharge_date", "anticipated_discharge_date", "first_contact_date"]
    return _localise(rows, times).select(*schemas.LATEST.names)


def updated_between(df: DataFrame, column: str, low: date, high: date) -> DataFrame:
    """Rows of whole days, both ends included."""
    day = F.col(column)
    return df.filter((day >= F.lit(low)) & (day < F.date_add(F.lit(high), 1)))


def page_records(raw: DataFrame, record: T.StructType) -> DataFrame:
    """Records of paged replies.  They are the array under the last key of a reply."""
    last_key = F.element_at(F.json_object_keys("value"), -1)
    path = F.concat(F.lit("$['"), last_key, F.lit("']"))
    return raw.select(F.inline(F.from_json(F.call_function("get_json_object", F.col("value"), path), T.ArrayType(record))))


def page_total(raw: DataFrame) -> Column:
    return F.coalesce(F.get_json_object("value", "$.pagination.total_pages").cast("int"), F.lit(1))


def forms(raw: DataFrame) -> DataFrame:
    """Paged form replies to the columns of a form table."""
    rows = page_records(raw, schemas.FORM_REPLY).withColumnsRenamed({"patient_casefile_id": "casefile_id", "id": "form_id"})
    rows = rows.withColumns(
        {"patient_id": split_key(F.col("casefile_id"), 0), "patient_master_id": split_key(F.col("casefile_id"), 1)}
    )
    return _localise(rows, ["created_at", "updated_at"]).select(*schemas.FORMS.names)


def step_down_values(raw: DataFrame) -> DataFrame:
    """Form detail replies to ``form_id`` and the 'Step Down To' answer."""
    detail = F.from_json("value", schemas.FORM_DETAIL_REPLY)["patient_evaluation"]
    return raw.select(detail.alias("d")).select(
        F.col("d.id").alias("form_id"), first_item(F.col("d.patient_evaluation_items"), "Step Down To").alias("step_down_value")
    )


def detox_forms(form_rows: DataFrame, details: DataFrame) -> DataFrame:
    """Forms with their step-down answer, joined by form.

    The answer belongs to a form, so it is not shared between forms of one case.
    """
    return (
        form_rows.join(details, "form_id", "left")
        .withColumn("step_down_value", clean_text(F.col("step_down_value")))
        .withColumn("transferred", F.when(F.col("step_down_value").isNotNull(), "Yes").otherwise("No"))
        .dropDuplicates()
    )


def history_rules() -> list[tuple[str, Column]]:
    """Reasons to set a history reply aside, in the order they are tested."""
    case = F.col("patient.casefile_id")
    return [
        ("missing patient", F.col("patient").isNull()),
        ("missing casefile_id", case.isNull() | (case == "")),
        ("malformed casefile_id", F.size(F.split(case, ":")) < 2),
        ("no program history", F.coalesce(F.size("patient.program_history"), F.lit(0)) <= 0),
    ]


def history_patients(raw: DataFrame) -> DataFrame:
    """History replies with the patient they tell of."""
    return raw.withColumn("patient", F.from_json("value", schemas.HISTORY_REPLY)["patient"])


def program_history(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """History replies to log rows, and the replies set aside with their reason; replies that have been read (``history_patients``) are not read again."""
    parsed = raw if "patient" in raw.columns else history_patients(raw)
    good, bad = split_valid(parsed, history_rules())
    rows = good.select(
        F.col("patient.casefile_id").alias("casefile_id"),
        split_key(F.col("patient.casefile_id"), 0).alias("patient_id"),
        split_key(F.col("patient.casefile_id"), 1).alias("patient_master_id"),
        F.coalesce("patient.first_name", F.lit("")).alias("first_name"),
        F.coalesce("patient.last_name", F.lit("")).alias("last_name"),
        F.inline("patient.program_history"),
    ).withColumnRenamed("program", "program_name")
    return _localise(rows, ["start_date", "logged_at"]).select(*schemas.PROGRAM_HISTORY.names), bad


def replies_for(work: DataFrame, replies: DataFrame, key: str, stage: Callable[[DataFrame], DataFrame] = lambda matched: matched) -> tuple[DataFrame, DataFrame]:
    """Match a work list with its replies; work without a reply is set aside.  ``stage`` may write the matches, since both results read them."""
    matched = stage(work.join(replies, key, "left").withColumn("_found", F.col("value").isNotNull()))
    return (
        matched.filter("_found").drop("_found"),
        matched.filter("NOT _found").select(key, F.lit("no reply").alias("reason")),
    )
