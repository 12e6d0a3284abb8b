"""Logical tables derived from the star-schema test tables.

Every rule is a plain expression of the given rows; nothing is invented
beyond the two small lookup tables.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.schemas import SOURCE_TABLES

AS_OF = datetime(2024, 2, 1)
SPINE = (date(2024, 1, 1), date(2024, 2, 1))

# The lookup rows of the test data.
PROGRAM_TYPE_ROWS = [
    ("view", "Inpatient", "Detox", "Program", "Main"),
    ("click", "Inpatient", "Residential", "Program", "Main"),
    ("signup", "Outpatient", "SUD IOP", "Program", "North"),
    ("purchase", "Outpatient", "Psych IOP", "Program", "North"),
    ("error", "Outpatient", "Discharge", "Discharge", "North"),
    ("admin_hold", "Administrative", "Hold", "Program", "Main"),
]
DISCHARGE_TYPE_ROWS = [
    ("T0", "Completed", "Successful"),
    ("T1", "Moved by staff", "Administrative"),
    ("T2", "Left early", "AMA"),
    ("T3", "Other", None),
]


def lookup(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small literal text table; Spark knows its size, so joins to it need no hint."""

    def cell(v: str | None) -> str:
        return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS lookup({', '.join(names)})")


class Tables:
    """The given tables by attribute, and the logical tables by method."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.schema(SOURCE_TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def case_events(self) -> DataFrame:
        part = F.floor((F.dayofmonth("ts") - 1) / 10).cast("string")
        return self.events.withColumn("casefile_id", F.concat(F.col("user_id").cast("string"), F.lit(":"), part))

    def program_log(self) -> DataFrame:
        """The append-only log: one row per event."""
        return (
            self.case_events()
            .join(self.customer, F.col("c_custkey") == F.col("user_id"), "left")
            .selectExpr(
                "casefile_id",
                "CAST(user_id AS STRING) AS patient_id",
                "element_at(split(casefile_id, ':'), 2) AS patient_master_id",
                "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS first_name",
                "c_name AS last_name",
                "CASE WHEN event_id % 17 = 0 THEN 'admin_hold' ELSE event_type END AS program_name",
                "ts AS start_date",
                "'log' AS logged_by",
                "ts + INTERVAL '5' MINUTE AS logged_at",
                "event_id AS program_history_pk",
            )
        )

    def case_state(self, before: datetime | None = None) -> DataFrame:
        """One row per case: first and last time, last program, discharge."""
        events = self.case_events()
        if before is not None:
            events = events.filter(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
        return (
            events.groupBy("casefile_id", "user_id")
            .agg(F.expr("min(ts) AS first_ts"), F.expr("max(ts) AS last_ts"), F.expr("max_by(event_type, struct(ts, event_id)) AS program"))
            .selectExpr(
                "*",
                "CASE user_id % 3 WHEN 1 THEN last_ts + INTERVAL '12' HOUR WHEN 2 THEN last_ts - INTERVAL '24' HOUR END AS discharge_date",
                "concat('T', CAST(user_id % 5 AS STRING)) AS discharge_type_code",
            )
        )

    def latest(self, before: datetime | None = None) -> DataFrame:
        """Current state, one row per case, all columns."""
        return (
            self.case_state(before)
            .join(self.customer, F.col("c_custkey") == F.col("user_id"), "left")
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .selectExpr(
                "casefile_id",
                "CAST(user_id AS STRING) AS patient_id",
                "element_at(split(casefile_id, ':'), 2) AS patient_master_id",
                "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS first_name",
                "c_name AS last_name",
                "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
                "first_ts - INTERVAL '1' DAY AS first_contact_date",
                "first_ts AS admission_date",
                "discharge_date",
                "last_ts + INTERVAL '2' DAY AS anticipated_discharge_date",
                "CAST(NULL AS STRING) AS discharge_type",
                "discharge_type_code",
                "CAST(NULL AS STRING) AS referrer_name",
                "concat('MR', CAST(user_id AS STRING)) AS mr_number",
                "c_mktsegment AS payment_method",
                "CAST(NULL AS STRING) AS payment_method_category",
                "first_ts AS created_at",
                "last_ts AS last_updated_at",
                "CASE WHEN c_acctbal >= 0 THEN n_name END AS insurance_company",
                "CAST(NULL AS STRING) AS level_of_care",
                "program",
                "CAST(c_nationkey AS DOUBLE) AS location_id",
                "n_name AS location_name",
                "'events' AS record_source",
            )
        )

    def program_types(self) -> DataFrame:
        names = ["program", "program_level", "program_category", "program_class", "program_location"]
        return lookup(self.spark, names, PROGRAM_TYPE_ROWS)

    def discharge_types(self) -> DataFrame:
        return lookup(self.spark, ["discharge_type_code", "discharge_type", "discharge_class"], DISCHARGE_TYPE_ROWS)

    def forms(self, kind: str) -> DataFrame:
        """Form tables: an 'error' event with a high value is an AMA form, with a low one an
        administrative form; a 'signup' event is a detox form."""
        rule = {
            "ama": "event_type = 'error' AND value >= 150",
            "admin": "event_type = 'error' AND value < 5",
            "detox": "event_type = 'signup'",
        }[kind]
        return (
            self.case_events()
            .filter(rule)
            .selectExpr(
                "event_id AS form_id",
                f"'{kind} form' AS name",
                "'complete' AS status",
                "casefile_id",
                "CAST(value AS BIGINT) AS evaluation_id",
                "user_id AS patient_process_id",
                "ts AS created_at",
                "'staff' AS created_by",
                "ts + INTERVAL '1' HOUR AS updated_at",
                "'staff' AS updated_by",
                "props AS evaluation_content",
                "CAST(user_id AS STRING) AS patient_id",
                "element_at(split(casefile_id, ':'), 2) AS patient_master_id",
            )
        )

    def movements(self) -> dict[str, DataFrame]:
        """The older model: three event tables, from orders by status."""
        out = {}
        for name, status in (("admissions", "O"), ("transfers", "P"), ("discharges", "F")):
            cols = {
                "id": "o_orderkey",
                "organization_id": "CAST(o_custkey % 4 AS INT)",
                "program": "o_orderpriority",
                "created_at": "o_orderdate",
                "patient_id": "o_custkey",
            }
            if name == "discharges":
                cols["discharge_type"] = "CASE WHEN o_totalprice < 150000 THEN 'AMA' WHEN o_totalprice < 300000 THEN 'Admin' ELSE 'Successful' END"
            out[name] = self.orders.filter(F.col("o_orderstatus") == status).selectExpr(
                *[f"{e} AS {n}" for n, e in cols.items()]
            )
        return out
