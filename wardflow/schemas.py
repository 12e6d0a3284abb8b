"""Column types of the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, TS, DT = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


LATEST = _schema(
    casefile_id=S, patient_id=S, patient_master_id=S, first_name=S, last_name=S, gender=S,
    first_contact_date=TS, admission_date=TS, discharge_date=TS, anticipated_discharge_date=TS,
    discharge_type=S, discharge_type_code=S, referrer_name=S, mr_number=S, payment_method=S,
    payment_method_category=S, created_at=TS, last_updated_at=TS, insurance_company=S, level_of_care=S,
    program=S, location_id=D, location_name=S, record_source=S,
)
PROGRAM_HISTORY = _schema(
    casefile_id=S, patient_id=S, patient_master_id=S, first_name=S, last_name=S, program_name=S,
    start_date=TS, logged_by=S, logged_at=TS,
)
PROGRAM_TYPES = _schema(program=S, program_level=S, program_category=S, program_class=S, program_location=S)
DISCHARGE_TYPES = _schema(
    discharge_type_code=S, discharge_type=S, discharge_class=S, discharge_category=S,
    discharge_subcategory=S, transfer_program=S,
)
FORMS = _schema(
    form_id=L, name=S, status=S, casefile_id=S, evaluation_id=L, patient_process_id=L, created_at=TS,
    created_by=S, updated_at=TS, updated_by=S, evaluation_content=S, patient_id=S, patient_master_id=S,
)
DETOX_FORMS = T.StructType([*FORMS.fields, T.StructField("step_down_value", S), T.StructField("transferred", S)])
ERROR_LOG = _schema(record_key=S, error_message=S, error_time=TS, procedure_name=S)

# Shapes of the source replies.  Times arrive as text.
PATIENT_REPLY = _schema(
    casefile_id=S, first_name=S, last_name=S, gender=S, first_contact_date=S, admission_date=S,
    discharge_date=S, anticipated_discharge_date=S, discharge_type=S, discharge_type_code=S, referrer_name=S,
    mr_number=S, payment_method=S, payment_method_category=S, created_at=S, last_updated_at=S,
    insurances=T.ArrayType(_schema(insurance_company=S)), level_of_care=S, program=S, location_id=D,
    location_name=S, record_source=S,
)
HISTORY_REPLY = _schema(
    patient=_schema(
        casefile_id=S, first_name=S, last_name=S,
        program_history=T.ArrayType(_schema(program=S, start_date=S, logged_by=S, logged_at=S)),
    )
)
FORM_REPLY = _schema(
    id=L, name=S, status=S, patient_casefile_id=S, evaluation_id=L, patient_process_id=L, created_at=S,
    created_by=S, updated_at=S, updated_by=S, evaluation_content=S,
)
FORM_DETAIL_REPLY = _schema(
    patient_evaluation=_schema(
        id=L, patient_casefile_id=S, patient_evaluation_items=T.ArrayType(_schema(name=S, value=S))
    )
)

# The given star-schema tables.  A stated schema saves a footer read per scan.
SOURCE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
