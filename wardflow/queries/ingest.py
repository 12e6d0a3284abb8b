"""Ingest of landed replies, merges and the whole run.

The replies are built from the given tables as JSON text and read back
through the ingest code.
"""

from datetime import date, datetime

from pyspark.sql import functions as F

from wardflow import schemas
from wardflow.functions import records as X
from wardflow.functions.dates import to_local
from wardflow.operators import merge as M
from wardflow.operators.ordered import dealt, position
from wardflow.operators.quality import duplicate_keys, error_log, split_valid
from wardflow.plans import nightly
from wardflow.queries import ctes as Q
from wardflow.queries.registry import ORACLE, query
from wardflow.queries.views import daily, ended, history
from wardflow.session import scratch_dir
from wardflow.sources import landing as L, tables as S
from wardflow.sources.adapter import AS_OF, SPINE
from wardflow.sources.buckets import BucketTable

CUT = datetime(2024, 1, 20)
UTC_TEXT = "date_format({c} + INTERVAL '7' HOUR, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
OFFSET_TEXT = "date_format({c} + INTERVAL '7' HOUR, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\")"
LOCAL_TEXT = "date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"


def patient_replies(t, before=None):
    """One reply per case; times in three notations, and one column that is no time."""
    utc = [f"{UTC_TEXT.format(c=c)} AS {c}" for c in ("admission_date", "created_at", "last_updated_at")]
    local = [f"{LOCAL_TEXT.format(c=c)} AS {c}" for c in ("first_contact_date",)]
    offset = [f"{OFFSET_TEXT.format(c=c)} AS {c}" for c in ("discharge_date",)]
    plain = [n for n in schemas.PATIENT_REPLY.names if n not in ("first_contact_date", "admission_date", "discharge_date", "anticipated_discharge_date", "created_at", "last_updated_at", "insurances")]
    insurance = (
        "CASE WHEN insurance_company IS NOT NULL THEN array(named_struct('insurance_company', insurance_company), "
        "named_struct('insurance_company', 'second')) WHEN gender = 'F' THEN array() END AS insurances"
    )
    rows = t.latest(before).selectExpr(*plain, *utc, *local, *offset, "'soon' AS anticipated_discharge_date", insurance)
    return rows.select(
        "casefile_id", F.to_json(F.struct(F.array(F.struct(*schemas.PATIENT_REPLY.names)).alias("patients"))).alias("value")
    )


def form_pages(t, kind, before=None):
    """Paged replies, one record each, under a key that differs by kind."""
    rows = t.forms(kind)
    if before is not None:
        rows = rows.filter(F.col("created_at") < F.lit(before).cast("timestamp_ntz"))
    record = (
        "named_struct('id', form_id, 'name', name, 'status', status, 'patient_casefile_id', casefile_id, 'evaluation_id', evaluation_id, "
        f"'patient_process_id', patient_process_id, 'created_at', {UTC_TEXT.format(c='created_at')}, 'created_by', created_by, "
        f"'updated_at', {UTC_TEXT.format(c='updated_at')}, 'updated_by', updated_by, 'evaluation_content', evaluation_content)"
    )
    return rows.selectExpr(
        "form_id", f"to_json(named_struct('pagination', named_struct('total_pages', 2), '{kind}_evaluations', array({record}))) AS value"
    )


def landed_replies(t, replies):
    """Replies written to a landing folder and read back from its files."""
    return L.land(replies, f"{scratch_dir(t.spark)}/landing")


PAGE_SIZE = 4


def full_pages(t, kind):
    """Replies of ``PAGE_SIZE`` records each, in the order of their ids; there are as many pages as that takes."""
    record = F.get_json_object("value", f"$.{kind}_evaluations[0]")
    rows, series = dealt(form_pages(t, kind).select("form_id", record.alias("record")), [], ["form_id"])
    numbered = position(rows, series, "n")
    pages = -(-rows.count() // PAGE_SIZE)
    listed = numbered.groupBy((F.floor((F.col("n") - 1) / PAGE_SIZE) + 1).cast("int").alias("page")).agg(F.concat_ws(",", F.collect_list("record")).alias("records"))
    head = F.concat(F.lit('{"pagination": {"page": '), F.col("page"), F.lit(f', "total_pages": {pages}}}, "{kind}_evaluations": ['))
    return listed.select("page", F.concat(head, F.col("records"), F.lit("]}")).alias("value"))


STEP_RULE = (
    "CASE WHEN value < 10 THEN array(named_struct('name', 'Other', 'value', 'x')) "
    "WHEN value < 20 THEN array(named_struct('name', 'Step Down To', 'value', 'NA')) "
    "WHEN value < 30 THEN array(named_struct('name', 'Other', 'value', 'x'), named_struct('name', 'Step Down To', 'value', '')) "
    "ELSE array(named_struct('name', 'Step Down To', 'value', concat('level ', CAST(user_id AS STRING))), named_struct('name', 'Step Down To', 'value', 'later')) END"
)
STEP_RAW = "CASE WHEN value < 20 THEN 'NA' WHEN value < 30 THEN '' ELSE 'level ' || CAST(user_id AS VARCHAR) END"
STEP_CLEAN = "CASE WHEN value >= 30 THEN 'level ' || CAST(user_id AS VARCHAR) END"


def form_details(t):
    return t.case_events().filter("event_type = 'signup'").selectExpr(
        "event_id AS form_id",
        "to_json(named_struct('patient_evaluation', named_struct('id', event_id, 'patient_casefile_id', casefile_id, "
        f"'patient_evaluation_items', {STEP_RULE}))) AS value",
    )


def history_replies(t):
    """One reply per log row.  Some lack the patient, the id, the separator or the list."""
    entry = (
        "named_struct('program', program_name, 'start_date', " + UTC_TEXT.format(c="start_date") + ", 'logged_by', logged_by, "
        "'logged_at', " + LOCAL_TEXT.format(c="logged_at") + ")"
    )
    case = "CASE WHEN event_value < 2 THEN CAST(NULL AS STRING) WHEN event_value < 4 THEN '' WHEN event_value < 6 THEN patient_id ELSE casefile_id END"
    listed = f"CASE WHEN event_value < 8 THEN array() ELSE array({entry}) END"
    rows = t.program_log().join(
        t.events.select(F.col("event_id").alias("program_history_pk"), F.col("value").alias("event_value")), "program_history_pk"
    )
    return rows.selectExpr(
        "casefile_id",
        "program_history_pk",
        "CASE WHEN event_value < 1 THEN '{\"error\": \"no such patient\"}' ELSE to_json(named_struct('patient', named_struct("
        f"'casefile_id', {case}, 'first_name', first_name, 'last_name', last_name, 'program_history', {listed}))) END AS value",
    )


STAGED = """
staged AS (SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS anticipated_discharge_date) FROM latest)"""
STATE = [Q.CASE_EVENTS, Q.LATEST, STAGED]

query(
    "a_s2_incremental_pull",
    Q.using(STATE, "SELECT * FROM staged WHERE last_updated_at >= DATE '2024-01-10' AND last_updated_at < DATE '2024-01-21'"),
)(lambda t: L.updated_between(L.patients(landed_replies(t, patient_replies(t))), "last_updated_at", date(2024, 1, 10), date(2024, 1, 20)))
query("a_p1_normalised_patients", Q.using(STATE, "SELECT * FROM staged"))(lambda t: L.patients(landed_replies(t, patient_replies(t))))


@query(
    "a_p1_flatten",
    Q.using(
        Q.LOG,
        "SELECT program_history_pk, CASE WHEN value >= 6 THEN casefile_id WHEN value >= 4 THEN patient_id WHEN value >= 2 THEN '' END AS patient_casefile_id, "
        "CASE WHEN value >= 1 THEN first_name END AS patient_first_name, CASE WHEN value >= 1 THEN last_name END AS patient_last_name "
        "FROM program_log JOIN events ON event_id = program_history_pk",
    ),
)
def _(t):
    parsed = history_replies(t).select("program_history_pk", F.from_json("value", schemas.HISTORY_REPLY)["patient"].alias("patient"))
    return X.flatten(parsed, sep="_").drop("patient_program_history")


query("a_p2_first_insurance", Q.using(STATE, "SELECT casefile_id, insurance_company FROM staged"))(
    lambda t: L.patients(patient_replies(t)).select("casefile_id", "insurance_company")
)
query(
    "a_p3_split_key",
    Q.using([Q.CASE_EVENTS], "SELECT event_id, CAST(user_id AS VARCHAR) AS part0, split_part(casefile_id, ':', 2) AS part1, CAST(NULL AS VARCHAR) AS part2 FROM case_events"),
)(lambda t: t.case_events().select("event_id", *[X.split_key(F.col("casefile_id"), i).alias(f"part{i}") for i in range(3)]))


@query(
    "a_p6_local_time",
    "SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts ELSE ts - INTERVAL 7 HOUR END AS local_ts FROM events",
)
def _(t):
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    text = f"CASE event_type WHEN 'error' THEN 'not a time' WHEN 'view' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') WHEN 'click' THEN concat({iso}, 'Z') ELSE concat({iso}, '+00:00') END"
    return t.events.select("event_id", to_local(F.expr(text)).alias("local_ts"))


SIGNUPS = "FROM case_events WHERE event_type = 'signup'"
query("a_p7_step_down_value", Q.using([Q.CASE_EVENTS], f"SELECT event_id AS form_id, {STEP_RAW} AS step_down_value {SIGNUPS}"))(
    lambda t: L.step_down_values(form_details(t))
)
query(
    "a_p8_sentinels_to_null",
    Q.using([Q.CASE_EVENTS], f"SELECT event_id AS form_id, {STEP_CLEAN} AS step_down_value {SIGNUPS}"),
)(lambda t: L.step_down_values(form_details(t)).withColumn("step_down_value", X.clean_text(F.col("step_down_value"))))
query(
    "a_j9_forms_with_step_down",
    Q.using(
        [Q.CASE_EVENTS, Q.forms("detox")],
        f"SELECT f.*, {STEP_CLEAN} AS step_down_value, CASE WHEN value >= 30 THEN 'Yes' ELSE 'No' END AS transferred FROM detox_forms f JOIN events ON event_id = form_id",
    ),
)(lambda t: L.detox_forms(L.forms(form_pages(t, "detox")), L.step_down_values(form_details(t))))
query("a_s3_paged_pull", Q.using([Q.CASE_EVENTS, Q.forms("ama")], "SELECT *, 2 AS total_pages FROM ama_forms"))(
    lambda t: L.forms(form_pages(t, "ama")).join(
        form_pages(t, "ama").select("form_id", L.page_total(form_pages(t, "ama")).alias("total_pages")), "form_id"
    )
)


query("a_s3_pages_of_many_records", Q.using([Q.CASE_EVENTS, Q.forms("ama")], "SELECT * FROM ama_forms"))(lambda t: L.forms(landed_replies(t, full_pages(t, "ama").drop("page"))))
query(
    "a_s3_missing_pages",
    Q.using([Q.CASE_EVENTS, Q.forms("ama")], f"SELECT CAST(p AS INTEGER) AS page FROM (SELECT unnest(range(1, CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) + 1)) AS p FROM ama_forms) WHERE p % 3 = 0"),
)(lambda t: L.missing_pages(landed_replies(t, full_pages(t, "ama").filter("page % 3 <> 0").drop("page"))))


@query(
    "a_s4_case_replies",
    Q.using(
        [Q.CASE_EVENTS],
        "SELECT c.casefile_id, CASE WHEN v.casefile_id IS NULL THEN 'no reply' ELSE 'reply' END AS outcome, coalesce(v.n, 0) AS replies "
        "FROM (SELECT DISTINCT casefile_id FROM case_events) c LEFT JOIN (SELECT casefile_id, count(*) AS n FROM case_events WHERE event_type = 'view' GROUP BY 1) v USING (casefile_id)",
    ),
)
def _(t):
    answers = history_replies(t).join(
        t.events.filter("event_type = 'view'").select(F.col("event_id").alias("program_history_pk")), "program_history_pk"
    )
    found, missing = L.replies_for(t.case_state().select("casefile_id"), answers, "casefile_id")
    return (
        found.groupBy("casefile_id").agg(F.count(F.lit(1)).alias("replies")).select("casefile_id", F.lit("reply").alias("outcome"), "replies")
        .unionByName(missing.select("casefile_id", F.col("reason").alias("outcome"), F.lit(0).cast("bigint").alias("replies")))
    )


REASON = "CASE WHEN value < 1 THEN 'missing patient' WHEN value < 4 THEN 'missing casefile_id' WHEN value < 6 THEN 'malformed casefile_id' WHEN value < 8 THEN 'no program history' END"
query("a_f8_reply_checks", f"SELECT event_id AS program_history_pk, {REASON} AS reason FROM events WHERE value < 8")(
    lambda t: L.program_history(history_replies(t))[1].select("program_history_pk", "reason")
)
query(
    "a_s4_program_history_rows",
    Q.using(
        Q.LOG,
        "SELECT casefile_id, patient_id, patient_master_id, coalesce(first_name, '') AS first_name, last_name, program_name, start_date, logged_by, logged_at "
        "FROM program_log JOIN events ON event_id = program_history_pk WHERE value >= 8",
    ),
)(lambda t: L.program_history(landed_replies(t, history_replies(t)))[0])


@query("a_s5_stage_load", Q.using(STATE, "SELECT count(*) AS row_count, CAST(min(last_updated_at) AS DATE) AS first_day, CAST(max(last_updated_at) AS DATE) AS last_day FROM staged"))
def _(t):
    staged = S.load_staging(L.patients(patient_replies(t)), scratch_dir(t.spark))
    return staged.agg(
        F.count(F.lit(1)).alias("row_count"), F.to_date(F.min("last_updated_at")).alias("first_day"), F.to_date(F.max("last_updated_at")).alias("last_day")
    )


@query(
    "a_s6_bulk_copy",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, 'copied' AS status FROM {n}" for n in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"])
    + " UNION ALL SELECT 'empty', 0, 'skipped'",
)
def _(t):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    wanted = {n: getattr(t, n) for n in names}
    wanted["empty"] = t.events.filter("event_id < 0")
    return S.bulk_copy(t.spark, wanted, scratch_dir(t.spark))


CSV = ["casefile_id", "full_name", "discharge_class", "program_category", "discharge_date"]


@query("a_s7_csv_export", Q.using(Q.ENDED, "SELECT " + " || ',' || ".join(f"'\"' || coalesce(CAST({c} AS VARCHAR), 'null') || '\"'" for c in CSV) + " AS value FROM discharged_stays"))
def _(t):
    path = scratch_dir(t.spark)
    S.write_csv(ended(t).select(*CSV), path)
    # Every part file has a header line.
    return t.spark.read.text(path).filter(F.col("value") != ",".join(f'"{c}"' for c in CSV))


@query(
    "a_s8_json_rows",
    """SELECT '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","event_type":"' || event_type || '","value":' ||
  CASE WHEN value < 1 THEN 'null' ELSE CAST(value AS VARCHAR) END || '}' AS json FROM events""",
)
def _(t):
    rows = t.events.selectExpr("event_id", "ts", "event_type", "CASE WHEN value < 1 THEN double('NaN') ELSE value END AS value")
    return X.json_rows(rows)


# Merges

OLD = Q.latest("old_state", "ts < TIMESTAMP '2024-01-20 00:00:00'")
CHANGED = "SELECT n.casefile_id, n.patient_id, n.patient_master_id FROM latest n LEFT JOIN old_state o USING (casefile_id) WHERE o.casefile_id IS NULL OR n.program <> o.program"
ID = ["casefile_id", "patient_id", "patient_master_id"]


def diff(t):
    return M.changed_keys(t.latest(), t.latest(CUT), key="casefile_id", compare="program", columns=ID)


query("a_j7_changed_cases", Q.using([Q.CASE_EVENTS, Q.LATEST, OLD], CHANGED))(diff)


@query(
    "a_f7_change_kind",
    Q.using([Q.CASE_EVENTS, Q.LATEST, OLD], "SELECT CASE WHEN o.casefile_id IS NULL THEN 'new' ELSE 'changed' END AS kind, count(*) AS n FROM latest n LEFT JOIN old_state o USING (casefile_id) WHERE o.casefile_id IS NULL OR n.program <> o.program GROUP BY 1"),
)
def _(t):
    old = t.case_state(CUT).select("casefile_id", F.lit(True).alias("known"))
    kind = F.when(F.col("known"), "changed").otherwise("new")
    return diff(t).join(old, "casefile_id", "left").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# Helpers that take a name: a closed list of callables, no text built into SQL.
NAMED = {"fetch_diff_records": diff, "vw_daily_census": daily, "vw_program_history": history, "vw_discharges": ended}
query("a_x1_fetch_diff_records", Q.using([Q.CASE_EVENTS, Q.LATEST, OLD], CHANGED))(lambda t: NAMED["fetch_diff_records"](t))
query("a_x2_view_by_name", Q.using(Q.DAILY, "SELECT * FROM daily"))(lambda t: NAMED["vw_daily_census"](t))


@query("a_j8_new_log_rows", Q.using(Q.LOG, "SELECT * FROM program_log WHERE start_date >= TIMESTAMP '2024-01-20 00:00:00'"))
def _(t):
    log = t.program_log()
    return M.new_rows(log, log.filter(F.col("start_date") < F.lit(CUT).cast("timestamp_ntz")))


@query("a_a16_load_range", Q.using(Q.LOG, "SELECT min(logged_at) AS first_logged, max(logged_at) AS last_logged, count(*) AS row_count FROM program_log WHERE start_date >= TIMESTAMP '2024-01-20 00:00:00'"))
def _(t):
    fresh = t.program_log().filter(F.col("start_date") >= F.lit(CUT).cast("timestamp_ntz"))
    return fresh.agg(F.min("logged_at").alias("first_logged"), F.max("logged_at").alias("last_logged"), F.count(F.lit(1)).alias("row_count"))


@query(
    "a_a6_high_water",
    Q.using([Q.CASE_EVENTS, Q.LATEST, Q.forms("ama"), Q.forms("detox")], "SELECT 'latest' AS table_name, strftime(max(last_updated_at), '%Y-%m-%d') AS high_water FROM latest UNION ALL SELECT 'ama_forms', strftime(max(updated_at), '%Y-%m-%d') FROM ama_forms UNION ALL SELECT 'detox_forms', strftime(max(updated_at), '%Y-%m-%d') FROM detox_forms"),
)
def _(t):
    marks = {"latest": (t.latest(), "last_updated_at"), "ama_forms": (t.forms("ama"), "updated_at"), "detox_forms": (t.forms("detox"), "updated_at")}
    parts = [M.high_water_day(df, c).select(F.lit(n).alias("table_name"), "high_water") for n, (df, c) in marks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "a_i1_upsert_latest",
    Q.using([Q.CASE_EVENTS, Q.LATEST, OLD], "SELECT * FROM latest WHERE last_updated_at >= TIMESTAMP '2024-01-20 00:00:00' UNION ALL SELECT o.* FROM old_state o WHERE casefile_id NOT IN (SELECT casefile_id FROM latest WHERE last_updated_at >= TIMESTAMP '2024-01-20 00:00:00')"),
)
def _(t):
    fresh = t.latest().filter(F.col("last_updated_at") >= F.lit(CUT).cast("timestamp_ntz"))
    return M.upsert(t.latest(CUT), fresh, keys=["casefile_id"], version=["last_updated_at"])


@query(
    "a_i1_upsert_without_first_contact",
    Q.using([Q.CASE_EVENTS, Q.LATEST, OLD], "SELECT n.casefile_id, n.program, o.first_contact_date FROM latest n LEFT JOIN old_state o USING (casefile_id)"),
)
def _(t):
    cols = [c for c in schemas.LATEST.names if c != "first_contact_date"]
    out = M.upsert(t.latest(CUT), t.latest(), keys=["casefile_id"], cols=cols, version=["last_updated_at"])
    return out.select("casefile_id", "program", "first_contact_date")


for _name, _kind in [("a_i2_upsert_admin_forms", "admin"), ("a_i3_upsert_ama_forms", "ama"), ("a_i4_upsert_detox_forms", "detox")]:

    def _forms(t, kind=_kind):
        all_forms = t.forms(kind)
        edge = F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz")
        target = all_forms.filter(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
        staged = all_forms.filter(F.col("created_at") >= edge).withColumn("status", F.lit("revised"))
        return M.upsert(target, staged, keys=["form_id"], version=["updated_at"])

    query(
        _name,
        Q.using([Q.CASE_EVENTS, Q.forms(_kind)], f"SELECT * REPLACE (CASE WHEN created_at >= DATE '2024-01-10' THEN 'revised' ELSE status END AS status) FROM {_kind}_forms"),
    )(_forms)


def order_changes(t):
    """All orders with a new status; large ones a second time with a later version; some without a key."""
    return t.orders.selectExpr("o_orderkey", "'N' AS o_orderstatus", "o_totalprice", "1 AS version").unionByName(
        t.orders.filter("o_totalprice > 250000").selectExpr(
            "CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_orderkey END AS o_orderkey", "'R' AS o_orderstatus", "o_totalprice + 1 AS o_totalprice", "2 AS version"
        )
    )


@query(
    "a_i5_upsert_generic",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 250000 AND o_totalprice <= 400000 THEN 'R' ELSE 'N' END AS o_orderstatus, "
    "CASE WHEN o_totalprice > 250000 AND o_totalprice <= 400000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders",
)
def _(t):
    target = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    return M.upsert(target, order_changes(t), keys=["o_orderkey"], version=["version"])


def stored(t, target, key):
    """A target as a stored table of key buckets."""
    table = BucketTable(t.spark, scratch_dir(t.spark), target.schema, [key], 32)
    table.change(target, lambda _, rows: rows)
    return table


@query("a_i1_merge_stored_latest", ORACLE["a_i1_upsert_latest"])
def _(t):
    table = stored(t, t.latest(CUT), "casefile_id")
    fresh = t.latest().filter(F.col("last_updated_at") >= F.lit(CUT).cast("timestamp_ntz"))
    for _ in range(2):  # twice is as good as once
        M.merge_into(table, fresh, version=["last_updated_at"])
    return table.read()


for _name, _kind in [("a_i2_merge_stored_admin_forms", "admin"), ("a_i3_merge_stored_ama_forms", "ama"), ("a_i4_merge_stored_detox_forms", "detox")]:

    def _stored_forms(t, kind=_kind):
        all_forms = t.forms(kind)
        edge = F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz")
        table = stored(t, all_forms.filter(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")), "form_id")
        M.merge_into(table, all_forms.filter(F.col("created_at") >= edge).withColumn("status", F.lit("revised")), version=["updated_at"])
        return table.read()

    query(_name, ORACLE[_name.replace("merge_stored", "upsert")])(_stored_forms)


@query("a_i5_merge_stored_generic", ORACLE["a_i5_upsert_generic"])
def _(t):
    table = stored(t, t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey"), "o_orderkey")
    M.merge_into(table, order_changes(t), version=["version"])
    return table.read()


@query("a_i5_stored_insert_and_delete", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN o_orderstatus ELSE 'new' END AS o_orderstatus FROM orders WHERE o_totalprice <= 300000")
def _(t):
    """Orders over 100000 are there; the others are inserted, those over 300000 deleted."""
    table = stored(t, t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    M.ignore_into(table, t.orders.selectExpr("o_orderkey", "'new' AS o_orderstatus", "1 AS version"), version=["version"])
    M.delete_from(table, t.orders.filter("o_totalprice > 300000"))
    return table.read()


query("a_i6_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(
    lambda t: duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
)


@query(
    "a_i7_error_isolation",
    "SELECT CAST(NULL AS VARCHAR) AS record_key, 'key is missing' AS error_message, TIMESTAMP '2024-02-01 00:00:00' AS error_time, 'upsert_orders' AS procedure_name FROM orders WHERE o_totalprice > 400000 "
    "UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'price is too low', TIMESTAMP '2024-02-01 00:00:00', 'upsert_orders' FROM orders WHERE o_totalprice < 2000",
)
def _(t):
    rules = [("key is missing", F.col("o_orderkey").isNull()), ("price is too low", F.col("o_totalprice") < 2000)]
    _, bad = split_valid(order_changes(t), rules)
    return error_log(bad, "o_orderkey", "upsert_orders", AS_OF)


@query(
    "a_i8_refresh_views",
    Q.using([*Q.ENDED, Q.CENSUS], "SELECT 'history' AS view_name, 'ok' AS status, count(*) AS row_count FROM history UNION ALL SELECT 'census', 'ok', count(*) FROM daily UNION ALL SELECT 'broken', 'failed', NULL UNION ALL SELECT 'discharges', 'ok', count(*) FROM discharged_stays"),
)
def _(t):
    return refreshed(t)[1].drop("error")


def refreshed(t):
    from wardflow.plans.census import daily_census
    from wardflow.plans.discharges import discharges

    steps = {
        "history": lambda _: history(t),
        "census": lambda v: daily_census(v["history"], start=SPINE[0], end=SPINE[1]),
        "broken": lambda v: v["no_such_view"],
        "discharges": lambda v: discharges(v["history"], t.case_state(), t.discharge_types(), t.forms("ama"), t.forms("admin")),
    }
    return S.refresh_views(t.spark, steps, scratch_dir(t.spark))


query("a_i8_refreshed_census", ORACLE["a_v2_daily_census"])(lambda t: refreshed(t)[0]["census"])
query("a_i8_refreshed_discharges", ORACLE["a_v3_discharges"])(lambda t: refreshed(t)[0]["discharges"])


def pulled(t):
    """Views after three pulls, each with what was logged or updated since the one before, and with a clock of its own."""
    from wardflow.plans.incremental import StoredViews

    views = StoredViews(t.spark, scratch_dir(t.spark), t.program_types(), *SPINE, buckets=16)
    log, since = t.program_log(), datetime(2000, 1, 1)
    for until in (datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2024, 3, 1)):
        new = log.filter((F.col("logged_at") >= F.lit(since).cast("timestamp_ntz")) & (F.col("logged_at") < F.lit(until).cast("timestamp_ntz")))
        state = t.latest(until) if until < AS_OF else t.latest()
        views.refresh(new, state.filter(F.col("last_updated_at") >= F.lit(since).cast("timestamp_ntz")), min(until, AS_OF))
        since = until
    return views


query("a_i8_incremental_history", ORACLE["a_v1_program_history"])(lambda t: pulled(t).history())
query("a_i8_incremental_census", ORACLE["a_v2_daily_census"])(lambda t: pulled(t).census())


def landed(t):
    return {
        "patients": patient_replies(t), "ama_forms": form_pages(t, "ama"), "admin_discharge": form_pages(t, "admin"),
        "detox_forms": form_pages(t, "detox"), "detox_details": form_details(t), "program_history": history_replies(t),
    }


def empty_state(t):
    return {n: t.spark.createDataFrame([], s) for n, s in nightly.TABLE_SCHEMAS.items()}


@query(
    "a_i9_whole_run",
    Q.using(
        [*Q.LOG, Q.LATEST, Q.forms("ama"), Q.forms("admin"), Q.forms("detox")],
        "SELECT 'latest' AS step, 'ok' AS status, 0 AS rows_before, count(*) AS rows_after FROM latest UNION ALL SELECT 'program_history', 'ok', 0, count(*) FROM events WHERE value >= 8 "
        "UNION ALL SELECT 'ama_forms', 'ok', 0, count(*) FROM ama_forms UNION ALL SELECT 'admin_discharge', 'ok', 0, count(*) FROM admin_forms UNION ALL SELECT 'detox_forms', 'ok', 0, count(*) FROM detox_forms "
        "UNION ALL SELECT 'error_log', 'ok', 0, count(*) FROM events WHERE value < 8",
    ),
)
def _(t):
    return whole_run(t)[1].filter("rows_before IS NOT NULL")


@query("a_i9_stored_state", ORACLE["a_p1_normalised_patients"])
def _(t):
    """Two runs on stored tables, the second with nothing new."""
    refs = {"program_types": t.program_types(), "discharge_types": t.discharge_types()}
    folder = scratch_dir(t.spark)
    for night in range(2):
        state = empty_state(t) | nightly.stored_tables(t.spark, f"{folder}/tables", 16)
        tables, _ = nightly.run(t.spark, landed(t), state, refs, f"{folder}/{night}", as_of=AS_OF, start=SPINE[0], end=SPINE[1])
    return tables["latest"]


def whole_run(t):
    refs = {"program_types": t.program_types(), "discharge_types": t.discharge_types()}
    return nightly.run(t.spark, landed(t), empty_state(t), refs, scratch_dir(t.spark), as_of=AS_OF, start=SPINE[0], end=SPINE[1])


query("a_i9_merged_log", ORACLE["a_s4_program_history_rows"])(lambda t: whole_run(t)[0]["program_history"])
query("a_i9_merged_state", ORACLE["a_p1_normalised_patients"])(lambda t: whole_run(t)[0]["latest"])


@query("a_i10_sequence_key", "SELECT event_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY ts, event_id) AS log_pk FROM events")
def _(t):
    top = t.orders.agg(F.max("o_orderkey").alias("top"))
    return M.sequence_key(t.events.select("event_id", "ts"), ["ts", "event_id"], "log_pk", top).select("event_id", "log_pk")


@query("a_i10_hashed_key", "SELECT event_id, md5(concat(length(CAST(event_id AS VARCHAR)), ':', event_id, '|', length(event_type), ':', event_type)) AS k FROM events")
def _(t):
    return t.events.select("event_id", M.hashed_key(["event_id", "event_type"]).alias("k"))


@query("a_a15_row_counts", "SELECT 'orders' AS step, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def _(t):
    folder = scratch_dir(t.spark)
    counts = [(n, S.write_counted(getattr(t, n), f"{folder}/{n}")) for n in ["orders", "lineitem"]]
    return S.report(t.spark, counts, "step string, row_count long")


@query("a_u2_append_and_distinct", "SELECT DISTINCT o_custkey AS id, o_orderstatus AS kind, CAST(NULL AS VARCHAR) AS segment FROM orders UNION SELECT c_custkey, NULL, c_mktsegment FROM customer")
def _(t):
    a = t.orders.selectExpr("o_custkey AS id", "o_orderstatus AS kind")
    b = t.customer.selectExpr("c_custkey AS id", "c_mktsegment AS segment")
    return a.unionByName(b, allowMissingColumns=True).dropDuplicates()
