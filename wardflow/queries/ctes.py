"""The logical tables and stay rules once more, as DuckDB SQL for the checks."""

CASE_EVENTS = """
case_events AS (
  SELECT *, CAST(user_id AS VARCHAR) || ':' || CAST((day(ts) - 1) // 10 AS VARCHAR) AS casefile_id FROM events)"""

PROGRAM_LOG = """
program_log AS (
  SELECT casefile_id, CAST(user_id AS VARCHAR) AS patient_id, split_part(casefile_id, ':', 2) AS patient_master_id,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS first_name, c_name AS last_name,
         CASE WHEN event_id % 17 = 0 THEN 'admin_hold' ELSE event_type END AS program_name,
         ts AS start_date, 'log' AS logged_by, ts + INTERVAL 5 MINUTE AS logged_at, event_id AS program_history_pk
  FROM case_events LEFT JOIN customer ON c_custkey = user_id)"""

PROGRAM_TYPES = """
program_types(program, program_level, program_category, program_class, program_location) AS (VALUES
  ('view', 'Inpatient', 'Detox', 'Program', 'Main'), ('click', 'Inpatient', 'Residential', 'Program', 'Main'),
  ('signup', 'Outpatient', 'SUD IOP', 'Program', 'North'), ('purchase', 'Outpatient', 'Psych IOP', 'Program', 'North'),
  ('error', 'Outpatient', 'Discharge', 'Discharge', 'North'), ('admin_hold', 'Administrative', 'Hold', 'Program', 'Main'))"""

def latest(name: str = "latest", where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT casefile_id, CAST(user_id AS VARCHAR) AS patient_id, split_part(casefile_id, ':', 2) AS patient_master_id,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS first_name, c_name AS last_name,
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         first_ts - INTERVAL 1 DAY AS first_contact_date, first_ts AS admission_date,
         CASE user_id % 3 WHEN 1 THEN last_ts + INTERVAL 12 HOUR WHEN 2 THEN last_ts - INTERVAL 24 HOUR END AS discharge_date,
         last_ts + INTERVAL 2 DAY AS anticipated_discharge_date, CAST(NULL AS VARCHAR) AS discharge_type,
         'T' || CAST(user_id % 5 AS VARCHAR) AS discharge_type_code, CAST(NULL AS VARCHAR) AS referrer_name,
         'MR' || CAST(user_id AS VARCHAR) AS mr_number, c_mktsegment AS payment_method,
         CAST(NULL AS VARCHAR) AS payment_method_category, first_ts AS created_at, last_ts AS last_updated_at,
         CASE WHEN c_acctbal >= 0 THEN n_name END AS insurance_company, CAST(NULL AS VARCHAR) AS level_of_care,
         program, CAST(c_nationkey AS DOUBLE) AS location_id, n_name AS location_name, 'events' AS record_source
  FROM (SELECT casefile_id, user_id, min(ts) AS first_ts, max(ts) AS last_ts,
               arg_max(event_type, (ts, event_id)) AS program FROM case_events WHERE {where} GROUP BY 1, 2) c
  LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey)"""


LATEST = latest()

DISCHARGE_TYPES = """
discharge_types(discharge_type_code, discharge_type, discharge_class) AS (VALUES
  ('T0', 'Completed', 'Successful'), ('T1', 'Moved by staff', 'Administrative'), ('T2', 'Left early', 'AMA'), ('T3', 'Other', NULL))"""


def forms(kind: str) -> str:
    rule = {
        "ama": "event_type = 'error' AND value >= 150",
        "admin": "event_type = 'error' AND value < 5",
        "detox": "event_type = 'signup'",
    }[kind]
    return f"""
{kind}_forms AS (
  SELECT event_id AS form_id, '{kind} form' AS name, 'complete' AS status, casefile_id,
         CAST(trunc(value) AS BIGINT) AS evaluation_id, user_id AS patient_process_id, ts AS created_at, 'staff' AS created_by,
         ts + INTERVAL 1 HOUR AS updated_at, 'staff' AS updated_by, props AS evaluation_content,
         CAST(user_id AS VARCHAR) AS patient_id, split_part(casefile_id, ':', 2) AS patient_master_id
  FROM case_events WHERE {rule})"""


GROUPED = """
grouped AS (
  SELECT g.casefile_id, g.first_name, g.last_name, p.program_category, p.program_class, p.program_level, l.discharge_date,
         CASE p.program_class WHEN 'Discharge' THEN max(g.start_date) ELSE min(g.start_date) END AS start_date,
         CASE p.program_class WHEN 'Discharge' THEN max(g.logged_at) ELSE min(g.logged_at) END AS logged_date
  FROM program_log g, program_types p, latest l
  WHERE g.program_name = p.program AND g.casefile_id = l.casefile_id AND p.program_level <> 'Administrative'
  GROUP BY g.casefile_id, g.first_name, g.last_name, p.program_category, p.program_class, p.program_level, l.discharge_date)"""

CLEANED = """
cleaned AS (
  SELECT * FROM grouped a WHERE program_class = 'Program' OR (program_class = 'Discharge' AND EXISTS (
    FROM grouped b WHERE b.program_class = 'Program' AND b.casefile_id = a.casefile_id
      AND b.program_level = a.program_level AND b.start_date < a.start_date)))"""

SETTLED = """
settled AS (
  SELECT * FROM cleaned a WHERE program_class <> 'Discharge' OR NOT EXISTS (
    FROM cleaned b WHERE b.program_class = 'Program' AND b.casefile_id = a.casefile_id
      AND b.start_date BETWEEN a.start_date AND a.start_date + INTERVAL 24 HOUR))"""

NUMBERED = """
numbered AS (
  SELECT *, lead(start_date) OVER w AS next_start, lead(program_class) OVER w AS next_class,
         lag(program_class) OVER w AS previous_class, row_number() OVER w AS ph_version
  FROM settled WINDOW w AS (PARTITION BY casefile_id
    ORDER BY start_date, logged_date, program_category, program_class, program_level))"""

HISTORY = """
closed AS (
  SELECT *, CASE WHEN next_start IS NULL AND program_class = 'Discharge' THEN least(discharge_date, start_date)
                 WHEN next_start IS NULL THEN coalesce(discharge_date, TIMESTAMP '2024-02-01 00:00:00')
                 WHEN discharge_date < next_start THEN discharge_date ELSE next_start END AS end_date,
         max(ph_version) OVER (PARTITION BY casefile_id) AS total_versions
  FROM numbered),
measured AS (
  SELECT *, CASE WHEN program_class = 'Program' AND start_date < end_date THEN 1 ELSE 0 END AS admission FROM closed),
history AS (
  SELECT casefile_id, first_name, last_name, program_level, program_category, program_class, start_date, end_date,
         discharge_date, CAST(ph_version AS INTEGER) AS ph_version, CAST(total_versions AS INTEGER) AS total_versions,
         CASE WHEN next_start IS NULL AND program_class = 'Program' AND discharge_date IS NULL
               AND start_date < TIMESTAMP '2024-02-01 00:00:00' THEN 1 ELSE 0 END AS is_active,
         CAST(start_date AS DATE) AS start_day, CAST(end_date AS DATE) AS end_day, CAST(discharge_date AS DATE) AS discharge_day,
         admission, CAST(admission * date_diff('day', CAST(start_date AS DATE), CAST(end_date AS DATE)) AS INTEGER) AS days_in_program,
         CAST(CASE WHEN admission = 1 THEN round((epoch_us(end_date) - epoch_us(start_date)) / 3.6e9) ELSE 0 END AS BIGINT) AS hours_in_program,
         CASE WHEN admission = 1 AND next_class = 'Program' AND end_date IS DISTINCT FROM discharge_date THEN 1 ELSE 0 END AS transferred_out,
         CASE WHEN admission = 1 AND previous_class = 'Program' THEN 1 ELSE 0 END AS transferred_in,
         CASE WHEN admission = 1 AND (next_class = 'Discharge' OR end_date = discharge_date) THEN 1 ELSE 0 END AS discharged
  FROM measured)"""

CENSUS = """
spine AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)) AS DATE) AS census_date),
heads AS (
  SELECT census_date, program_category, count(DISTINCT casefile_id) AS census
  FROM spine JOIN history ON program_class = 'Program' AND start_day <= census_date AND census_date < end_day GROUP BY 1, 2),
arrivals AS (
  SELECT start_day, program_category, CAST(sum(admission - transferred_in) AS BIGINT) AS admissions,
         CAST(sum(transferred_in) AS BIGINT) AS transfer_in FROM history GROUP BY 1, 2),
departures AS (
  SELECT end_day, program_category, CAST(sum(transferred_out) AS BIGINT) AS transfer_out,
         CAST(sum(discharged) AS BIGINT) AS discharges FROM history GROUP BY 1, 2),
daily AS (
  SELECT h.census_date, h.program_category, h.census, coalesce(a.admissions, 0) AS admissions,
         coalesce(a.transfer_in, 0) AS transfer_in, coalesce(d.transfer_out, 0) AS transfer_out, coalesce(d.discharges, 0) AS discharges
  FROM heads h
  LEFT JOIN arrivals a ON a.start_day = h.census_date AND a.program_category = h.program_category
  LEFT JOIN departures d ON d.end_day = h.census_date AND d.program_category = h.program_category)"""

DISCHARGED = """
discharged_stays AS (
  SELECT h.casefile_id, coalesce(h.first_name, '') || ' ' || coalesce(h.last_name, '') AS full_name, h.program_level,
         h.program_category, h.program_class, h.end_day AS discharge_date,
         CASE WHEN h.casefile_id IN (SELECT casefile_id FROM ama_forms) THEN 'AMA'
              WHEN h.casefile_id IN (SELECT casefile_id FROM admin_forms) THEN 'Admin'
              ELSE coalesce(t.discharge_class, 'Successful') END AS discharge_class
  FROM history h LEFT JOIN latest l USING (casefile_id) LEFT JOIN discharge_types t USING (discharge_type_code)
  WHERE h.discharged = 1)"""

MOVEMENTS = """
moves AS (
  SELECT o_orderkey AS id, CAST(o_custkey % 4 AS INTEGER) AS organization_id, o_orderpriority AS program,
         o_orderdate AS created_at, o_custkey AS patient_id,
         CASE o_orderstatus WHEN 'O' THEN 'admissions' WHEN 'P' THEN 'transfers' ELSE 'discharges' END AS source,
         CASE WHEN o_totalprice < 150000 THEN 'AMA' WHEN o_totalprice < 300000 THEN 'Admin' ELSE 'Successful' END AS discharge_type
  FROM orders WHERE o_orderstatus IN ('O', 'P', 'F'))"""

LOG = [CASE_EVENTS, PROGRAM_LOG]
STAYS = [*LOG, PROGRAM_TYPES, LATEST, GROUPED, CLEANED, SETTLED, NUMBERED, HISTORY]
DAILY = [*STAYS, CENSUS]
ENDED = [*STAYS, DISCHARGE_TYPES, forms("ama"), forms("admin"), DISCHARGED]


def using(parts: list[str], body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body.strip()
