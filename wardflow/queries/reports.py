"""Reports, filters, ordering, paging, presets and the older daily figures."""

from datetime import date

from pyspark.sql import functions as F

from wardflow.functions.dates import calendar_dimension
from wardflow.plans import kpi as K, reports as R
from wardflow.queries import ctes as Q
from wardflow.queries.registry import query
from wardflow.queries.views import daily, ended
from wardflow.session import settle

DAY, LOW, HIGH = date(2024, 1, 15), date(2024, 1, 8), date(2024, 1, 21)
PROGRAMS = ["Detox", "Residential", "Psych IOP"]
PLACE = "CASE program_category WHEN 'Detox' THEN 0 WHEN 'Residential' THEN 1 WHEN 'SUD IOP' THEN 2 WHEN 'Psych IOP' THEN 3 WHEN 'Aftercare' THEN 4 ELSE -1 END"
TOTALS = ", ".join(f"CAST(coalesce(sum({n}), 0) AS BIGINT) AS {n}" for n in ["admissions", "transfer_in", "transfer_out", "discharges"])
CENSUS_TOTALS = "CAST(coalesce(sum(census), 0) AS BIGINT) AS census, " + TOTALS
ON_DAY = "census_date = DATE '2024-01-15'"
IN_RANGE = "census_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
CHOSEN = "discharge_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND program_category IN ('Detox', 'Residential', 'Psych IOP')"

query("a_f1_census_on_day", Q.using(Q.DAILY, f"SELECT * FROM daily WHERE {ON_DAY}"))(
    lambda t: R.on_day(daily(t), "census_date", DAY)
)
query("a_f2_census_between", Q.using(Q.DAILY, f"SELECT * FROM daily WHERE {IN_RANGE}"))(
    lambda t: R.between(daily(t), "census_date", LOW, HIGH)
)
query("a_f3_programs_among", Q.using(Q.ENDED, f"SELECT * FROM discharged_stays WHERE {CHOSEN}"))(
    lambda t: R.select_discharges(ended(t), LOW, HIGH, PROGRAMS)
)
query("a_f3_programs_empty_list", Q.using(Q.ENDED, "SELECT * FROM discharged_stays"))(
    lambda t: R.among(ended(t), "program_category", [])
)
query("a_a7_day_totals", Q.using(Q.DAILY, f"SELECT {CENSUS_TOTALS} FROM daily WHERE {ON_DAY}"))(
    lambda t: R.day_totals(daily(t), DAY)
)

PERIOD = f"SELECT round(avg(census), 6) AS average_census, {TOTALS} FROM (SELECT census_date, sum(census) AS census, sum(admissions) AS admissions, sum(transfer_in) AS transfer_in, sum(transfer_out) AS transfer_out, sum(discharges) AS discharges FROM daily WHERE {IN_RANGE} GROUP BY 1)"
BY_PROGRAM = f"SELECT program_category, round(avg(census), 6) AS average_census, {TOTALS}, {PLACE} AS place FROM daily WHERE {IN_RANGE} GROUP BY program_category"
query("a_a8_period_totals", Q.using(Q.DAILY, PERIOD))(lambda t: R.period_totals(daily(t), LOW, HIGH))
query("a_a9_period_by_program", Q.using(Q.DAILY, BY_PROGRAM))(lambda t: R.period_by_program(daily(t), LOW, HIGH))

PCT = ", ".join(f"round(100.0 * count(*) FILTER (discharge_class = '{c}') / nullif(count(*), 0), {{d}}) AS {c.lower()}_pct" for c in R.DISCHARGE_CLASSES)
CNT = ", ".join(f"count(*) FILTER (discharge_class = '{c}') AS {c.lower()}" for c in R.DISCHARGE_CLASSES)
query("a_a10_discharge_totals", Q.using(Q.ENDED, f"SELECT count(*) AS total, {CNT}, {PCT.format(d=1)} FROM discharged_stays"))(
    lambda t: R.discharge_totals(ended(t))
)
query("a_a11_discharge_matrix", Q.using(Q.ENDED, f"SELECT program_category, count(*) AS total, {PCT.format(d=6)} FROM discharged_stays GROUP BY 1"))(
    lambda t: R.discharge_matrix(ended(t))
)
query("a_o2_program_order", Q.using(Q.DAILY, f"SELECT DISTINCT program_category, {PLACE} AS place FROM daily"))(
    lambda t: daily(t).select("program_category").distinct().withColumn("place", R.list_index("program_category", R.PROGRAM_ORDER)).orderBy("place")
)
query(
    "a_o3_discharge_page",
    Q.using(Q.ENDED, "SELECT * FROM discharged_stays ORDER BY discharge_date, casefile_id, program_category, discharge_class, full_name LIMIT 25 OFFSET 50"),
)(lambda t: R.page(ended(t), R.DISCHARGE_ORDER, 2, 25))
query("a_o4_filter_choices", Q.using(Q.DAILY, "SELECT DISTINCT program_category FROM daily"))(
    lambda t: R.choices(daily(t), "program_category")
)
query(
    "a_v6_daily_census_report",
    Q.using(
        Q.DAILY,
        f"SELECT program_category, census, admissions, transfer_in, transfer_out, discharges, {PLACE} AS place FROM daily WHERE {ON_DAY} "
        f"UNION ALL SELECT 'Total', {CENSUS_TOTALS}, 99 FROM daily WHERE {ON_DAY}",
    ),
)(lambda t: R.census_report(daily(t), day=DAY))
query("a_v7_census_trends_report", Q.using(Q.DAILY, f"{BY_PROGRAM} UNION ALL SELECT 'Total', *, 99 FROM ({PERIOD})"))(
    lambda t: R.census_trends(settle(daily(t)), start=LOW, end=HIGH)
)


@query(
    "a_v8_discharge_trends_report",
    Q.using(
        Q.ENDED,
        f"""SELECT 'total' AS section, CAST(NULL AS VARCHAR) AS label, CAST(count(*) AS VARCHAR) AS figure FROM discharged_stays WHERE {CHOSEN}
UNION ALL SELECT 'matrix', program_category, CAST(count(*) AS VARCHAR) FROM discharged_stays WHERE {CHOSEN} GROUP BY 2
UNION ALL (SELECT 'page', casefile_id, CAST(discharge_date AS VARCHAR) FROM discharged_stays WHERE {CHOSEN}
  ORDER BY discharge_date, casefile_id, program_category, discharge_class, full_name LIMIT 10)""",
    ),
)
def _(t):
    total, matrix, rows = R.discharge_trends(settle(ended(t)), start=LOW, end=HIGH, programs=PROGRAMS)
    return (
        total.selectExpr("'total' AS section", "CAST(NULL AS STRING) AS label", "CAST(total AS STRING) AS figure")
        .unionByName(matrix.selectExpr("'matrix' AS section", "program_category AS label", "CAST(total AS STRING) AS figure"))
        .unionByName(rows.selectExpr("'page' AS section", "casefile_id AS label", "CAST(discharge_date AS STRING) AS figure"))
    )


M = [Q.MOVEMENTS]
KPI = ", ".join(f"count(DISTINCT CASE WHEN source = '{s}' THEN id END) AS {s}" for s in ["admissions", "transfers", "discharges"])
KPI_SQL = Q.using(M, f"SELECT organization_id, program, CAST(created_at AS DATE) AS date, {KPI}, count(DISTINCT patient_id) AS census FROM moves GROUP BY 1, 2, 3")
query("a_v4_daily_kpi", KPI_SQL)(lambda t: K.daily_kpi(t.movements()))
query("a_a12_conditional_distinct", Q.using(M, f"SELECT program, {KPI} FROM moves GROUP BY 1"))(
    lambda t: K.tagged_union(t.movements())
    .groupBy("program")
    .agg(*[F.count_distinct(F.when(F.col("source") == s, F.col("id"))).alias(s) for s in ["admissions", "transfers", "discharges"]])
)
COUNTS = "SELECT organization_id, program, CAST(created_at AS DATE) AS date, discharge_type, count(*) AS count FROM moves WHERE source = 'discharges' GROUP BY 1, 2, 3, 4"
query("a_v5_discharge_counts", Q.using(M, COUNTS))(lambda t: K.discharge_counts(t.movements()["discharges"]))
query(
    "a_a13_discharge_counts_by_program",
    Q.using(M, "SELECT program, discharge_type, count(*) AS count FROM moves WHERE source = 'discharges' GROUP BY 1, 2"),
)(lambda t: K.discharge_counts(t.movements()["discharges"]).groupBy("program", "discharge_type").agg(F.sum("count").alias("count")))
query(
    "a_a14_trend_matrix",
    Q.using(M, "SELECT CAST(created_at AS DATE) AS date, " + ", ".join(f"count(*) FILTER (discharge_type = '{c}') AS {c}" for c in R.DISCHARGE_CLASSES) + " FROM moves WHERE source = 'discharges' GROUP BY 1"),
)(lambda t: K.trend_matrix(K.discharge_counts(t.movements()["discharges"]), R.DISCHARGE_CLASSES))
query(
    "a_u1_tagged_union",
    Q.using(M, "SELECT id, organization_id, program, created_at, patient_id, source FROM moves"),
)(lambda t: K.tagged_union(t.movements()))


@query(
    "a_p17_date_presets",
    """WITH d AS (SELECT CAST(max(ts) AS DATE) AS a FROM events)
SELECT 'yesterday' AS preset, a - 1 AS start_date, a - 1 AS end_date FROM d UNION ALL SELECT 'initial', a - 7, a - 1 FROM d
UNION ALL SELECT 'last_n_days', a - 8, a - 1 FROM d UNION ALL SELECT 'month_to_date', CAST(date_trunc('month', a) AS DATE), a - 1 FROM d""",
)
def _(t):
    return t.events.agg(F.to_date(F.max("ts")).alias("as_of")).select(F.inline(R.presets(F.col("as_of"))))


@query(
    "a_p19_calendar",
    """SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(week(d) AS BIGINT) AS week, CAST(isodow(d) AS INTEGER) AS day_of_week,
  dayname(d) AS weekday_name, monthname(d) AS month_name, CAST(isodow(d) >= 6 AS BIGINT) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def _(t):
    return calendar_dimension(t.orders.agg(F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high")))
