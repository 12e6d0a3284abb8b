"""Stay history, census and discharges, and the steps they are made of."""

from pyspark.sql import functions as F

from wardflow.plans import census as C, discharges as D, history as H
from wardflow.queries import ctes as Q
from wardflow.queries.registry import query
from wardflow.sources.adapter import AS_OF, SPINE

START, END = SPINE


def history(t):
    return H.build_history(t.program_log(), t.program_types(), t.case_state(), as_of=AS_OF)


def daily(t):
    return C.daily_census(history(t), start=START, end=END)


def ended(t):
    return D.discharges(history(t), t.case_state(), t.discharge_types(), t.forms("ama"), t.forms("admin"))


query("a_v1_program_history", Q.using(Q.STAYS, "SELECT * FROM history"))(history)
query("a_v2_daily_census", Q.using(Q.DAILY, "SELECT * FROM daily"))(daily)
query("a_v3_discharges", Q.using(Q.ENDED, "SELECT * FROM discharged_stays"))(ended)


@query(
    "a_v2b_daily_census_all_flows",
    Q.using(
        Q.DAILY,
        """
SELECT coalesce(h.census_date, f.d) AS census_date, coalesce(h.program_category, f.c) AS program_category, coalesce(h.census, 0) AS census,
       coalesce(f.a, 0) AS admissions, coalesce(f.i, 0) AS transfer_in, coalesce(f.o, 0) AS transfer_out, coalesce(f.x, 0) AS discharges
FROM heads h FULL JOIN (
  SELECT d, c, CAST(sum(a) AS BIGINT) AS a, CAST(sum(i) AS BIGINT) AS i, CAST(sum(o) AS BIGINT) AS o, CAST(sum(x) AS BIGINT) AS x FROM (
    SELECT start_day AS d, program_category AS c, admissions AS a, transfer_in AS i, 0 AS o, 0 AS x FROM arrivals
    UNION ALL SELECT end_day, program_category, 0, 0, transfer_out, discharges FROM departures)
  WHERE d BETWEEN DATE '2024-01-01' AND DATE '2024-02-01' GROUP BY 1, 2 HAVING sum(a + i + o + x) > 0) f
ON f.d = h.census_date AND f.c = h.program_category""",
    ),
)
def _(t):
    return C.daily_census(history(t), start=START, end=END, keep_flow_only_days=True)


def grouped(t):
    return H.grouped_starts(t.program_log(), t.program_types(), t.case_state())


def cleaned(t):
    return grouped(t).transform(H.keep_discharges_after_a_start)


def settled(t):
    return cleaned(t).transform(H.drop_interim_discharges)


def numbered(t):
    return settled(t).transform(H.number_stays)


G = [*Q.LOG, Q.PROGRAM_TYPES, Q.LATEST, Q.GROUPED]
query("a_a1_grouped_starts", Q.using(G, "SELECT * FROM grouped"))(grouped)
query("a_f5_exists_earlier_start", Q.using([*G, Q.CLEANED], "SELECT * FROM cleaned"))(cleaned)
query("a_f6_no_restart_within_day", Q.using([*G, Q.CLEANED, Q.SETTLED], "SELECT * FROM settled"))(settled)


@query("a_j4_semi_join_earlier_start", Q.using([*G, Q.CLEANED], "SELECT * FROM cleaned"))
def _(t):
    return grouped(t).transform(H.keep_discharges_by_semi_join)


@query("a_j5_anti_join_restart", Q.using([*G, Q.CLEANED, Q.SETTLED], "SELECT * FROM settled"))
def _(t):
    return cleaned(t).transform(H.drop_interim_by_anti_join)


KEY = ["casefile_id", "program_category", "program_class", "program_level", "start_date"]
N = [*G, Q.CLEANED, Q.SETTLED, Q.NUMBERED]
for _name, _cols in {
    "a_w1_next_start": ["next_start"],
    "a_w2_version": ["ph_version"],
    "a_w3_next_class": ["next_class"],
    "a_w4_previous_class": ["previous_class"],
}.items():

    def _step(t, cols=tuple(_cols)):
        return numbered(t).select(*KEY, *cols)

    query(_name, Q.using(N, f"SELECT {', '.join(KEY + _cols)} FROM numbered"))(_step)


@query(
    "a_w5_version_count",
    Q.using(N, "SELECT casefile_id, ph_version, max(ph_version) OVER (PARTITION BY casefile_id) AS total_versions FROM numbered"),
)
def _(t):
    return numbered(t).select("casefile_id", "ph_version", "total_versions")


@query(
    "a_j10_version_total_per_case",
    Q.using(N, "SELECT n.casefile_id, n.start_date, v.total FROM numbered n JOIN (SELECT casefile_id, max(ph_version) AS total FROM numbered GROUP BY 1) v USING (casefile_id)"),
)
def _(t):
    return numbered(t).select("casefile_id", "start_date", F.col("total_versions").alias("total"))


@query("a_p10_stay_end", Q.using(Q.STAYS, "SELECT casefile_id, ph_version, end_date FROM closed"))
def _(t):
    return numbered(t).transform(H.close_stays, AS_OF).select("casefile_id", "ph_version", "end_date")


@query(
    "a_p_stay_measures",
    Q.using(Q.STAYS, "SELECT casefile_id, ph_version, days_in_program, hours_in_program, round(hours_in_program / 24.0, 1) AS days_decimal FROM history"),
)
def _(t):
    return history(t).selectExpr(
        "casefile_id", "ph_version", "days_in_program", "hours_in_program", "round(hours_in_program / 24.0, 1) AS days_decimal"
    )


@query(
    "a_j1_log_program_state_join",
    Q.using(
        [*Q.LOG, Q.PROGRAM_TYPES, Q.LATEST],
        "SELECT program_history_pk, casefile_id, program_category, program_level, discharge_date FROM program_log "
        "JOIN program_types ON program_name = program_types.program JOIN latest USING (casefile_id)",
    ),
)
def _(t):
    log, types, state = t.program_log(), t.program_types(), t.case_state()
    return (
        log.join(types, log["program_name"] == types["program"])
        .join(state.select("casefile_id", "discharge_date"), "casefile_id")
        .select("program_history_pk", "casefile_id", "program_category", "program_level", "discharge_date")
    )


@query(
    "a_f4_not_administrative",
    Q.using(
        [*Q.LOG, Q.PROGRAM_TYPES],
        "SELECT program_category, count(*) AS n FROM program_log LEFT JOIN program_types ON program_name = program "
        "WHERE program_level <> 'Administrative' GROUP BY 1",
    ),
)
def _(t):
    log, types = t.program_log(), t.program_types()
    return (
        log.join(types, log["program_name"] == types["program"], "left")
        .filter(F.col("program_level") != "Administrative")
        .groupBy("program_category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "a_j2_left_join_discharge_type",
    Q.using(
        [Q.CASE_EVENTS, Q.LATEST, Q.DISCHARGE_TYPES],
        "SELECT casefile_id, l.discharge_type_code, t.discharge_type, t.discharge_class FROM latest l LEFT JOIN discharge_types t USING (discharge_type_code)",
    ),
)
def _(t):
    return (
        t.case_state()
        .join(t.discharge_types(), "discharge_type_code", "left")
        .select("casefile_id", "discharge_type_code", "discharge_type", "discharge_class")
    )


@query(
    "a_j3_census_range_join",
    Q.using(
        Q.DAILY,
        "SELECT census_date, program_category, casefile_id FROM spine JOIN history ON program_class = 'Program' "
        "AND census_date >= start_day AND census_date < end_day",
    ),
)
def _(t):
    return C.census_by_days(history(t), start=START, end=END)


@query("a_a2_distinct_census", Q.using(Q.DAILY, "SELECT * FROM heads"))
def _(t):
    return C.distinct_census(history(t), start=START, end=END)


@query("a_a2_distinct_census_approx", Q.using(Q.DAILY, "SELECT census_date, program_category, TRUE AS close FROM heads"))
def _(t):
    h = history(t)
    both = C.census_by_days(h, start=START, end=END).groupBy("census_date", "program_category").agg(
        F.count_distinct("casefile_id").alias("n"), F.approx_count_distinct("casefile_id", 0.02).alias("a")
    )
    return both.select("census_date", "program_category", (F.abs(F.col("a") - F.col("n")) <= F.greatest(F.lit(2.0), F.col("n") * 0.1)).alias("close"))


query("a_a3_arrivals", Q.using(Q.DAILY, "SELECT * FROM arrivals"))(lambda t: C.arrivals(history(t)))
query("a_a4_departures", Q.using(Q.DAILY, "SELECT * FROM departures"))(lambda t: C.departures(history(t)))


@query(
    "a_j6_form_membership",
    Q.using(
        [Q.CASE_EVENTS, Q.LATEST, Q.forms("ama"), Q.forms("admin")],
        "SELECT casefile_id, casefile_id IN (SELECT casefile_id FROM ama_forms) AS in_ama, "
        "casefile_id IN (SELECT casefile_id FROM admin_forms) AS in_admin FROM latest",
    ),
)
def _(t):
    return (
        t.case_state()
        .join(D.case_flag(t.forms("ama"), "_a"), "casefile_id", "left")
        .join(D.case_flag(t.forms("admin"), "_d"), "casefile_id", "left")
        .select("casefile_id", F.col("_a").isNotNull().alias("in_ama"), F.col("_d").isNotNull().alias("in_admin"))
    )
