"""Reads, projections and scalar expressions used throughout, one query each."""

from pyspark.sql import functions as F

from wardflow.operators import aggregates as A, sets as S, windows as W
from wardflow.operators.ordered import Series, position
from wardflow.queries import ctes as Q
from wardflow.queries.registry import query
from wardflow.queries.views import daily, history

query("a_s1_full_read", "SELECT * FROM orders")(lambda t: t.orders)
query("a_p4_column_subset", Q.using([Q.CASE_EVENTS, Q.LATEST], "SELECT casefile_id, program, gender, location_id FROM latest"))(
    lambda t: t.latest().select("casefile_id", "program", "gender", "location_id")
)
query("a_p5_rename", "SELECT event_id AS form_id, user_id AS patient FROM events")(
    lambda t: t.events.select("event_id", "user_id").withColumnsRenamed({"event_id": "form_id", "user_id": "patient"})
)
query("a_p9_derived_flag", "SELECT event_id, CASE WHEN value >= 30 THEN 'Yes' ELSE 'No' END AS transferred FROM events")(
    lambda t: t.events.select("event_id", F.when(F.col("value") >= 30, "Yes").otherwise("No").alias("transferred"))
)
query(
    "a_p11_coalesce_least",
    Q.using(Q.STAYS, "SELECT casefile_id, ph_version, coalesce(discharge_date, end_date) AS known_end, least(discharge_date, start_date) AS earliest FROM history"),
)(lambda t: history(t).select("casefile_id", "ph_version", F.coalesce("discharge_date", "end_date").alias("known_end"), F.least("discharge_date", "start_date").alias("earliest")))
query("a_p12_date_casts", "SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS second FROM events")(
    lambda t: t.events.select("event_id", F.to_date("ts").alias("day"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("second"))
)
query("a_p13_days_between", Q.using(Q.STAYS, "SELECT casefile_id, ph_version, CAST(date_diff('day', start_day, end_day) AS INTEGER) AS days FROM history"))(
    lambda t: history(t).select("casefile_id", "ph_version", F.datediff("end_day", "start_day").alias("days"))
)
query("a_p14_hours_between", Q.using(Q.STAYS, "SELECT casefile_id, ph_version, hours_in_program FROM history WHERE admission = 1"))(
    lambda t: history(t).filter("admission = 1").select("casefile_id", "ph_version", "hours_in_program")
)
query("a_p15_full_name", Q.using([Q.CASE_EVENTS, Q.LATEST], "SELECT casefile_id, concat(first_name, ' ', last_name) AS full_name FROM latest"))(
    lambda t: t.latest().select("casefile_id", F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit(""))).alias("full_name"))
)
query("a_p16_day_text", "SELECT event_type, strftime(max(ts), '%Y-%m-%d') AS last_day FROM events GROUP BY 1")(
    lambda t: t.events.groupBy("event_type").agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_day"))
)
query("a_p18_one_decimal", "SELECT o_orderstatus, round(sum(CAST(o_totalprice AS DECIMAL(18,2))) / count(*) / 1000, 1) AS thousands FROM orders GROUP BY 1")(
    lambda t: t.orders.groupBy("o_orderstatus").agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)) / 1000, 1).alias("thousands"))
)
query("a_a5_distinct_keys", "SELECT DISTINCT o_custkey FROM orders")(lambda t: t.orders.select("o_custkey").distinct())
query("a_o1_ordered_census", Q.using(Q.DAILY, "SELECT census_date, program_category, census, row_number() OVER (ORDER BY census_date, program_category) AS place FROM daily"))(
    lambda t: S.sorted_positions(daily(t), [("census_date", True), ("program_category", True)], [], "place").select("census_date", "program_category", "census", "place")
)
query("a_u3_drop_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")(
    lambda t: t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity").dropDuplicates()
)
query("a_u4_unique_keys", Q.using([Q.CASE_EVENTS], "SELECT DISTINCT casefile_id FROM case_events"))(lambda t: t.case_events().select("casefile_id").distinct())
query("a_x3_scalar_rules", Q.using([Q.CASE_EVENTS], "SELECT casefile_id, event_id, value > 100 AS big FROM case_events"))(
    lambda t: t.case_events().select("casefile_id", "event_id", (F.col("value") > 100).alias("big"))
)
NULLED = "CASE WHEN o_totalprice < 400000 THEN o_orderstatus END"
query("b_a1_null_keys_kept", f"SELECT {NULLED} AS k, count(*) AS n FROM orders GROUP BY 1")(
    lambda t: t.orders.selectExpr(f"{NULLED} AS k").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
)
query("b_a1_null_keys_dropped", f"SELECT {NULLED} AS k, count(*) AS n FROM orders WHERE {NULLED} IS NOT NULL GROUP BY 1")(
    lambda t: t.orders.selectExpr(f"{NULLED} AS k").dropna().groupBy("k").agg(F.count(F.lit(1)).alias("n"))
)
query("b_a5_any_all", "SELECT user_id, bool_or(value > 200) AS any_big, bool_and(value > 0.5) AS all_some FROM events GROUP BY 1")(
    lambda t: t.events.groupBy("user_id").agg(F.bool_or(F.col("value") > 200).alias("any_big"), F.bool_and(F.col("value") > 0.5).alias("all_some"))
)
query("b_a7_row_of_extreme", "SELECT user_id, arg_max(event_type, (value, -event_id)) AS top_type, max(value) AS top_value, arg_min(ts, (value, event_id)) AS low_ts FROM events GROUP BY 1")(
    lambda t: t.events.groupBy("user_id").agg(A.label_of_max("event_type", "value", ["event_id"]).alias("top_type"), F.max("value").alias("top_value"), A.label_of_min("ts", "value", ["event_id"]).alias("low_ts"))
)
O = "PARTITION BY user_id ORDER BY ts, event_id"


def by_user(t):
    return Series.fitted(t.events, ["user_id"], "ts", "event_id")


query("b_a17_group_and_row_numbers", f"SELECT event_id, dense_rank() OVER (ORDER BY user_id) - 1 AS ngroup, row_number() OVER ({O}) - 1 AS cumcount FROM events")(
    lambda t: position(A.group_numbers(t.events.select("event_id", "user_id", "ts"), "user_id"), by_user(t), "p").select("event_id", "ngroup", (F.col("p") - 1).alias("cumcount"))
)
query(
    "b_w12_cumulative",
    f"SELECT event_id, round(sum(value) OVER w, 4) AS total, round(product(1 + value / 10000) OVER w, 8) AS growth, min(value) OVER w AS low, max(value) OVER w AS high FROM events WINDOW w AS ({O} ROWS UNBOUNDED PRECEDING)",
)(
    lambda t: W.cumulative(
        W.cumulative(t.events.withColumn("f", 1 + F.col("value") / 10000), by_user(t), "value", {"total": "sum", "low": "min", "high": "max"}), by_user(t), "f", {"growth": "product"}
    ).select("event_id", F.round("total", 4).alias("total"), F.round("growth", 8).alias("growth"), "low", "high")
)
query("b_w13_shift_diff_change", f"SELECT event_id, lag(value, 3) OVER ({O}) AS back, round(value - lag(value) OVER ({O}), 6) AS diff, round(sqrt(value) / lag(sqrt(value), 2) OVER ({O}) - 1, 5) AS change FROM events")(
    lambda t: W.shifts(t.events.selectExpr("event_id", "user_id", "ts", "value", "sqrt(value) AS r"), by_user(t), {"back": ("value", 3), "_one": ("value", 1), "_two": ("r", 2)})
    .select("event_id", "back", F.round(F.col("value") - F.col("_one"), 6).alias("diff"), F.round(F.try_divide("r", "_two") - 1, 5).alias("change"))
)
query("b_m1_fill_by_column", f"SELECT o_orderkey, coalesce({NULLED}, 'none') AS status, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, 0) AS price FROM orders")(
    lambda t: t.orders.selectExpr("o_orderkey", f"{NULLED} AS status", "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price").fillna({"status": "none", "price": 0.0})
)
query("b_o6_consecutive_differences", f"SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER ({O})) AS gap FROM events")(
    lambda t: W.difference(t.events.select("event_id", "user_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")), by_user(t), "us", 1, "gap").select("event_id", "gap")
)
