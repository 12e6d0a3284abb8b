"""Streaming jobs over the given tables, run to the end of the files."""

from pyspark.sql import functions as F, types as T

from wardflow import schemas
from wardflow.operators.ordered import Series
from wardflow.operators.resample import sessions
from wardflow.queries import ctes as Q
from wardflow.queries.ingest import UTC_TEXT
from wardflow.queries.registry import query
from wardflow.session import scratch_dir
from wardflow.sources import landing
from wardflow.streaming import feeds as S


def in_slices(t, rows, number, job, parts: int = 4):
    """Land rows slice by slice, those without a number last, and run a job after each slice; gives what the last run does.

    Each run takes all files that are new as one batch and ends, so every run but the first begins from a stored state.
    """
    folder, out = scratch_dir(t.spark), None
    numbered = rows.withColumn("_slice", F.least(F.greatest(F.coalesce(number, F.lit(parts - 1)), F.lit(0)), F.lit(parts - 1)).cast("int"))
    for i in range(parts):
        numbered.filter(F.col("_slice") == i).drop("_slice").write.parquet(f"{folder}/{i}")
        out = job(t.spark.readStream.schema(rows.schema).parquet(f"{folder}/*"))
    return out


def in_order(rows, order: str, parts: int = 4):
    """The number of a row's slice, by equal spans of a time column."""
    low, high = rows.agg(F.unix_micros(F.min(order).cast("timestamp")), F.unix_micros(F.max(order).cast("timestamp"))).first()
    return F.try_divide(F.unix_micros(F.col(order).cast("timestamp")) - F.lit(low), F.lit(high) - F.lit(low)) * parts


def events(t):
    return S.stream_of(t.spark, t.folder, "events.parquet", schemas.SOURCE_TABLES["events"])


CHANGES = (
    "inline(filter(array(named_struct('event', 'INSERT', 'sequence', 1, 'status', o_orderstatus, 'price', o_totalprice), "
    "CASE WHEN o_totalprice > 200000 THEN named_struct('event', 'UPDATE', 'sequence', 2, 'status', 'U', 'price', o_totalprice + 1) END, "
    "CASE WHEN o_totalprice > 400000 THEN named_struct('event', 'DELETE', 'sequence', 3, 'status', CAST(NULL AS STRING), 'price', CAST(NULL AS DOUBLE)) END), x -> x IS NOT NULL))"
)


FED = "SELECT o_orderkey AS id, CASE WHEN o_totalprice > 200000 THEN 'U' ELSE o_orderstatus END AS status, CASE WHEN o_totalprice > 200000 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_totalprice <= 400000"
FED_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("price", T.DoubleType())])


@query("b_t1_change_feed", FED)
def _(t):
    folder = scratch_dir(t.spark)

    def follow(stream):
        changes = S.listen(stream.selectExpr("o_orderkey AS id", "'orders' AS table", CHANGES), table="orders")
        return S.follow_changes(changes, FED_SCHEMA, ["id"], "sequence", folder, buckets=16)

    return in_slices(t, t.orders, in_order(t.orders, "o_orderdate"), follow)


@query("b_t1_change_feed_out_of_order", FED)
def _(t):
    """The changes of a key come in any order: an update before its insert, a deletion before both."""
    folder = scratch_dir(t.spark)
    changes = t.orders.selectExpr("o_orderkey AS id", CHANGES)
    late = F.pmod(F.xxhash64("id", "sequence"), F.lit(3))
    return in_slices(t, changes, late, lambda stream: S.follow_changes(stream, FED_SCHEMA, ["id"], "sequence", folder, buckets=16), parts=3)


@query("b_t1_listen_updates", "SELECT o_orderkey AS id, o_totalprice + 1 AS price FROM orders WHERE o_totalprice > 200000 AND o_totalprice < 300000")
def _(t):
    stream = S.stream_of(t.spark, t.folder, "orders.parquet", schemas.SOURCE_TABLES["orders"])
    changes = stream.selectExpr("o_orderkey AS id", "'orders' AS table", CHANGES)
    wanted = S.listen(changes, event="UPDATE", table="orders", where=F.col("price") < 300001)
    return S.run_to_files(wanted.select("id", "price"), scratch_dir(t.spark))


MARK = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"
ISLANDS = """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
i AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g),
s AS (SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM i GROUP BY user_id, k),
closed AS (SELECT * FROM s WHERE "end" <= """ + MARK + ")"
query("b_t2_presence", ISLANDS + " SELECT user_id, 'join' AS change, \"start\" AS \"at\" FROM closed UNION ALL SELECT user_id, 'leave', \"end\" FROM closed")(
    lambda t: S.run_to_files(S.presence(events(t).select("ts", "user_id"), "ts", "user_id", "6 hours"), scratch_dir(t.spark))
)
query("b_t2_presence_batch", ISLANDS + " SELECT user_id, 'join' AS change, \"start\" AS \"at\" FROM s UNION ALL SELECT user_id, 'leave', \"end\" FROM s")(
    lambda t: S.joins_and_leaves(sessions(t.events, ts="ts", by=["user_id"], gap="6 hours"), "user_id")
)


# Signs of life and leaves of a user's references, one for each type of event; a fourth of the events are leaves.
REFERENCES = """WITH e AS (SELECT user_id, event_type AS ref, ts, event_id % 4 = 0 AS leaves FROM events WHERE ts <= {mark}),
n AS (SELECT *, lag(ts) OVER w AS before, lag(leaves) OVER w AS left_before, lead(ts) OVER w AS after, lead(leaves) OVER w AS leaves_after FROM e WINDOW w AS (PARTITION BY user_id, ref ORDER BY ts, leaves)),
d AS (SELECT user_id, ref, 'join' AS change, ts AS "at" FROM n WHERE NOT leaves AND (before IS NULL OR left_before OR ts > before + INTERVAL 3 DAY)
UNION ALL SELECT user_id, ref, 'leave', CASE WHEN leaves_after AND after <= ts + INTERVAL 3 DAY THEN after ELSE ts + INTERVAL 3 DAY END FROM n
WHERE NOT leaves AND (after IS NULL OR leaves_after OR after > ts + INTERVAL 3 DAY) AND (ts + INTERVAL 3 DAY <= {mark} OR after <= {mark}))""".format(mark=MARK)


def references(t):
    """Changes over four runs, each from the state of the one before."""
    folder = scratch_dir(t.spark)
    job = lambda stream: S.run_to_files(S.reference_presence(stream.withColumn("ref", F.col("event_type")), "ts", "user_id", "ref", F.col("event_id") % 4 == 0, "3 days"), folder)
    return in_slices(t, t.events, in_order(t.events, "ts"), job)


query("b_t2_presence_by_reference", REFERENCES + " SELECT * FROM d")(references)
query(
    "b_t2_presence_of_keys",
    REFERENCES + """, s AS (SELECT *, sum(CASE change WHEN 'join' THEN 1 ELSE -1 END) OVER (PARTITION BY user_id ORDER BY "at", change, ref) AS here FROM d)
SELECT user_id, change, "at" FROM s WHERE (change = 'join' AND here = 1) OR (change = 'leave' AND here = 0)""",
)(lambda t: S.key_presence(references(t), "user_id", "ref"))


@query("b_t3_continuous_ingest", Q.using([Q.CASE_EVENTS], "SELECT event_id AS form_id, casefile_id, ts + INTERVAL 1 HOUR AS updated_at FROM case_events WHERE event_type = 'signup'"))
def _(t):
    case = "concat(user_id, ':', CAST(floor((day(ts) - 1) / 10) AS STRING))"
    record = f"named_struct('id', event_id, 'patient_casefile_id', {case}, 'created_at', {UTC_TEXT.format(c='ts')}, 'updated_at', {UTC_TEXT.format(c='(ts + INTERVAL 1 HOUR)')})"
    # Every reply is landed twice, as the last day is on each run.
    replies = events(t).filter("event_type = 'signup'").selectExpr(f"to_json(named_struct('patient_evaluations', array({record}))) AS value", "explode(array(1, 2)) AS pull")
    rows = S.ingest(landing.forms(replies), "form_id", "updated_at")
    return S.run_to_files(rows.select("form_id", "casefile_id", "updated_at"), scratch_dir(t.spark))


EWM = """n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT c.event_id, round(sum(pow(0.8, c.n - p.n) * p.value / 7.919) / sum(pow(0.8, c.n - p.n)), 6) AS mean FROM n c JOIN n p ON p.user_id = c.user_id AND p.n <= c.n GROUP BY 1"""


def series():
    return Series.by_time(["user_id"], "ts", "event_id")


def values(df):
    return df.selectExpr("event_id", "user_id", "ts", "value / 7.919 AS v")


@query("b_w11_ewm_carried_state", f"WITH {EWM}")
def _(t):
    rows = values(t.events)
    middle = F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    empty = t.spark.createDataFrame([], S.ewm_state_schema([("user_id", T.LongType())]))
    first, state = S.ewm_step(rows.filter(F.col("ts") < middle), empty, series(), "v", 0.2)
    second, _state = S.ewm_step(rows.filter(F.col("ts") >= middle), state, series(), "v", 0.2)
    return first.unionByName(second).select("event_id", F.round("mean", 6).alias("mean"))


@query("b_t4_online_ewm", f"WITH {EWM}")
def _(t):
    folder = scratch_dir(t.spark)
    means = in_slices(t, t.events, in_order(t.events, "ts"), lambda stream: S.online_ewm(values(stream), series(), "v", 0.2, folder, buckets=16))
    return means.select("event_id", F.round("mean", 6).alias("mean"))


query("b_t5_tumbling_counts", f"SELECT * FROM (SELECT time_bucket(INTERVAL 3 HOUR, ts) AS \"start\", time_bucket(INTERVAL 3 HOUR, ts) + INTERVAL 3 HOUR AS \"end\", event_type, count(*) AS n FROM events GROUP BY ALL) WHERE \"end\" <= {MARK}")(
    lambda t: S.run_to_files(S.window_counts(events(t), "ts", ["event_type"], "3 hours"), scratch_dir(t.spark))
)
query("b_t5_sliding_counts", f"SELECT \"start\", \"start\" + INTERVAL 6 HOUR AS \"end\", count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 2 HOUR, ts), time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR, time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 4 HOUR]) AS \"start\" FROM events) WHERE \"start\" + INTERVAL 6 HOUR <= {MARK} GROUP BY 1")(
    lambda t: S.run_to_files(S.window_counts(events(t), "ts", [], "6 hours", "2 hours"), scratch_dir(t.spark))
)
query("b_t5_session_counts", ISLANDS + ' SELECT "start", "end", user_id, n FROM closed')(
    lambda t: S.run_to_files(S.session_counts(events(t), "ts", ["user_id"], "6 hours"), scratch_dir(t.spark))
)
