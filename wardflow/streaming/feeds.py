"""Streaming jobs: ingest, change feeds, windowed counts, presence, online averages.

Every job reads a stream, keeps its progress in a checkpoint below the shared folder, and
stops when what is there has been read (``availableNow``), unless told otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wardflow.operators.keys import join_null_safe
from wardflow.operators.ordered import Series, from_micros, micros, position, running, span_micros, time_bucket
from wardflow.operators.windows import decayed_sums
from wardflow.session import settle
from wardflow.sources.buckets import BUCKETS, BucketTable
from wardflow.streaming.references import References


def stream_of(spark: SparkSession, folder: str, name: str, schema: str | T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_to_files(df: DataFrame, folder: str, *, mode: str = "append") -> DataFrame:
    """Run to the end of what is there; returns the files written."""
    out, progress = f"{folder}/out", f"{folder}/progress"
    q = df.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], folder: str) -> None:
    q = df.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    q.awaitTermination()


# Change feed

EVENTS = ("INSERT", "UPDATE", "DELETE")


def listen(changes: DataFrame, *, event: str = "*", table: str | None = None, where: Column | None = None) -> DataFrame:
    """Change rows of one kind, table and filter."""
    out = changes if event == "*" else changes.filter(F.col("event") == event)
    out = out if table is None else out.filter(F.col("table") == table)
    return out if where is None else out.filter(where)


DELETED = "_deleted"


def versioned(schema: T.StructType, sequence: str) -> T.StructType:
    """The state of a followed table: its columns, the sequence of the change that wrote a row, and whether that was a deletion."""
    fields = [f for f in schema.fields if f.name not in (sequence, DELETED)]
    return T.StructType([*fields, T.StructField(sequence, T.LongType()), T.StructField(DELETED, T.BooleanType())])


def apply_changes(state: DataFrame, changes: DataFrame, key: list[str], sequence: str) -> DataFrame:
    """The state after the change of highest sequence of each key, whatever order changes come in.

    A deletion stays as a row without values, so that an earlier change that comes later does not bring the key back.  Of a change that comes again, the first stays; of two different
    changes of one key and sequence in one batch, the one of the greater row hash.
    """
    rest = [c for c in state.columns if c not in key]
    fresh = changes.select(
        *key, *[F.col(c) if c != DELETED else (F.col("event") == "DELETE").alias(DELETED) for c in rest], F.lit(False).alias("_kept"), F.xxhash64(*rest[:-2], "event").alias("_hash")
    )
    both = state.withColumns({"_kept": F.lit(True), "_hash": F.lit(0).cast("long")}).unionByName(fresh)
    picked = both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(sequence, "_kept", "_hash")).alias("_row"))
    values = [F.when(~F.col(f"_row.{DELETED}"), F.col(f"_row.{c}")).alias(c) for c in rest[:-2]]
    return picked.select(*key, *values, f"_row.{sequence}", f"_row.{DELETED}").select(*state.columns)


def follow_changes(changes: DataFrame, schema: T.StructType, key: list[str], sequence: str, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """Keep a table in step with a change stream; gives its rows at the end of what is there.

    A batch reads and writes only the buckets that its keys hit.  A job that is begun again goes on from the newest state.
    """
    states = BucketTable(changes.sparkSession, f"{folder}/state", versioned(schema, sequence), key, buckets)
    wanted = [*key, *[c for c in states.schema.names if c not in (*key, DELETED)], "event"]
    run_batches(
        changes, lambda df, n: states.change(df.select(*dict.fromkeys(wanted)).withColumn(sequence, F.col(sequence).cast("long")), lambda old, new: apply_changes(old, new, key, sequence), n), folder
    )
    return states.read().filter(~F.col(DELETED)).select(*schema.names)


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermarks need TIMESTAMP; the session zone is UTC, so clock times keep their face."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


# Ingest


def ingest(rows: DataFrame, key: str, updated: str, delay: str = "1 day") -> DataFrame:
    """Rows of a pull stream without the repeats that the re-read of the last day brings."""
    once = with_event_time(rows, updated, delay).dropDuplicatesWithinWatermark([key, updated])
    return once.withColumn(updated, F.col(updated).cast("timestamp_ntz"))


# Windowed counts


def window_counts(stream: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Counts per window, given out when the watermark has passed it; later rows are dropped."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    counts = with_event_time(stream, ts, delay).groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), *by, "n")


def session_counts(stream: DataFrame, ts: str, by: list[str], gap: str, delay: str = "1 hour") -> DataFrame:
    s = F.session_window(ts, gap)
    counts = with_event_time(stream, ts, delay).groupBy(s.alias("s"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("s.start").cast("timestamp_ntz").alias("start"), F.col("s.end").cast("timestamp_ntz").alias("end"), *by, "n")


# Presence


def presence(stream: DataFrame, ts: str, key: str, timeout: str, delay: str = "1 hour") -> DataFrame:
    """Join and leave of each key.  A key joins with its first sign of life and leaves when none
    has come for ``timeout``.  Sessions are merged map-side before the shuffle, so the state is
    one row per open session and a busy key is no burden."""
    return joins_and_leaves(session_counts(stream, ts, [key], timeout, delay), key)


def joins_and_leaves(sessions: DataFrame, key: str) -> DataFrame:
    diff = F.array(
        F.struct(F.lit("join").alias("change"), F.col("start").alias("at")), F.struct(F.lit("leave").alias("change"), F.col("end").alias("at"))
    )
    return sessions.select(key, F.inline(diff))


def as_text(col: str, kind: T.DataType) -> Column:
    """A key as text, so that null keys come through Python as they are; ``from_text`` gives it back."""
    return F.hex(col) if isinstance(kind, T.BinaryType) else F.col(col).cast("string")


def from_text(col: str, kind: T.DataType) -> Column:
    return F.unhex(col) if isinstance(kind, T.BinaryType) else F.col(col).cast(kind)


def reference_presence(stream: DataFrame, ts: str, key: str, ref: str, leaves: Column, timeout: str, delay: str = "1 hour", buckets: int = 1024) -> DataFrame:
    """Joins and leaves of each reference of a key: (key, ref, change, at).

    A reference joins with its first sign of life and leaves with a row for which ``leaves`` holds, or when no sign has come for longer than ``timeout``.  At equal times a leave comes
    last; leaves of references that are not here say nothing, and rows without a time are left out.  References, not keys, are dealt to ``buckets`` by their hash, so that those of a busy
    key spread over tasks; a bucket's references are worked on together, and its state is kept, with a timer, in Spark's own state store, which a job that is begun again reads.
    There should be so many buckets that one of them, with its events that wait for the watermark, fits a task; a job keeps the number it began with.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    types = {c: stream.schema[c].dataType for c in (key, ref)}
    # Names that begin with an underscore are lost on the way to Python.
    rows = stream.filter(F.col(ts).isNotNull()).select(
        as_text(key, types[key]).alias("presence_key"), as_text(ref, types[ref]).alias("presence_ref"), F.col(ts), micros(ts).alias("at_us"), F.coalesce(leaves, F.lit(False)).alias("leaves")
    )
    dealt = rows.withColumn("presence_bucket", F.pmod(F.xxhash64("presence_key", "presence_ref"), F.lit(buckets)))
    schema = "presence_key string, presence_ref string, change string, at_us long"
    changes = with_event_time(dealt, ts, delay).groupBy("presence_bucket").transformWithStateInPandas(References(span_micros(timeout)), schema, "Append", "EventTime")
    return changes.select(from_text("presence_key", types[key]).alias(key), from_text("presence_ref", types[ref]).alias(ref), "change", from_micros(F.col("at_us")).alias("at"))


def key_presence(changes: DataFrame, key: str, ref: str) -> DataFrame:
    """Joins and leaves of whole keys, from those of their references: a key is here while any reference is.

    At equal times joins are counted first.  The count of references is a prefix sum over the buckets of a key, so a busy key is no burden.
    """
    order = Series([key], ["at", "_o", ref], time_bucket("at").cast("long"))
    step = F.when(F.col("change") == "join", 1).otherwise(-1)
    rows = running(changes.withColumn("_o", F.when(F.col("change") == "join", 0).otherwise(1)), order, {"_before": ("sum", step)}, exclusive=True)
    before = F.coalesce("_before", F.lit(0))
    turns = ((F.col("change") == "join") & (before == 0)) | ((F.col("change") == "leave") & (before == 1))
    return rows.filter(turns).select(key, "change", "at")


# Online exponentially weighted mean


def ewm_state_schema(by: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([*[T.StructField(n, t) for n, t in by], T.StructField("weight", T.DoubleType()), T.StructField("weighted", T.DoubleType())])


def ewm_step(batch: DataFrame, state: DataFrame, series: Series, col: str, alpha: float) -> tuple[DataFrame, DataFrame]:
    """Means for the rows of a batch, and the state after it.

    The state is the sum of weights and of weighted values per key.  A batch's own sums come
    from the distributed scan; the state is added with the ageing of the rows since.
    """
    by = series.by
    if alpha == 1:  # only the last value counts
        rows = settle(position(batch.filter(F.col(col).isNotNull()), series, "_n"))
        means = rows.select(*batch.columns, F.col(col).cast("double").alias("mean"))
        fresh = rows.groupBy(*by).agg(F.lit(1.0).alias("weight"), F.max_by(F.col(col).cast("double"), "_n").alias("weighted"))
        return means, join_null_safe(state, fresh, by, "left_anti").unionByName(fresh.select(*state.columns))
    rate = -math.log1p(-alpha)
    rows = settle(position(batch.filter(F.col(col).isNotNull()), series, "_n"))
    sums = decayed_sums(rows, series, F.col("_n") * F.lit(rate), {"_w": (F.lit(1.0), 1.0), "_x": (F.col(col), 1.0)})
    old = state.select(*by, F.col("weight").alias("_ow"), F.col("weighted").alias("_ox"))
    aged = F.exp(F.col("_n") * F.lit(-rate))
    joined = join_null_safe(sums, old, by, "left").withColumns(
        {"_w": F.col("_w") + F.coalesce(F.col("_ow") * aged, F.lit(0.0)), "_x": F.col("_x") + F.coalesce(F.col("_ox") * aged, F.lit(0.0))}
    )
    joined = settle(joined)
    means = joined.select(*batch.columns, (F.col("_x") / F.col("_w")).alias("mean"))
    fresh = joined.groupBy(*by).agg(F.max_by("_w", "_n").alias("weight"), F.max_by("_x", "_n").alias("weighted"))
    kept = join_null_safe(state, fresh, by, "left_anti")
    return means, kept.unionByName(fresh.select(*state.columns))


def online_ewm(stream: DataFrame, series: Series, col: str, alpha: float, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """Means for every row of a stream whose batches follow each other in time.

    A batch reads and writes the state of only those buckets that its keys hit.
    """
    types = [(c, stream.schema[c].dataType) for c in series.by]
    states = BucketTable(stream.sparkSession, f"{folder}/state", ewm_state_schema(types), series.by, buckets)

    def each(df: DataFrame, n: int) -> None:
        rows = settle(df)
        hit = states.hit(rows)
        means, state = ewm_step(rows, states.read(hit, min(states.version, n - 1)), series, col, alpha)
        means.write.mode("overwrite").parquet(f"{folder}/means/batch={n}")
        states.write(state, hit, n)

    run_batches(stream, each, folder)
    return stream.sparkSession.read.parquet(f"{folder}/means")
