"""Daily census by program.

Stays become a small ledger of day changes: +1 when a case enters a program's
census, -1 when it leaves, and the flows of the day.  Ledger rows combine
map-side to one row per program and day, so no row per stay and day is ever
shuffled.  A case that is in one program twice at a time is counted once: a stay
enters the ledger only from where the case's earlier stays there end.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window as W, functions as F

FLOWS = ["admissions", "transfer_in", "transfer_out", "discharges"]


def census_ledger(history: DataFrame, *, start: date, end: date) -> DataFrame:
    earlier = (
        W.partitionBy("casefile_id", "program_category")
        .orderBy("start_day", "ph_version")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    first, stop = F.lit(start), F.lit(end + timedelta(days=1))
    stays = (
        history.filter(F.col("program_class") == "Program")
        .withColumn("_seen", F.max("end_day").over(earlier))
        .withColumn("_in", F.greatest("start_day", "_seen", first))
        .withColumn("_out", F.least("end_day", stop))
        .withColumn("_counts", (F.col("_in") < F.col("_out")).cast("int"))
    )

    def entry(day, present=F.lit(0), admissions=F.lit(0), transfer_in=F.lit(0), transfer_out=F.lit(0), discharges=F.lit(0)):
        return F.struct(
            day.alias("day"), present.alias("present"), admissions.alias("admissions"), transfer_in.alias("transfer_in"),
            transfer_out.alias("transfer_out"), discharges.alias("discharges"),
        )

    c = F.col
    entries = F.array(
        entry(c("start_day"), admissions=c("admission") - c("transferred_in"), transfer_in=c("transferred_in")),
        entry(c("end_day"), transfer_out=c("transferred_out"), discharges=c("discharged")),
        entry(c("_in"), present=c("_counts")),
        entry(c("_out"), present=-c("_counts")),
    )
    return (
        stays.select("program_category", F.inline(entries))
        .filter(F.col("day").between(first, stop))
        .groupBy("program_category", "day")
        .agg(*[F.sum(n).alias(n) for n in ["present", *FLOWS]])
    )


def daily_census(history: DataFrame, *, start: date, end: date, keep_flow_only_days: bool = False) -> DataFrame:
    """Census and flows per day and program.

    A flow on a day without census for that program is left out unless
    ``keep_flow_only_days``.
    """
    return census_of_ledger(census_ledger(history, start=start, end=end), end=end, keep_flow_only_days=keep_flow_only_days)


def census_of_ledger(ledger: DataFrame, *, end: date, keep_flow_only_days: bool = False) -> DataFrame:
    days = W.partitionBy("program_category").orderBy("day")
    stop = F.lit(end + timedelta(days=1))
    spans = (
        ledger.withColumn("census", F.sum("present").over(days.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_next", F.coalesce(F.lead("day").over(days), stop))
        .filter(F.col("day") < stop)
    )
    has_flow = (F.col("admissions") + F.col("transfer_in") + F.col("transfer_out") + F.col("discharges")) != 0
    # An empty program needs no more than the day of its last change.
    until = F.when(F.col("census") > 0, F.date_sub("_next", 1)).otherwise(F.col("day"))
    kept = F.col("census") > 0
    if keep_flow_only_days:
        kept = kept | has_flow
    return (
        spans.filter(kept)
        .select("*", F.posexplode(F.sequence("day", until)).alias("_i", "census_date"))
        .select(
            "census_date",
            "program_category",
            "census",
            *[F.when(F.col("_i") == 0, F.col(n)).otherwise(F.lit(0)).alias(n) for n in FLOWS],
        )
    )


def census_by_days(history: DataFrame, *, start: date, end: date) -> DataFrame:
    """Every (day, program, case) of the range join of days and stays, half-open.

    The days of a stay come from the stay itself, cut to the spine, so there is
    no comparison of all days with all stays.
    """
    c = F.col
    low = F.greatest(c("start_day"), F.lit(start))
    high = F.least(F.date_sub("end_day", 1), F.lit(end))
    return (
        history.filter(c("program_class") == "Program")
        .select("casefile_id", "program_category", low.alias("_low"), high.alias("_high"))
        .filter(c("_low") <= c("_high"))
        .select("casefile_id", "program_category", F.explode(F.sequence("_low", "_high")).alias("census_date"))
    )


def distinct_census(history: DataFrame, *, start: date, end: date, approximate: bool = False) -> DataFrame:
    """Different cases per day and program.

    The ledger counts a case once, so its running total is the exact number, and no row per stay and day is made.
    """
    if not approximate:
        return daily_census(history, start=start, end=end).select("census_date", "program_category", "census")
    return census_by_days(history, start=start, end=end).groupBy("census_date", "program_category").agg(F.approx_count_distinct("casefile_id").alias("census"))


def arrivals(history: DataFrame) -> DataFrame:
    return history.groupBy("start_day", "program_category").agg(
        (F.sum("admission") - F.sum("transferred_in")).alias("admissions"), F.sum("transferred_in").alias("transfer_in")
    )


def departures(history: DataFrame) -> DataFrame:
    return history.groupBy("end_day", "program_category").agg(
        F.sum("transferred_out").alias("transfer_out"), F.sum("discharged").alias("discharges")
    )
