"""History and census kept up to date by what a pull changes.

Stays are rebuilt only for cases with a new log row or a new state, and, when the clock has moved on, for cases whose last stay is open.  The ledger
entries of their old stays are taken back, those of the new ones added, and the census of a program is patched from the first day whose
entries changed.  Tables lie in key buckets: buckets without such a case are neither read nor written.

A refresh writes its version of every table and then its commit.  One that fails is simply run again: it begins from the last commit.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wardflow import schemas
from wardflow.operators.keys import join_null_safe
from wardflow.operators.merge import upsert
from wardflow.plans.census import FLOWS, census_ledger, census_of_ledger
from wardflow.plans.history import build_history
from wardflow.session import settle
from wardflow.sources.buckets import BUCKETS, BucketTable

CASE = "casefile_id"
LEDGER = T.StructType([T.StructField("program_category", T.StringType()), T.StructField("day", T.DateType()), *[T.StructField(n, T.LongType()) for n in ["present", *FLOWS]]])
CENSUS = T.StructType([
    T.StructField("program_category", T.StringType()), T.StructField("month", T.DateType()), T.StructField("census_date", T.DateType()),
    *[T.StructField(n, T.LongType()) for n in ["census", *FLOWS]],
])
OPEN = T.StructType([T.StructField(CASE, T.StringType())])


@dataclass
class StoredViews:
    """The tables of one ward below a folder: ``log`` and ``latest`` as pulled, ``history``, ``ledger`` and ``census`` made from them.

    ``start`` and ``end`` bound the census and stay the same from refresh to refresh, as do the program types; a new calendar or new types need a new folder.
    """

    spark: SparkSession
    folder: str
    program_types: DataFrame
    start: date
    end: date
    buckets: int = BUCKETS
    tables: dict[str, BucketTable] = field(default_factory=dict)

    def __post_init__(self):
        history = build_history(*self._empty_inputs(), as_of=datetime(2000, 1, 1)).schema
        keyed = {
            "log": (schemas.PROGRAM_HISTORY, [CASE]), "latest": (schemas.LATEST, [CASE]), "history": (history, [CASE]), "open": (OPEN, [CASE]),
            "ledger": (LEDGER, ["program_category", "day"]), "census": (CENSUS, ["program_category", "month"]),
        }
        self.tables = {n: BucketTable(self.spark, f"{self.folder}/{n}", s, k, self.buckets) for n, (s, k) in keyed.items()}
        files, path = self.tables["log"]._files, self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/*/_SUCCESS")
        self.version = max([int(x.getPath().getParent().getName()) for x in files.globStatus(path) or []], default=-1)

    def _empty_inputs(self):
        return self.spark.createDataFrame([], schemas.PROGRAM_HISTORY), self.program_types, self.spark.createDataFrame([], schemas.LATEST)

    def read(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        return self.tables[name].read(buckets, self.version)

    def census(self) -> DataFrame:
        return self.read("census").select("census_date", "program_category", "census", *FLOWS)

    def history(self) -> DataFrame:
        return self.read("history")

    def _clock(self) -> datetime | None:
        return None if self.version < 0 else self.spark.read.schema("as_of timestamp_ntz").parquet(f"{self.folder}/commits/{self.version}").first()["as_of"]

    def refresh(self, log: DataFrame, latest: DataFrame, as_of: datetime) -> int:
        """Take in new log rows and new states of cases; gives the version."""
        version, t = self.version + 1, self.tables
        log, latest = settle(log.select(*schemas.PROGRAM_HISTORY.names)), settle(latest.select(*schemas.LATEST.names))
        moved = self._clock() != as_of
        changed = log.select(CASE).unionByName(latest.select(CASE))
        # A case may be closed by the clock alone if its last stay is open.
        changed = settle((changed.unionByName(self.read("open")) if moved else changed).filter(F.col(CASE).isNotNull()).distinct())
        hit = t["history"].hit(changed)

        t["log"].append(log, version)
        t["latest"].change(latest.dropna(subset=[CASE]), lambda old, new: upsert(old, new, keys=[CASE], version=["last_updated_at"]), version, written=True)
        of = lambda df: df.join(changed, CASE, "left_semi")
        old = self.read("history", hit)
        fresh = settle(build_history(of(t["log"].read(hit, version)), self.program_types, of(t["latest"].read(hit, version)), as_of=as_of).select(*old.columns))
        t["history"].write(old.join(changed, CASE, "left_anti").unionByName(fresh), hit, version)
        # A last stay without an end of its own, and a stay that has not begun yet, change with the clock.
        last = (F.col("ph_version") == F.col("total_versions")) & (F.col("program_class") == "Program") & F.col("discharge_date").isNull()
        still = self.read("open", hit).join(changed, CASE, "left_anti").unionByName(fresh.filter(last).select(CASE).distinct())
        t["open"].write(still, hit, version)

        before = census_ledger(of(old), start=self.start, end=self.end)
        after = census_ledger(fresh, start=self.start, end=self.end)
        sums = ["present", *FLOWS]
        taken_back = before.select("program_category", "day", *[(-F.col(n)).cast("long").alias(n) for n in sums])
        delta = taken_back.unionByName(after.select("program_category", "day", *[F.col(n).cast("long").alias(n) for n in sums]))
        delta = settle(delta.groupBy("program_category", "day").agg(*[F.sum(n).alias(n) for n in sums]).filter(" OR ".join(f"{n} <> 0" for n in sums)))
        added = lambda rows, new: rows.unionByName(new).groupBy("program_category", "day").agg(*[F.sum(n).alias(n) for n in sums]).filter(" OR ".join(f"{n} <> 0" for n in sums))
        t["ledger"].change(delta, added, version, written=True)
        self._patch_census(delta, version)
        self.spark.createDataFrame([(as_of,)], "as_of timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/{version}")
        self.version = version
        return version

    def _patch_census(self, delta: DataFrame, version: int) -> None:
        """The census of each changed program from its first changed day on; what was counted the day before is carried in."""
        table = self.tables["census"]
        first = settle(delta.groupBy("program_category").agg(F.min("day").alias("first")).filter(F.col("first") <= F.lit(self.end)))
        months = first.select("program_category", F.explode(F.sequence(F.trunc("first", "month"), F.lit(self.end), F.expr("INTERVAL 1 MONTH"))).alias("month"))
        # The day before may lie in the month before.
        eve = first.select("program_category", F.date_sub("first", 1).alias("day"))
        hit = table.hit(months)
        eves = eve.select("*", F.trunc("day", "month").alias("month"))
        carried = join_null_safe(self.read("census", table.hit(eves)), eve.withColumnRenamed("day", "_eve"), ["program_category"]).filter(F.col("census_date") == F.col("_eve"))
        zeros = [F.lit(0).cast("long").alias(n) for n in FLOWS]
        base = carried.select("program_category", F.col("census_date").alias("day"), F.col("census").alias("present"), *zeros)
        later = join_null_safe(self.tables["ledger"].read(None, version), first, ["program_category"]).filter(F.col("day") >= F.col("first")).drop("first")
        whole = census_of_ledger(later.unionByName(base), end=self.end)
        fresh = join_null_safe(whole, first, ["program_category"]).filter(F.col("census_date") >= F.col("first"))
        fresh = fresh.select("program_category", F.trunc("census_date", "month").alias("month"), "census_date", *[F.col(n).cast("long").alias(n) for n in ["census", *FLOWS]])
        old = join_null_safe(self.read("census", hit), first, ["program_category"], "left").filter(F.col("first").isNull() | (F.col("census_date") < F.col("first"))).drop("first")
        table.write(old.unionByName(fresh), hit, version)
