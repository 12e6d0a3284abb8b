"""Keyed tables in hash buckets, of which a change rewrites only those that its keys hit.

A version of the table is a list that names, for each bucket, the version that wrote it last, and those that added rows since.  A change reads the buckets of its keys, writes
them anew below its own version and then its list; all other buckets are carried by name.  Rows that are only added are written beside those that are there, which are
not read.  Nothing is overwritten, so a run that fails leaves the
version before, and a run that is repeated writes the same version again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wardflow.session import settle

BUCKETS = 256
#: A bucket in so many pieces is written as one when rows are added again.
PIECES = 16


class BucketTable:
    """Rows with a key below a folder; all rows of a key lie in one bucket.

    A small bucket is written by one task: ``buckets`` should be so many that one of them fits a task; one that outgrows the size advised for a partition is shared out.  What reaches the driver are lists of at most as many entries as there are buckets.  Keys spread by their hash, null keys included, so no bucket outgrows the others.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: list[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.schema, self.key = spark, folder, schema, list(key)
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        #: Lists that were read or written here, by version.
        self._lists: dict[int, tuple[dict[int, tuple[int, ...]], int | None]] = {-1: ({}, None)}
        done = self._files.globStatus(self._path("list/*/_SUCCESS"))
        self.version = max([int(x.getPath().getParent().getName()) for x in done or []], default=-1)
        #: A table keeps the number of buckets that it began with.
        self.buckets = self._list(self.version)[1] or buckets

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _list(self, version: int) -> tuple[dict[int, tuple[int, ...]], int | None]:
        """The versions that hold each bucket, and the number of buckets."""
        if version not in self._lists:
            held: dict[int, tuple[int, ...]] = {}
            for r in self.spark.read.schema("bucket int, version int").parquet(f"{self.folder}/list/{version}").collect():
                held[r["bucket"]] = (*held.get(r["bucket"], ()), r["version"])
            self._lists[version] = held, held.pop(-1)[0]
        return self._lists[version]

    def bucket(self) -> Column:
        """The bucket of a row, by its key in the table's types."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.key]), F.lit(self.buckets)).cast("int")

    def hit(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of some rows belong to."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The table, or some of its buckets, as of a version."""
        held, _ = self._list(self.version if version is None else version)
        paths = [f"{self.folder}/data/{v}/_bucket={b}" for b, pieces in sorted(held.items()) if buckets is None or b in set(buckets) for v in pieces]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, buckets: list[int], version: int | None = None) -> int:
        """The next version: ``rows`` are all that the given buckets hold from now on."""
        version = self.version + 1 if version is None else version
        # A change that is run again begins from the same version as before.
        held, _ = self._list(min(self.version, version - 1))
        filled = self._put(rows, version)
        if filled - set(buckets):
            raise ValueError(f"rows of buckets that were not to be written: {sorted(filled - set(buckets))[:5]}")
        return self._name({b: v for b, v in held.items() if b not in set(buckets)} | dict.fromkeys(filled, (version,)), version)

    def append(self, rows: DataFrame, version: int | None = None) -> int:
        """The next version, with some rows more; of what is there only buckets in ``PIECES`` pieces are read and written."""
        version = self.version + 1 if version is None else version
        begun = min(self.version, version - 1)
        held, _ = self._list(begun)
        crowded = [b for b, pieces in held.items() if len(pieces) >= PIECES]
        filled = self._put(rows.select(*self.schema.names).unionByName(self.read(crowded, begun)) if crowded else rows, version)
        return self._name(held | {b: (*(() if b in crowded else held.get(b, ())), version) for b in filled}, version)

    def _put(self, rows: DataFrame, version: int) -> set[int]:
        """Write rows by bucket below a version; gives the buckets that have any."""
        placed = rows.select(*self.schema.names).withColumn("_bucket", self.bucket()).hint("rebalance", F.col("_bucket"))
        placed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/data/{version}")
        return {int(x.getPath().getName().split("=")[1]) for x in self._files.globStatus(self._path(f"data/{version}/_bucket=*")) or []}

    def _name(self, now: dict[int, tuple[int, ...]], version: int) -> int:
        """Write the list of a version."""
        listed = [(-1, self.buckets), *[(b, v) for b, pieces in now.items() for v in pieces]]
        self.spark.createDataFrame(listed, "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/list/{version}")
        self.version, self._lists[version] = version, (now, self.buckets)
        self._forget(version - 2)
        return version

    def _forget(self, version: int) -> None:
        """Remove a version that no run can begin from any more, but for the buckets that the next one still names."""
        if not self._files.exists(self._path(f"list/{version}/_SUCCESS")) or not self._files.exists(self._path(f"list/{version + 1}/_SUCCESS")):
            return
        old, new = self._list(version)[0], self._list(version + 1)[0]
        for bucket, holder in [(b, v) for b, pieces in old.items() for v in pieces]:
            if holder not in new.get(bucket, ()):
                self._files.delete(self._path(f"data/{holder}/_bucket={bucket}"), True)
        self._files.delete(self._path(f"list/{version}"), True)
        self._lists.pop(version, None)

    def change(self, source: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None, *, written: bool = False) -> int:
        """Put ``apply(rows, source)`` in place of the rows of the buckets that the source's keys hit.

        The source is written first, unless it is ``written`` already: it is read for its buckets and again for its rows.  A source without rows gives a version that
        names what the one before does.
        """
        source = source if written else settle(source)
        buckets = self.hit(source)
        before = self.version if version is None else min(self.version, version - 1)
        return self.write(apply(self.read(buckets, before), source), buckets, version)
