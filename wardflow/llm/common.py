"""What the operators share: reading texts in pieces of bounded size, remainders of ids, spans."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardflow.session import prepare, scratch_dir

PIECE_BYTES = 1 << 20
ARROW_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings, and small Arrow batches: a batch of long texts is held by the executor and by Python at once."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Spark's own limit for the buckets of a table.
MOST_BUCKETS = 100_000


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a write goes when it ends, and not when the driver next collects garbage; the session's setting is put back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Dealt:
    """A table in the shared scratch folder, in buckets by the hash of a key, so that what is grouped or joined by that key leaves its rows where they are.

    There are at least as many buckets as shuffle partitions, or Spark would deal the rows anew.  Frames are added until the table's name is forgotten; its files stay.
    """

    def __init__(self, spark: SparkSession, key: str, least: int):
        self.spark, self.key = spark, key
        self.parts = min(MOST_BUCKETS, max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        self.name, self.path = f"settled_{uuid.uuid4().hex}", scratch_dir(spark)

    def add(self, df: DataFrame, moved: bool = True) -> None:
        """Add rows, a file for each bucket; those that are not ``moved`` are written by the tasks that have them, each to a file for each of its buckets."""
        df = df.repartition(self.parts, self.key) if moved else df
        with swept(self.spark):
            df.write.format("parquet").mode("append").bucketBy(self.parts, self.key).option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def plain(self) -> DataFrame:
        """As ``read``, without the buckets, and with columns of its own: a table that comes twice into nested cogroups would lose some."""
        return self.spark.read.schema(self.read().schema).parquet(self.path)

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


@contextmanager
def fleeting(df: DataFrame) -> Iterator[DataFrame]:
    """As ``settle``, for a frame that nothing reads later: its files are removed at the end.  So what was shuffled for a frame can go before it is dealt."""
    spark, folder = df.sparkSession, scratch_dir(df.sparkSession)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        with swept(spark):
            df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def two(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own, so that no other column can clash; a null text is empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def remainder(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array without nulls; one more than it has values."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text array one after the other, and where each text starts (and the last ends)."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    at = offsets(texts)
    data = texts.buffers()[2] if len(texts) else None
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def text_bytes(texts: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in texts.cast(pa.binary()).to_pylist()]


def pieces(batches, column: str = "text", limit: int = PIECE_BYTES):
    """Cut record batches so that the texts of each piece have at most ``limit`` bytes, or the piece has one row."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        texts = pc.fill_null(texts, "") if texts.null_count else texts
        at, i, n = offsets(texts), 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield batch.slice(i, min(j, n) - i)
            i = j


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def shrink(x: bytes) -> bytes:
    """Compressed bytes, for rows that hold many values."""
    return pa.compress(x, codec="zstd", asbytes=True)


def grow(x: bytes, size: int) -> bytes:
    return pa.decompress(x, size, codec="zstd", asbytes=True) if size else b""
