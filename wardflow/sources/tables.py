"""Staging, bulk copy, export and view refresh."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def write_counted(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write a new table and count its rows in the same pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def load_staging(df: DataFrame, path: str) -> DataFrame:
    """Replace the staging table with this pull."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def report(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def bulk_copy(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Copy named tables to a new folder; empty ones are skipped.  Returns rows per table."""
    done = []
    for name, df in tables.items():
        if df.isEmpty():
            done.append((name, 0, "skipped"))
        else:
            done.append((name, write_counted(df, f"{folder}/{name}"), "copied"))
    return report(spark, done, "table_name string, row_count long, status string")


def write_csv(df: DataFrame, path: str) -> None:
    """Header, every value quoted, quotes doubled, NULL as the word null."""
    (
        df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in df.columns])
        .write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def refresh_views(
    spark: SparkSession, steps: dict[str, Callable[[dict[str, DataFrame]], DataFrame]], folder: str
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write views in order.  A later step gets the views written before it; a step that
    fails is reported, and the next one is still tried."""
    written: dict[str, DataFrame] = {}
    status = []
    for name, build in steps.items():
        try:
            df = build(written)
            rows = write_counted(df, f"{folder}/{name}")
            written[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
            status.append((name, "ok", rows, None))
        except Exception as e:  # noqa: BLE001 - reported, by design
            status.append((name, "failed", None, type(e).__name__))
    return written, report(spark, status, "view_name string, status string, row_count long, error string")
