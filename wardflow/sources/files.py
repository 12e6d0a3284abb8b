"""File formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_parquet(spark: SparkSession, path: str, *, columns: list[str] | None = None, where: Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Only these columns and row groups are read."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    df = df if where is None else df.filter(where)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, *, partition_cols: list[str] = (), compression: str = "zstd") -> None:
    """One folder per partition value.  Rows are sorted by them in each task, not shuffled, so a
    frequent value does not end in one task."""
    writer = df.write.option("compression", compression)
    if partition_cols:
        writer = df.sortWithinPartitions(*partition_cols).write.option("compression", compression).partitionBy(*partition_cols)
    writer.parquet(path)


def read_orc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.orc(path)
    return df.select(*columns) if columns else df


def write_orc(df: DataFrame, path: str) -> None:
    df.write.orc(path)


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",", header: bool = True, null: str = "") -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the lines that do not fit the schema.

    A scan tests a line only in the columns a query uses.  The always-true comparison of a hash
    over all columns has every one of them read, so that a line is good or bad for all queries alike.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = (
        spark.read.schema(whole)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(sep=sep, header=header, nullValue=null)
        .csv(path)
    )
    all_read = F.xxhash64(*schema.names) >= F.lit(-(2**63))
    return (
        df.filter(all_read & F.col(CORRUPT).isNull()).drop(CORRUPT),
        df.filter(all_read & F.col(CORRUPT).isNotNull()).select(*schema.names, CORRUPT),
    )


def write_csv(df: DataFrame, path: str, *, sep: str = ",", header: bool = True, null: str = "", quote_all: bool = False) -> None:
    df.write.options(sep=sep, header=header, nullValue=null, quoteAll=quote_all).csv(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).format("xml").load(path)


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str = "rows") -> None:
    df.write.option("rowTag", row_tag).option("rootTag", root_tag).format("xml").save(path)


def schema_to_json(df: DataFrame) -> str:
    return df.schema.json()


def schema_from_json(text: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(text))
