"""Expressions for nested source records and composite keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MISSING = "NA"


def split_key(key: Column, part: int) -> Column:
    """Part of a ``a:b`` key; NULL when the part is absent."""
    return F.get(F.split(key, ":"), part)


def first_item(items: Column, name: str, default: str | None = MISSING) -> Column:
    """``value`` of the first item called ``name``; the default when there is none.

    An item that is there but holds NULL gives NULL.
    """
    found = F.filter(items, lambda i: i["name"] == name)
    return F.when(F.size(found) > 0, F.get(found, 0)["value"]).otherwise(F.lit(default))


def clean_text(col: Column) -> Column:
    """The 'NA' marker and empty text as NULL."""
    return F.nullif(F.nullif(col, F.lit(MISSING)), F.lit(""))


def flatten(df: DataFrame, sep: str = ".", max_level: int | None = None) -> DataFrame:
    """Struct columns, at any depth, to top-level columns named by their path."""

    def walk(field: T.StructField, path: list[str], level: int):
        if isinstance(field.dataType, T.StructType) and (max_level is None or level < max_level):
            for child in field.dataType.fields:
                yield from walk(child, [*path, child.name], level + 1)
        else:
            yield path

    paths = [p for f in df.schema.fields for p in walk(f, [f.name], 0)]
    return df.select(*[F.col(".".join(f"`{n}`" for n in p)).alias(sep.join(p)) for p in paths])


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row: ISO times, NaN as null, null fields kept."""
    cols = [
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    options = {
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "ignoreNullFields": "false",
    }
    return df.select(F.to_json(F.struct(*cols), options).alias("json"))
