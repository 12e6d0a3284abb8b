"""Text expressions, and jobs over text tables."""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardflow.functions.html_tables import grid_rows

# Case


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def title(c: Column) -> Column:
    """First letter of each run of letters upper, the rest lower; whatever is no letter ends a run."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, capitalize), "")


def casefold(c: Column) -> Column:
    """Lower case for comparison: by way of upper case, with the sharp s spelt out and one form of sigma."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.upper(c)), "[ßẞ]", "ss"), "ς", "σ")


def swapcase(c: Column) -> Column:
    letters = F.transform(F.split(c, ""), lambda x: F.when(x == F.upper(x), F.lower(x)).otherwise(F.upper(x)))
    return F.array_join(letters, "")


# Padding and slices


def center(c: Column, width: int, fill: str = " ") -> Column:
    """Text in the middle; an odd space goes to the right."""
    gap = F.greatest(F.lit(width) - F.length(c), F.lit(0))
    left = F.floor(gap / 2).cast("int")
    return F.concat(F.repeat(F.lit(fill), left), c, F.repeat(F.lit(fill), (gap - left).cast("int")))


def pad(c: Column, width: int, side: str = "left", fill: str = " ") -> Column:
    """Pad to a width; longer text stays whole."""
    if side == "both":
        return center(c, width, fill)
    make = F.lpad if side == "left" else F.rpad
    return F.when(F.length(c) >= width, c).otherwise(make(c, width, fill))


def zfill(c: Column, width: int) -> Column:
    """Zeros after a sign."""
    sign = F.when(c.rlike(r"^[+-]"), F.substring(c, 1, 1)).otherwise("")
    digits = F.when(sign != "", F.substring(c, 2, 2**31 - 1)).otherwise(c)
    return F.when(F.length(c) >= width, c).otherwise(F.concat(sign, F.lpad(digits, F.lit(width) - F.length(sign), F.lit("0"))))


def remove_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def remove_suffix(c: Column, suffix: str) -> Column:
    return F.when(c.endswith(suffix), F.substring(c, F.lit(1), F.length(c) - len(suffix))).otherwise(c)


def slice_text(c: Column, start: int, stop: int) -> Column:
    """Characters start..stop-1, from 0."""
    return F.substring(c, start + 1, max(stop - start, 0))


def slice_replace(c: Column, start: int, stop: int, new: str) -> Column:
    return F.concat(F.substring(c, 1, start), F.lit(new), F.substring(c, stop + 1, 2**31 - 1))


def wrap(c: Column, width: int) -> Column:
    """Line breaks at spaces so that lines have at most ``width`` characters; longer words are not broken."""
    return F.rtrim(F.regexp_replace(c, rf"(.{{1,{width}}})(?: +|$)", "$1\n"), F.lit("\n"))


# Search


def find(c: Column, part: str) -> Column:
    """0-based place of the first occurrence, -1 if none."""
    return F.instr(c, part) - 1


def rfind(c: Column, part: str) -> Column:
    at = F.instr(F.reverse(c), part[::-1])
    return F.when(at == 0, -1).otherwise(F.length(c) - at - len(part) + 1)


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def match(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})")


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def find_all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def extract(c: Column, pattern: str, names: list[str]) -> list[Column]:
    """Groups of the first match; NULL without a match."""
    return [F.when(c.rlike(pattern), F.regexp_extract(c, pattern, i + 1)).alias(n) for i, n in enumerate(names)]


# Splitting


def split_left(c: Column, sep: str, n: int) -> Column:
    """At most n splits from the left."""
    return F.split(c, re.escape(sep), n + 1)


def split_right(c: Column, sep: str, n: int) -> Column:
    """At most n splits from the right."""
    back = F.split(F.reverse(c), re.escape(sep[::-1]), n + 1)
    return F.reverse(F.transform(back, lambda x: F.reverse(x)))


def partition(c: Column, sep: str, names: tuple[str, str, str] = ("before", "sep", "after")) -> list[Column]:
    """Text before, at and after the first separator."""
    at = F.instr(c, sep)
    return [
        F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c).alias(names[0]),
        F.when(at > 0, sep).otherwise("").alias(names[1]),
        F.when(at > 0, F.substring(c, at + len(sep), F.length(c))).otherwise("").alias(names[2]),
    ]


# Character classes of whole-text tests.
CLASSES = {
    "is_alnum": r"\A[\p{L}\p{N}]+\z",
    "is_alpha": r"\A\p{L}+\z",
    "is_decimal": r"\A\p{Nd}+\z",
    "is_digit": r"\A[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐❶-❾]+\z",
    "is_numeric": r"\A\p{N}+\z",
    "is_space": r"\A\s+\z",
    "is_lower": r"\A[^\p{Lu}]*\p{Ll}[^\p{Lu}]*\z",
    "is_upper": r"\A[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\z",
    "is_title": r"\A[^\p{Lu}\p{Ll}]*\p{Lu}\p{Ll}*(?:[^\p{Lu}\p{Ll}]+\p{Lu}\p{Ll}*)*[^\p{Lu}\p{Ll}]*\z",
}


def class_tests(c: Column, names: list[str] | None = None) -> list[Column]:
    return [c.rlike(CLASSES[n]).alias(n) for n in names or CLASSES]


# Jobs

# Patterns counted by the profile.
PATTERNS = {
    "emails": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "urls": r"https?://[^\s]+",
    "addresses": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
}

# Text that any hit of the pattern must hold.
NEEDS = {"emails": "@", "urls": "://", "addresses": "."}


def text_figures(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Lengths, class counts, tokens and pattern hits of each text, over the whole text."""
    c = F.col(text)

    def hits(pattern: str, only_with: str | None = None) -> Column:
        found = count(c, pattern)
        if only_with is not None:  # the plain search is much cheaper than the pattern
            found = F.when(c.contains(only_with), found).otherwise(0)
        return found.cast("bigint")

    def left_by(removed: Column) -> Column:
        """How many characters a removal takes."""
        return (F.length(c) - F.length(removed)).cast("bigint")

    return df.select(
        *keep,
        F.length(c).cast("bigint").alias("chars"),
        left_by(F.translate(c, "0123456789", "")).alias("digits"),
        left_by(F.regexp_replace(c, r"\p{Lu}+", "")).alias("uppers"),
        left_by(F.translate(c, " \t\n\r", "")).alias("spaces"),
        hits(r"[^ \t\n\r]+").alias("tokens"),
        *[hits(p, NEEDS[n]).alias(n) for n, p in PATTERNS.items()],
    )


def text_profile(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    sums = ["chars", "digits", "uppers", "spaces", "tokens", *PATTERNS]
    rows = text_figures(df, text, by).groupBy(*by).agg(F.count(F.lit(1)).alias("texts"), *[F.sum(n).alias(n) for n in sums])
    shares = [F.round(F.col(n) / F.col("chars"), 10).alias(f"{n}_share") for n in ("digits", "uppers", "spaces")]
    return rows.select(*by, "texts", *sums, *shares)


def url_parts(url: Column) -> list[Column]:
    """Scheme, host, port, path and fragment; the port defaults by scheme."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    port = F.nullif(F.regexp_extract(authority, r":([0-9]+)$", 1), F.lit("")).cast("int")
    default = F.when(scheme == "http", 80).when(scheme == "https", 443)
    return [
        scheme.alias("scheme"),
        F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")).alias("host"),
        F.coalesce(port, default).alias("port"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.nullif(F.regexp_extract(url, r"#(.*)$", 1), F.lit("")).alias("fragment"),
    ]


def url_query_pairs(df: DataFrame, url: str, keep: list[str]) -> DataFrame:
    """One row per key and value of the query part, decoded."""

    def decode(c: Column) -> Column:
        return F.coalesce(F.try_url_decode(c), c)

    query = F.nullif(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    pairs = df.select(*keep, F.posexplode(F.split(query, "&")).alias("place", "pair")).filter("pair <> ''")
    return pairs.select(
        *keep, "place", decode(F.split_part("pair", F.lit("="), F.lit(1))).alias("key"),
        decode(F.when(F.instr("pair", "=") > 0, F.expr("substring(pair, instr(pair, '=') + 1)")).otherwise("")).alias("value"),
    )


# Entities decoded in cell text; the ampersand last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def plain_text(html: Column) -> Column:
    """Markup removed, entities decoded, outer space trimmed."""
    text = F.regexp_replace(html, r"<[^>]*>", "")
    for entity, sign in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def html_cells(df: DataFrame, html: str, keep: list[str], *, table: str = "table", row: str = "tr", cell: str = "t[dh]") -> DataFrame:
    """Cells of well-formed, not nested tables: table, row and column number, text.

    The tag names may be others, such as ``ul`` and ``li``; without ``row`` a table is one row.
    """

    def inner(source: Column, tag: str) -> Column:
        return F.regexp_extract_all(source, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))

    tables = df.select(*keep, F.posexplode(inner(F.col(html), table)).alias("table_no", "_t"))
    rows = inner(F.col("_t"), row) if row else F.array(F.col("_t"))
    rows_df = tables.select(*keep, "table_no", F.posexplode(rows).alias("row_no", "_r"))
    cells = rows_df.select(*keep, "table_no", "row_no", F.posexplode(inner(F.col("_r"), cell)).alias("column_no", "_c"))
    return cells.select(*keep, "table_no", "row_no", "column_no", plain_text(F.col("_c")).alias("text"))


GRID = "table_no int, inside int, section string, row_no int, column_no int, header boolean, text string"


def html_grid(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Places of all tables as a browser lays them out: row and column spans repeated, omitted end tags closed, nested tables apart.

    ``inside`` is the table that a nested one stands in; ``section`` is head, body or foot.  Only pages with a table go to Python.
    """
    schema = T.StructType([*[df.schema[c] for c in keep], *T.StructType.fromDDL(GRID).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            rows = grid_rows(batch.column(len(keep)).to_pylist())
            while part := list(islice(rows, 10_000)):
                at, *cells = zip(*part)
                kept = [batch.column(i).take(pa.array(at)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(v, arrow.field(len(keep) + i).type) for i, v in enumerate(cells)]], schema=arrow)

    return df.filter(F.col(html).rlike("(?i)<table")).select(*keep, html).mapInArrow(run, schema)
