"""Wide and long forms, dummies, bins and nested columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardflow.operators.joins import distinct_values, hash_join
from wardflow.operators.keys import with_one_row
from wardflow.operators.ordered import edges_below
from wardflow.operators.quality import duplicate_keys
from wardflow.operators.ranks import quantiles

ALL = "All"


def pivot_table(
    df: DataFrame, *, index: list[str], columns: str, values: list | None, agg: Column, fill=None, margins: bool = False
) -> DataFrame:
    """Aggregate by index and column.  ``values`` fixes the result's columns.

    With margins, a cube gives the totals in the same pass; they are the
    aggregate over the rows, not over the cells.
    """
    values = distinct_values(df, columns) if values is None else values
    if not margins:
        out = df.groupBy(*index).pivot(columns, values).agg(agg)
        return out.fillna(fill, subset=[str(v) for v in values]) if fill is not None else out
    sets = [[*index, columns], index, [columns], []]
    rows = df.filter(F.col(columns).isin(values)).groupingSets(
        [[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*index, columns]]
    ).agg(agg.alias("_v"), *[F.grouping(c).alias(f"_g_{c}") for c in [*index, columns]])
    label = F.when(F.col(f"_g_{columns}") == 1, ALL).otherwise(F.col(columns).cast("string")).alias("_label")
    keys = [F.when(F.col(f"_g_{c}") == 1, ALL).otherwise(F.col(c).cast("string")).alias(c) for c in index]
    names = [*[str(v) for v in values], ALL]
    out = rows.select(*keys, label, "_v").groupBy(*index).pivot("_label", names).agg(F.first("_v"))
    return out.fillna(fill, subset=names) if fill is not None else out


def pivot_long(df: DataFrame, index: list[str], columns: str, agg: Column) -> DataFrame:
    """The cells of a pivot table as rows: index, category and value, however many categories there are."""
    return df.groupBy(*index, columns).agg(agg.alias("value"))


def dummies_long(df: DataFrame, key: list[str], column: str, sep: str | None = None) -> DataFrame:
    """The ones of dummy columns as rows: key and category; with ``sep`` the column holds a separated list."""
    category = F.col(column) if sep is None else F.explode(F.split(column, re.escape(sep)))
    return df.select(*key, category.alias("category")).filter("category IS NOT NULL AND category <> ''").distinct()


def totals(df: DataFrame, by: list[str], agg: Column, kind: str = "cube") -> DataFrame:
    """Sub-totals over all (cube) or leading (rollup) key subsets, with ``grouping_id``."""
    grouped = df.cube(*by) if kind == "cube" else df.rollup(*by)
    return grouped.agg(agg, F.grouping_id().cast("int").alias("grouping_id"))


def pivot(df: DataFrame, *, index: list[str], columns: str, values: list, cell: str) -> DataFrame:
    """Reshape without aggregating; more than one row for a cell is an error."""
    if not duplicate_keys(df, [*index, columns]).isEmpty():
        raise ValueError(f"several rows for one cell of {index} x {columns}")
    return df.groupBy(*index).pivot(columns, values).agg(F.first(cell))


def crosstab(df: DataFrame, row: str, column: str, values: list, normalize: str | None = None, margins: bool = False) -> DataFrame:
    """Counts of pairs, or shares of all rows, of the row or of the column."""
    counts = df.filter(F.col(column).isin(values)).groupBy(row).agg(
        *[F.count_if(F.col(column) == v).alias(str(v)) for v in values], F.count(F.lit(1)).alias(ALL)
    )
    names = [str(v) for v in values]
    if margins or normalize in ("all", "columns"):
        sums = counts.agg(*[F.sum(n).alias(n) for n in [*names, ALL]])
    if margins:
        counts = counts.withColumn(row, F.col(row).cast("string")).unionByName(sums.withColumn(row, F.lit(ALL)))
    if normalize == "index":
        counts = counts.select(row, *[(F.col(n) / F.col(ALL)).alias(n) for n in names])
    elif normalize in ("all", "columns"):
        joined = with_one_row(counts, sums.select(*[F.col(n).alias(f"_t_{n}") for n in [*names, ALL]]))
        counts = joined.select(row, *[(F.col(n) / F.col(f"_t_{ALL if normalize == 'all' else n}")).alias(n) for n in names])
    return counts if margins and not normalize else counts.drop(ALL)


def melt(df: DataFrame, ids: list[str], values: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, variable, value)


def wide_to_long(df: DataFrame, stubs: list[str], ids: list[str], j: str, sep: str = "_", suffix: str = r"\w+") -> DataFrame:
    """Columns ``stub<sep>suffix`` to one row per suffix."""
    pattern = re.compile("^(" + "|".join(map(re.escape, stubs)) + ")" + re.escape(sep) + f"({suffix})$")
    found = [m for m in map(pattern.match, df.columns) if m]
    endings = sorted({m.group(2) for m in found})
    have = {m.group(0) for m in found}
    types = {s: df.schema[f"{s}{sep}{e}"].dataType for s in stubs for e in endings if f"{s}{sep}{e}" in have}

    def cell(stub: str, ending: str) -> Column:
        name = f"{stub}{sep}{ending}"
        return (F.col(name) if name in have else F.lit(None).cast(types[stub])).alias(stub)

    rows = [F.struct(F.lit(e).alias(j), *[cell(s, e) for s in stubs]) for e in endings]
    keep = [c for c in df.columns if c not in have]
    return df.select(*ids, *[c for c in keep if c not in ids], F.inline(F.array(*rows)))


def long_by_groups(df: DataFrame, groups: dict[str, list[str]], dropna: bool = True) -> DataFrame:
    """Lists of columns stacked side by side: ``{"value": ["a", "b"], "kind": ["c", "d"]}``."""
    width = len(next(iter(groups.values())))
    used = {c for cols in groups.values() for c in cols}
    rows = [F.struct(*[F.col(cols[i]).alias(n) for n, cols in groups.items()]) for i in range(width)]
    out = df.select(*[c for c in df.columns if c not in used], F.inline(F.array(*rows)))
    return out.dropna(subset=list(groups)) if dropna else out


def stack(df: DataFrame, ids: list[str], dropna: bool = True) -> DataFrame:
    out = df.unpivot(ids, [c for c in df.columns if c not in ids], "column", "value")
    return out.dropna(subset=["value"]) if dropna else out


def unstack(df: DataFrame, index: list[str], columns: str, cell: str, values: list, fill=None) -> DataFrame:
    out = df.groupBy(*index).pivot(columns, values).agg(F.first(cell))
    return out if fill is None else out.fillna(fill, subset=[str(v) for v in values])


def get_dummies(
    df: DataFrame, column: str, *, values: list | None = None, prefix: str | None = None, sep: str = "_", dummy_na: bool = False, drop_first: bool = False
) -> DataFrame:
    values = distinct_values(df, column) if values is None else values
    name = f"{column if prefix is None else prefix}{sep}"
    cells = [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{name}{v}") for v in values]
    if dummy_na:
        cells.append(F.col(column).isNull().cast("int").alias(f"{name}nan"))
    return df.select(*[c for c in df.columns if c != column], *cells[1 if drop_first else 0 :])


def from_dummies(df: DataFrame, columns: list[str], *, name: str, sep: str = "_", default: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Dummy columns back to one category, and the rows set aside: more than one
    mark, or none where no default is given."""
    marks = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    category = F.coalesce(*[F.when(F.col(c) == 1, F.lit(c.split(sep, 1)[1])) for c in columns], F.lit(default))
    rest = [c for c in df.columns if c not in columns]
    ok = (marks == 1) if default is None else (marks <= 1)
    return df.filter(ok).select(*rest, category.alias(name)), df.filter(~F.coalesce(ok, F.lit(False)))


def label_dummies(df: DataFrame, key: list[str], column: str, sep: str, labels: list[str] | None = None) -> DataFrame:
    """0/1 columns for the labels of a separated list."""
    if labels is None:
        labels = distinct_values(df.select(F.explode(F.split(column, re.escape(sep))).alias("l")).filter("l <> ''"), "l")
    parts = F.split(column, re.escape(sep))
    return df.select(*key, *[F.coalesce(F.array_contains(parts, x).cast("int"), F.lit(0)).alias(x) for x in labels])


def equal_width_edges(low: float, high: float, bins: int, right: bool = True) -> list[float]:
    """Edges over the range, widened by 0.1 % on the open side."""
    if low == high:
        pad = 0.001 * abs(low) if low else 0.001
        low, high = low - pad, high + pad
        return [low + (high - low) * i / bins for i in range(bins + 1)]
    edges = [low + (high - low) * i / bins for i in range(bins)] + [high]
    widen = (high - low) * 0.001
    if right:
        edges[0] -= widen
    else:
        edges[-1] += widen
    return edges


def cut_code(col: str, edges: list[float], *, right: bool = True, include_lowest: bool = False) -> Column:
    """0-based interval of a value, closed on the right or left; NULL outside."""
    edges = [float(e) for e in edges]
    code = edges_below(col, edges, strict=right) - 1
    if right and include_lowest:
        code = F.when(F.col(col) == edges[0], 0).otherwise(code)
    return F.when(code.between(0, len(edges) - 2) & F.col(col).isNotNull(), code).cast("int")


def cut(df: DataFrame, col: str, edges: list[float], name: str, *, right: bool = True, include_lowest: bool = False, labels: list[str] | None = None) -> DataFrame:
    code = cut_code(col, edges, right=right, include_lowest=include_lowest)
    if labels is None:
        return df.withColumn(name, code)
    return df.withColumn(name, F.get(F.array(*[F.lit(x) for x in labels]), code))


def cut_equal(df: DataFrame, col: str, bins: int, name: str, *, right: bool = True) -> DataFrame:
    """Equal-width intervals over the column's range."""
    row = df.agg(F.min(col).cast("double").alias("a"), F.max(col).cast("double").alias("b")).first()
    return cut(df, col, equal_width_edges(row["a"], row["b"], bins, right), name, right=right)


def qcut(df: DataFrame, col: str, q: int | list[float], name: str, *, duplicates: str = "raise") -> DataFrame:
    """Intervals with equal shares of the rows."""
    qs = [i / q for i in range(q + 1)] if isinstance(q, int) else list(q)
    row = quantiles(df, [], col, {f"q{i}": p for i, p in enumerate(qs)}).first()
    edges = list(row)
    unique = sorted(set(edges))
    if len(unique) < len(edges):
        if duplicates == "raise":
            raise ValueError("bin edges are not unique")
        edges = unique
    return cut(df, col, edges, name, include_lowest=True)


def concat_rows(frames: dict[str, DataFrame], *, join: str = "outer", key: str | None = None) -> DataFrame:
    """Rows of several tables; ``inner`` keeps the shared columns; ``key`` names the source."""
    parts = list(frames.items())
    if join == "inner":
        shared = [c for c in parts[0][1].columns if all(c in df.columns for _, df in parts)]
        parts = [(n, df.select(*shared)) for n, df in parts]
    if key:
        parts = [(n, df.withColumn(key, F.lit(n))) for n, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df for _, df in parts])


def concat_columns(frames: list[DataFrame], on: list[str], join: str = "outer") -> DataFrame:
    """Tables side by side by key."""
    return reduce(lambda a, b: hash_join(a, b, on, "full" if join == "outer" else "inner"), frames)


def normalise_json(
    df: DataFrame, column: str, schema: T.StructType, *, record_path: list[str], meta: list[list[str]], sep: str = "."
) -> DataFrame:
    """One row per record under ``record_path``, with values carried from the levels above."""
    parsed = df.select(*[c for c in df.columns if c != column], F.from_json(column, schema).alias("_j"))
    keep = [c for c in df.columns if c != column]
    carried = [F.col(".".join(["_j", *path])).alias(sep.join(path)) for path in meta]
    names = [sep.join(path) for path in meta]
    out = parsed.select(*keep, *carried, F.explode_outer(".".join(["_j", record_path[0]])).alias("_r"))
    for step in record_path[1:]:
        out = out.select(*keep, *[f"`{n}`" for n in names], F.explode_outer(f"_r.{step}").alias("_r"))
    return out.select(*keep, *[f"`{n}`" for n in names], "_r.*")


def explode_list(df: DataFrame, column: str) -> DataFrame:
    """One row per list item; an empty or missing list gives one row with NULL."""
    return df.withColumn(column, F.explode_outer(column))

