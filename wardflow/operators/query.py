"""Filters, order and changes on a table by method chains."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.merge import all_of, any_of, delete_where, insert_ignore, update_where, upsert


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Array containment


def contains(c, items) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(i) for i in items]), _col(c))) == 0


def contained_by(c, items) -> Column:
    return F.size(F.array_except(_col(c), F.array(*[F.lit(i) for i in items]))) == 0


def overlaps(c, items) -> Column:
    return F.arrays_overlap(_col(c), F.array(*[F.lit(i) for i in items]))


def json_contains(c, values: dict, path: str = "$") -> Column:
    """A JSON object text that has these members, of the same kind; members of a member are compared one by one, lists by what they hold."""
    text = _col(c)

    def one(k: str, v) -> Column:
        found = F.get_json_object(text, f"{path}.{k}")
        if isinstance(v, dict):
            return json_contains(c, v, f"{path}.{k}")
        if isinstance(v, (list, tuple)):
            held = F.from_json(found, "array<string>")
            return F.coalesce(F.size(F.array_except(F.array(*[F.lit(_json_text(x)) for x in v]).cast("array<string>"), held)) == 0, F.lit(False))
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return F.coalesce(found.try_cast("double") == F.lit(float(v)), F.lit(False))
        return found == F.lit(_json_text(v))

    return all_of([one(k, v) for k, v in values.items()])


def _json_text(v) -> str:
    return v if isinstance(v, str) else json.dumps(v)


# Ranges are structs ``lo, hi`` with the low end included and the high end not.


def strictly_left(c, lo, hi) -> Column:
    return _col(c)["hi"] <= F.lit(lo)


def strictly_right(c, lo, hi) -> Column:
    return _col(c)["lo"] >= F.lit(hi)


def not_extending_left(c, lo, hi) -> Column:
    return _col(c)["lo"] >= F.lit(lo)


def not_extending_right(c, lo, hi) -> Column:
    return _col(c)["hi"] <= F.lit(hi)


def adjacent(c, lo, hi) -> Column:
    return (_col(c)["hi"] == F.lit(lo)) | (_col(c)["lo"] == F.lit(hi))


def range_overlaps(c, lo, hi) -> Column:
    return (_col(c)["lo"] < F.lit(hi)) & (_col(c)["hi"] > F.lit(lo))


# Text search.  A text is its lower-case words; there is no stemming.


def _has(c, phrase: str) -> Column:
    """The words one after another, as whole words; stops at the first place found."""
    words = [re.escape(w) for w in re.split(r"[\W_]+", phrase.lower()) if w]
    sign = r"[\p{L}\p{N}]"
    between = r"[^\p{L}\p{N}]+"
    return F.lower(_col(c)).rlike(f"(?<!{sign})" + between.join(words) + f"(?!{sign})")


def search_plain(c, text: str) -> Column:
    """All words, in any order."""
    return all_of([_has(c, w) for w in text.split()])


def search_phrase(c, text: str) -> Column:
    return _has(c, text)


def search_web(c, required: list[str] = (), excluded: list[str] = (), any_group: list[str] = ()) -> Column:
    """Words or phrases that must be there, must not, and of which one must."""
    out = all_of([_has(c, p) for p in required] + [~_has(c, p) for p in excluded])
    return out & any_of([_has(c, p) for p in any_group]) if any_group else out


WEB = re.compile(r'\s*(-?)(?:"([^"]*)"?|([^\s"]+))')


def search_web_text(c, text: str) -> Column:
    """A search as typed into a web page: words and "quoted phrases" that must be there, ``-`` before what must not, and ``or`` between alternatives, which binds least.

    Anything is understood: a quotation mark may be missing, and what has no letter or digit asks for nothing. A text that asks for nothing finds nothing.
    """
    groups: list[list[Column]] = [[]]
    for minus, phrase, word in WEB.findall(text):
        if word.lower() == "or" and not minus:
            groups.append([])
        elif re.search(r"[^\W_]", phrase or word):
            found = _has(c, phrase or word)
            groups[-1].append(~found if minus else found)
    return any_of([all_of(g) for g in groups if g])


RAW = re.compile(r"\s*(<->|<(\d+)>|[&|!()]|([^\W_]+)(:\*)?)", re.UNICODE)


def _raw_tree(text: str) -> tuple:
    """The tree of a raw search text: ("word", w, is_prefix), ("not", x), ("near", x, n, y), ("and", x, y), ("or", x, y)."""
    parts, at = [], 0
    while at < len(text.rstrip()):
        m = RAW.match(text, at)
        if not m:
            raise ValueError(f"search text: {text[at:].strip()!r} is not understood")
        parts.append(m)
        at = m.end()

    def ahead() -> str:
        return parts[0][1] if parts else ""

    def single() -> tuple:
        m = parts.pop(0) if parts else None
        if m and m[1] == "!":
            return ("not", single())
        if m and m[1] == "(":
            tree = either()
            if ahead() != ")":
                raise ValueError("search text: a bracket is not closed")
            parts.pop(0)
            return tree
        if not m or not m[3]:
            raise ValueError(f"search text: a word is missing {'before ' + m[1] if m else 'at the end'}")
        return ("word", m[3].lower(), bool(m[4]))

    def near() -> tuple:
        tree = single()
        while ahead().startswith("<"):
            step = parts.pop(0)[2]
            tree = ("near", tree, 1 if step is None else int(step), single())
        return tree

    def both() -> tuple:
        tree = near()
        while ahead() == "&":
            parts.pop(0)
            tree = ("and", tree, near())
        return tree

    def either() -> tuple:
        tree = both()
        while ahead() == "|":
            parts.pop(0)
            tree = ("or", tree, both())
        return tree

    tree = either()
    if parts:
        raise ValueError(f"search text: an operator is missing before {ahead()!r}")
    return tree


def _hit(tree: tuple, word: Column) -> Column:
    """Whether a word is the one of a leaf; False beyond the ends of a text."""
    return F.coalesce(F.startswith(word, F.lit(tree[1])) if tree[2] else word == tree[1], F.lit(False))


def _spans(tree: tuple, words: Column, at: Column, onward: bool) -> Column:
    """The other ends of a part's matches that begin at a place (``onward``) or end there.

    Only the words around the place are looked at, so that a text costs a step for each word, however often the parts occur in it.
    """
    kind = tree[0]
    nothing = F.array().cast("array<int>")
    if kind == "word":
        return F.when(_hit(tree, F.get(words, at)), F.array(at)).otherwise(nothing)
    if kind == "or":
        return F.array_union(_spans(tree[1], words, at, onward), _spans(tree[2], words, at, onward))
    if kind == "and":
        return F.array_intersect(_spans(tree[1], words, at, onward), _spans(tree[2], words, at, onward))
    if kind == "near":
        _, x, n, y = tree
        if x[0] == y[0] == "not":
            raise ValueError("search text: of two neighbours only one may be negated")
        near, far, step = (x, y, n) if onward else (y, x, -n)
        if near[0] == "not":  # the match is the other part's alone
            clear = ~_touches(near[1], words, at - step, not onward)
            return F.when(clear, _spans(far, words, at, onward)).otherwise(nothing)
        if far[0] == "not":
            return F.filter(_spans(near, words, at, onward), lambda end: ~_touches(far[1], words, end + step, onward))
        return F.array_distinct(F.flatten(F.transform(_spans(near, words, at, onward), lambda end: _spans(far, words, end + step, onward))))
    raise ValueError("search text: a negated part stands alone beside a distance")


def _touches(tree: tuple, words: Column, at: Column, onward: bool) -> Column:
    """Whether any match of a part begins (``onward``) or ends at a place."""
    if tree[0] == "word":
        return _hit(tree, F.get(words, at))
    if tree[0] == "or":
        return _touches(tree[1], words, at, onward) | _touches(tree[2], words, at, onward)
    return F.size(_spans(tree, words, at, onward)) > 0


def _holds(tree: tuple, words: Column) -> Column:
    kind = tree[0]
    if kind == "word":
        return F.exists(words, lambda w: F.startswith(w, F.lit(tree[1]))) if tree[2] else F.array_contains(words, tree[1])
    if kind == "not":
        return ~_holds(tree[1], words)
    if kind == "near":
        return F.size(F.filter(words, lambda w, i: _touches(tree, words, i, True))) > 0
    x, y = _holds(tree[1], words), _holds(tree[2], words)
    return x & y if kind == "and" else x | y


def search_raw(c, text: str) -> Column:
    """A search text with operators: ``!`` not, ``<->`` directly followed by, ``<n>`` followed n words later, ``&`` and, ``|`` or, in falling order of strength, and brackets; ``word:*`` is a beginning.

    Around a distance may stand words, brackets of words and further distances; ``!x <-> y`` is a y without an x before it.  NULL for a NULL text; a text that is not understood is an error.
    """
    tree = _raw_tree(text)
    words = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    # The words are found once, however often the search names them.
    return F.get(F.transform(F.array(words), lambda w: _holds(tree, w)), F.lit(0))


class TableQuery:
    """A chain of filters, order and paging over a table; ``df`` is the result.

    >>> TableQuery(orders).select("o_orderkey").eq("o_orderstatus", "F").order("o_orderkey").limit(5).df
    """

    def __init__(self, df: DataFrame, negate: bool = False):
        self.df, self._negate = df, negate

    def where(self, condition: Column) -> "TableQuery":
        return TableQuery(self.df.filter(~condition if self._negate else condition))

    @property
    def not_(self) -> "TableQuery":
        """Negates the filter that follows."""
        return TableQuery(self.df, not self._negate)

    def select(self, *columns: str) -> "TableQuery":
        return TableQuery(self.df.select(*columns))

    def eq(self, c, v):
        return self.where(_col(c) == F.lit(v))

    def neq(self, c, v):
        return self.where(_col(c) != F.lit(v))

    def gt(self, c, v):
        return self.where(_col(c) > F.lit(v))

    def gte(self, c, v):
        return self.where(_col(c) >= F.lit(v))

    def lt(self, c, v):
        return self.where(_col(c) < F.lit(v))

    def lte(self, c, v):
        return self.where(_col(c) <= F.lit(v))

    def is_(self, c, v):
        """NULL, True or False; never unknown itself."""
        return self.where(_col(c).isNull() if v is None else _col(c).eqNullSafe(F.lit(v)))

    def in_(self, c, values):
        return self.where(_col(c).isin(list(values)))

    def like(self, c, pattern):
        return self.where(_col(c).like(pattern))

    def ilike(self, c, pattern):
        return self.where(_col(c).ilike(pattern))

    def like_all_of(self, c, patterns):
        return self.where(all_of([_col(c).like(p) for p in patterns]))

    def like_any_of(self, c, patterns):
        return self.where(any_of([_col(c).like(p) for p in patterns]))

    def ilike_all_of(self, c, patterns):
        return self.where(all_of([_col(c).ilike(p) for p in patterns]))

    def ilike_any_of(self, c, patterns):
        return self.where(any_of([_col(c).ilike(p) for p in patterns]))

    def or_(self, *conditions: Column):
        return self.where(any_of(list(conditions)))

    def plfts(self, c, text):
        return self.where(search_plain(c, text))

    def phfts(self, c, text):
        return self.where(search_phrase(c, text))

    def wfts(self, c, text):
        return self.where(search_web_text(c, text))

    def fts(self, c, text):
        return self.where(search_raw(c, text))

    def match(self, values: dict):
        return self.where(all_of([_col(k) == F.lit(v) for k, v in values.items()]))

    def order(self, *columns: str, desc: bool = False, nulls_first: bool | None = None) -> "TableQuery":
        """NULLs come last when ascending and first when descending, unless told."""
        first = desc if nulls_first is None else nulls_first

        def one(c: str) -> Column:
            col = F.col(c)
            if desc:
                return col.desc_nulls_first() if first else col.desc_nulls_last()
            return col.asc_nulls_first() if first else col.asc_nulls_last()

        return TableQuery(self.df.orderBy(*[one(c) for c in columns]))

    def limit(self, n: int) -> "TableQuery":
        return TableQuery(self.df.limit(n))

    def range(self, start: int, end: int) -> "TableQuery":
        """Rows start..end, both included."""
        return TableQuery(self.df.offset(start).limit(end - start + 1))

    def count(self) -> int:
        return self.df.count()

    def estimated_count(self, fraction: float = 0.01) -> int:
        """From the rows whose hash falls into a share of all; the same however the rows are dealt, and no shuffle.

        Equal rows are taken or left together.
        """
        scale = 1_000_000
        kept = self.df.filter(F.pmod(F.xxhash64(*self.df.columns), F.lit(scale)) < round(fraction * scale))
        return round(kept.count() / fraction)

    def planned_count(self) -> int | None:
        """Spark's own estimate, if the plan has one; reads no data."""
        rows = self.df._jdf.queryExecution().optimizedPlan().stats().rowCount()
        return int(rows.get().toString()) if rows.isDefined() else None

    def single(self) -> DataFrame:
        """The one row; none or several are an error."""
        found = self.df.limit(2).count()
        if found != 1:
            raise ValueError(f"expected one row, found {'none' if found == 0 else 'several'}")
        return self.df.limit(1)

    def maybe_single(self) -> DataFrame:
        """At most one row; several are an error."""
        if self.df.limit(2).count() > 1:
            raise ValueError("expected at most one row, found several")
        return self.df.limit(1)


def insert(target: DataFrame, rows: DataFrame, *, default_to_null: bool = True, defaults: dict | None = None) -> DataFrame:
    """Append rows; columns they lack are NULL or the given default."""
    for name, value in ({} if default_to_null else defaults or {}).items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(value))
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def upsert_rows(target: DataFrame, rows: DataFrame, *, on_conflict: list[str], version: list[str], ignore_duplicates: bool = False) -> DataFrame:
    if ignore_duplicates:
        return insert_ignore(target, rows, keys=on_conflict, version=version)
    return upsert(target, rows, keys=on_conflict, version=version)


def update(target: DataFrame, where: Column, **values: Column) -> DataFrame:
    return update_where(target, where, values)


def delete(target: DataFrame, where: Column) -> DataFrame:
    return delete_where(target, where)

