"""Secret scans through a trigram index.

Each rule's regex is turned into a Boolean query over trigrams that any match must hold.  A shard of texts is
indexed once: for every trigram that some rule asks for, the postings are the texts that hold it.  A rule's
candidates are intersections and unions of postings; only these are searched with the regex.  A rule that demands no
trigram, as a bare run of characters, scans all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op, _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardflow.llm.common import batch, column, flat, pieces, text_bytes, two
from wardflow.llm.spans import ARROW as SPAN_LIST, SPANS, ordered

#: Strings kept for one stretch of a regex before its trigrams are taken.
MOST_STRINGS = 64
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint32)
ARROW = pa.schema([("doc_id", pa.int64()), ("spans", SPAN_LIST)])


@dataclass
class Rule:
    """``group`` of a match of ``pattern`` needs ``least`` bytes; a match that fails is dropped and not tried again."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


#: The three base rules, and public formats of common tokens.
RULES = [
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12, 1),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
]
BASE = ["assign", "access", "hex"]

# A query is True, a trigram's code, or ("all" | "any", queries).


def both(kind: str, parts: list):
    parts = [p for p in parts if p is not True] if kind == "all" else parts
    if not parts:
        return True
    if kind == "any" and any(p is True for p in parts):
        return True
    return parts[0] if len(parts) == 1 else (kind, parts)


def of_strings(strings: set[bytes]):
    """Any of the strings, each as all of its trigrams."""
    return both("any", [both("all", [s[i] << 16 | s[i + 1] << 8 | s[i + 2] for i in range(len(s) - 2)]) for s in sorted(strings)])


def characters(items) -> set[bytes] | None:
    """The lower-cased characters of a small class."""
    out: set[int] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(value)
        elif kind is op.RANGE and value[1] - value[0] < 16:
            out.update(range(value[0], value[1] + 1))
        else:
            return None
    return {bytes([LOWER[c]]) for c in out} if len(out) <= 16 else None


def sequence(tree) -> tuple[set[bytes] | None, object]:
    """All strings that a sequence matches, if they are few, and the trigrams that every match needs."""
    now, needs, exact = {b""}, [], True
    for node in tree:
        strings, need = part(node)
        if strings is not None and len(now) * len(strings) <= MOST_STRINGS:
            now = {a + b for a in now for b in strings}
            continue
        needs += [of_strings(now), need if strings is None else of_strings(strings)]
        now, exact = {b""}, False
    if exact:
        return now, of_strings(now)
    return None, both("all", [*needs, of_strings(now)])


def part(node) -> tuple[set[bytes] | None, object]:
    kind, value = node
    if kind is op.LITERAL:
        return {bytes([LOWER[value]])}, True
    if kind is op.IN:
        return characters(value), True
    if kind is op.SUBPATTERN:
        return sequence(value[3])
    if kind is op.BRANCH:
        ways = [sequence(w) for w in value[1]]
        if all(s is not None for s, _ in ways) and len(union := set().union(*(s for s, _ in ways))) <= MOST_STRINGS:
            return union, of_strings(union)
        return None, both("any", [n for _, n in ways])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, need = sequence(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {b""}, True
        return None, need if least else True
    if kind is op.AT:
        return {b""}, True
    return None, True


def trigram_query(pattern: str):
    """Trigrams, lower-cased, that every match of a regex over bytes holds."""
    return sequence(parser.parse(pattern.encode()))[1]


def codes(query) -> set[int]:
    return set() if query is True else set().union(*map(codes, query[1])) if isinstance(query, tuple) else {query}


class Index:
    """Postings of some trigrams in one shard of texts: for each, the sorted numbers of the texts that hold it."""

    def __init__(self, texts: pa.Array, wanted: np.ndarray):
        raw, at = flat(texts)
        self.n, low = len(at) - 1, LOWER[raw]
        grams = low[:-2] << 16 | low[1:-1] << 8 | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        place = np.flatnonzero(wanted[grams])
        text = np.searchsorted(at, place, "right") - 1
        inside = place + 2 < at[text + 1]
        pairs = np.unique(grams[place][inside].astype(np.int64) << 32 | text[inside])
        self.pairs = pairs

    def postings(self, code: int) -> np.ndarray:
        a, b = np.searchsorted(self.pairs, [code << 32, (code + 1) << 32])
        return self.pairs[a:b] & 0xFFFFFFFF

    def candidates(self, query) -> np.ndarray:
        if query is True:
            return np.arange(self.n)
        if not isinstance(query, tuple):
            return self.postings(query)
        found = [self.candidates(q) for q in query[1]]
        if query[0] == "any":
            return np.unique(np.concatenate(found))
        out = min(found, key=len)
        for x in found:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


def secrets(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the secrets of every row, in code points with exclusive ends, by start and then rule as listed.

    Matches of one rule are leftmost and do not overlap; those of different rules may.  A null or empty text has none.
    Repeated rows and null ids are answered row by row; there is no shuffle.
    """
    fields = [(r.kind, r.pattern, r.least, r.group, trigram_query(r.pattern)) for r in (rules or RULES)]

    def run(batches):
        kinds = [f[0] for f in fields]
        compiled = [(k, re.compile(p.encode()), least, group, query) for k, p, least, group, query in fields]
        wanted = np.zeros(1 << 24, bool)
        wanted[[c for f in fields for c in codes(f[4])]] = True
        for b in pieces(batches):
            texts = column(b, "text")
            index, raw = Index(texts, wanted), text_bytes(texts)
            found: list[list] = [[] for _ in raw]
            for kind, regex, least, group, query in compiled:
                for i in index.candidates(query).tolist():
                    found[i] += [(*m.span(), kind) for m in regex.finditer(raw[i]) if len(m[group]) >= least]
            yield batch(ARROW, column(b, "doc_id"), [ordered(t, f, kinds) for t, f in zip(raw, found)])

    return two(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {SPANS}")
