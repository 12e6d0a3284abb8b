"""Spans of kinds in texts: byte offsets to code points, rows, digests."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SPANS = "spans array<struct<kind: string, start: long, end: long>>"
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
Span = tuple[int, int, str]  # start, end, kind


def ordered(text: bytes, found: list[Span], kinds: list[str]) -> list[dict]:
    """Spans with offsets in code points, by start and then kind as listed."""
    found = sorted(found, key=lambda s: (s[0], kinds.index(s[2]), s[1]))
    if found and not text.isascii():
        upto = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
        return [{"kind": k, "start": int(upto[a]), "end": int(upto[b])} for a, b, k in found]
    return [{"kind": k, "start": a, "end": b} for a, b, k in found]


def listed(spans: str | Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(spans: str | Column, kinds: list[str]) -> Column:
    """SHA-256 of the spans of some kinds, listed."""
    return F.sha2(listed(F.filter(spans, lambda s: s["kind"].isin(kinds))).cast("binary"), 256)


def count(spans: str | Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
