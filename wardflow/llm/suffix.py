"""Byte-level removal of repeated passages, by column-wise construction of a collection's Burrows-Wheeler transform.

Texts that share seeds meet in parts (see ``repeats``).  A part's stretches are put into one transform column by column, from
their last bytes on: each round inserts one byte of every stretch.  A round reads the transform and the common prefixes once, in order, and writes
both anew with the round's suffixes in their places.  A suffix's place is the rank of its byte in the transform so far; its common prefix
with the suffix before it is one more than the least between this and the last place of the same byte.  Windows are equal if no common
prefix between them is shorter than a window.  A part is bounded, so that its columns are arrays in memory in place of files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardflow.llm.common import batch
from wardflow.llm.repeats import HOT, SHARD_BYTES, Kind, Shard, covered, repeated, spans

WINDOW = 50
GRAM = 20
#: Bytes of a column.
WIDTH = 5
ROWS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
SCHEMA = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def byte_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 20 bytes from each place on."""
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    raw = b"".join(texts)
    n = max(0, len(raw) - GRAM + 1)
    eights = np.ndarray((max(0, len(raw) - 7),), np.uint64, raw, 0, (1,)) if len(raw) > 7 else np.zeros(0, np.uint64)
    h = eights[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += eights[8 : 8 + n]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += eights[GRAM - 8 : GRAM - 8 + n]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h, at


def byte_cutter(texts: list[bytes]):
    return lambda t, i, j: texts[t][i:j]


def least_between(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of x[a..b], both included; a <= b.  Each stretch is covered by two of a power of two."""
    level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    tables = np.empty((int(level.max()) + 1, len(x)), x.dtype)
    tables[0] = x
    for k in range(1, len(tables)):
        step = 1 << (k - 1)
        np.minimum(tables[k - 1, :-step], tables[k - 1, step:], out=tables[k, :-step])
    flat, row = tables.ravel(), level * len(x)
    return np.minimum(flat[row + a], flat[row + b + 1 - (1 << level)])


def transform(columns: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefixes of a collection of strings.

    ``columns[j]`` holds the symbol of each string j places before its last; symbols are over 0, which stands for a string's start.  The
    first rows are the empty suffixes, in the order of the strings; common prefixes never include an end.
    """
    strings = len(lens)
    bwt, lcp = np.zeros(strings, columns.dtype), np.zeros(strings, np.uint8 if len(columns) < 255 else np.int32)
    place = np.arange(strings)
    active = place
    for j, column in enumerate(columns):
        active = active[lens[active] > j]
        at = place[active]
        bwt[at] = column[active]
        n, more = len(bwt), len(active)
        order = np.argsort(bwt, kind="stable")
        body = order[strings - more :] if j == 0 else order[n - (n - strings + more) :]
        new, owner = np.zeros(n, bool), np.zeros(n, np.int32)
        new[at] = True
        owner[at] = active
        fresh = np.flatnonzero(new[body])
        spot = body[fresh]
        # Common prefix with the row before, for the new rows and those right after them.
        near = np.zeros(len(body) + 1, bool)
        near[fresh] = near[fresh + 1] = True
        rows = np.flatnonzero(near[:-1])
        here, before = body[rows], body[np.maximum(rows - 1, 0)]
        alike = (rows > 0) & (bwt[here] == bwt[before])
        common = np.zeros(len(rows), lcp.dtype)
        if alike.any():
            a, b = before[alike] + 1, here[alike]
            common[alike] = 1 + least_between(lcp, a, b)
        keep = np.ones(n + more, bool)
        keep[strings + fresh] = False
        wider = np.zeros(n + more, bwt.dtype)
        wider[keep] = bwt
        prefixes = np.zeros(n + more, lcp.dtype)
        prefixes[keep] = lcp
        prefixes[strings + rows] = common
        bwt, lcp = wider, prefixes
        place[owner[spot]] = strings + fresh
    return bwt, lcp


def symbols(raw: np.ndarray, width: int) -> np.ndarray:
    """For each place, the rank of the ``width`` bytes from it on among all such, from 1; the last places have none."""
    codes = np.zeros(max(0, len(raw) - width + 1), np.uint64)
    for i in range(width):
        codes = codes << np.uint64(8) | raw[i : i + len(codes)]
    used, ranks = np.unique(codes, return_inverse=True)
    return np.concatenate([ranks + 1, np.zeros(len(raw) - len(codes), np.int64)]).astype(np.uint8 if len(used) < 256 else np.uint16 if len(used) < 65536 else np.uint32)


def least_of_windows(strings: list[bytes], least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every string, the least value of a string that holds it; and where each string's windows start.

    A column is ``WIDTH`` bytes wide if that divides the window.  Then each string goes in once for each place modulo the width, and each
    window is a whole number of symbols of one of these.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    upto = np.concatenate([[0], np.cumsum(np.maximum(0, sizes - k + 1))]).astype(np.int64)
    if not upto[-1]:
        return np.zeros(0, np.int64), upto
    width = WIDTH if k % WIDTH == 0 else 1
    symbol = symbols(np.frombuffer(b"".join(strings), np.uint8), width)
    phase = np.tile(np.arange(width), len(sizes))
    of = np.repeat(np.arange(len(sizes)), width)
    first = (np.cumsum(sizes) - sizes)[of] + phase
    lens = np.maximum(0, (sizes[of] - phase) // width)
    columns = np.zeros((int(lens.max()), len(lens)), symbol.dtype)
    for j in range(len(columns)):
        has = np.flatnonzero(lens > j)
        columns[j, has] = symbol[first[has] + width * (lens[has] - 1 - j)]
    bwt, lcp = transform(columns, lens)
    group = np.cumsum(lcp < k // width)
    # Follow each string from its empty suffix to longer ones, and note the group of each of its windows.
    order = np.argsort(bwt, kind="stable")
    zeros = int(np.count_nonzero(bwt == 0))
    to = np.zeros(len(bwt), np.int64)
    to[order[zeros:]] = len(lens) + np.arange(len(bwt) - zeros)
    place, active = np.arange(len(lens)), np.arange(len(lens))
    groups = np.zeros(upto[-1], np.int64)
    for j in range(1, len(columns) + 1):
        active = active[lens[active] >= j]
        place[active] = to[place[active]]
        if j >= k // width:
            groups[upto[of[active]] + phase[active] + width * (lens[active] - j)] = group[place[active]]
    best = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(best, groups, np.repeat(least, np.diff(upto)))
    return best[groups], upto


def byte_kind(window: int = WINDOW) -> Kind:
    return Kind(window, GRAM, bytes, byte_grams, byte_cutter, least_of_windows, 16)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """Every row without the bytes that a string of ``window`` bytes covers which also starts in a document with a smaller id.

    Strings are judged on the input; they may overlap, and never cross documents.  A null or empty text has no bytes.  Rows of equal id do not
    count against each other; a row without an id keeps all and counts against none.  ``spans`` are the removed runs, ``kept`` the bytes that are left, which may
    cut a character.  An empty table gives no rows.  ``window`` is at least 20.
    """
    kind = byte_kind(window)

    def finish(shard: Shard, told: pa.Table) -> pa.Table:
        rows = []
        for i, v, t, inside in zip(shard.ids.tolist(), shard.valid.tolist(), shard.texts, covered(shard, told, kind, [len(t) for t in shard.texts])):
            kept = np.frombuffer(t, np.uint8)[~inside].tobytes() if inside.any() else t
            rows.append((i if v else None, len(t), len(t) - len(kept), spans(inside), kept))
        return pa.Table.from_batches([batch(ROWS, *zip(*rows))])

    return repeated(docs, kind, finish, SCHEMA, id_col, text_col, shard_bytes, hot)
