"""Statistics of many overlapping frames of one block of rows, in numpy.

A frame is a range of places.  Nothing is ever subtracted: a frame is put together from two pieces that lie wholly inside it, so one huge value or a
NaN is felt only by the frames that hold it.

* Sums, extremes and moments: a disjoint sparse table.  Places are halved again and again; at the level where a frame's two ends part it is a
  suffix of the left half and a prefix of the right, both accumulated outwards from the middle.
* Quantiles and ranks: a wavelet matrix over the places' ranks by value.  A frame is a difference of two counts at each bit.

Blocks come from ``row_frame`` and ``time_frame``, which bound them.  The module is sent to executors by value.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOMENTS = ("mean", "var", "std", "sem", "skew", "kurt")
PLAIN = ("sum", "min", "max")
ORDERED = ("quantile", "rank")


def _pieces(v: np.ndarray, a: np.ndarray, b: np.ndarray):
    """For each level: the frames whose ends part there, the halves as rows, where a frame's left piece begins and its right piece ends in them."""
    level = np.frexp((a ^ (b - 1)).astype(float))[1] - 1
    for j in np.unique(level[b - a > 1]):
        at = np.flatnonzero((level == j) & (b - a > 1))
        half = 1 << int(j)
        width = 2 * half
        padded = np.concatenate([v, np.zeros(-len(v) % width, v.dtype)]).reshape(-1, 2, half)
        yield at, padded[:, 0, ::-1], padded[:, 1], a[at] // width, half - 1 - a[at] % width, (b[at] - 1) % width - half


def folded(v: np.ndarray, a: np.ndarray, b: np.ndarray, fold: np.ufunc) -> np.ndarray:
    """The values of each frame folded by a ufunc; a frame without values gives what ``v`` holds for none (callers mask it)."""
    out = np.zeros(len(a), v.dtype)
    single = b - a == 1
    out[single] = v[a[single]]
    for at, left, right, row, i, k in _pieces(v, a, b):
        out[at] = fold(fold.accumulate(left, axis=1)[row, i], fold.accumulate(right, axis=1)[row, k])
    return out


def moments(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean and the sums of second to fourth powers about it, of each frame."""
    mean, m2, m3, m4 = (np.zeros(len(a)) for _ in range(4))
    single = b - a == 1
    mean[single] = v[a[single]]
    m2[single] = m3[single] = m4[single] = np.where(np.isfinite(mean[single]), 0.0, np.nan)

    def piece(half: np.ndarray, row: np.ndarray, i: np.ndarray):
        # About the value next to the middle, which every piece holds.
        shift = half[:, :1]
        d = half - shift
        n = i + 1.0
        p1, p2, p3, p4 = (np.add.accumulate(d**k, axis=1)[row, i] for k in (1, 2, 3, 4))
        c = p1 / n
        return n, shift[row, 0] + c, np.maximum(p2 - p1 * c, 0), p3 - 3 * c * p2 + 2 * p1 * c**2, p4 - 4 * c * p3 + 6 * c**2 * p2 - 3 * p1 * c**3

    for at, left, right, row, i, k in _pieces(v, a, b):
        nl, ml, l2, l3, l4 = piece(left, row, i)
        nr, mr, r2, r3, r4 = piece(right, row, k)
        n, d = nl + nr, mr - ml
        mean[at] = ml + d * nr / n
        m2[at] = l2 + r2 + d**2 * nl * nr / n
        m3[at] = l3 + r3 + d**3 * nl * nr * (nl - nr) / n**2 + 3 * d * (nl * r2 - nr * l2) / n
        m4[at] = l4 + r4 + d**4 * nl * nr * (nl**2 - nl * nr + nr**2) / n**3 + 6 * d**2 * (nl**2 * r2 + nr**2 * l2) / n**2 + 4 * d * (nl * r3 - nr * l3) / n
    return mean, m2, m3, m4


class Wavelet:
    """Values by place, as one bit level after the other of their ranks."""

    def __init__(self, v: np.ndarray):
        order = np.argsort(v, kind="stable")
        self.sorted = v[order]
        codes = np.empty(len(v), np.int64)
        codes[order] = np.arange(len(v))
        self.bits = max(1, int(len(v) - 1).bit_length())
        self.zeros, self.ones_from = [], []
        for bit in reversed(range(self.bits)):
            zero = (codes >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]))
            self.ones_from.append(int(zero.sum()))
            codes = np.concatenate([codes[zero], codes[~zero]])

    def smallest(self, a: np.ndarray, b: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value, from 0, of each range of places."""
        a, b, k = a.copy(), b.copy(), k.copy()
        code = np.zeros(len(a), np.int64)
        for zeros, ones in zip(self.zeros, self.ones_from):
            za, zb = zeros[a], zeros[b]
            up = k >= zb - za
            k -= np.where(up, zb - za, 0)
            a, b = np.where(up, ones + a - za, za), np.where(up, ones + b - zb, zb)
            code = 2 * code + up
        return self.sorted[np.minimum(code, len(self.sorted) - 1)]

    def below(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many places of each range have a rank below the limit."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for i, (zeros, ones) in enumerate(zip(self.zeros, self.ones_from)):
            za, zb = zeros[a], zeros[b]
            up = (limit >> (self.bits - 1 - i)) & 1 == 1
            out += np.where(up, zb - za, 0)
            a, b = np.where(up, ones + a - za, za), np.where(up, ones + b - zb, zb)
        # A limit above all ranks does not fit into the bits.
        return out


def statistic(name: str, q: float | None, v: np.ndarray, real: np.ndarray, a: np.ndarray, b: np.ndarray, own: np.ndarray, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """A statistic of each frame [a, b) of the values, and where it has none; ``own`` is the place of the row's own value, -1 if null."""
    n = (b - a).astype(float)
    empty = b <= a
    if name == "count":
        return b - a, np.zeros(len(a), bool)
    if not len(v):
        return np.zeros(len(a), v.dtype if name in PLAIN else float), np.ones(len(a), bool)
    with np.errstate(all="ignore"):
        if name in PLAIN:
            return folded(v, a, b, {"sum": np.add, "min": np.fmin, "max": np.maximum}[name]), empty
        if name == "mean":
            return folded(real, a, b, np.add) / n, empty
        if name in MOMENTS:
            if "moments" not in cache:
                cache["moments"] = moments(real, a, b)
            _, m2, m3, m4 = cache["moments"]
            if name in ("var", "std", "sem"):
                out = m2 / (n - 1)
                out = out if name == "var" else np.sqrt(out) if name == "std" else np.sqrt(out / (n - 1))
                return out, n < 2
            if name == "skew":
                return np.sqrt(n) * m3 / m2**1.5 * np.sqrt(n * (n - 1)) / (n - 2), (n < 3) | (m2 == 0)
            return ((n + 1) * (n * m4 / m2**2 - 3) + 6) * (n - 1) / ((n - 2) * (n - 3)), (n < 4) | (m2 == 0)
        if "wavelet" not in cache:
            cache["wavelet"] = Wavelet(real)
        wavelet = cache["wavelet"]
        if name == "quantile":
            at = np.maximum(n - 1, 0) * q
            low = np.floor(at).astype(np.int64)
            first, share = wavelet.smallest(a, b, low), at - low
            after = wavelet.smallest(a, b, np.minimum(low + 1, np.maximum(b - a - 1, 0)))
            return np.where((share == 0) | (first == after), first, first * (1 - share) + after * share), empty
        x = real[np.maximum(own, 0)]
        upto = [np.searchsorted(wavelet.sorted, x, side) for side in ("left", "right")]
        less, also = (np.where(u >= len(real), b - a, wavelet.below(a, b, u)) for u in upto)
        return less + (also - less + 1) / 2, (own < 0) | empty


#: Rows whose frames are computed at once; blocks are not cut.
AT_ONCE = 1 << 17


def _time_ranges(spot: np.ndarray, start: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Frames by time, of blocks that begin at the given places."""
    size = np.diff(np.append(start, len(spot)))
    inside = spot - np.repeat(spot[start], size)
    stride = int(inside.max(initial=0)) + abs(low) + abs(high) + 2
    if stride * len(start) >= 1 << 62:
        parts = [_time_ranges(spot[i : i + n], np.zeros(1, np.int64), low, high) for i, n in zip(start, size)]
        return tuple(np.concatenate([p[k] + i for p, i in zip(parts, start)]) for k in (0, 1))
    # One line of time, a block after the other, too far apart for a frame to reach the next.
    line = inside + stride * np.repeat(np.arange(len(start)), size)
    return np.searchsorted(line, line + low, "left"), np.searchsorted(line, line + high, "right")


def block_statistics(col: str, at: str, number: str, wanted: list[tuple[str, str, float | None]], low: int, high: int, by_rows: bool, least: int, schema: pa.Schema):
    """A function of Arrow batches that adds the wanted statistics (name, kind, share) of frames from ``low`` to ``high`` about each row's ``at``.

    Rows come block after block, numbered from 1 in each, in the order of ``at``: a position without gaps, or a time.  Rows of equal time see
    each other, and rows without a time all of their kind.  Several blocks are taken together, but one block is never cut.
    """

    def added(table: pa.Table) -> pa.Table:
        start = np.flatnonzero(table.column(number).to_numpy() == 1)
        size = np.diff(np.append(start, table.num_rows))
        begin, stop = np.repeat(start, size), np.repeat(start + size, size)
        if by_rows:
            places = np.arange(table.num_rows)
            first, end = np.maximum(places + low, begin), np.minimum(places + high + 1, stop)
        else:
            moments_of = table.column(at).combine_chunks()
            first, end = _time_ranges(moments_of.fill_null(0).to_numpy(), start, low, high)
            timeless = ~moments_of.is_valid().to_numpy(zero_copy_only=False)
            first, end = np.where(timeless, begin, first), np.where(timeless, stop, end)
        end = np.maximum(first, end)
        values = table.column(col).combine_chunks()
        there = values.is_valid().to_numpy(zero_copy_only=False)
        v = values.drop_null().to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(there)])
        a, b = upto[first], upto[end]
        v = v.astype(np.int64) if pa.types.is_integer(values.type) else v.astype(np.float64)
        real, own, cache = v.astype(np.float64), np.where(there, upto[:-1], -1), {}
        table = table.drop_columns([number])
        for name, kind, q in wanted:
            out, none = statistic(kind, q, v, real, a, b, own, cache)
            table = table.append_column(name, pa.array(out, mask=none | (b - a < least)).cast(schema.field(name).type))
        return table

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if rows >= AT_ONCE:
                # Up to the last block that begins in this batch.
                begins = np.flatnonzero(batch.column(batch.schema.get_field_index(number)).to_numpy() == 1)
                if len(begins):
                    yield from added(pa.Table.from_batches([*held, batch.slice(0, begins[-1])])).to_batches()
                    held, rows, batch = [], 0, batch.slice(begins[-1])
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield from added(pa.Table.from_batches(held)).to_batches()

    return run
