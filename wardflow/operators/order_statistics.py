"""Order statistics of all rows so far, for blocks of rows at a time.

The module is sent to executors by value.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Prefixes:
    """Weighted codes in order, asked about the first of them: a wavelet matrix, with a level per bit of the codes."""

    def __init__(self, code: np.ndarray, weight: np.ndarray):
        self.levels = []
        for bit in reversed(range(max(int(code.max(initial=0)), 1).bit_length())):
            zero = (code >> bit) & 1 == 0
            self.levels.append((bit, np.append(0, np.cumsum(zero)), np.append(0, np.cumsum(np.where(zero, weight, 0)))))
            order = np.append(np.flatnonzero(zero), np.flatnonzero(~zero))
            code, weight = code[order], weight[order]
        self.weight = np.append(0, np.cumsum(weight))

    def kth(self, upto: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The code at weight k, from 0, among the first ``upto`` in the order of codes."""
        low, high, found = np.zeros_like(upto), upto, np.zeros_like(upto)
        for bit, place, heavy in self.levels:
            zeros = heavy[high] - heavy[low]
            right = k >= zeros
            k = np.where(right, k - zeros, k)
            found += right.astype(np.int64) << bit
            low, high = (np.where(right, place[-1] + x - place[x], place[x]) for x in (low, high))
        return found

    def below(self, upto: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight of smaller codes, and of the same one, among the first ``upto``."""
        low, high, less = np.zeros_like(upto), upto, np.zeros_like(upto)
        for bit, place, heavy in self.levels:
            right = (code >> bit) & 1 == 1
            less += np.where(right, heavy[high] - heavy[low], 0)
            low, high = (np.where(right, place[-1] + x - place[x], place[x]) for x in (low, high))
        return less, self.weight[high] - self.weight[low]


def _numbered(parts: list[pa.Table], names: list[str]) -> np.ndarray:
    """A number per row that is the same for the same values; NULL equals NULL."""
    number = np.zeros(sum(p.num_rows for p in parts), np.int64)
    for name in names:
        cells = pa.chunked_array([c for p in parts for c in p[name].chunks], parts[0][name].type).combine_chunks()
        number = number * (len(cells) + 1) + cells.dictionary_encode(null_encoding="encode").indices.to_numpy()
        number = np.unique(number, return_inverse=True)[1]
    return number


def _plain(table: pa.Table, name: str) -> np.ndarray:
    return table[name].fill_null(0).to_numpy()


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a sorted column has another value than before; NaN equals NaN."""
    return np.append(True, (x[1:] != x[:-1]) & ~((x[1:] != x[1:]) & (x[:-1] != x[:-1])))[: len(x)]


def within_range(rows: pa.Table) -> pa.Table:
    """For each row of a range of values, how many rows before it in the range have a smaller value, and how many up to it the same."""
    rows = rows.sort_by("_n")
    code = np.unique(rows["_code"].to_numpy(), return_inverse=True)[1]
    less, same = Prefixes(code, np.ones(len(code), np.int64)).below(np.arange(1, len(code) + 1), code)
    return rows.drop_columns(["_range", "_code"]).append_column("_less", pa.array(less)).append_column("_same", pa.array(same))


def block_answers(rows: pa.Table, more: pa.Table, by: list[str], names: list[str], quantiles: list[float], min_periods: int, unit: float) -> pa.Table:
    """Quantiles and the average rank for each row of some keys or of a block of a key.

    ``more`` has what came before the block: weighted values (``_weight``), and answers of ``within_range`` by row.
    """
    key = _numbered([rows, more], [*by, "_block"])
    own, other = key[: rows.num_rows], key[rows.num_rows :]
    n, is_value = _plain(rows, "_n"), pc.is_valid(rows["_code"]).to_numpy()
    earlier, here = pc.is_valid(more["_weight"]).to_numpy(), np.flatnonzero(is_value)

    def both(name: str) -> np.ndarray:
        return np.append(_plain(more, name)[earlier], _plain(rows, name)[here])

    wide = int(n.max(initial=0)) + 1
    place = np.append(other[earlier] * wide, own[here] * wide + n[here])
    along = np.argsort(place, kind="stable")
    keys, ranges, codes = np.append(other[earlier], own[here]), both("_range"), both("_code")
    weight = np.append(_plain(more, "_weight")[earlier], np.ones(len(here), np.int64))
    # Dense numbers of the values in the order of key, range and value.
    by_value = np.lexsort((codes, ranges, keys))
    new_range = _changes(keys[by_value]) | _changes(ranges[by_value])
    new = new_range | _changes(codes[by_value])
    dense, start = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
    dense[by_value] = np.cumsum(new) - 1
    start[by_value] = np.maximum.accumulate(np.where(new_range, dense[by_value], 0))
    value = codes[by_value][new].astype(float) / unit
    so_far = Prefixes(dense[along], weight[along])
    total, place = np.append(0, np.cumsum(weight[along])), place[along]
    upto = np.searchsorted(place, own * wide + n, "right")
    base = total[np.searchsorted(place, own * wide, "left")]

    columns, enough = [], n >= max(min_periods, 1)
    for q in quantiles:
        spot = (n[enough] - 1) * q
        k = np.floor(spot).astype(np.int64)
        share, at, first = spot - k, upto[enough], base[enough]
        low = value[so_far.kth(at, first + k)]
        up, apart = low.copy(), np.flatnonzero(share > 0)
        up[apart] = value[so_far.kth(at[apart], first[apart] + np.minimum(k + 1, n[enough] - 1)[apart])]
        alike = (low == up) | (np.isnan(low) & np.isnan(up))
        with np.errstate(invalid="ignore"):
            answer = np.zeros(len(n))
            answer[enough] = np.where((share == 0) | alike, low, low * (1 - share) + up * share)
        columns.append(pa.array(answer, mask=~enough))

    inside = rows["_inside"].to_numpy()[here].astype(bool)
    dense, start = dense[earlier.sum() :], start[earlier.sum() :]
    less, same = so_far.below(upto[here], np.where(inside, start, dense))
    less -= base[here]
    told = np.flatnonzero(~earlier)
    if len(told):
        spots = other[told] * wide + _plain(more, "_n")[told]
        order = np.argsort(spots)
        at = told[order][np.searchsorted(spots[order], (own * wide + n)[here][inside])]
        less[inside] += _plain(more, "_less")[at]
        same[inside] = _plain(more, "_same")[at]
    rank = np.zeros(len(n))
    rank[here] = less + (same + 1) / 2
    columns.append(pa.array(rank, mask=~(is_value & (n >= min_periods))))
    out = rows.select(names)
    for i, c in enumerate(columns):
        out = out.append_column(f"_a{i}", c)
    return out
