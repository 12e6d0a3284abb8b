"""A hash table over byte spans: equal spans find one representative, every match verified byte by byte."""

from __future__ import annotations

import numpy as np

#: Longer spans are compared as byte strings, one by one.
WIDE = 64
MIX = np.uint64(0x9E3779B97F4A7C15)


def words64(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,)).astype(np.uint64)


def masked(loaded: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes at each place, without those after the ``left`` bytes that remain of the span."""
    drop = np.clip(8 - left, 0, 7).astype(np.uint64) * np.uint64(8)
    return loaded[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> drop)


def hashes(raw: np.ndarray, loaded: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    out = length.astype(np.uint64) * MIX
    short = length <= WIDE
    for k in range(0, WIDE, 8):
        on = np.flatnonzero(short & (length > k))
        if not len(on):
            break
        h = (out[on] ^ masked(loaded, start[on] + k, length[on] - k)) * MIX
        out[on] = h ^ (h >> np.uint64(29))
    data = raw.tobytes() if not short.all() else b""
    for i in np.flatnonzero(~short):
        out[i] ^= np.uint64(hash(data[start[i] : start[i] + length[i]]) & 0xFFFFFFFFFFFFFFFF)
    return out


def same(raw: np.ndarray, loaded: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of equal length from a and from b on hold the same bytes."""
    out, short = np.ones(len(a), bool), length <= WIDE
    for k in range(0, WIDE, 8):
        on = np.flatnonzero(short & out & (length > k))
        if not len(on):
            break
        out[on] = masked(loaded, a[on] + k, length[on] - k) == masked(loaded, b[on] + k, length[on] - k)
    for i in np.flatnonzero(~short):
        out[i] = np.array_equal(raw[a[i] : a[i] + length[i]], raw[b[i] : b[i] + length[i]])
    return out


def representatives(raw: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """For each span the number of one span with the same bytes, the same for all of them; with ``group``, of the same group.

    All spans are inserted at once into an open table.  Whoever finds its slot free writes itself there, one of those that do so stays, and
    each then compares itself with the holder; those that differ go on to the next slot.
    """
    n = len(start)
    out = np.arange(n)
    if not n:
        return out
    loaded = words64(raw)
    key = hashes(raw, loaded, start, length)
    if group is not None:
        key = (key ^ group.astype(np.uint64)) * MIX
    bits = max(4, int(2 * n - 1).bit_length())
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    holders, pending = np.full(1 << bits, -1, np.int64), np.arange(n)
    while len(pending):
        at = slot[pending]
        free = holders[at] < 0
        holders[at[free]] = pending[free]
        holder = holders[at]
        met = (key[holder] == key[pending]) & (length[holder] == length[pending])
        if group is not None:
            met &= group[holder] == group[pending]
        i = np.flatnonzero(met & (holder != pending))
        met[i] = same(raw, loaded, start[holder[i]], start[pending[i]], length[pending[i]])
        out[pending[met]] = holder[met]
        pending = pending[~met]
        slot[pending] = (slot[pending] + 1) & ((1 << bits) - 1)
    return out
