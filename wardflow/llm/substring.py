"""Word-level removal of repeated passages, by compressed full-text indexes.

Texts that share seeds meet in parts (see ``repeats``).  A part's stretches are joined into one text of word numbers, and indexed: its
Burrows-Wheeler transform is kept as a wavelet matrix, one packed bit vector with sampled ranks for each bit of a word number.  The
stretches are then streamed against the index.  Backward search from a window's last word to its first narrows an interval of suffixes, for all
windows at once; the number of words matched, up to the window's, is its matching statistic.  Windows of full statistic report their interval,
whose least document decides.  A window whose interval has shrunk to itself alone is found nowhere else and is not searched further.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardflow.llm.common import batch
from wardflow.llm.repeats import HOT, SHARD_BYTES, Kind, Shard, covered, repeated, spans

WINDOW = 13
GRAM = 4
PRIME = np.uint64(0x9E3779B97F4A7C15)
ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"


def one_space(text: bytes) -> bytes:
    return b" ".join(text.split())


def word_count(text: bytes) -> int:
    return text.count(b" ") + 1 if text else 0


def word_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the four words from each on, for texts with one space between words.

    A word's hash is a polynomial in its bytes, from running sums over all bytes.
    """
    at = np.concatenate([[0], np.cumsum([word_count(t) for t in texts])]).astype(np.int64)
    raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    blank = raw == 32
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    powers = np.multiply.accumulate(np.full(len(raw), PRIME))
    sums = np.cumsum(powers * (raw.astype(np.uint64) + np.uint64(1)))
    back = np.multiply.accumulate(np.full(len(raw), np.uint64(pow(int(PRIME), -1, 1 << 64))))
    word = (sums[end - 1] - sums[start - 1]) * back[start - 1]
    word ^= word >> np.uint64(32)
    word *= np.uint64(0xBF58476D1CE4E5B9)
    n = max(0, len(word) - GRAM + 1)
    h = np.zeros(n, np.uint64)
    for i in range(GRAM):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + word[i : i + n]
    h ^= h >> np.uint64(31)
    return h * PRIME, at


def word_cutter(texts: list[bytes]):
    starts: dict[int, list[int]] = {}

    def cut(t: int, i: int, j: int) -> bytes:
        own = starts.get(t)
        if own is None:
            places = np.flatnonzero(np.frombuffer(texts[t], np.uint8) == 32) + 1
            own = starts[t] = [0, *places.tolist(), len(texts[t]) + 1]
        return texts[t][own[i] : own[j] - 1]

    return cut


class Bits:
    """A packed bit vector with a sampled rank for every 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1]]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        word = i >> 6
        return self.upto[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))


class Index:
    """Backward search over a text of numbers; 0 and 1 end the text and its stretches."""

    def __init__(self, text: np.ndarray):
        self.order = suffixes(text)
        n, most = len(text), int(text.max()) + 1
        last = text[self.order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=most))]).astype(np.int64)
        self.levels, self.zeros, starts = [], [], np.zeros(most, np.int64)
        symbols = np.arange(most)
        for bit in reversed(range(max(1, (most - 1).bit_length()))):
            ones = (last >> bit) & 1 == 1
            level, zeros = Bits(ones), int(n - ones.sum())
            ranks = level.rank(starts)
            starts = np.where((symbols >> bit) & 1 == 1, zeros + ranks, starts - ranks)
            self.levels.append((bit, level))
            self.zeros.append(zeros)
            last = np.concatenate([last[~ones], last[ones]])
        # Where the rows before a symbol's first stand at the bottom of the matrix.
        self.base = self.first[:-1] - starts

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that start with a symbol, followed by those of low..high."""
        both, twice = np.concatenate([low, high]), np.concatenate([symbol, symbol])
        for (bit, level), zeros in zip(self.levels, self.zeros):
            ones = level.rank(both)
            both = np.where((twice >> bit) & 1 == 1, zeros + ones, both - ones)
        both += self.base[twice]
        return both[: len(low)], both[len(low) :]


def suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; the text's last number is its least and stands nowhere else."""
    n, width = len(text), 1
    _, rank = np.unique(text, return_inverse=True)
    while True:
        key = rank.astype(np.int64) * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        own = key[order]
        new = np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        width *= 2


def least_of_windows(strings: list[bytes], least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every stretch, the least value of a stretch that holds it; and where each stretch's windows start."""
    split = [s.split(b" ") for s in strings]
    sizes = np.array([len(s) for s in split], np.int64)
    upto = np.concatenate([[0], np.cumsum(np.maximum(0, sizes - k + 1))]).astype(np.int64)
    if not upto[-1]:
        return np.zeros(0, np.int64), upto
    number: dict[bytes, int] = {}
    text: list[int] = []
    for s in split:
        text += [number.setdefault(w, len(number) + 2) for w in s]
        text.append(1)
    text.append(0)
    numbers = np.array(text, np.int64)
    index = Index(numbers)
    start = np.cumsum(sizes + 1) - (sizes + 1)
    windows = np.diff(upto)
    own = np.repeat(np.arange(len(sizes)), windows)
    place = np.repeat(start - upto[:-1], windows) + np.arange(upto[-1])
    found = least[own]
    low, high = np.zeros(len(place), np.int64), np.full(len(place), len(numbers))
    open_ = np.arange(len(place))
    for back in reversed(range(k)):
        low, high = index.step(numbers[place[open_] + back], low, high)
        more = high - low > 1
        open_, low, high = open_[more], low[more], high[more]
    if len(open_):
        # Intervals of different windows of one length do not overlap.
        lows, which = np.unique(low, return_inverse=True)
        highs = np.zeros(len(lows), np.int64)
        highs[which] = high
        holder = np.concatenate([np.repeat(least, sizes + 1), [np.iinfo(np.int64).max]])[index.order]
        ends = np.append(holder, np.iinfo(np.int64).max)
        found[open_] = np.minimum.reduceat(ends, np.stack([lows, highs], 1).ravel())[::2][which]
    return found, upto


def word_kind(window: int = WINDOW) -> Kind:
    return Kind(window, GRAM, one_space, word_grams, word_cutter, least_of_windows, 4)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """Every row without the words that a run of ``window`` words covers which also starts in a document with a smaller id.

    Words are runs of what is not ASCII white space, unchanged.  Runs are judged on the input; they may overlap, and never cross documents.  A null
    or empty text has no words.  Rows of equal id do not count against each other; a row without an id keeps all and counts against none.
    ``spans`` are the removed runs of words, ``kept`` the words that are left, joined by one space.  An empty table gives no rows.  ``window`` is at least 4.
    """
    kind = word_kind(window)

    def finish(shard: Shard, told: pa.Table) -> pa.Table:
        rows, texts = [], [one_space(t) for t in shard.texts]
        counts = [word_count(t) for t in texts]
        for i, v, t, n, inside in zip(shard.ids.tolist(), shard.valid.tolist(), texts, counts, covered(shard, told, kind, counts)):
            kept = b" ".join([w for w, x in zip(t.split(b" "), inside.tolist()) if not x]) if inside.any() else t
            rows.append((i if v else None, n, int(inside.sum()), spans(inside), kept.decode()))
        return pa.Table.from_batches([batch(ROWS, *zip(*rows))])

    return repeated(docs, kind, finish, SCHEMA, id_col, text_col, shard_bytes, hot)
