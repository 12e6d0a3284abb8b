"""Language model scores by a weighted backoff automaton.

The states of the automaton are the contexts of the kept n-grams; the root is the empty context.  An arc reads a word, adds
its log-probability and leads to the longest suffix that is a state.  Where a state has no arc for a word, its failure arc adds the
backoff weight and leads to the context without its first word.

All training documents are counted.  An n-gram is kept if it occurs ``LEAST_COUNT`` times, whatever the size of the corpus, so the model
grows with the input.  It never stands in one place.  Documents are taken where they are read, in shards of bounded text.  A shard asks for the
n-grams of its own texts, order by order: those whose two parts of one word less are kept.  They are totalled in buckets by hash, and the shard gets
back the total and a number of each.  Two numbers of one order name an n-gram of the next, so names stay short and exact.  A number
is the bucket and the rank there, so within a shard numbers ascend, and their steps are what is sent.
An n-gram is asked for where its right part says, in pieces of bounded size, so what is asked of a bucket names few right parts, each once with its total.
What a context's backoff weight needs are two sums over its followers, which are added up by context and told to the shards that hold it.
The texts and all that is told are stored by shard, in one table, and stay where they are; what is asked and told moves once.

A shard so has just the states and arcs that its texts meet, and reads them from left to right once, carrying a state.  Since a state is known from the last
``ORDER - 1`` words, texts are cut into lanes that begin with as many words of the lane before, unscored, and all lanes take a step at a time.
``build`` makes the same automaton whole, for a corpus that fits one process.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import Dealt, column, fleeting, grow, remainder, shrink, text_bytes

ORDER = 3
#: An n-gram is kept if it occurs so often.
LEAST_COUNT = 2
DISCOUNT = 0.75
SHARD_BYTES = 14 << 20
#: Bits of a number that hold the rank in its bucket.
RANK_BITS = 40
#: The end of a text, which is also what stands before its first word.
END = b""
#: Occurrences of a right part for which its n-grams go to one bucket; more are shared out among several.
HOT = 1 << 17
#: The buckets are asked for n-grams of the highest order in so many rounds, so that part of what is asked lies on disk at a time.
ROUNDS = 2
#: The level of texts, of the words that a shard asks for, and less the order, of the sums of contexts; answers have the order of their n-grams.  Rows that no
#: shard asked for have a negative shard.
TEXT, WORDS, SUMS = 0, -1, -1
STORED = pa.schema(
    [("level", pa.int64()), ("shard", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("data", pa.binary()), ("totals", pa.binary()), ("size", pa.int64()), ("words", pa.binary())]
    + [("ids", pa.binary()), ("flags", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())]
)
ASKED = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("data", pa.binary()), ("bits", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


@dataclass
class Automaton:
    """Words with numbers; arcs by (state, word), failure arcs, and the state before a text."""

    numbers: dict[bytes, int]
    arcs: dict[int, tuple[float, int]]
    single: list[int]
    back: list[float]
    fail: list[int]
    down: list[float]
    start: int

    def score(self, numbers: list[int], root: list[float]) -> float:
        """Log10 probability of words given by number (-1: none) and by their log10 probability at the root."""
        arcs, back, fail, down, single = self.arcs, self.back, self.fail, self.down, self.single
        n, state, total = len(single), self.start, 0.0
        for w, p in zip(numbers, root):
            if w < 0:
                total += down[state] + p
                state = 0
                continue
            while state:
                arc = arcs.get(state * n + w)
                if arc:
                    total += arc[0]
                    state = arc[1]
                    break
                total += back[state]
                state = fail[state]
            else:
                total += p
                state = single[w]
        return total


def build(frequent: dict[bytes, int], grams: list[dict[tuple, int]], tokens: int, types: int) -> Automaton:
    """Automaton of kept n-grams; ``grams`` are counts by word numbers, of order 2 and up; the frequent words' numbers are their order."""
    numbers = {w: i for i, w in enumerate(frequent)}
    root = [(c + 0.5) / (tokens + 0.5 * (types + 1)) for c in frequent.values()]
    count = {(i,): c for i, c in enumerate(frequent.values())}
    for g in grams:
        count |= g
    contexts = sorted({g[:-1] for level in grams for g in level}, key=lambda c: (len(c), c))
    state = {(): 0} | {c: i + 1 for i, c in enumerate(contexts)}

    def longest(gram: tuple) -> tuple:
        while gram not in state:
            gram = gram[1:]
        return gram

    chance = {(i,): p for i, p in enumerate(root)}
    followers: dict[tuple, list] = {}
    for level in grams:
        for gram, c in level.items():
            chance[gram] = (c - min(DISCOUNT, c / 2)) / count[gram[:-1]]
            followers.setdefault(gram[:-1], []).append(gram)
    back, fail, down, arcs = [0.0], [0], [0.0], {}
    for c in contexts:
        kept = sum(chance[g] for g in followers[c])
        lower = sum(chance[g[1:]] for g in followers[c])
        back.append(log10(max(1 - kept, 1e-12) / max(1 - lower, 1e-12)))
        fail.append(state[longest(c[1:])])
        down.append(back[-1] + down[fail[-1]])
        for g in followers[c]:
            arcs[state[c] * len(numbers) + g[-1]] = (log10(chance[g]), state[longest(g[-len(grams) :])])
    single = [state[longest((i,))] for i in range(len(numbers))]
    return Automaton(numbers, arcs, single, back, fail, down, single[numbers[END]] if END in numbers else 0)


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def tabled(schema: pa.Schema, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def put(*columns: np.ndarray) -> bytes:
    """Columns of 64 bits and of one length, byte by byte, since the high bytes are mostly alike."""
    return shrink(np.stack([c.view(np.int64) for c in columns]).view(np.uint8).reshape(-1, 8).T.tobytes())


def got(rows: pa.Table, name: str, width: int, length: str = "n") -> list[np.ndarray]:
    """The columns of each row, by ``put``."""
    sizes = rows[length].to_pylist()
    return [np.frombuffer(grow(x, 8 * width * n), np.uint8).reshape(8, -1).T.copy().view(np.int64).reshape(width, n) for x, n in zip(rows[name].to_pylist(), sizes)]


def steps(number: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers; one that is -1 adds nothing."""
    return np.diff(np.maximum.accumulate(number), prepend=-1)


def numbers(step: np.ndarray) -> np.ndarray:
    """Numbers by their steps, -1 where there is none: a number is larger than those before it."""
    return np.where(step > 0, np.cumsum(step) - 1, -1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x >> np.uint64(20)


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the place there of each; keys and places are sorted as one number where they fit."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> 63 - bits:
        return np.unique(keys, return_inverse=True)
    both = np.sort(keys << bits | np.arange(len(keys)))
    at = both & (1 << bits) - 1
    both >>= bits
    new = np.append(True, np.diff(both) != 0)
    place = np.empty(len(keys), np.int64)
    place[at] = np.cumsum(new) - 1
    return both[new], place


def close(number: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers with the rank in as few bits as it takes, each but the ``new`` ones as a step from the one before, and these bits."""
    rank = number & (1 << RANK_BITS) - 1
    bits = int(rank.max()).bit_length()
    short = number >> RANK_BITS << bits | rank
    return np.where(new, short, np.diff(short, prepend=0)), bits


def far(step: np.ndarray, new: np.ndarray, bits: int) -> np.ndarray:
    """Numbers, by ``close``."""
    start, total = np.flatnonzero(new), np.cumsum(step)
    short = total - np.repeat(total[start] - step[start], np.diff(np.append(start, len(step))))
    return short >> bits << RANK_BITS | short & (1 << bits) - 1


def discounted(n: np.ndarray) -> np.ndarray:
    return n - np.minimum(DISCOUNT, n / 2)


def packs(batches, buckets: int):
    """Rows of ``Pack`` for every ``SHARD_BYTES`` of texts."""
    shard, pack, size = TaskContext.get().partitionId() << 32, Pack(), 0
    for b in batches:
        for i, held, text in zip(column(b, "doc_id").to_pylist(), column(b, "held_out").to_pylist(), text_bytes(column(b, "text"))):
            if size and size + len(text) > SHARD_BYTES:
                yield pack.rows(shard, buckets)
                shard, pack, size = shard + 1, Pack(), 0
            pack.add(i, held, text)
            size += len(text) + 1
    if size:
        yield pack.rows(shard, buckets)


class Pack:
    """A shard's texts as places of words: -1, the end, the words, the end."""

    def __init__(self):
        self.texts, self.ids, self.flags = [], [], []

    def add(self, doc_id: int | None, held: bool, text: bytes) -> None:
        self.texts.append(text)
        self.ids.append(doc_id or 0)
        self.flags.append(held + 2 * (doc_id is None))

    def places(self) -> tuple[np.ndarray, list[bytes]]:
        """The place of each word, and the words, of which the end is the first."""
        raw = np.frombuffer(b" ".join([*self.texts, b""]).lower(), np.uint8)
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        start = np.flatnonzero(~blank & np.append(True, blank[:-1]))
        stop = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
        offsets = np.append(0, np.cumsum(stop - start))
        found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~blank])]).dictionary_encode()
        n = np.diff(np.searchsorted(start, np.cumsum([len(t) + 1 for t in self.texts])), prepend=0)
        first = np.cumsum(n + 3) - n - 3
        at, inner = np.zeros(int((n + 3).sum()), np.int32), np.ones(int((n + 3).sum()), bool)
        at[first], inner[first], inner[first + 1], inner[first + n + 2] = -1, False, False, False
        at[inner] = found.indices.to_numpy() + 1
        return at, [END, *found.dictionary.to_pylist()]

    def rows(self, shard: int, buckets: int) -> pa.RecordBatch:
        """The texts in one row, and the words with their counts in training documents in rows by bucket; places follow these rows."""
        at, words = self.places()
        first = np.flatnonzero(at < 0)
        counted = np.repeat(np.array(self.flags) & 1 == 0, np.diff(np.append(first, len(at))))
        counted[first] = counted[first + 1] = False
        counts = np.bincount(at[counted], minlength=len(words))
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        order = np.array(sorted(range(len(words)), key=words.__getitem__))
        order = order[np.argsort(bucket[order], kind="stable")]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        # Words by their counts, so that most numbers are small.
        code = np.empty(len(order) + 1, np.int32)
        code[order[np.argsort(-counts[order], kind="stable")]] = np.arange(1, len(order) + 1)
        code[-1] = 0
        planes = code[at].view(np.uint8).reshape(-1, 4).T.tobytes()
        rows = [{"level": TEXT, "shard": shard, "n": len(at), "data": shrink(planes), "ids": np.array(self.ids, np.int64).tobytes(), "flags": np.array(self.flags, np.uint8).tobytes()}]
        for k in np.unique(bucket).tolist():
            own = order[cuts[k] : cuts[k + 1]]
            joined = b"\n".join([words[i] for i in own.tolist()])
            rows.append({"level": WORDS, "shard": shard, "bucket": k, "n": len(own), "data": put(counts[own]), "size": len(joined), "words": shrink(joined)})
        return pa.RecordBatch.from_pylist(rows, schema=STORED)


def tell(asked: pa.Table, least: int) -> pa.Table:
    """Numbers (-1: not kept) and totals of a bucket's words for each shard that asked, and the bucket's tokens and types."""
    total: defaultdict[bytes, int] = defaultdict(int)
    shards = asked["shard"].to_pylist()
    found = [grow(x, size).split(b"\n") for x, size in zip(asked["words"].to_pylist(), asked["size"].to_pylist())]
    for ws, (n,) in zip(found, got(asked, "data", 1)):
        for w, c in zip(ws, n.tolist()):
            total[w] += c
    bucket = asked["bucket"][0].as_py()
    number = {w: (bucket << RANK_BITS) + i for i, w in enumerate(sorted(w for w, c in total.items() if c >= least))}
    rows = [{"level": 1, "shard": -1 - bucket, "bucket": bucket, "n": 0, "tokens": sum(total.values()), "types": sum(c > 0 for c in total.values())}]
    for shard, ws in zip(shards, found):
        rows.append({"level": 1, "shard": shard, "bucket": bucket, "n": len(ws), "data": put(steps(np.array([number.get(w, -1) for w in ws]))), "totals": put(np.array([total[w] for w in ws])), "size": len(ws)})
    return tabled(STORED, rows)


@dataclass
class Level:
    """A shard's n-grams of one order: the place at each start (-1: none), and by place the two parts, the bucket, number and total."""

    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    bucket: np.ndarray
    number: np.ndarray
    total: np.ndarray

    def above(self, buckets: int) -> Level:
        """The n-grams of the next order whose parts are kept, still without number and total."""
        size = len(self.number)
        kept = np.append(self.number, -1)[self.at] >= 0
        ok = kept[:-1] & kept[1:]
        keys, place = ranked(self.at[1:][ok] * size + self.at[:-1][ok])
        right, left = keys // size, keys % size
        piece = mixed(self.number[left]) % (1 + self.total[right] // HOT).astype(np.uint64)
        bucket = (mixed(mixed(self.number[right]) + piece) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        at = np.full(len(self.at), -1, np.int64)
        at[:-1][ok] = moved[place]
        return Level(at, left[order], right[order], bucket[order], np.zeros(0, np.int64), np.zeros(0, np.int64))


def answers(rows: pa.Table, level: int) -> pa.Table:
    return rows.filter(pc.equal(rows["level"], level)).sort_by("bucket")


def levels(rows: pa.Table, buckets: int, orders: int) -> list[Level]:
    """A shard's n-grams up to an order, of which the last has no answers yet if there are none."""
    text = answers(rows, TEXT)
    planes = np.frombuffer(grow(text["data"][0].as_py(), 4 * text["n"][0].as_py()), np.uint8)
    code = planes.reshape(4, -1).T.copy().view(np.int32).ravel()
    counts = np.concatenate(got(answers(rows, WORDS), "data", 1), axis=1)[0]
    none = np.zeros(0, np.int64)
    out = [Level(np.append(-1, np.argsort(-counts, kind="stable"))[code], none, none, none, none, none)]
    for k in range(1, orders + 1):
        if k > 1:
            out.append(out[-1].above(buckets))
        told = answers(rows, k)
        if told.num_rows:
            out[-1].number = number = np.concatenate([numbers(step) for (step,) in got(told, "data", 1)])
            total = np.concatenate([x for (x,) in got(told, "totals", 1, "size")])
            if k > 1:
                out[-1].total = np.zeros(len(number), np.int64)
                out[-1].total[number >= 0] = total
            else:
                out[-1].total = total
    return out


def training(text: pa.Table, at: np.ndarray) -> np.ndarray:
    """Whether each position belongs to a training document."""
    flags = np.frombuffer(text["flags"][0].as_py(), np.uint8)
    return np.repeat(flags & 1 == 0, np.diff(np.append(np.flatnonzero(at < 0), len(at))))


def ask_above(stored: pa.Table, buckets: int, order: int, round: int, rounds: int) -> pa.Table:
    """A shard's n-grams of an order, in rows by bucket, of every so many buckets: numbers of both parts, count in its training documents, total of the right part.

    They are sorted by right part, whose total stands at the first of its n-grams.
    """
    own = levels(stored, buckets, order)
    last, above = own[-2:]
    shard = stored["shard"][0].as_py()
    counts = np.bincount(above.at[training(answers(stored, TEXT), own[0].at) & (above.at >= 0)], minlength=len(above.left))
    cuts = np.searchsorted(above.bucket, np.arange(buckets + 1))
    rows = []
    for k in np.unique(above.bucket[above.bucket % rounds == round]).tolist():
        own = slice(cuts[k], cuts[k + 1])
        left, right = above.left[own], above.right[own]
        new = np.diff(right, prepend=-1) != 0
        step, bits = close(last.number[left], new)
        rows.append({"bucket": k, "shard": shard, "n": len(left), "data": put(steps(last.number[right]), step, counts[own], np.where(new, last.total[right], 0)), "bits": bits})
    return tabled(ASKED, rows)


def tell_above(asked: pa.Table, least: int, level: int) -> pa.Table:
    """Numbers of a bucket's n-grams for each shard that asked, totals of those that are kept, and two sums over the followers of each context, by its bucket.

    The sums are four times those of the discounted counts of the kept n-grams and of their right parts', which are whole numbers; words count without discount, as at the root.
    """
    data = got(asked, "data", 4)
    _, _, n, below = np.concatenate(data, axis=1)
    left = np.concatenate([far(step, new > 0, bits) for (new, step, *_), bits in zip(data, asked["bits"].to_pylist())])
    right = np.concatenate([np.cumsum(x[0]) - 1 for x in data])
    below = below[np.maximum.accumulate(np.where(below > 0, np.arange(len(below)), 0))]
    bucket = asked["bucket"][0].as_py()
    order = np.lexsort((left, right))
    new = np.append(True, (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0))
    first = np.flatnonzero(new)
    total = np.add.reduceat(n[order], first)
    kept = total >= least
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    number = np.where(kept, (bucket << RANK_BITS) + np.cumsum(kept) - 1, -1)
    rows, i = [], 0
    for shard, size in zip(asked["shard"].to_pylist(), asked["n"].to_pylist()):
        own = place[i : i + size]
        some = own[kept[own]]
        rows.append({"level": level, "shard": shard, "bucket": bucket, "n": size, "data": put(steps(number[own])), "totals": put(total[some]), "size": len(some)})
        i += size
    context, below = left[order][first][kept], below[order][first][kept]
    if len(context):
        by = np.argsort(context, kind="stable")
        context = context[by]
        start = np.flatnonzero(np.append(True, np.diff(context) != 0))
        sums = [np.add.reduceat((4 * x[by]).astype(np.int64), start) for x in (discounted(total[kept]), below + 0.5 if level == 2 else discounted(below))]
        context = context[start]
        home, cuts = np.unique(context >> RANK_BITS, return_index=True)
        for k, a, b in zip(home.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(context)]):
            rows.append({"level": level, "shard": -1 - k, "bucket": k, "n": b - a, "data": put(steps(context[a:b] - (k << RANK_BITS)), *[x[a:b] for x in sums])})
    return tabled(STORED, rows)


def tell_sums(asked: pa.Table, found: pa.Table, level: int) -> pa.Table:
    """For each shard that asked a bucket, those of its n-grams that are contexts, by place, and four times both sums of each."""
    data = got(found, "data", 3) if found.num_rows else []
    rank, *sums = np.concatenate([[np.cumsum(x[0]) - 1, *x[1:]] for x in data], axis=1) if data else np.zeros((3, 0), np.int64)
    rank, first = np.unique(rank, return_inverse=True)
    order = np.argsort(first, kind="stable")
    start = np.searchsorted(first[order], np.arange(len(rank)))
    sums = [np.add.reduceat(x[order], start) if len(rank) else x for x in sums]
    rows = []
    if not asked.num_rows:
        return tabled(STORED, rows)
    for shard, bucket, size, (step,) in zip(asked["shard"].to_pylist(), asked["bucket"].to_pylist(), asked["n"].to_pylist(), got(asked, "data", 1)):
        own = numbers(step)
        own = np.where(own < 0, -1, own - (bucket << RANK_BITS))
        at = np.searchsorted(rank, own)
        place = np.flatnonzero(np.append(rank, -2)[at] == own)
        rows.append({"level": SUMS - level, "shard": shard, "bucket": bucket, "size": size, "n": len(place), "data": put(steps(place), *[x[at[place]] for x in sums])})
    return tabled(STORED, rows)


def context_sums(told: pa.Table, level: int, size: int) -> np.ndarray:
    """Both sums of each of a shard's n-grams of an order; 0 where nothing follows."""
    told, out, start = answers(told, SUMS - level), np.zeros((2, size)), 0
    for n, (step, *sums) in zip(told["size"].to_pylist(), got(told, "data", 3)):
        out[:, start + np.cumsum(step) - 1] = np.array(sums) / 4
        start += n
    return out


def backoff(level: Level, below: Level | None, sums: np.ndarray, tokens: int, types: int) -> np.ndarray:
    """Log10 backoff weight of each n-gram as a context; 0 where nothing follows."""
    kept, lower = sums
    size = tokens + 0.5 * (types + 1) if below is None else below.total[level.right]
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.log10(np.maximum(1 - kept / level.total, 1e-12) / np.maximum(1 - lower / size, 1e-12))
    return np.where(kept > 0, weight, 0.0)


LANE = 256


def traverse(own: list[Level], base: np.ndarray, arcs: list[np.ndarray], backs: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of the word at each place, by one pass over all lanes from left to right.

    A lane's state is the longest kept n-gram that ends before its place, given by its order, 0 for the root.  ``arcs`` hold by order (2 and up) the arc of the
    n-gram that begins at each place, NaN for none; ``backs`` by order (1 and up) the weight of the failure arc of the state that begins there.  A failure
    arc leads to the state without its first word, and where an arc is taken the next state is the n-gram it spells, or its longest end that is one.
    """
    at = own[0].at
    size, orders = len(at), len(own)
    first = np.flatnonzero(at < 0)
    lengths = np.diff(np.append(first, size)) - 2
    # Scored places of each text, in lanes.
    cuts = [np.arange(a + 2, a + 2 + n, LANE) for a, n in zip(first.tolist(), lengths.tolist())]
    begin = np.concatenate(cuts) if cuts else np.zeros(0, np.int64)
    end = np.repeat(first + 2 + lengths, [len(c) for c in cuts])
    end = np.minimum(end, begin + LANE)
    held = [np.append(level.number, -1)[level.at] >= 0 for level in own[:-1]]
    out = np.zeros(size)
    state = np.zeros(len(begin), np.int64)
    for step in range(1 - orders, LANE):
        place = begin + step
        on = np.flatnonzero(place < end)
        if not len(on):
            break
        # What stands before a text's first end is no word, and leads to the root.
        here, now = np.maximum(place[on], 0), state[on]
        told = np.zeros(len(on))
        for order in range(orders - 1, 0, -1):
            reading = np.flatnonzero(now == order)
            spot = here[reading] - order
            arc = arcs[order - 1][spot]
            fails = np.isnan(arc)
            taken = reading[~fails]
            told[taken] += arc[~fails]
            now[taken] = -min(order + 1, orders - 1)
            back = reading[fails]
            told[back] += backs[order - 1][spot[fails]]
            now[back] = order - 1
        root = now == 0
        told[root] += base[here[root]]
        now = np.where(root, 1, -now)
        # The longest end that is a state.
        for order in range(orders - 1, 0, -1):
            shorter = (now == order) & ~held[order - 1][np.maximum(here - order + 1, 0)]
            now[shorter] = order - 1
        state[on] = now
        if step >= 0:
            out[here] = told
    return out


def by_shard(stored: DataFrame):
    """What is stored for each shard, but for the words themselves; no row moves."""
    return stored.filter("shard >= 0").select("level", "shard", "bucket", "n", "data", "totals", "size", "ids", "flags").groupBy("shard")


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, least_count: int = LEAST_COUNT) -> DataFrame:
    """Scores of every row under a model of the training rows, those whose remainder modulo 5 is not 1.

    A null or empty text is the end alone.  Without training rows every count is 0 and the model is the root.  Repeated rows are
    counted and answered each; a null id counts as empty text for the remainder.  An empty table gives no rows.  What comes to the driver
    are token and type totals.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(id_col, 5) == 1).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // SHARD_BYTES))
    stored = Dealt(docs.sparkSession, "shard", buckets)
    try:
        with fleeting(rows.mapInArrow(lambda b: packs(b, buckets), ddl(STORED))) as packed:
            asked = packed.filter(F.col("level") == WORDS).select("bucket", "shard", "n", "data", "size", "words")
            stored.add(asked.groupBy("bucket").applyInArrow(lambda t: tell(t, least_count), ddl(STORED)))
            stored.add(packed.withColumn("words", F.lit(None).cast("binary")), moved=False)
        totals = stored.read().filter("level = 1 AND shard < 0").agg(F.sum("tokens"), F.sum("types")).first()
        tokens, types = totals[0] or 0, totals[1] or 0

        def next_order(k: int, round: int, rounds: int) -> DataFrame:
            asked = by_shard(stored.read()).applyInArrow(lambda t: ask_above(t, buckets, k, round, rounds), ddl(ASKED))
            return asked.groupBy("bucket").applyInArrow(lambda t: tell_above(t, least_count, k), ddl(STORED))

        def sums_of(k: int, told: DataFrame) -> DataFrame:
            own = stored.plain().filter((F.col("level") == k) & (F.col("shard") >= 0)).select("shard", "bucket", "n", "data")
            found = told.filter((F.col("level") == k + 1) & (F.col("shard") < 0)).select("bucket", "n", "data")
            return own.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(lambda a, f: tell_sums(a, f, k), ddl(STORED))

        for k in range(2, order):
            with fleeting(next_order(k, 0, 1)) as told:
                stored.add(told.filter("shard >= 0"))
                with fleeting(sums_of(k - 1, told)) as sums:
                    stored.add(sums)
        for r in range(ROUNDS if order > 1 else 0):
            with fleeting(next_order(order, r, ROUNDS)) as told:
                stored.add(told)
        last_sums = sums_of(order - 1, stored.plain()) if order > 1 else stored.plain().filter("false")
        every = stored.read()
    finally:
        stored.forget()

    def score(stored: pa.Table, told: pa.Table) -> pa.Table:
        own = levels(stored, buckets, order)
        at, total = own[0].at, own[0].total
        root = np.log10((total + 0.5) / (tokens + 0.5 * (types + 1)))
        base = np.append(root, 0.0)[at]
        arcs, backs = [], []
        for k in range(2, order + 1):
            last, new = own[k - 2], own[k - 1]
            back = backoff(last, own[k - 3] if k > 2 else None, context_sums(told if k == order else stored, k - 1, len(last.number)), tokens, types)
            with np.errstate(divide="ignore", invalid="ignore"):
                arc = np.append(np.where(new.total > 0, np.log10(discounted(new.total) / last.total[new.left]), np.nan), np.nan)
            arcs.append(arc[new.at])
            backs.append(np.append(back, 0.0)[last.at])
        p = traverse(own, base, arcs, backs)
        known, out = np.append(total, 0)[at] > 0, []
        first, text = np.flatnonzero(at < 0), answers(stored, TEXT)
        ids, flags = np.frombuffer(text["ids"][0].as_py(), np.int64).tolist(), np.frombuffer(text["flags"][0].as_py(), np.uint8).tolist()
        for i, flag, a, b in zip(ids, flags, (first + 2).tolist(), np.append(first[1:], len(at)).tolist()):
            row = (None if flag & 2 else i, bool(flag & 1), b - a, int(known[a:b].sum()), tokens, float(base[a:b].sum()), float(p[a:b].sum()))
            out.append(dict(zip(SCORES.names, row)))
        return tabled(SCORES, out)

    return by_shard(every).cogroup(last_sums.groupBy("shard")).applyInArrow(score, ddl(SCORES))
