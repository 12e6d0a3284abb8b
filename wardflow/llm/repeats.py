"""Windows of k symbols that also start in a document with a smaller id: how they meet.

Documents are dealt to shards of bounded text.  Each window has a seed, the least hash of the m-grams in it; neighbouring windows
with the same seed form a stretch.  Equal windows have equal seeds, so:

1. each shard sends its seeds, by bucket, and learns which of them other documents have too;
2. it sends the different stretches of those seeds, once each with the least id that holds it, to the part of the seed;
3. a part finds equal windows among its stretches with an index of its own kind, and returns the least id of each window;
4. the shard compares these with the ids of its documents.

Seeds and stretches are only the way to a part.  Whether windows are equal is decided there, symbol by symbol.  A stretch is sent once for a
shard however many documents hold it.  A seed of a great many windows, as of an m-gram that stands in very many surroundings, is
split: its windows are sent one by one, to the part of the window's own hash.  What counts is the number of its different windows, which the shards send with their seeds, at
every size of corpus.

Blobs of many small values in one row are compressed, so that few rows move.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import batch, column, grow, pieces, shrink, text_bytes
from wardflow.session import settle

SHARD_BYTES = 6 << 20
#: Text that a task gathers before it packs it by shard.
PACK_BYTES = 16 << 20
#: Parts and buckets for each shard.
PARTS = 2
#: Different windows of a seed, added up over shards, from which on they are sent one by one.
HOT = 1 << 18
#: Windows of a stretch at most.
MOST = 32
#: A seed whose number of windows is not sent counts as two to this power of them in a shard, which it does not exceed.
FEW = 6
CHUNK = 1 << 19
NEVER = np.iinfo(np.int64).max
ODD = np.uint64(0xD6E8FEB86659FD93)
PACKED = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("valid", pa.binary()), ("lens", pa.binary()), ("data", pa.binary()), ("size", pa.int64())])
SEEDS = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("codes", pa.binary()), ("many", pa.binary()), ("sizes", pa.binary())])
FLAGS = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("shared", pa.binary()), ("hot", pa.binary())])
SENT = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("subs", pa.binary()), ("lens", pa.binary()), ("least", pa.binary()), ("data", pa.binary()), ("size", pa.int64()), ("windows", pa.binary()), ("places", pa.binary()), ("n_places", pa.int64())])
ANSWER = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("least", pa.binary()), ("size", pa.int64()), ("places", pa.binary())])


@dataclass
class Kind:
    """What symbols are.

    ``clean`` brings a text into the form in which symbols are read; ``grams`` hashes the m-grams of several such texts, with the offsets
    of their symbols; ``cutter`` gives a function for the bytes of symbols from..to of one of them; ``solve`` finds the least value of
    each window of many stretches, and where each stretch's windows start.  A part is solved in ``subs`` pieces, by further bits of the seed.
    """

    k: int
    m: int
    clean: Callable
    grams: Callable
    cutter: Callable
    solve: Callable
    subs: int


def deal(docs: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> tuple[DataFrame, int]:
    """Documents packed by shard; the shard follows from a hash of the row's id and text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def pack(batches):
        held: dict[int, list[tuple]] = {}
        held_bytes = 0

        def packed():
            rows = []
            for shard, docs in held.items():
                data = b"".join([t for *_, t in docs])
                ids, valid, lens = np.array([i or 0 for i, _ in docs], "<i8"), np.array([i is not None for i, _ in docs], bool), np.array([len(t) for *_, t in docs], "<i8")
                rows.append((shard, ids.tobytes(), valid.tobytes(), lens.tobytes(), shrink(data), len(data)))
            held.clear()
            return batch(PACKED, *zip(*rows))

        for b in pieces(batches):
            for shard, i, t in zip(column(b, "shard").to_pylist(), column(b, "doc_id").to_pylist(), text_bytes(column(b, "text"))):
                held.setdefault(shard, []).append((i, t))
                held_bytes += len(t)
            if held_bytes > PACK_BYTES:  # long stretches of text compress better
                yield packed()
                held_bytes = 0
        if held:
            yield packed()

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))
    return dealt.mapInArrow(pack, "shard long, ids binary, valid binary, lens binary, data binary, size long"), shards


@dataclass
class Shard:
    """Documents of one shard, in an order that does not depend on how they came."""

    number: int
    ids: np.ndarray
    valid: np.ndarray
    texts: list[bytes]


def unpack(table: pa.Table) -> Shard:
    docs = []
    for ids, valid, lens, data, size in zip(*(table[c].to_pylist() for c in ("ids", "valid", "lens", "data", "size"))):
        data, at = grow(data, size), 0
        for i, v, n in zip(np.frombuffer(ids, "<i8").tolist(), np.frombuffer(valid, bool).tolist(), np.frombuffer(lens, "<i8").tolist()):
            docs.append((i, v, data[at : at + n]))
            at += n
    docs.sort()
    number = table["shard"][0].as_py() if table.num_rows else -1
    return Shard(number, np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], bool), [d[2] for d in docs])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, step = len(x) - width + 1, 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:n], x[width - step : width - step + n]) if step < width else x[:n]


def stretches(texts: list[bytes], kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, seed, mark) of all stretches of cleaned texts; equal stretches have equal marks, others mostly not."""
    out = [[], [], [], [], []]
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (size == 0 or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        grams, at = kind.grams(texts[i:j])
        n = at[-1] - kind.k + 1
        if n > 0:
            seed = sliding_min(grams, kind.k - kind.m + 1)[:n]
            text = np.repeat(np.arange(len(at) - 1), np.diff(at))
            whole = text[:n] == text[kind.k - 1 : kind.k - 1 + n]
            new = np.ones(n, bool)
            new[1:] = (seed[1:] != seed[:-1]) | (text[1:n] != text[: n - 1])
            edge = np.flatnonzero(new | ~whole)
            first = edge[whole[edge]]
            count = np.append(edge[1:], n)[whole[edge]] - first
            parts = -(-count // MOST)
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start = np.repeat(first, parts) + MOST * step
            out[0].append(text[start] + i)
            out[1].append(start - at[text[start]])
            size = np.minimum(MOST, np.repeat(first + count, parts) - start)
            out[2].append(size)
            out[3].append(seed[start])
            out[4].append(grams[start] * ODD + grams[start + size - 1 + kind.k - kind.m] + size.astype(np.uint64))
        i = j
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate(x).astype(t) if x else np.zeros(0, t) for x, t in zip(out, kinds))


def keys(seed: np.ndarray, parts: int) -> np.ndarray:
    """Bucket in the upper half, and 32 bits of the seed in the lower: enough to tell most seeds of one bucket apart."""
    mixed = (seed ^ (seed >> np.uint64(31))) * ODD
    return ((mixed >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | (mixed & np.uint64(0xFFFFFFFF))


def by_bucket(found: np.ndarray) -> list[slice]:
    """Runs of equal upper halves in sorted keys."""
    if not len(found):
        return []
    cut = np.flatnonzero(np.diff(found >> np.uint64(32))) + 1
    return [slice(a, b) for a, b in zip([0, *cut], [*cut, len(found)])]


def send_seeds(shard: Shard, kind: Kind, parts: int) -> pa.Table:
    """The shard's different seeds by bucket, whether several of its documents have them, and for those of more than a few the number of their different windows, as a power of two."""
    text, _, count, seed, mark = stretches([kind.clean(t) for t in shard.texts], kind)
    key = keys(seed, parts)
    order = np.lexsort((mark, key))
    key, text, count, mark = key[order], text[order], count[order], mark[order]
    if not len(key):
        return tabled(SEEDS, [])
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(new)
    many = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
    other = new | np.concatenate([[True], mark[1:] != mark[:-1]])
    size = np.ceil(np.log2(np.add.reduceat(np.where(other, count, 0), first))).astype(np.uint8)
    found = key[first]
    rows = []
    for s in by_bucket(found):
        large = np.flatnonzero(size[s] > FEW)
        sizes = large.astype("<u4").tobytes() + size[s][large].tobytes()
        rows.append((int(found[s.start] >> np.uint64(32)), shard.number, (found[s] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), np.packbits(many[s]).tobytes(), sizes))
    return tabled(SEEDS, rows)


def sizes_of(data: bytes, n: int) -> np.ndarray:
    """The numbers of windows of n seeds, as powers of two."""
    out, k = np.full(n, FEW, np.uint8), len(data) // 5
    out[np.frombuffer(data, "<u4", k)] = np.frombuffer(data, np.uint8, k, 4 * k)
    return out


def tabled(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([batch(schema, *zip(*rows))] if rows else [], schema=schema)


def share_seeds(table: pa.Table, hot: int) -> pa.Table:
    """For each shard that sent seeds of this bucket: which of them another document has, and which have too many windows for one part."""
    codes = [np.frombuffer(x, "<u4") for x in table["codes"].to_pylist()]
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(c)) for x, c in zip(table["many"].to_pylist(), codes)])
    sizes = np.concatenate([sizes_of(x, len(c)) for x, c in zip(table["sizes"].to_pylist(), codes)])
    _, place, count = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    several = np.bincount(place, many) > 0
    crowded = np.bincount(place, 2.0**sizes) >= hot
    shared, crowded, at = (several | (count > 1))[place], crowded[place], 0
    rows = []
    for shard, bucket, c in zip(table["shard"].to_pylist(), table["bucket"].to_pylist(), codes):
        rows.append((shard, bucket, *(np.packbits(x[at : at + len(c)]).tobytes() for x in (shared, crowded))))
        at += len(c)
    return tabled(FLAGS, rows)


def send_stretches(shard: Shard, flags: pa.Table, kind: Kind, parts: int) -> pa.Table:
    """The different stretches with a shared seed, by part, the least id of each, and where they stand: (stretch, text, first window)."""
    texts = [kind.clean(t) for t in shard.texts]
    text, start, count, seed, _ = stretches(texts, kind)
    key = keys(seed, parts)
    found, place = np.unique(key, return_inverse=True)
    told = {b: (s, h) for b, s, h in zip(*(flags[c].to_pylist() for c in ("bucket", "shared", "hot")))}
    shared, hot = np.zeros(len(found), bool), np.zeros(len(found), bool)
    for s in by_bucket(found):
        for into, x in zip((shared, hot), told[int(found[s.start] >> np.uint64(32))]):
            into[s] = np.unpackbits(np.frombuffer(x, np.uint8), count=s.stop - s.start)
    wanted = np.flatnonzero(shared[place])
    single = hot[place[wanted]]
    part, code = (key >> np.uint64(32)).astype(np.int64), (key >> np.uint64(8)).astype(np.int64)
    cut = kind.cutter(texts)
    # (part, sub, text, first window, windows) of each stretch, and of each window of a crowded seed
    whole = wanted[~single]
    found = [np.stack([part[whole], code[whole] % kind.subs, text[whole], start[whole], count[whole]], 1)]
    hashed: dict[bytes, list[int]] = {}
    for i in wanted[single].tolist():
        t, first, n = int(text[i]), int(start[i]), int(count[i])
        data = cut(t, first, first + n + kind.k - 1)
        if data not in hashed:
            hashed[data] = [xxhash.xxh64_intdigest(cut(t, w, w + kind.k)) for w in range(first, first + n)]
        hashes = hashed[data]
        found.append(np.array([(h % parts, (h >> 40) % kind.subs, t, first + w, 1) for w, h in enumerate(hashes)], np.int64))
    todo = np.concatenate(found)
    todo = todo[np.argsort(todo[:, 0], kind="stable")]
    ids, rows = np.where(shard.valid, shard.ids, NEVER).tolist(), []
    for mine in np.split(todo, np.flatnonzero(np.diff(todo[:, 0])) + 1) if len(todo) else []:
        own: dict[bytes, int] = {}
        least, windows, subs, numbers = [], [], [], []
        for _, sub, t, first, n in mine.tolist():
            data = cut(t, first, first + n + kind.k - 1)
            number = own.get(data)
            if number is None:
                number = own[data] = len(own)
                least.append(ids[t])
                windows.append(n)
                subs.append(sub)
            elif ids[t] < least[number]:
                least[number] = ids[t]
            numbers.append(number)
        data, spots = b"".join(own), np.stack([numbers, mine[:, 2], mine[:, 3]]).astype("<i4")
        lens, low, count_, sub = (np.array(x, t).tobytes() for x, t in (([len(x) for x in own], "<i4"), (least, "<i8"), (windows, "<i4"), (subs, "u1")))
        rows.append((int(mine[0, 0]), shard.number, sub, lens, shrink(low), shrink(data), len(data), count_, shrink(spots.tobytes()), spots.shape[1]))
    return tabled(SENT, rows)


def answer(table: pa.Table, kind: Kind) -> pa.Table:
    """For each shard, the least id of every window of the stretches it sent, in order."""
    own: dict[bytes, int] = {}
    low: list[int] = []
    group: list[int] = []
    sent = []
    for subs, lens, least, data, size in zip(*(table[c].to_pylist() for c in ("subs", "lens", "least", "data", "size"))):
        data, at, numbers = grow(data, size), 0, []
        lens = np.frombuffer(lens, "<i4").tolist()
        for sub, n, x in zip(subs, lens, np.frombuffer(grow(least, 8 * len(lens)), "<i8").tolist()):
            i = own.setdefault(data[at : at + n], len(own))
            if i == len(low):
                low.append(x)
                group.append(sub)
            elif x < low[i]:
                low[i] = x
            numbers.append(i)
            at += n
        sent.append(numbers)
    strings, lows, groups = list(own), np.array(low, np.int64), np.array(group)
    start, count, solved, at = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64), [], 0
    for sub in range(kind.subs):
        mine = np.flatnonzero(groups == sub)
        if len(mine):
            best, upto = kind.solve([strings[i] for i in mine], lows[mine], kind.k)
            start[mine], count[mine] = at + upto[:-1], np.diff(upto)
            solved.append(best)
            at += len(best)
    found = np.concatenate(solved)
    rows = []
    for shard, part, numbers in zip(table["shard"].to_pylist(), table["part"].to_pylist(), sent):
        i = np.array(numbers, np.int64)
        n = count[i]
        spot = np.repeat(start[i] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        rows.append((shard, part, shrink(found[spot].astype("<i8").tobytes()), int(n.sum()), None))
    return pa.Table.from_batches([batch(ANSWER, *zip(*rows))])


def covered(shard: Shard, told: pa.Table, kind: Kind, symbols: list[int]) -> list[np.ndarray]:
    """For each text, which of its symbols a repeated window covers; ``symbols`` are their numbers.

    ``told`` holds two rows for each part: the windows and places of the stretches that the shard sent, and what it was answered.
    """
    at = np.concatenate([[0], np.cumsum(symbols)]).astype(np.int64)
    own = np.where(shard.valid, shard.ids, np.iinfo(np.int64).min)
    parts: dict[int, dict] = {}
    for part, values, size, places in zip(*(told[c].to_pylist() for c in ("part", "least", "size", "places"))):
        if places is None:
            parts.setdefault(part, {})["least"] = np.frombuffer(grow(values, 8 * size), "<i8")
        else:
            parts.setdefault(part, {}).update(windows=np.frombuffer(values, "<i4"), places=np.frombuffer(grow(places, 12 * size), "<i4").reshape(3, -1))
    edges = np.zeros(at[-1] + 1, np.int32)
    for p in parts.values():
        upto = np.concatenate([[0], np.cumsum(p["windows"])]).astype(np.int64)
        which, text, first = p["places"].astype(np.int64)
        n = upto[which + 1] - upto[which]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = p["least"][np.repeat(upto[which], n) + step] < np.repeat(own[text], n)
        spot = (np.repeat(at[text] + first, n) + step)[hit]
        np.add.at(edges, spot, 1)
        np.add.at(edges, spot + kind.k, -1)
    inside = np.cumsum(edges[:-1]) > 0
    return [inside[a:b] for a, b in zip(at, at[1:])]


def spans(inside: np.ndarray) -> list[dict]:
    """Maximal runs."""
    d = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return [{"start": a, "end": b} for a, b in zip(np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist())]


def repeated(docs: DataFrame, kind: Kind, finish: Callable, schema: str, id_col: str, text_col: str, shard_bytes: int, hot: int) -> DataFrame:
    """Run the steps above; ``finish(shard, told)`` makes the result rows of one shard, of ``schema``."""
    dealt, shards = deal(docs, id_col, text_col, shard_bytes)
    parts = PARTS * shards
    by_shard = dealt.groupBy("shard")
    seeds = by_shard.applyInArrow(lambda t: send_seeds(unpack(t), kind, parts), "bucket long, shard long, codes binary, many binary, sizes binary")
    flags = settle(seeds.groupBy("bucket").applyInArrow(lambda t: share_seeds(t, hot), "shard long, bucket long, shared binary, hot binary"))
    sent = settle(
        by_shard.cogroup(flags.groupBy("shard")).applyInArrow(
            lambda d, f: send_stretches(unpack(d), f, kind, parts), "part long, shard long, subs binary, lens binary, least binary, data binary, size long, windows binary, places binary, n_places long"
        )
    )
    asked = sent.select("part", "shard", "subs", "lens", "least", "data", "size")
    told = asked.groupBy("part").applyInArrow(lambda t: answer(t, kind), "shard long, part long, least binary, size long, places binary")
    own = sent.select("shard", "part", F.col("windows").alias("least"), F.col("n_places").alias("size"), "places")
    return by_shard.cogroup(own.union(told).groupBy("shard")).applyInArrow(lambda d, t: finish(unpack(d), t), schema)
