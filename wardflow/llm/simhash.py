"""Near duplicates by SimHash, found through deletion variants of fingerprint segments.

Fingerprints that differ in at most ``distance`` bits differ in at most one bit of one of ``distance // 2 + 1``
segments.  So each segment is indexed once for each of its bits with that bit blanked out: an equality join on
(segment, blanked bit, remaining bits) finds all pairs, and the whole fingerprints are then compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import batch, column, pieces, text_bytes, two
from wardflow.llm.components import components
from wardflow.session import settle

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Fingerprints of one index key beyond which the key is split by further segments.
SPLIT = 4096
#: Up to this many, all pairs of a key are compared at once.
SMALL = 24
#: Bytes of text whose shingles are held at once; each takes about sixty times as much for a moment.
PIECE = 1 << 18
PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
MARKED = pa.schema([*PRINTS, ("mark", pa.binary())])
ENTRY = pa.schema([("key", pa.int64()), ("sub", pa.int64()), ("fp", pa.int64())])
FOUND = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each run of ``size`` words, or of the whole if there are fewer; none without words."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    line = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(line[s:e], SEED) for s, e in zip(starts, ends[size - 1 :])]


def majority(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each run of hashes between offsets, the bits that more than half of them have."""
    out, n = np.zeros(len(at) - 1, np.uint64), np.diff(at)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, at[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > n[some, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def marked(text: Column) -> Column:
    """SHA-256 of a text; null for none."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, marks: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row; 0 for a text without words.  With ``marks``, also the text's own mark."""

    def run(batches):
        for b in pieces(batches, limit=PIECE):
            found = [shingle_hashes(t, shingle) for t in text_bytes(column(b, "text"))]
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
            flat = np.fromiter((h for x in found for h in x), np.uint64, at[-1])
            found = [column(b, "doc_id"), majority(flat, at).view(np.int64)]
            yield batch(MARKED, *found, column(b, "mark")) if marks else batch(PRINTS, *found)

    if marks:
        own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), marked(F.col(text_col)).alias("mark"))
        return own.mapInArrow(run, "doc_id long, fp long, mark binary")
    return two(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    cut = np.linspace(0, 64, distance // 2 + 2).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def variants(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of all fingerprints: segment's first bit, blanked bit, and the segment without it."""
    keys = []
    for first, bits in segments(distance):
        part = (fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        keys += [(part & ~np.uint64(1 << p)) | np.uint64((first << 50) | (p << 44)) for p in range(bits)]
    return np.concatenate(keys), np.tile(fps, len(keys))


def linked(key: int, x: np.ndarray, distance: int) -> np.ndarray:
    """Which differences link two fingerprints, counting each pair under one key alone.

    That key is of the first segment with at most one difference, and of that bit (or the first, if there is none).
    """
    own, bit, ok = key >> 50, (key >> 44) & 63, np.bitwise_count(x) <= distance
    for first, bits in segments(distance):
        part = (x >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        if first == own:
            return ok & ((part == 1 << bit) | (part == 0) if bit == 0 else part == 1 << bit)
        ok &= np.bitwise_count(part) > 1
    return ok


def forest(key: int, fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join all linked fingerprints of one key: one fewer than there are in each connected set."""
    out, rest = [], fps
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            one = todo.pop()
            near = linked(key, rest ^ one, distance)
            if near.any():
                out += [(one, x) for x in rest[near]]
                todo += list(rest[near])
                rest = rest[~near]
    return out


def small_pairs(run: np.ndarray, keys: np.ndarray, fps: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links within short runs: each fingerprint is compared with the next of its run, the one after that and so on."""
    out, step = [], 1
    at = np.flatnonzero(run[1:] == run[:-1])
    while len(at):
        x = fps[at] ^ fps[at + step]
        near = [i for i in at[np.bitwise_count(x) <= distance] if linked(int(keys[i]), (fps[i] ^ fps[i + step])[None], distance)[0]]
        if near:
            out.append(np.stack([fps[near], fps[np.array(near) + step]], 1))
        step += 1
        at = at[at + step < len(run)]
        at = at[run[at + step] == run[at]]
    return out


def splits(keys: np.ndarray, fps: np.ndarray, distance: int) -> pa.RecordBatch:
    """Entries of a key with too many fingerprints, once for each of ``distance + 1`` parts of the whole, of which one is equal in a linked pair."""
    cut, subs = np.linspace(0, 64, distance + 2).round().astype(int).tolist(), []
    for a, b in zip(cut, cut[1:]):
        subs.append(((fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)) | np.uint64((a + 1) << 32))
    n = len(subs)
    return batch(ENTRY, np.tile(keys, n).view(np.int64), np.concatenate(subs).view(np.int64), np.tile(fps, n).view(np.int64))


def matched(batches, distance: int, split: int | None):
    """Links among sorted index entries; entries of a key of more than ``split`` go on to be split.

    Rows are (key, a, b): a link if key is null, else an entry with its sub-key and fingerprint.
    """
    keep = np.zeros((3, 0), np.uint64)
    big = None

    def links(k, s, f):
        if not len(k):
            return
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(k)))
        run = np.repeat(np.arange(len(at)), n)
        low = n[run] <= SMALL
        pairs = small_pairs(run[low], k[low], f[low], distance)
        for i in np.flatnonzero(n > SMALL):
            found = forest(int(k[at[i]]), f[at[i] : at[i] + n[i]], distance)
            pairs += [np.array(found, np.uint64)] if found else []
        if pairs:
            p = np.concatenate(pairs)
            yield batch(FOUND, pa.nulls(len(p), pa.int64()), p[:, 0].view(np.int64), p[:, 1].view(np.int64))

    for b in batches:
        rows = np.concatenate([keep, np.stack([column(b, c).to_numpy().view(np.uint64) for c in ("key", "sub", "fp")])], 1)
        last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1]) if rows.shape[1] else np.zeros(0, bool)
        whole, keep = rows[:, ~last], rows[:, last]
        for part, ended in ((whole, True), (keep, False)):
            k, s, f = part
            if split is not None and len(k):
                over = np.isin(k, [x for x, n in zip(*np.unique(k, return_counts=True)) if n > split or x == big])
                if over.any():
                    big = k[over][-1]
                    e = splits(k[over], f[over], distance)
                    yield batch(FOUND, e.column(0), e.column(1), e.column(2))
                    k, s, f = k[~over], s[~over], f[~over]
            if ended:
                yield from links(k, s, f)
            else:
                keep = np.stack([k, s, f])
    yield from links(*keep)


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that connect all different fingerprints at most ``distance`` bits apart, not every pair."""

    def index(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                k, f = variants(column(b.slice(i, 4096), "fp").to_numpy().view(np.uint64), distance)
                yield batch(ENTRY, k.view(np.int64), np.zeros(len(k), np.int64), f.view(np.int64))

    def join(entries: DataFrame, split: int | None) -> DataFrame:
        dealt = entries.repartition("key", "sub").sortWithinPartitions("key", "sub")
        return settle(dealt.mapInArrow(lambda batches: matched(batches, distance, split), "key long, a long, b long"))

    first = join(prints.select("fp").distinct().mapInArrow(index, "key long, sub long, fp long"), SPLIT)
    second = join(first.filter("key IS NOT NULL").select("key", F.col("a").alias("sub"), F.col("b").alias("fp")), None)
    return first.filter("key IS NULL").union(second).select("a", "b")


def labelled(prints: DataFrame, distance: int, least: Column) -> DataFrame:
    """(fp, least, root): the root of each fingerprint's component, and the least value of the fingerprint's rows."""
    own = prints.groupBy("fp").agg(F.min(least).alias("least"))
    sets = components(links(prints, distance)).select(F.col("node").alias("fp"), "root")
    return settle(own.join(sets, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Fingerprint and component of every row; ``component_id`` is the smallest id reachable over links, itself included.

    A null or empty text has no words; texts without words have fingerprint 0, which links like any other.  Rows of equal text share
    a component, repeated rows are answered each.  A null id takes part and is never the smallest.  An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, id_col, text_col, shingle))
    found = labelled(prints, distance, F.col("doc_id"))
    roots = found.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = found.join(roots, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents, with all their columns, that are the first of their component; repeated rows stay once.

    One document of each component stays: that of the smallest id, where ids are equal that of the smallest mark of its text.  A document
    without an id stays only if no document of its component has one.
    """
    prints = settle(fingerprints(docs, id_col, text_col, shingle, marks=True))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = labelled(prints, distance, order).groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.mark")
    own = docs[id_col].eqNullSafe(first["doc_id"]) & marked(docs[text_col]).eqNullSafe(first["mark"])
    kept = docs.join(first, own, "left_semi")
    repeated = docs.groupBy(id_col).count().filter("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([id_col, text_col])
