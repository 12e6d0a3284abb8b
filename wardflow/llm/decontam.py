"""Benchmark decontamination by a positional inverted index.

The training texts are indexed shard by shard: for every term the sorted positions where it stands.  The index is stored, and then read once for
each block of the benchmark, without the texts.  A benchmark window is looked up from its rarest term in the shard: the rarest term's
positions, less the term's offset in the window, are the possible starts, and they are intersected with the equally adjusted positions of the next rarest
term and so on.  What is left after all terms are the exact phrases; with a tolerance, the rarest terms alone give proximity matches.

The benchmark is cut into parts of bounded length that share no window, which are written once and dealt to blocks of bounded size, so a long item lies in
many.  One block at a time comes to the driver and goes to all tasks; its matches are written and it is let go before the next.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import batch, column, grow, pieces, shrink, text_bytes, two
from wardflow.session import settle

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Windows of a part of a benchmark item.
PART_WINDOWS = 4096
#: Bytes of text of a shard of the index.
SHARD_BYTES = 2 << 20
#: Possible starts looked at in one go.
STARTS = 1 << 20
#: Rarest terms of a window that a proximity match needs.
RARE = 3
#: Word characters are digits, a-z and all beyond ASCII; A-Z are lowered, the rest separates.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
PARTS = pa.schema([("item", pa.string()), ("data", pa.binary())])
INDEX = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("valid", pa.binary()), ("counts", pa.binary()), ("terms", pa.binary()), ("terms_size", pa.int64()), ("sizes", pa.binary()), ("places", pa.binary()), ("places_size", pa.int64())])
INDEX_SQL = "shard long, ids binary, valid binary, counts binary, terms binary, terms_size long, sizes binary, places binary, places_size long"
FOUND = pa.schema([("shard", pa.int64()), ("spans", pa.binary()), ("near", pa.binary()), ("items", pa.list_(pa.struct([("doc", pa.int32()), ("item", pa.string())])))])
FOUND_SQL = "shard long, spans binary, near binary, items array<struct<doc: int, item: string>>"
REPORT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("n_near", pa.int64())])


def words(text: bytes) -> list[bytes]:
    # only blanks are left between words, as no other white space survives the table
    return text.translate(TO_WORDS).split()


@dataclass
class Block:
    """Windows of some benchmark items: term numbers (-1 beyond a short window's end), lengths, and the items that hold each."""

    terms: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def build_block(items: list[tuple[str, bytes]], window: int) -> Block:
    terms: dict[bytes, int] = {}
    holders: dict[tuple, set[str]] = {}
    for item, text in items:
        ids = [terms.setdefault(w, len(terms)) for w in text.split(b" ")]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            holders.setdefault(tuple(ids[i : i + window]), set()).add(item)
    lengths = np.array([len(w) for w in holders], np.int64)
    table = np.full((len(holders), window), -1, np.int64)
    for row, w in zip(table, holders):
        row[: len(w)] = w
    return Block(terms, table, lengths, [sorted(x) for x in holders.values()])


@dataclass
class Benchmark:
    """Parts of benchmark items, as rows of the item and its words, dealt to ``n`` blocks."""

    parts: DataFrame
    n: int
    window: int

    def block(self, i: int) -> Block:
        """One block; only its parts are read."""
        part = F.pmod(F.xxhash64("item", "data"), F.lit(self.n))
        return build_block([(r["item"], bytes(r["data"])) for r in self.parts.filter(part == i).collect()], self.window)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Benchmark:
    """The benchmark in blocks of about ``block_bytes`` of words; an item's parts are dealt each by itself, and no two of them hold one window of it."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def cut(batches):
        for b in pieces(batches):
            out = []
            for item, text in zip(column(b, "item").to_pylist(), text_bytes(column(b, "text"))):
                own = words(text)
                for i in range(0, max(1, len(own) - window + 1) if own else 0, PART_WINDOWS):
                    out.append((item, b" ".join(own[i : i + PART_WINDOWS + window - 1])))
            if out:
                yield batch(PARTS, *zip(*out))

    parts = settle(rows.mapInArrow(cut, "item string, data binary"))
    size = parts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    return Benchmark(parts, -(-size // block_bytes), window)


class Postings:
    """The terms of one shard of texts, and for each the sorted positions where it stands; positions count through all texts."""

    def __init__(self, counts: np.ndarray, terms: list[bytes], sizes: np.ndarray, places: np.ndarray):
        self.counts, self.terms, self.sizes, self.places = counts, terms, sizes, places

    @staticmethod
    def of(texts: list[bytes]) -> "Postings":
        number: dict[bytes, int] = {}
        found = [[number.setdefault(w, len(number)) for w in words(t)] for t in texts]
        counts = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter((i for x in found for i in x), np.int64, int(counts.sum()))
        return Postings(counts, list(number), np.bincount(ids, minlength=len(number)), np.argsort(ids, kind="stable"))

    def stored(self) -> tuple:
        """Counts, terms, sizes and places; a term's places as steps from one to the next, which compress well."""
        steps = np.diff(self.places, prepend=0).astype("<i4").tobytes()
        terms = b"\n".join(self.terms)
        return (self.counts.astype("<i4").tobytes(), shrink(terms), len(terms), self.sizes.astype("<i4").tobytes(), shrink(steps), len(steps))

    @staticmethod
    def read(counts: bytes, terms: bytes, terms_size: int, sizes: bytes, places: bytes, places_size: int) -> "Postings":
        listed = grow(terms, terms_size).split(b"\n") if terms_size else []
        steps = np.frombuffer(grow(places, places_size), "<i4") if places_size else np.zeros(0, "<i4")
        return Postings(np.frombuffer(counts, "<i4").astype(np.int64), listed, np.frombuffer(sizes, "<i4").astype(np.int64), np.cumsum(steps, dtype=np.int64))


class Lists:
    """The postings of a block's terms in one shard, as sorted (term, position) codes."""

    def __init__(self, shard: Postings, terms: dict[bytes, int]):
        self.at = np.concatenate([[0], np.cumsum(shard.counts)]).astype(np.int64)
        self.n, self.doc = int(self.at[-1]), np.repeat(np.arange(len(shard.counts)), shard.counts)
        both = sorted((terms[w], i) for i, w in enumerate(shard.terms) if w in terms)
        asked, own = (np.array(x, np.int64) for x in zip(*both)) if both else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        n, start = shard.sizes[own], (np.cumsum(shard.sizes) - shard.sizes)[own]
        spot = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        self.codes = np.repeat(asked, n) * self.n + shard.places[spot]
        self.first = np.searchsorted(self.codes, np.arange(len(terms) + 1) * self.n)

    def holds(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a term has a position in low..high."""
        i = np.searchsorted(self.codes, term * self.n + np.maximum(low, 0))
        found = self.codes[np.minimum(i, len(self.codes) - 1)] if len(self.codes) else i
        return (i < len(self.codes)) & (found <= term * self.n + np.minimum(high, self.n - 1))


def lookup(index: Lists, block: Block, slop: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, start) of exact phrases and, with a tolerance, of proximity matches that are not exact."""
    out = [[], [], [], []]
    if not index.n or not len(block.lengths):
        return tuple(np.zeros(0, np.int64) for _ in out)
    df = np.diff(index.first)
    sizes = np.where(block.windows >= 0, df[block.windows], np.iinfo(np.int64).max)
    order = np.argsort(sizes, 1, kind="stable")
    rarest = sizes[np.arange(len(sizes)), order[:, 0]]
    alive = np.flatnonzero(rarest)
    upto = np.cumsum(rarest[alive])
    for part in np.split(alive, np.searchsorted(upto, np.arange(STARTS, upto[-1] if len(upto) else 0, STARTS))):
        if not len(part):
            continue
        n = rarest[part]
        win = np.repeat(part, n)
        step = np.arange(len(win)) - np.repeat(np.cumsum(n) - n, n)
        term = block.windows[win, order[win, 0]]
        start = index.codes[index.first[term] + step] - term * index.n - order[win, 0]
        end = start + block.lengths[win] - 1
        ok = (start >= 0) & (end < index.n)
        ok[ok] = index.doc[start[ok]] == index.doc[end[ok]]
        w, s, near = win[ok], start[ok], np.ones(int(ok.sum()), bool)
        exact = near.copy()
        for k in range(1, block.windows.shape[1]):
            at = order[w, k]
            t = block.windows[w, at]
            has = k < block.lengths[w]
            look = has & (exact | near) if slop is not None and k < RARE else has & exact
            go = np.flatnonzero(look)
            if not len(go):
                break
            spot = s[go] + at[go]
            if slop is not None and k < RARE:
                near[go] &= index.holds(t[go], spot - slop, spot + slop)
            exact[go] &= index.holds(t[go], spot, spot)
            if slop is None and not exact.all():
                w, s, exact, near = w[exact], s[exact], exact[exact], near[exact]
        out[0].append(w[exact]), out[1].append(s[exact])
        if slop is not None:
            out[2].append(w[near & ~exact]), out[3].append(s[near & ~exact])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def index_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index, one row for each shard of at most SHARD_BYTES of text (or one text): its documents, terms and postings."""

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        for i, b in enumerate(pieces(batches, limit=SHARD_BYTES)):
            ids = column(b, "doc_id")
            own = (shard + i, ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_valid().to_numpy(zero_copy_only=False).tobytes())
            yield batch(INDEX, *zip((*own, *Postings.of(text_bytes(column(b, "text"))).stored())))

    rows = two(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, INDEX_SQL)


def search(index: DataFrame, block: Block, slop: int | None):
    """One block's matches in each shard that has some: (document, start, end) of exact phrases and of proximity matches, and (document, item); and what was sent."""
    sent = index.sparkSession.sparkContext.broadcast(vars(block))

    def run(batches):
        block = Block(**sent.value)
        for b in batches:
            for row in b.to_pylist():
                lists = Lists(Postings.read(*(row[c] for c in INDEX.names[3:])), block.terms)
                win, start, near_win, near_start = lookup(lists, block, slop)
                places = []
                for wins, starts in ((win, start), (near_win, near_start)):
                    doc = lists.doc[starts]
                    low = starts - lists.at[doc]
                    places.append(np.stack([doc, low, low + block.lengths[wins]], 1).astype("<i4").tobytes())
                named = {(int(d), x) for d, w in set(zip(lists.doc[start].tolist(), win.tolist())) for x in block.items[w]}
                if any(places):
                    yield batch(FOUND, [row["shard"]], [places[0]], [places[1]], [[{"doc": d, "item": x} for d, x in sorted(named)]])

    return index.mapInArrow(run, FOUND_SQL), sent


def contamination(docs: DataFrame, benchmark: Benchmark, id_col: str = "doc_id", text_col: str = "text", slop: int | None = None) -> DataFrame:
    """Words of every row that lie inside any occurrence of a benchmark window, and the items these are of.

    An item of fewer words than a window is one window; one without words is none.  A null or empty text has no words and no
    hits; without a benchmark nothing is hit.  Windows that several items share name them all; null item ids count as
    empty text.  ``n_near`` counts proximity matches: places where a window's rarest terms stand within ``slop`` words of their
    place, but not the whole phrase.  Repeated rows are answered each.  The index is written to the shared folder, and so are each block's
    matches; texts are not shuffled, only matches by shard.
    """
    index = settle(index_postings(docs, id_col, text_col))
    rows = index.select("shard", "ids", "valid", "counts", F.lit(None).cast("binary").alias("spans"), F.lit(None).cast("binary").alias("near"), F.lit(None).cast("array<struct<doc: int, item: string>>").alias("items"))
    for i in range(benchmark.n):
        matches, sent = search(index, benchmark.block(i), slop)
        rows = rows.unionByName(settle(matches), allowMissingColumns=True)
        sent.destroy()

    def report(table: pa.Table) -> pa.Table:
        own = [r for r in table.to_pylist() if r["ids"] is not None][0]
        found = [r for r in table.to_pylist() if r["ids"] is None]
        ids, valid, counts = np.frombuffer(own["ids"], "<i8"), np.frombuffer(own["valid"], bool), np.frombuffer(own["counts"], "<i4").astype(np.int64)
        at = np.concatenate([[0], np.cumsum(counts)])
        doc, low, high = np.frombuffer(b"".join(r["spans"] for r in found), "<i4").reshape(-1, 3).T
        edges = np.bincount(at[doc] + low, minlength=at[-1] + 1) - np.bincount(at[doc] + high, minlength=at[-1] + 1)
        hit = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
        items: list[set] = [set() for _ in counts]
        for x in (x for r in found for x in r["items"]):
            items[x["doc"]].add(x["item"])
        near = np.bincount(np.frombuffer(b"".join(r["near"] for r in found), "<i4").reshape(-1, 3)[:, 0], minlength=len(counts))
        return pa.Table.from_batches([batch(REPORT, pa.array(ids, pa.int64(), mask=~valid), counts, hit[at[1:]] - hit[at[:-1]], [sorted(x) for x in items], near)])

    return rows.groupBy("shard").applyInArrow(report, "doc_id long, n_words long, n_hit long, items array<string>, n_near long")


def keep_clean(docs: DataFrame, benchmark: Benchmark, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark.

    A shard's postings are asked for one block and let go, so they are not stored; the documents stay where they are, and are written between blocks.
    """
    for i in range(benchmark.n):
        sent = docs.sparkSession.sparkContext.broadcast(vars(benchmark.block(i)))

        def run(batches, sent=sent):
            block = Block(**sent.value)
            for b in pieces(batches, text_col):
                lists = Lists(Postings.of(text_bytes(column(b, text_col))), block.terms)
                hit = np.zeros(b.num_rows, bool)
                hit[lists.doc[lookup(lists, block, None)[1]]] = True
                yield b.filter(pa.array(~hit))

        docs = docs.mapInArrow(run, docs.schema)
        if i + 1 < benchmark.n:
            docs = settle(docs)
            sent.destroy()
    return docs
