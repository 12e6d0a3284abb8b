"""Harmonic packing of token sequences.

A document that fits a sequence stays whole.  Its length puts it into a reciprocal class: lengths over a (k+1)-th and up to a k-th of a
sequence are class k, and k documents of one class make a bin.  A task fills the bins of each class by itself, without knowing of
other tasks.  Longer documents are cut into full sequences; their rests are filler.

What a full bin leaves free is filled by filler, cut where the sequence is full.  Where filler is short, the emptiest bins that wait are
taken apart to fill the others; where it is plenty, it is laid end to end.  So only the last sequence of a task is short, and only filler is cut.
"""

from __future__ import annotations

import os
import re
from bisect import insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wardflow.llm.common import batch, column, pieces, two

CAPACITY = 2048
#: Bins that may wait for filler, and sequences of filler that may wait for bins, in one task.
WAITING = 256
END_ID = 1
CACHED_WORDS = 400_000
SEGMENT = 1 << 20
WORD_END = "</w>"
#: Letters whose lower case is one letter and that no normal form joins or splits, then punctuation that is a token of its own.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")])


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next from 256 on."""
    shown = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    return [chr(b) if shown[b] else chr(256 + shown[:b].count(False)) for b in range(256)]


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """A text cut at spaces into segments of about ``size`` characters."""
    i = 0
    while i < len(text):
        j = text.find(" ", i + size)
        j = len(text) if j < 0 else j
        yield text[i:j]
        i = j


class WordIds:
    """Token ids of a text as little-endian 32-bit bytes.

    The tokenizer never joins characters across white space, nor letters and punctuation, so a text's ids are those of
    its words, one after the other, and words seen before come from a dictionary of bounded size.  New words of
    plain letters are encoded many at a time by the ranks of the same vocabulary, with a mark for the word's end, which gives the same
    ids; all others go through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks, byte = {}, {c: b for b, c in enumerate(byte_letters())}
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            if all(c in byte for c in token.removesuffix(WORD_END)):
                last = token.endswith(WORD_END)
                ranks[bytes(byte[c] for c in token.removesuffix(WORD_END)) + b"\0" * last] = i
                self.ends[i] = last
        self.ranks = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})

    def learn(self, words: list[str]) -> None:
        plain, other = [], []
        for w in words:
            (plain if (m := PLAIN.fullmatch(w)) else other).append(m or w)
        other += {m[2] for m in plain}.difference(self.known)
        for i in range(0, len(other), 4096):
            some = other[i : i + 4096]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[w] = np.array(e.ids, "<u4").tobytes()
        if plain:
            ids = np.array(self.ranks.encode_ordinary("\0".join([m[1] for m in plain]).lower() + "\0"), "<u4")
            flat, start = ids.tobytes(), 0
            for m, end in zip(plain, (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()):
                self.known[m[0]] = flat[start:end] + self.known[m[2]]
                start = end

    def __call__(self, text: str) -> bytes:
        out = []
        for part in segments(text):
            words = part.replace("\n", " ").split(" ")
            new = set(words).difference(self.known)
            if len(self.known) + 2 * len(new) > CACHED_WORDS:
                self.known.clear()
                new = set(words)
            self.learn(list(new))
            out.append(b"".join(map(self.known.__getitem__, words)))
        return b"".join(out)


class Bins:
    """The open bins of one task; finished sequences come out as rows (doc_id, start, length, ids, doc_tokens, sequence_id, offset)."""

    def __init__(self, capacity: int, first: int, waiting: int = WAITING):
        self.capacity, self.next, self.most = capacity, first, waiting
        #: Pieces (doc_id, start, ids, doc_tokens), by class; full bins with room, emptiest last; filler and its tokens.
        self.open: dict[int, list[tuple]] = {}
        self.waiting: list[tuple[int, list[tuple]]] = []
        self.filler: deque[tuple] = deque()
        self.free = 0

    def add(self, doc_id, ids: bytes) -> list[tuple]:
        """A whole document; rows of what is finished by it."""
        total, rows, start = len(ids) // 4, [], 0
        if total > self.capacity:
            while total - start >= self.capacity:
                rows += self.laid([(doc_id, start, ids[4 * start : 4 * (start + self.capacity)], total)])
                start += self.capacity
            if start < total:
                self.fill_with((doc_id, start, ids[4 * start :], total))
        else:
            size = self.capacity // total
            bin_ = self.open.setdefault(size, [])
            bin_.append((doc_id, 0, ids, total))
            if len(bin_) == size:
                del self.open[size]
                insort(self.waiting, (self.room(bin_), bin_), key=lambda w: w[0])
        return rows + self.settled()

    def room(self, bin_: list[tuple]) -> int:
        return self.capacity - sum(len(p[2]) for p in bin_) // 4

    def fill_with(self, piece: tuple) -> None:
        self.filler.append(piece)
        self.free += len(piece[2]) // 4

    def settled(self) -> list[tuple]:
        rows = []
        # The fullest bins first, which need least.
        while self.waiting and (self.waiting[0][0] <= self.free or len(self.waiting) > self.most):
            if self.waiting[0][0] > self.free:
                for piece in self.waiting.pop()[1]:
                    self.fill_with(piece)
            else:
                room, bin_ = self.waiting.pop(0)
                rows += self.laid(bin_ + self.taken(room))
        while self.most and self.free >= self.most * self.capacity:
            rows += self.laid(self.taken(self.capacity))
        return rows

    def taken(self, room: int) -> list[tuple]:
        """So many tokens of filler, or all there are."""
        out = []
        while room and self.filler:
            doc_id, start, ids, total = self.filler.popleft()
            n = min(room, len(ids) // 4)
            out.append((doc_id, start, ids[: 4 * n], total))
            if 4 * n < len(ids):
                self.filler.appendleft((doc_id, start + n, ids[4 * n :], total))
            room, self.free = room - n, self.free - n
        return out

    def laid(self, pieces_: list[tuple]) -> list[tuple]:
        at, rows = 0, []
        for doc_id, start, ids, total in pieces_:
            rows.append((doc_id, start, len(ids) // 4, ids, total, self.next, at))
            at += len(ids) // 4
        self.next += 1
        return rows

    def rest(self) -> list[tuple]:
        """All that is left: bins of too few documents become filler, longest pieces first, and then the emptiest bins that wait."""
        for size in sorted(self.open):
            for piece in self.open[size]:
                self.fill_with(piece)
        self.open.clear()
        self.most = 0
        rows = self.settled()
        while self.filler:
            rows += self.laid(self.taken(self.capacity))
        return rows


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, each with its ids (little-endian, 32 bits), its sequence and its place there.

    ``tokenizer`` is the path of a word-end BPE file.  A null or empty text has the end id alone.  Rows of equal id or text
    are packed each by itself; a null id stays null; an empty table gives no rows.  There is no shuffle.  Sequence
    ids hold the task's number in their upper bits: a task that is run again on the same input gives the same rows.
    """

    def run(batches):
        ids_of, end = WordIds(tokenizer), END_ID.to_bytes(4, "little")
        bins, rows = Bins(capacity, TaskContext.get().partitionId() << 40), []
        for b in pieces(batches):
            for doc_id, text in zip(column(b, "doc_id").to_pylist(), column(b, "text").to_pylist()):
                rows += bins.add(doc_id, ids_of(text) + end)
                if len(rows) > 4_000:
                    yield batch(ARROW, *zip(*rows))
                    rows = []
        if rows := rows + bins.rest():
            yield batch(ARROW, *zip(*rows))

    return two(docs, id_col, text_col).mapInArrow(run, SCHEMA)
