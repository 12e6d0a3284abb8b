"""Token counts of every prefix of a text, by dynamic programming over the last piece.

The byte-pair encoding of a prefix ends with one piece, and what stands before that piece is the encoding of a shorter prefix.  So the
last piece of a prefix is the one that ends there and forms, with the last piece of the prefix before it, a pair that encoding leaves as it is; the
count is one more than that prefix's.  Counts are kept for every prefix, as steps from one code point to the next, and truncation
and budget questions are sums of them.

Texts are cut where no piece holds both neighbouring characters: no merge crosses such a place, nor does it in any prefix.
A segment's steps depend on the segment alone; those seen are remembered, and the new ones of many texts are solved together,
one place at a time.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import batch, column, grow, offsets, pieces, shrink, two
from wardflow.llm.hashing import representatives

SPACE = "▁"
#: Segments remembered by a task, and bits of the table of pairs it has judged.
SEGMENTS, PAIR_BITS = 400_000, 20
#: Longer segments are solved by themselves.
LONG = 48
#: Characters of new segments solved at once.
SOLVED = 1 << 18
NEVER = 1 << 40
SCHEMA = "doc_id long, n_bytes long, n_chars long, n_tokens long"
COUNTS = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_chars", "n_tokens")])
STEPS = COUNTS.append(pa.field("steps", pa.binary()))
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5


def merged(text: str, score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """The pieces of a text, by merging the best pair, the first of equals, until none is left; and the last pair merged."""
    parts, last = list(text), None
    while pairs := [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]:
        i = min(pairs)[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


def load(path: str) -> dict[str, float]:
    """Scores of the pieces that texts are merged to.

    The vocabulary has to be byte-pair with byte fallback, without normal forms, each of its pieces its own encoding and each of its characters a piece; else an error says so.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    form, kind = model.normalizer_spec, model.trainer_spec
    plain = not form.precompiled_charsmap and form.add_dummy_prefix and form.escape_whitespaces and not form.remove_extra_whitespaces
    if kind.model_type != kind.BPE or not kind.byte_fallback or kind.treat_whitespace_as_suffix or not plain or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
        raise ValueError(f"{path}: only byte-pair vocabularies with byte fallback, a leading blank and no normal form are supported")
    score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
    if any(c not in score for t in score for c in t) or any(merged(t, score)[0] != [t] for t in score):
        raise ValueError(f"{path}: a piece is not its own encoding")
    return score


class Vocabulary:
    """The pieces as arrays.

    ``rank`` is the order in which pieces are merged, less than 0 for single characters; ``left`` and ``right`` are the parts of a piece's last merge.  A piece is
    ``plain`` if it is merged after its parts and no other has its rank.
    """

    def __init__(self, score: dict[str, float]):
        self.score = score
        self.text = sorted(score, key=lambda t: (len(t), -score[t], t))
        self.ids = {t: i for i, t in enumerate(self.text)}
        ids, n = self.ids, len(self.text)
        order = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        often: dict[float, int] = {}
        for t in self.text:
            often[score[t]] = often.get(score[t], 0) + (len(t) > 1)
        self.rank = np.array([-1 if len(t) == 1 else order[score[t]] for t in self.text], np.int64)
        self.left, self.right, self.plain = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
        for i, t in enumerate(self.text):
            if len(t) > 1:
                a, b = (ids[x] for x in merged(t, score)[1])
                self.left[i], self.right[i] = a, b
                self.plain[i] = often[score[t]] == 1 and self.plain[a] and self.plain[b] and self.rank[i] > max(self.rank[a], self.rank[b])
        pairs = sorted((ids[t[:i]] << 32 | ids[t[i:]], self.rank[ids[t]]) for t in self.text for i in range(1, len(t)) if t[:i] in ids and t[i:] in ids)
        self.pairs, self.pair_rank = (np.array([p[k] for p in pairs] + [NEVER << 22][: 1 - k] + [NEVER][: k], np.int64) for k in (0, 1))
        self.longest = max(map(len, self.text), default=1)
        self._characters()
        self._tree()

    def _characters(self) -> None:
        """A small number for each code point, 0 if no piece holds it, and a bit for each two characters that some piece holds side by side."""
        number = {c: i for i, c in enumerate(sorted({c for t in self.text for c in t}), 1)}
        self.number, self.width = np.zeros(0x110000, np.uint16), len(number) + 1
        for c, i in number.items():
            self.number[ord(c)] = i
        beside = np.zeros(self.width**2, bool)
        for pair in {t[i : i + 2] for t in self.text for i in range(len(t) - 1)}:
            beside[number[pair[0]] * self.width + number[pair[1]]] = True
        self.beside = np.packbits(beside, bitorder="little")
        self.letters = "\0" + "".join(number)

    def _tree(self) -> None:
        """The pieces as a tree: the next node of each node that has any, for each character's column, and each node's piece.  Node 0 is none, node 1 the root."""
        starts = {t[:i] for t in self.text for i in range(1, len(t) + 1)}
        inner = {t[:-1] for t in starts if len(t) > 1}
        ordered = sorted(starts, key=lambda t: (t not in inner, len(t), t))
        node = {"": 1} | {t: i for i, t in enumerate(ordered, 2)}
        later = sorted({t[-1] for t in starts if len(t) > 1})
        self.columns = np.zeros(self.width, np.int64)
        for i, c in enumerate(later, 1):
            self.columns[self.number[ord(c)]] = i
        self.first = np.zeros(self.width, np.int64)
        self.inner = len(inner) + 2
        self.edges = np.array([(node[t[:-1]], self.columns[self.number[ord(t[-1])]], node[t]) for t in ordered if len(t) > 1], np.int64).reshape(-1, 3)
        self.piece = np.full(len(node) + 1, -1, np.int64)
        for t in ordered:
            if len(t) == 1:
                self.first[self.number[ord(t)]] = node[t]
            self.piece[node[t]] = self.ids.get(t, -1)


class Prefixes:
    """Steps of token counts for texts, with what a task remembers."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        self.next = np.zeros((v.inner, int(v.columns.max(initial=0)) + 1), np.int32)
        self.next[v.edges[:, 0], v.edges[:, 1]] = v.edges[:, 2]
        self.known: dict[bytes, np.ndarray] = {}
        self.judged, self.verdict = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.stays = lru_cache(1 << 16)(self._stays)

    def _stays(self, a: int, b: int) -> bool:
        x, y = self.v.text[a], self.v.text[b]
        return merged(x + y, self.v.score)[0] == [x, y]

    def pairs_stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether encoding leaves the pieces a and b, side by side, as they are."""
        key = a << 32 | b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        new = np.flatnonzero(self.judged[slot] != key)
        out = self.verdict[slot]
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            judged = self.judge(keys >> 32, keys & 0xFFFFFFFF)
            out[new] = judged[back]
            at = slot[new]
            self.judged[at], self.verdict[at] = key[new], out[new]
            # Where two keys took one slot, the later stays; its verdict has to be its own.
            lost = self.judged[at] != key[new]
            self.verdict[at[~lost]] = out[new[~lost]]
        return out

    def judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Follow the parts of a along its right edge and of b along its left, from the last merge backwards.

        The two pieces at the border are there together until one is merged away; a merge of both that comes first, or, on the left's side of equal ranks, at the same time, breaks the pair.
        """
        v = self.v
        out = np.ones(len(a), bool)
        odd = ~(v.plain[a] & v.plain[b])
        for i in np.flatnonzero(odd):
            out[i] = self.stays(int(a[i]), int(b[i]))
        on = np.flatnonzero(~odd)
        x, y = a[on], b[on]
        until_x, until_y = np.full(len(on), NEVER), np.full(len(on), NEVER)
        while len(on):
            key = x << 32 | y
            at = np.searchsorted(v.pairs, key)
            r = np.where(v.pairs[at] == key, v.pair_rank[at], NEVER)
            broken = (r < until_x) & (r <= until_y) & (r < NEVER)
            out[on[broken]] = False
            rx, ry = v.rank[x], v.rank[y]
            go = ~broken & ((rx >= 0) | (ry >= 0))
            on, x, y, rx, ry, until_x, until_y = (z[go] for z in (on, x, y, rx, ry, until_x, until_y))
            back = rx > ry
            until_x, until_y = np.where(back, rx, until_x), np.where(back, until_y, ry)
            x, y = np.where(back, v.right[x], x), np.where(back, y, v.left[y])
        return out

    def solve(self, chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Token counts after each character of the segments that lie one after the other."""
        v, n = self.v, len(chars)
        most = int(min(length.max(), v.longest))
        inside = np.repeat(start + length, length)
        ends = np.full((most, n), -1, np.int32)
        at, node = np.arange(n), v.first[chars]
        for k in range(most):
            ends[k, at + k] = v.piece[node]
            on = (node < v.inner) & (at + k + 1 < inside[at])
            at, node = at[on], node[on]
            node = self.next[node, v.columns[chars[at + k + 1]]].astype(np.int64)
            at, node = at[node > 0], node[node > 0]
        last, count = np.full(n, -1, np.int64), np.zeros(n, np.int32)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        for p in range(int(length[0])):
            here = start[: np.searchsorted(-length, -p, "left")] + p
            for k in reversed(range(min(p + 1, most))):
                piece = ends[k, here].astype(np.int64)
                at = np.flatnonzero(piece >= 0)
                if k == p:
                    last[here[at]], count[here[at]] = piece[at], 1
                else:
                    before = here[at] - k - 1
                    fits = self.pairs_stay(last[before], piece[at])
                    last[here[at[fits]]], count[here[at[fits]]] = piece[at[fits]], count[before[fits]] + 1
                    at = at[fits]
                here = np.delete(here, at)
                if not len(here):
                    break
        return count

    def solve_long(self, text: str) -> np.ndarray:
        """The same for one segment of any length."""
        ids, last, count = self.v.ids, [], np.zeros(len(text), np.int32)
        for p in range(len(text)):
            for k in range(max(0, p + 1 - self.v.longest), p + 1):
                piece = ids.get(text[k : p + 1], -1)
                if piece >= 0 and (k == 0 or self.stays(last[k - 1], piece)):
                    last.append(piece)
                    count[p] = count[k - 1] + 1 if k else 1
                    break
        return count

    def learn(self, keys: list[bytes]) -> None:
        short = [k for k in keys if len(k) <= 2 * LONG]
        i = 0
        while i < len(short):
            j, size = i, 0
            while j < len(short) and size < SOLVED:
                size += len(short[j]) // 2
                j += 1
            some = short[i:j]
            length = np.array([len(k) // 2 for k in some])
            at = np.concatenate([[0], np.cumsum(length)])
            count = self.solve(np.frombuffer(b"".join(some), np.uint16), at[:-1], length)
            steps = np.diff(count, prepend=0)
            steps[at[1:-1]] = count[at[1:-1]]
            steps = steps.astype(np.int16)
            for k, a, b in zip(some, at[:-1].tolist(), at[1:].tolist()):
                self.known[k] = steps[a:b].copy()
            i = j
        for k in keys:
            if len(k) > 2 * LONG:
                self.known[k] = np.diff(self.solve_long("".join(map(self.v.letters.__getitem__, np.frombuffer(k, np.uint16)))), prepend=0).astype(np.int16)

    def steps(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The steps of all texts, one for each code point and one more for a text's leading blank, and where each text starts (and the last ends)."""
        v = self.v
        own = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        at = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
        codes = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int16), at
        chars = v.number[codes]
        pair = chars[:-1].astype(np.int64) * v.width + chars[1:]
        cut = np.concatenate([[True], (v.beside[pair >> 3] >> (pair & 7).astype(np.uint8)) & 1 == 0])
        cut[at[at < len(codes)]] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.concatenate([start, [len(codes)]]))
        holder = representatives(chars.view(np.uint8), 2 * start, 2 * length)
        heads = np.flatnonzero(holder == np.arange(len(start)))
        keys = [chars[a:b].tobytes() for a, b in zip(start[heads].tolist(), (start[heads] + length[heads]).tolist())]
        new = [k for k in keys if k not in self.known]
        if len(self.known) + len(new) > SEGMENTS:
            self.known.clear()
            new = keys
        self.learn([k for k in new if k != b"\0\0"])
        self.known[b"\0\0"] = np.zeros(1, np.int16)
        found = [self.known[k] for k in keys]
        offset = np.zeros(len(start), np.int64)
        offset[heads] = np.concatenate([[0], np.cumsum(length[heads])])[:-1]
        out = np.concatenate(found)[np.repeat(offset[holder] - start, length) + np.arange(len(codes))]
        # A character that no piece holds is a token for each of its bytes.
        odd = chars == 0
        c = codes[odd]
        out[odd] = 1 + (c > 0x7F).astype(np.int16) + (c > 0x7FF) + (c > 0xFFFF)
        return out, at


def _counted(docs: DataFrame, path: str, id_col: str, text_col: str, keep: bool) -> DataFrame:
    spark = docs.sparkSession
    # A vocabulary, of fixed size.
    sent = spark.sparkContext.broadcast(vars(Vocabulary(load(path))))

    def run(batches):
        vocabulary = Vocabulary.__new__(Vocabulary)
        vars(vocabulary).update(sent.value)
        prefixes = Prefixes(vocabulary)
        for b in pieces(batches):
            texts = column(b, "text")
            steps, at = prefixes.steps(texts.to_pylist())
            total = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
            size = np.diff(at)
            rows = [column(b, "doc_id"), np.diff(offsets(texts)), np.maximum(size - 1, 0), total[at[1:]] - total[at[:-1]]]
            if keep:
                yield batch(STEPS, *rows, [_stored(steps[i:j]) for i, j in zip(at[:-1], at[1:])])
            else:
                yield batch(COUNTS, *rows)

    rows = two(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA + (", steps binary" if keep else ""))


def _stored(steps: np.ndarray) -> bytes:
    """One step for each code point; the leading blank counts with the first."""
    out = steps[1:].astype("<i2")
    if len(out):
        out[0] += steps[0]
    return shrink(out.tobytes()) if len(out) else b""


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every document its bytes, code points and tokens, and the steps of the token count from prefix to prefix.

    ``path`` is a byte-pair vocabulary file, read by the driver.  A null text is empty and has no tokens; repeated rows and null ids are
    counted row by row; there is no shuffle, and an empty table gives no rows.  A text of any length is held once, with eight bytes or so a character.
    """
    return _counted(docs, path, id_col, text_col, True)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``prefix_counts``, without the steps."""
    return _counted(docs, path, id_col, text_col, False)


def counts_of(steps: bytes, n_chars: int) -> np.ndarray:
    """Token counts of all prefixes, from the empty one on."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(grow(steps, 2 * n_chars), "<i2"), dtype=np.int64)])


def tokens_at(stored: DataFrame, places: Column) -> DataFrame:
    """Rows of ``prefix_counts`` with ``tokens``: the count of the prefix of each length, in code points, of the array ``places``; null beyond the text."""

    def run(batches):
        for b in pieces(batches, "steps"):
            out = []
            for steps, n, at in zip(column(b, "steps").to_pylist(), column(b, "n_chars").to_pylist(), column(b, "places").to_pylist()):
                count = counts_of(steps, n)
                out.append(None if at is None else [int(count[k]) if k is not None and 0 <= k <= n else None for k in at])
            yield batch(pa.schema([("doc_id", pa.int64()), ("tokens", pa.list_(pa.int64()))]), column(b, "doc_id"), out)

    return stored.select("doc_id", "n_chars", "steps", places.cast("array<long>").alias("places")).mapInArrow(run, "doc_id long, tokens array<long>")


def longest_prefixes(stored: DataFrame, budgets: list[int]) -> DataFrame:
    """For each document and budget, the code points of the longest prefix of at most so many tokens, and its tokens.

    A longer prefix may have fewer tokens than a shorter one, so all prefixes are looked at.  Nothing is encoded again.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "budget", "n_chars", "n_tokens")])

    def run(batches):
        for b in pieces(batches, "steps"):
            out = []
            for doc, steps, n in zip(column(b, "doc_id").to_pylist(), column(b, "steps").to_pylist(), column(b, "n_chars").to_pylist()):
                count = counts_of(steps, n)
                for budget in budgets:
                    fit = np.flatnonzero(count <= budget)
                    if len(fit):
                        out.append((doc, budget, int(fit[-1]), int(count[fit[-1]])))
            if out:
                yield batch(schema, *zip(*out))

    return stored.select("doc_id", "n_chars", "steps").mapInArrow(run, "doc_id long, budget long, n_chars long, n_tokens long")
