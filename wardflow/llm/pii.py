"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field's labels are the kinds and "none".  It is trained on a small table of labelled lines: words, and a label
for each.  It sees only the shape of a word and of its neighbours, so it finds what looks like personal data in its surroundings
but is missed by a pattern, such as two numbers run together.  Beside the lines that the patterns label stand copies in which a labelled span has lost
what its pattern needs, under the same label.  Decoding is Viterbi over whole lines of any length, many at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import batch, column, pieces, text_bytes, two
from wardflow.llm.spans import ARROW as SPAN_LIST, SPANS, Span, ordered

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
#: Expected number of documents in the labelled table.
SAMPLE_DOCS = 3000
#: How much better than "none" a labelling has to be, in nats for each word: the least of these that on held-out lines marks at most
#: ``MOST_WRONG`` unlabelled words for each labelled one it finds.
MARGINS, MOST_WRONG = (0.5, 1.0, 2.0, 4.0), 0.002
ARROW = pa.schema([("doc_id", pa.int64()), ("base", SPAN_LIST), ("spans", SPAN_LIST)])

# Patterns of the base kinds, over bytes.  Possessive forms and the look-behind only spare retries that must fail.
DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def emails(text: bytes) -> list[tuple[int, int]]:
    """For each @, the run of name characters before it and the domain after it; never before the end of the last match."""
    out, end, at = [], 0, text.find(b"@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at)
        at = text.find(b"@", max(end, at + 1))
    return out


def luhn(digits: bytes) -> bool:
    d = [c - 48 for c in digits[::-1]]
    return (sum(d[::2]) + sum(DOUBLED[x] for x in d[1::2])) % 10 == 0


def base_spans(text: bytes) -> list[Span]:
    """Matches of the fixed patterns."""
    found = [(a, b, "email") for a, b in emails(text)] if b"@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip(b"0") for p in m[0].split(b".")]
        if all(len(p) < 3 or len(p) == 3 and p <= b"255" for p in parts):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := m[0].translate(None, NOT_DIGITS)) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    if b"+" in text:
        found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(m[0].translate(None, NOT_DIGITS)) <= 15]
    return found


# Shapes: letters are a, digits 0, bytes beyond ASCII a; the rest stays.  Runs of letters are cut to one.
TO_SHAPE = bytes(48 if 48 <= c <= 57 else 97 if 65 <= c <= 90 or 97 <= c <= 122 or c > 127 else c for c in range(256))
LETTERS = re.compile(rb"a+")
DIGITS = re.compile(rb"0{21,}")


def shape(word: bytes) -> bytes:
    """The shape of a word already put through TO_SHAPE; a run of over twenty digits is one of twenty and a mark."""
    return DIGITS.sub(b"0" * 20 + b"~", LETTERS.sub(b"a", word))


def traits(form: bytes) -> list[bytes]:
    """Features of a shape, the whole first; the others also serve shapes that training never saw."""
    digits = form.count(b"0")
    marks = bytes(sorted({c for c in form if c not in b"a0"}))
    whole = [b"=" + form, b"d%d" % min(digits, 20), b"m" + marks, b"a" if b"a" in form else b"-", b"f" + form[:1], b"l" + form[-1:]]
    return whole + [b"c%c" % m for m in marks]


@dataclass
class Field:
    """Weights: of a word's own, previous and next features by label, and of label pairs."""

    own: dict[bytes, list[float]]
    before: dict[bytes, list[float]]
    after: dict[bytes, list[float]]
    pairs: list[list[float]]
    margin: float = 2.0


def near(form: bytes) -> list[bytes]:
    """Features that a word shows its neighbours."""
    t = traits(form)
    return [t[1], t[2]] if form else [b"edge"]


def forward(emit: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Log sums over all labellings up to each word; emit is (lines, words, labels)."""
    out = emit.copy()
    for t in range(1, emit.shape[1]):
        x = out[:, t - 1, :, None] + pairs
        top = x.max(1, keepdims=True)
        out[:, t] += top[:, 0] + np.log(np.exp(x - top).sum(1))
    return out


def train(lines: list[tuple[list[bytes], list[int], int]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Weights that maximise the likelihood of labelled lines, by full-batch Adam; lines are (shapes, labels, times).

    Without lines, or without a labelled word, all weights favour "none".
    """
    n = len(LABELS)
    names: list[dict[bytes, int]] = [{}, {}, {}]
    groups: dict[int, list] = {}
    for forms, labels, times in lines:
        padded = [b"", *forms, b""]
        rows = []
        for i in range(len(forms)):
            rows.append([[names[k].setdefault(x, len(names[k])) for x in f] for k, f in enumerate((traits(padded[i + 1]), near(padded[i]), near(padded[i + 2])))])
        if rows:
            groups.setdefault(len(rows), []).append((rows, labels, times))
    weights = [np.zeros((len(x), n)) for x in names] + [np.zeros((n, n))]
    data = []
    for size, members in groups.items():
        index = []
        for k in range(3):
            most = max(len(r[k]) for rows, *_ in members for r in rows)
            index.append(np.array([[r[k] + [len(names[k])] * (most - len(r[k])) for r in rows] for rows, *_ in members]))
        data.append((index, np.array([labels for _, labels, _ in members]), np.array([times for *_, times in members], float)))
    state = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    total = max(1.0, sum(m.sum() for *_, m in data))
    for step in range(1, rounds + 1):
        grads = [decay * w for w in weights]
        for index, y, m in data:
            emit = sum(np.concatenate([w, np.zeros((1, n))])[i].sum(2) for w, i in zip(weights, index))
            pairs = weights[3]
            ahead = forward(emit, pairs)
            back = forward(emit[:, ::-1], pairs.T)[:, ::-1]
            log_z = np.logaddexp.reduce(ahead[:, -1], 1)
            one = np.exp(ahead + back - emit - log_z[:, None, None])
            delta = (one - np.eye(n)[y]) * (m / total)[:, None, None]
            for k, i in enumerate(index):
                full = np.zeros((len(weights[k]) + 1, n))
                np.add.at(full, i.reshape(-1), np.repeat(delta.reshape(-1, n), i.shape[2], 0))
                grads[k] += full[:-1]
            if y.shape[1] > 1:
                both = (np.exp(ahead[:, :-1, :, None] + pairs + back[:, 1:, None, :] - log_z[:, None, None, None]).sum(1) * m[:, None, None]).sum(0)
                seen = np.zeros((n, n))
                np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), np.repeat(m, y.shape[1] - 1))
                grads[3] += (both - seen) / total
        for w, g, (u, v) in zip(weights, grads, state):
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            w -= rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    if not any(y.any() for _, y, _ in data):
        return Field({}, {}, {}, np.diag([1.0] + [0.0] * (n - 1)).tolist())
    return Field(*({x: weights[k][i].tolist() for x, i in names[k].items()} for k in range(3)), weights[3].tolist())


def viterbi(emit: np.ndarray, pairs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Best labels of the words of lines that lie one after the other, each of its own size above 0.

    All lines take a step at a time, the longest first in order, so that those which have ended are the last.
    """
    order = np.argsort(-sizes, kind="stable")
    at = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    live = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    came = np.zeros((len(emit), emit.shape[1]), np.int8)
    best = emit[at].copy()
    for t in range(1, len(live)):
        n = live[t]
        x = best[:n, :, None] + pairs
        came[at[:n] + t] = x.argmax(1)
        best[:n] = x.max(1) + emit[at[:n] + t]
    out = np.zeros(len(emit), np.int64)
    label = best.argmax(1)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        out[at[:n] + t] = label[:n]
        label[:n] = came[at[:n] + t, label[:n]]
    return out


class Decoder:
    """Scores of shapes, each looked up once, and labels of the lines of many texts at once."""

    def __init__(self, field: Field):
        self.field, self.pairs = field, np.array(field.pairs)
        self.number: dict[bytes, int] = {b"": 0}
        self.raw: dict[bytes, int] = {}
        self.scores = [[self.score(b"")]]

    def score(self, form: bytes) -> np.ndarray:
        """Own score, score given to the next word, and score given to the word before."""
        zero, out = [0.0] * len(LABELS), np.zeros((3, len(LABELS)))
        for k, (table, features) in enumerate(((self.field.own, traits(form)), (self.field.before, near(form)), (self.field.after, near(form)))):
            for x in features:
                out[k] += table.get(x, zero)
        return out

    def numbers(self, forms: list[bytes], shaped: bool = False) -> np.ndarray:
        if len(self.raw) > 200_000:  # shapes of words are few, but nothing bounds them
            self.raw.clear(), self.number.clear(), self.scores.clear()
            self.number[b""], self.scores = 0, [[self.score(b"")]]
        for w in set(forms).difference(self.raw):
            form = w if shaped else shape(w)
            if form not in self.number:
                self.number[form] = len(self.scores)
                self.scores.append([self.score(form)])
            self.raw[w] = self.number[form]
        return np.fromiter(map(self.raw.__getitem__, forms), np.int64, len(forms))

    def labels(self, lines: list[list[bytes]], shaped: bool = False) -> list[np.ndarray]:
        """Labels of lines of words in TO_SHAPE form, or of shapes."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lines)
        sizes = np.array([len(x) for x in lines], np.int64)
        flat = self.numbers([w for x in lines for w in x], shaped)
        table = np.array(self.scores)[:, 0]
        at = np.concatenate([[0], np.cumsum(sizes)])
        # Each word's score with its neighbours' parts; a line's ends have the empty shape beside them.
        own = table[flat, 0]
        last, first = np.zeros(len(flat), bool), np.zeros(len(flat), bool)
        some = sizes > 0
        first[at[:-1][some]] = True
        last[at[1:][some] - 1] = True
        prev, nxt = np.concatenate([[0], flat[:-1]]) if len(flat) else flat, np.concatenate([flat[1:], [0]]) if len(flat) else flat
        emit = own + table[np.where(first, 0, prev), 1] + table[np.where(last, 0, nxt), 2]
        emit[:, 0] += self.field.margin
        # Lines whose words all prefer "none" by more than any label pair can change need no search.
        free = float(np.ptp(self.pairs)) * 2 if self.pairs.size else 0.0
        doubt = (emit[:, 1:].max(1) + free > emit[:, 0]) if len(flat) else np.zeros(0, bool)
        count = np.concatenate([[0], np.cumsum(doubt)])
        open_ = np.flatnonzero(count[at[1:]] > count[at[:-1]])
        if len(open_):
            words = np.concatenate([np.arange(at[i], at[i + 1]) for i in open_])
            found = np.split(viterbi(emit[words], self.pairs, sizes[open_]), np.cumsum(sizes[open_])[:-1])
            for line, labels in zip(open_.tolist(), found):
                out[line] = labels
        return out


def lines_of(text: bytes) -> tuple[list[list[bytes]], list[int]]:
    """Words of each line of a text, in TO_SHAPE form, and where the line starts."""
    lines = text.translate(TO_SHAPE).split(b"\n")
    return [line.split() for line in lines], list(accumulate((len(x) + 1 for x in lines[:-1]), initial=0))


WORD = re.compile(rb"\S+")
#: Punctuation that is not part of a span at its ends.
EDGES = b"\"'[]{}<>,.;:!?"


def added(text: bytes, starts: list[int], labels: list[np.ndarray], base: list[Span], line_words: list[list[bytes]]) -> list[Span]:
    """Runs of words of one kind, without the words that a base span touches and without punctuation at their ends."""
    out: list[Span] = []
    for start, found, words in zip(starts, labels, line_words):
        if not len(found) or not found.any():
            continue
        places = []
        for m in WORD.finditer(text, start):
            places.append(m.span())
            if len(places) == len(words):
                break
        own = [0 if any(x < b and a < y for x, y, _ in base) else k for (a, b), k in zip(places, found.tolist())]
        for kind, run in groupby(range(len(places)), own.__getitem__):
            run = list(run)
            if kind:
                a, b = places[run[0]][0], places[run[-1]][1]
                piece = text[a:b]
                a += len(piece) - len(piece.lstrip(EDGES))
                b = a + len(text[a:b].rstrip(EDGES))
                if a < b:
                    out.append((a, b, LABELS[kind]))
    return out


#: What a span loses in each copy, by kind: an address all of its domain but the first name, then its digits and dots too; a number abroad its plus.
DAMAGES = {
    "email": [(re.compile(rb"(@[A-Za-z0-9-]+).*", re.S), rb"\1"), (re.compile(rb"@([A-Za-z-]*).*|[0-9._%+]", re.S), lambda m: b"@" + (m[1] or b"host") if m[0][:1] == b"@" else b"")],
    "phone": [(re.compile(rb"\A\+"), b"00")],
}


def damaged(line: bytes, spans: list[Span], copy: int) -> tuple[bytes, list[Span]]:
    """A line whose spans have lost what their patterns need, and where they are now."""
    out, moved, at = b"", [], 0
    for a, b, kind in sorted(spans):
        if a < at or copy >= len(DAMAGES.get(kind, [])):
            continue
        out += line[at:a]
        new = DAMAGES[kind][copy][0].sub(DAMAGES[kind][copy][1], line[a:b])
        moved.append((len(out), len(out) + len(new), kind))
        out, at = out + new, b
    return out + line[at:], moved


def labelled(line: bytes, spans: list[Span]) -> tuple[list[bytes], list[int]]:
    words = [(m.start(), m.end()) for m in WORD.finditer(line)]
    forms = [shape(line[a:b].translate(TO_SHAPE)) for a, b in words]
    return forms, [next((LABELS.index(k) for x, y, k in spans if x < b and a < y), 0) for a, b in words]


def labelled_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> list[tuple[list[bytes], list[int], int]]:
    """A small labelled table: lines of about ``sample_docs`` documents, picked by a hash of id and text, labelled by the base patterns, and damaged copies.

    A line is cut to its part around what is labelled or holds a digit, @ or +, or to its first words; equal ones are one row with the number of times.
    Rows of equal id and text are picked together and counted once, so what comes to the driver is bounded by the sample.
    """
    own = two(docs, id_col, text_col).select("text", F.xxhash64("doc_id", "text").alias("key"))
    total = docs.count()
    picked = own.filter(F.pmod("key", F.lit(1 << 20)) < -(-(sample_docs << 20) // max(1, total))).groupBy("key").agg(F.first("text").alias("text"))

    def cut(forms: list[bytes], labels: list[int]) -> tuple[bytes, bytes]:
        hot = [i for i, (f, y) in enumerate(zip(forms, labels)) if y or any(c in f for c in b"0@+")]
        part = slice(max(0, hot[0] - 3), hot[-1] + 4) if hot else slice(0, 3)
        return b"\n".join(forms[part]), bytes(labels[part])

    def run(batches):
        for b in pieces(batches):
            rows: list[tuple[bytes, bytes]] = []
            for text in text_bytes(column(b, "text")):
                spans, at = base_spans(text), 0
                for line in text.split(b"\n"):
                    mine = [(max(x, at) - at, min(y, at + len(line)) - at, k) for x, y, k in spans if x < at + len(line) and at < y]
                    copies = max((len(DAMAGES.get(k, [])) for *_, k in mine), default=0)
                    for forms, labels in [labelled(line, mine), *(labelled(*damaged(line, mine, i)) for i in range(copies))]:
                        if forms:
                            rows.append(cut(forms, labels))
                    at += len(line) + 1
            yield pa.record_batch({"forms": pa.array([r[0] for r in rows], pa.binary()), "labels": pa.array([r[1] for r in rows], pa.binary())})

    counted = picked.mapInArrow(run, "forms binary, labels binary").groupBy("forms", "labels").count().orderBy("forms", "labels").toArrow()
    return [(f.split(b"\n"), list(y), n) for f, y, n in zip(*(counted[c].to_pylist() for c in ("forms", "labels", "count")))]


def margin(field: Field, held: list[tuple[list[bytes], list[int], int]]) -> float:
    """The least margin that marks few unlabelled words of held-out lines."""
    lines = [forms for forms, *_ in held]
    truth = [np.array(labels) for _, labels, _ in held]
    for m in MARGINS[:-1]:
        found = Decoder(replace(field, margin=m)).labels(lines, shaped=True)
        marked = [(y, x, n) for y, x, (*_, n) in zip(truth, found, held) if len(x)]
        wrong = sum(n * int(((x > 0) & (y == 0)).sum()) for y, x, n in marked)
        right = sum(n * int(((x > 0) & (x == y)).sum()) for y, x, n in marked)
        if wrong <= MOST_WRONG * right:
            return m
    return MARGINS[-1]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Field:
    """A field trained on four fifths of the labelled lines, with the margin that the others ask for."""
    lines = labelled_lines(docs, id_col, text_col, sample_docs)
    held = [x for i, x in enumerate(lines) if i % 5 == 4]
    field = train([x for i, x in enumerate(lines) if i % 5 != 4])
    return replace(field, margin=margin(field, held))


def spans_of(texts: list[bytes], decoder: Decoder) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and those the field adds, for each text."""
    lines, own = [], []
    for t in texts:
        words, starts = lines_of(t)
        own.append((len(lines), starts, base_spans(t)))
        lines += words
    labels = decoder.labels(lines)
    return [(base, added(t, starts, labels[i : i + len(starts)], base, lines[i : i + len(starts)])) for t, (i, starts, base) in zip(texts, own)]


def personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): the fixed patterns' spans and all spans of every row, in code points with exclusive ends, by start and then kind as listed.

    Base spans always stay; the field adds spans of words that none of them touches.  A null or empty text has none.  Repeated
    rows and null ids are answered row by row; there is no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(field))

    def run(batches):
        decoder = Decoder(Field(**sent.value))
        for b in pieces(batches):
            texts = text_bytes(column(b, "text"))
            found = spans_of(texts, decoder)
            yield batch(ARROW, column(b, "doc_id"), [ordered(t, s, KINDS) for t, (s, _) in zip(texts, found)], [ordered(t, s + more, KINDS) for t, (s, more) in zip(texts, found)])

    return two(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {SPANS.replace('spans', 'base', 1)}, {SPANS}")


def masked(text: bytes, found: list[Span]) -> bytes:
    """The text with [KIND] in place of each span; overlapping spans become one, named by the first."""
    out, end = [], 0
    for a, b, kind in sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1])):
        if a >= end:
            out += [text[end:a], b"[", kind.upper().encode(), b"]"]
        end = max(end, b)
    return b"".join([*out, text[end:]])


def mask(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, with personal data masked in their text; a null text stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(field))

    def run(batches):
        decoder = Decoder(Field(**sent.value))
        for b in pieces(batches, text_col):
            texts = column(b, text_col)
            raw = text_bytes(texts)
            new = pa.array([masked(t, s + more) for t, (s, more) in zip(raw, spans_of(raw, decoder))], pa.binary()).cast(texts.type)
            i = b.schema.get_field_index(text_col)
            yield b.set_column(i, b.schema.field(i), pc.if_else(pc.is_valid(texts), new, pa.scalar(None, texts.type)))

    return docs.mapInArrow(run, docs.schema)
