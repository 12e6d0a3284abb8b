"""Filter audits, conversation repair and prefix counts against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from wardflow.llm import filters, hashing, prefixes, repair

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def test_representatives_are_verified(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 63, 64, 65, 200]))).encode() for _ in range(600)]
    words += [w[:-1] + b"c" for w in words[:200]] + words[:100]
    raw = np.frombuffer(b"".join(words), np.uint8)
    length = np.array([len(w) for w in words])
    start = np.cumsum(length) - length
    group = np.array([rng.randint(0, 2) for _ in words])

    def agree():
        for g in (None, group):
            keys = words if g is None else list(zip(words, group))
            out = hashing.representatives(raw, start, length, g)
            assert all(keys[i] == keys[j] for i, j in enumerate(out))
            assert len(set(out)) == len(set(keys))

    agree()
    # Even if all spans have one hash.
    monkeypatch.setattr(hashing, "hashes", lambda raw, loaded, start, length: np.zeros(len(start), np.uint64))
    agree()


def failed(rows):
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall("[^\\x20\\x09-\\x0D]+", text)
        earlier = doc_id is not None and any(t is not None and i is not None and i < doc_id and (t or "") == text for i, t, _ in [(i, t or "", s) for i, t, s in rows])
        out.append(
            "".join(
                f
                for f, x in zip(
                    "ABCDE",
                    [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text)), earlier],
                )
                if x
            )
        )
    return out


def test_filter_audit(spark):
    rng = random.Random(5)
    words = ["river", "Stone", "WALK", "é", "light#", "a", "\x85", "b\u00a0c", "漢字", "paper"]
    rows = []
    for i in range(150):
        pool = words if i % 2 else [w + str(k) for w in words[:3] + words[5:] for k in range(30)]
        rows.append((i, rng.choice([" ", "\n", "\t  ", "\x0b"]).join(rng.choice(pool).lower() if i % 3 else rng.choice(pool) for _ in range(rng.randint(0, 120))), rng.choice(["x", "y", None, ""])))
    rows += [(200 + i, rows[rng.randint(0, 20)][1], "x") for i in range(40)] + [(None, rows[3][1], "x"), (3, rows[3][1], "z"), (201, None, "x"), (202, "", "y"), (203, "w " * 3000, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 230, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "m", 1, "d") for r in rows], "doc_id long, text string, source string, mask string, first int, digest string").repartition(3)
    found = filters.failures(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    masks = failed(rows)
    assert Counter((r["doc_id"], r["part"], r["mask"]) for r in found.collect()) == Counter((i, s or "", sum(1 << "ABCDE".index(f) for f in m)) for (i, _, s), m in zip(rows, masks))
    good, toxic = {i for i, q, _ in labels if i is not None and q == 1}, {i for i, _, t in labels if i is not None and t == 1}
    want = {}
    for order in map("".join, permutations("ABCDE")):
        for part in {s or "" for _, _, s in rows}:
            inside = [(i, m) for (i, _, s), m in zip(rows, masks) if (s or "") == part]
            gone = set()
            for step, f in enumerate(order, 1):
                hit = {k for k, (_, m) in enumerate(inside) if f in m}
                new = hit - gone
                row = dict(removed=len(new), redundant=len(hit & gone), unique_fails=sum(m == f for _, m in inside), good_lost=sum(inside[k][0] in good for k in new), toxic_lost=sum(inside[k][0] in toxic for k in new))
                gone |= hit
                want[part, order, step] = row | {"kept": len(inside) - len(gone)}
    shapley = Counter()
    for (part, order, step), row in want.items():
        shapley[part, order[step - 1]] += row["removed"]
    got = {(r["part"], r["filter_order"], r["step"]): r.asDict() for r in filters.audit(found).collect()}
    assert set(got) == set(want)
    for k, row in want.items():
        assert {n: got[k][n] for n in row} == row
        assert got[k]["shapley"] == shapley[k[0], k[1][k[2] - 1]]


def test_one_of_many_copies_is_first(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("s").alias("source"))
    found = filters.failures(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["mask"]: r["count"] for r in found.groupBy("mask").count().collect()} == {1: 1, 17: 2999}


def cheapest(turns):
    best = None
    for n in [0, *range(2, 2 * len(turns) + 3)]:
        target = "s" * (n % 2) + "ua" * (n // 2)

        @lru_cache(None)
        def ways(i, j):
            if i == len(turns) and j == n:
                return 0, ""
            found = []
            if i < len(turns):
                found.append((3, "D", ways(i + 1, j)))
            if j < n and target[j] != "s":
                found.append((2, "I", ways(i, j + 1)))
            if i < len(turns) and j < n and turns[i] != "d":
                same, cut = turns[i].lower() == target[j], int(turns[i].isupper())
                if same or target[j] != "s":
                    found.append((cut if same else 2 + cut, "K" if same else "R", ways(i + 1, j + 1)))
            return min(((c + rest[0], e + rest[1]) for c, e, rest in found if rest), default=None)

        if (found := ways(0, 0)) and (best is None or found < best):
            best = found
    return best


def test_alignment_is_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(800):
        turns = "".join(rng.choice("suadxSUAXuauaua") for _ in range(rng.randint(0, 9)))
        assert repair.align(turns) == repair.by_states(turns) == cheapest(turns), turns


def test_long_alignments_agree():
    rng = random.Random(2)
    for n in (40, 90, repair.MOST_TURNS):
        turns = "".join("ua"[i % 2] if rng.random() < 0.85 else rng.choice("suadxSUAX") for i in range(n))
        assert repair.align(turns) == repair.by_states(turns)
    long = "ua" * 5000 + "u" + "ua" * 5000
    assert repair.align(long) == (2, "K" * 10001 + "I" + "K" * 10000)


def repaired(rows):
    """Every column of the contract, for rows (conversation, turn, role, text) in any order."""
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = role if role is not None else " ", text if text is not None else " "
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            damaged += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        counts, letters, seen = Counter(), "", set()
        for turn, role, text in damaged:
            inner = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else None
            counts[fault] += 1
            seen.add((role, text))
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "d" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        firsts = [r[1][:1] for r in damaged]
        turns = [r[0] for r in damaged if r[0] is not None]
        cost, audit = cheapest(letters)
        size, lines, i = len(audit) - audit.count("D"), [], 0
        target = "s" * (size % 2) + "ua" * (size // 2)
        for edit in audit:
            if edit != "D":
                made = {"s": "system", "u": "user", "a": "assistant"}[target[len(lines)]]
                lines.append(f"{made if edit != 'K' else damaged[i][1]}:{'' if edit == 'I' else damaged[i][2]}")
            i += edit != "I"
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_conversation_repair(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No", "", "  \n", None, "Why?  ", "Good. Then", "\u00a0", "so\u2028", "é!"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "unit"]) if rng.random() < 0.3 else ("user", "assistant")[t % 2], rng.choice(texts) if rng.random() < 0.4 else f"turn {c} {t}.") for c in range(150) for t in range(rng.randint(1, 8))]
    rows += [(200, None, "user", "Hi."), (200, None, "user", "Hi."), (200, 3, "user", "Hi."), (200, 3, "assistant", "Oh."), (200, 3, "assistant", "Oh."), (200, -2, "assistant", "Oh.")]
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 7, None, None)]
    rows += [(300 + i, 0, "user", "Lost.") for i in range(60)]
    want = repaired(rows)
    shuffled = rng.sample(rows, len(rows))
    turns = spark.createDataFrame([(*r, 5, "c", "x") for r in shuffled], "conv_id long, turn long, role string, text string, copies int, digest string, kind string").repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(repair.damaged(turns), copies_col="copies").collect()}
    assert got == want
    assert sum(v[6] == "" for v in want.values()) > 0


def test_prefix_counts(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    rng = random.Random(6)
    parts = ["a", "b", " ", "  ", "th", "e", "ing", "\n", "é", "ü", "漢", "😀", "\x00", "▁", "12", ".", "the ", "<s>", "</s>", "<unk>", "<0x0A>", "ﬁ", "aaaa", "    "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(150)] + [" " * k for k in range(0, 40, 3)] + ["a" * 300, "q" * 60 + "the", None, "", "the cat sat. " * 800]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])]
    docs = spark.createDataFrame([(i, t, 0, b"x", 1) for i, t in rows], "doc_id long, text string, n_tokens int, steps binary, key int").repartition(3)
    stored = prefixes.prefix_counts(docs, PIECE_BPE)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_chars"], tuple(prefixes.counts_of(r["steps"], r["n_chars"]))) for r in stored.collect())
    want = Counter()
    for i, t in rows:
        t = t or ""
        counts = tuple(map(len, library.encode([t[:k] for k in range(len(t) + 1)]))) if len(t) < 1000 else None
        if counts:
            want[i, len(t.encode()), len(t), counts] += 1
    assert want == Counter({k: n for k, n in got.items() if k[2] < 1000})
    totals = prefixes.token_counts(docs, PIECE_BPE)
    assert Counter(tuple(r) for r in totals.collect()) == Counter((i, len((t or "").encode()), len(t or ""), len(library.encode(t or ""))) for i, t in rows)


def test_budgets_are_answered_from_stored_counts(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    texts = ["unbelievable stories of the old towns", "", "x", "    ", "hel hello"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = prefixes.prefix_counts(docs, PIECE_BPE)
    counts = [list(map(len, library.encode([t[:k] for k in range(len(t) + 1)]))) for t in texts]
    got = {(r["doc_id"], r["budget"]): (r["n_chars"], r["n_tokens"]) for r in prefixes.longest_prefixes(stored, [0, 1, 3, 100]).collect()}
    assert got == {(i, b): max((k, n) for k, n in enumerate(c) if n <= b) for i, c in enumerate(counts) for b in (0, 1, 3, 100)}
    at = {r["doc_id"]: r["tokens"] for r in prefixes.tokens_at(stored, F.array(F.lit(0), F.lit(3), F.lit(None), F.lit(9))).collect()}
    assert at == {i: [c[k] if k is not None and k < len(c) else None for k in (0, 3, None, 9)] for i, c in enumerate(counts)}


def test_other_vocabularies_are_refused(spark, docs):
    with pytest.raises(Exception):
        prefixes.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
