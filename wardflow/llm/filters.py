"""How filters of documents interact: what each removes alone, after others, and in every order.

A finite-state transducer reads the bytes of all texts once.  Its table gives, for a state (``BLANK`` or ``WORD``) and a byte, the next state
and the outputs: a word starts, a capital, a code point, a symbol.  The next state follows from the byte alone, so the
states of a whole piece are one table look-up and the outputs a second, with the states shifted by one place.  The word spans
it finds go into a verified hash table, which tells a document's distinct words.

A document's failed filters are the bits of a mask.  Masks are counted by part, and every order of the filters is then answered from these counts.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import batch, column, flat, pieces
from wardflow.llm.hashing import representatives
from wardflow.session import settle

FILTERS = "ABCDE"
LEAST_WORDS = 50
#: Least share of distinct words and greatest share of capitals, in hundredths.
LEAST_DISTINCT, MOST_CAPITALS = 65, 5
SYMBOLS = b"#$%&*|"
BLANK, WORD = 0, 1
STARTS, CAPITAL, CODE_POINT, SYMBOL = 1, 2, 4, 8
ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), *[(n, pa.int64()) for n in ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")], ("digest", pa.binary())])


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and the outputs, for each state and byte."""
    byte = np.arange(256)
    blank = (byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D))
    state = np.tile(np.where(blank, BLANK, WORD), (2, 1)).astype(np.uint8)
    out = CAPITAL * ((byte >= 0x41) & (byte <= 0x5A)) + CODE_POINT * (byte & 0xC0 != 0x80) + SYMBOL * np.isin(byte, list(SYMBOLS))
    out = np.tile(out, (2, 1))
    out[BLANK] += STARTS * ~blank
    return state, out.astype(np.uint8)


def measure(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of each of the texts that lie one after the other."""
    state, output = transducer()
    starts, ends = at[:-1], at[1:]
    after = state[BLANK][raw]
    before = np.concatenate([[BLANK], after[:-1]]).astype(np.uint8) if len(raw) else after
    before[starts[starts < len(raw)]] = BLANK
    out = output[before, raw]

    def total(bit: int) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(out & bit != 0)])
        return upto[ends] - upto[starts]

    n_words = total(STARTS)
    first = np.flatnonzero(out & STARTS)
    # A word ends before a blank or another text.
    last = np.concatenate([after, [BLANK]]).astype(bool)
    follows = np.concatenate([last[1:], [False]])[: len(raw)]
    follows[ends[(ends > 0) & (ends <= len(raw))] - 1] = False
    stop = np.flatnonzero(last[: len(raw)] & ~follows) + 1
    doc = np.repeat(np.arange(len(starts)), n_words)
    unique = representatives(raw, first, stop - first, doc) == np.arange(len(first))
    return np.stack([n_words, np.bincount(doc[unique], minlength=len(starts)), total(CAPITAL), total(CODE_POINT), total(SYMBOL)])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What the filters ask of each document: counts, and the SHA-256 of its bytes.

    A null text is empty, a null part is an empty string; repeated rows and null ids are measured row by row.  There is no shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for b in pieces(batches):
            raw, at = flat(column(b, "text"))
            data = raw.tobytes()
            digests = [hashlib.sha256(data[i:j]).digest() for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield batch(ARROW, column(b, "doc_id"), column(b, "part"), *measure(raw, at), digests)

    return rows.mapInArrow(run, "doc_id long, part string, n_words long, n_distinct long, n_capitals long, n_chars long, n_symbols long, digest binary")


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Each document's part, mask of failed filters (bit i for ``FILTERS[i]``), and whether it is labelled good or toxic.

    A copy fails E if a smaller id has the same text; a null id has no order, so it neither fails E nor makes others fail. A document is good or toxic if any of
    its labels says so.  Only digests are compared across documents: the first id of each digest is an aggregate, joined back by id and
    digest, so that a text that many documents share is no hot key.
    """
    rows = settle(measured(docs, id_col, text_col, part_col))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    labelled = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    fails = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_chars"),
        F.col("n_symbols") > 0,
        F.col("doc_id").isNotNull() & F.col("is_first").isNull(),
    ]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    no = F.lit(False)
    return rows.join(first, ["doc_id", "digest"], "left").join(labelled, "doc_id", "left").select("doc_id", "part", mask.alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def effects(filters: str = FILTERS) -> list[tuple]:
    """What each step of each order does to a document with each mask.

    One row (mask, order, step, kept, removed, redundant, only, shapley) for each; shapley is the number of orders in which the step's filter removes the document.
    """
    n, rows = len(filters), []
    orders = ["".join(p) for p in permutations(filters)]
    for mask in range(1 << n):
        failed = {f for i, f in enumerate(filters) if mask >> i & 1}
        for order in orders:
            before = False
            for step, f in enumerate(order, 1):
                fails = f in failed
                # Each of the failed filters is the first of them in equally many orders.
                rows.append((mask, order, step, int(not before and not fails), int(fails and not before), int(fails and before), int(failed == {f}), len(orders) // len(failed) if fails else 0))
                before |= fails
    return rows


def audit(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For each part, order of the filters and step: documents kept, removed, redundant, lost, and Shapley counts; zeros included.

    ``failed`` has one row for each document, as ``failures`` gives.  A part without documents has no rows, so an empty table gives none.
    What is joined is one row for each part and mask, with a constant table of the effects of ``len(filters)`` filters.
    """
    n = F.count(F.lit(1))
    masks = failed.groupBy("part", "mask").agg(n.alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("bad"))
    steps = failed.sparkSession.createDataFrame(effects(filters), "mask int, filter_order string, step int, kept long, removed long, redundant long, only long, shapley long")
    sums = {
        "kept": F.col("kept") * F.col("n"),
        "removed": F.col("removed") * F.col("n"),
        "redundant": F.col("redundant") * F.col("n"),
        "unique_fails": F.col("only") * F.col("n"),
        "good_lost": F.col("removed") * F.col("good"),
        "toxic_lost": F.col("removed") * F.col("bad"),
        "shapley": F.col("shapley") * F.col("n"),
    }
    # 600 rows for each of 32 masks, whatever the input.
    return masks.join(F.broadcast(steps), "mask").groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
