"""Language identification by bit-sliced Bloom filters of character n-grams.

A table of ``SLOTS`` rows holds one bit for each language: column l is the Bloom filter of
language l's n-grams.  The conjunction of the rows that an n-gram hashes to is the set of all
languages that contain it, found at once.  A text's count for a language is the number of its n-grams whose
set holds the language, less what the filter's fill lets through by chance.

Every language is learned, however rare, and every n-gram of its sampled documents, however rare, but those that are far more usual in another
language and so look like quotations; the table has as many slots as the most n-grams of a language need.  It is held and sent in blocks of languages; over several blocks a document carries its
best language, that one's count and the sum of counts from block to block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import batch, column, pieces, remainder
from wardflow.session import settle

GRAM = 4
#: Bits of a slot number at least; there are at least ``SLOTS_EACH`` slots for each n-gram of a language.
LEAST_SLOT_BITS, SLOTS_EACH = 18, 8
#: Odd multipliers, one for each hash function.
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Expected number of sampled training documents of a language.
SAMPLE_DOCS = 2000
#: An n-gram is not learned where its share is so many times less than in another language.
QUOTED = 16
#: Bytes of slices, and languages, sent to the documents at once; each 64 languages take eight bytes a slot.
BLOCK_BYTES, BLOCK = 32 << 20, 1024
#: A document is kept if its best language has this share of its n-grams, chance taken off.
LEAST_KNOWN = 0.2
UNKNOWN = "und"
#: Bytes of text whose n-grams are held at once; each takes about a hundred times as much for a moment.
PIECE = 1 << 19
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
GRAMS = pa.schema([("place", pa.int64()), ("gram", pa.int64()), ("n", pa.int64())])
#: What a document carries from block to block.
CARRIED = {"_lang_best": pa.int64(), "_lang_count": pa.float64(), "_lang_total": pa.float64()}


@dataclass
class Block:
    """Languages, most documents first, and the bit slices: one row of slots for each 64 languages."""

    languages: list[str]
    slices: np.ndarray
    slot_bits: int

    def chance(self) -> np.ndarray:
        """For each language, the share of foreign n-grams that its filter lets through."""
        fill = [float(np.mean((self.slices[i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(self.languages))]
        return np.array(fill) ** len(HASHES)


@dataclass
class Model:
    """All languages, most documents first, and the stored bits of the slices."""

    languages: list[str]
    bits: DataFrame | None
    slot_bits: int = LEAST_SLOT_BITS

    def width(self) -> int:
        """Languages of a block, a multiple of 64."""
        return min(BLOCK, 64 * max(1, BLOCK_BYTES // (8 << self.slot_bits)))

    def block(self, i: int) -> Block:
        names = self.languages[i * self.width() : (i + 1) * self.width()]
        slices = np.zeros((-(-len(names) // 64), 1 << self.slot_bits), np.uint64)
        if names:
            first = i * self.width() // 64
            out = self.bits.filter(F.col("word").between(first, first + len(slices) - 1)).toArrow()
            slices[out["word"].to_numpy() - first, out["slot"].to_numpy()] = out["bits"].to_numpy().view(np.uint64)
        return Block(names, slices, self.slot_bits)

    def blocks(self) -> int:
        return max(1, -(-len(self.languages) // self.width()))


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts in order, where each text's n-grams start and end, and whether it has a letter.

    Whatever is no letter counts as a blank; an n-gram's inner characters are letters.
    """
    own = [f" {t.lower()} " for t in texts]
    at = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
    codes = np.frombuffer("".join(own).encode("utf-32-le", "replace"), np.uint32)
    alpha = letter[codes]
    seen = np.concatenate([[0], np.cumsum(alpha)])
    codes = np.where(alpha, codes, 32).astype(np.uint64)
    n = max(0, len(codes) - GRAM + 1)
    keys, inner = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(GRAM):
        keys = keys * np.uint64(0x100000001B3) + codes[i : i + n]
        if 0 < i < GRAM - 1:
            inner &= alpha[i : i + n]
    upto = np.concatenate([[0], np.cumsum(inner)])
    return keys[inner], upto[np.minimum(at, n)], seen[at[1:]] > seen[at[:-1]]


def slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((keys ^ (keys >> np.uint64(29))) * np.uint64(m) >> np.uint64(64 - bits)).astype(np.int64) for m in HASHES]


def tally(block: Block, texts: list[str], letter: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's best language of a block, its corrected count, the sum of counts, whether the text has a letter, and its n-grams; ties go to the language with more training documents."""
    keys, at, has = grams(texts, letter)
    places = slots(keys, block.slot_bits)
    n = np.diff(at)
    best, count, total = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
    for word, table in enumerate(block.slices):
        held = np.bitwise_and.reduce([table[p] for p in places])
        counts = np.zeros((len(texts), min(64, len(block.languages) - 64 * word)))
        for bit in range(counts.shape[1]):
            hits = np.diff(np.concatenate([[0], np.cumsum((held >> np.uint64(bit)) & np.uint64(1))])[at].astype(np.int64))
            free = chance[64 * word + bit]
            counts[:, bit] = np.maximum(0, (hits - n * free) / (1 - free)) if free < 1 else 0
        first, most = counts.argmax(1), counts.max(1)
        best, count, total = np.where(most > count, 64 * word + first, best), np.maximum(count, most), total + counts.sum(1)
    return best, count, total, has, n


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from about ``sample_docs`` documents of each language, picked by a hash of id and text.

    Only documents whose remainder modulo 3 is not 1 and whose text and language are not null are learned from.  What comes to
    the driver are the names of the languages; the slices come by block.
    """
    spark = docs.sparkSession
    known = docs.filter((remainder(id_col, 3) != 1) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.orderBy(F.desc("n"), "lang").collect()
    languages = [r["lang"] for r in rows]
    if not languages:
        return Model(languages, None)
    share = spark.createDataFrame([(r["lang"], i, -(-(sample_docs << 20) // r["n"])) for i, r in enumerate(rows)], "lang string, place long, keep long")
    # One short row for each language.
    share = F.broadcast(share)
    picked = known.join(share, "lang").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.col("keep")).select("place", "text")

    def learn(batches):
        letter = letters()
        for b in pieces(batches, limit=PIECE):
            texts, places = np.array(column(b, "text").to_pylist(), object), column(b, "place").to_numpy()
            for place in np.unique(places):
                keys, n = np.unique(grams(list(texts[places == place]), letter)[0], return_counts=True)
                yield batch(GRAMS, np.full(len(keys), place), keys.view(np.int64), n)

    held = settle(picked.mapInArrow(learn, "place long, gram long, n long").groupBy("place", "gram").agg(F.sum("n").alias("n")))
    # One row for each language.
    totals = F.broadcast(held.groupBy("place").agg(F.sum("n").alias("total")))
    shares = held.join(totals, "place").select("place", "gram", (F.col("n") / F.col("total")).alias("share"))
    usual = shares.groupBy("gram").agg(F.max("share").alias("most"))
    learned = settle(shares.join(usual, "gram").filter(F.col("share") * QUOTED >= F.col("most")).select("place", "gram"))
    most = learned.groupBy("place").count().agg(F.max("count")).first()[0] or 0
    slot_bits = max(LEAST_SLOT_BITS, int(SLOTS_EACH * most - 1).bit_length() if most else 0)

    def place(batches):
        for b in batches:
            keys, lang = column(b, "gram").to_numpy().view(np.uint64), column(b, "place").to_numpy()
            at = np.concatenate(slots(keys, slot_bits))
            yield pa.record_batch({"word": np.tile(lang // 64, len(HASHES)), "slot": at, "bit": np.tile(np.left_shift(np.int64(1), lang % 64), len(HASHES))})

    bits = learned.mapInArrow(place, "word long, slot long, bit long").groupBy("word", "slot").agg(F.bit_or("bit").alias("bits"))
    return Model(languages, settle(bits), slot_bits)


def carried(docs: DataFrame, model: Model, text_col: str, last) -> DataFrame:
    """Documents block after block of languages, with their best language so far, its count and the sum of counts in columns of their own.

    ``last`` gets a batch without these columns, the three, whether texts have a letter and their n-grams, once the last block has been counted, and makes the
    result's batch.  Between blocks the documents are written.
    """
    spark, names = docs.sparkSession, list(CARRIED)
    kinds = {pa.int64(): "long", pa.float64(): "double"}
    rows = docs.withColumns({n: F.lit(0).cast(kinds[t]) for n, t in CARRIED.items()})

    def counted(sent, first: int, end):
        def run(batches):
            block = Block(**sent.value)
            letter, chance = letters(), block.chance()
            for b in pieces(batches, text_col, PIECE):
                texts = ["" if t is None else t for t in column(b, text_col).to_pylist()]
                best, count, total, has, n = tally(block, texts, letter, chance)
                before, so_far, sum_so_far = (column(b, x).to_numpy() for x in names)
                told = np.where(count > so_far, first + best, before), np.maximum(count, so_far), sum_so_far + total
                plain = b.drop_columns(names)
                if end is not None:
                    yield end(plain, *told, has, n)
                else:
                    yield pa.RecordBatch.from_arrays([*plain.columns, *[pa.array(x, t) for x, t in zip(told, CARRIED.values())]], names=[*plain.schema.names, *names])

        return run

    end, schema = last
    for i in range(model.blocks()):
        is_last = i == model.blocks() - 1
        sent = spark.sparkContext.broadcast(vars(model.block(i)))
        out = rows.mapInArrow(counted(sent, i * model.width(), end if is_last else None), schema if is_last else rows.schema)
        if is_last:
            return out
        rows = settle(out)
        sent.destroy()


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every document.

    A null or empty text, and one without a letter, is ``und`` with score 0; so is every text if no language was
    learned.  A text with letters but without a known n-gram gets the language with most training documents, with score 0.
    Repeated rows and null ids are answered row by row; there is no shuffle.  Over several blocks of languages the documents are written between them.
    """
    languages = docs.sparkSession.sparkContext.broadcast(model.languages)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(id_col, 3) == 1).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def named(b, best, count, total, has, n):
        known = has & bool(languages.value)
        names = [languages.value[k] if x else UNKNOWN for k, x in zip(best.tolist(), known)]
        return batch(ARROW, column(b, "doc_id"), column(b, "held_out"), names, np.divide(count, total, out=np.zeros(len(count)), where=known & (total > 0)))

    return carried(rows, model, "text", (named, "doc_id long, held_out boolean, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least_known: float = LEAST_KNOWN, languages: list[str] | None = None) -> DataFrame:
    """The documents, with all their columns, whose language the model tells.

    A document goes if it has no letter, if nothing was learned, if its best language has less than ``least_known`` of its n-grams, or if that
    language is none of ``languages``, where these are given.  A text too short for an n-gram stays where its language is not asked for.
    """
    wanted = None if languages is None else np.array([x in languages for x in model.languages], bool)
    learned = bool(model.languages)

    def kept(b, best, count, total, has, n):
        keep = has & learned & ((count >= least_known * n) if least_known > 0 else True)
        if wanted is not None and learned:
            keep &= wanted[best] & (count > 0)
        return b.filter(pa.array(keep, pa.bool_()))

    return carried(docs, model, text_col, (kept, docs.schema))
