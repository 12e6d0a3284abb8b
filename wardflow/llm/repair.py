"""Repair of conversations: the cheapest edits that make the roles alternate, found by alignment.

The roles of a repaired conversation read ``(s?(ua)+)?``.  For each length there is at most one such string: ``uaua...`` if it is even,
``s`` before that if it is odd, none of length 1.  The turns are aligned to the string of each feasible length by the Wagner-Fischer
recurrence, costs counted from the end.  The cheapest cost so far bounds the band of cells that are filled (Ukkonen): a cell counts only if the deletions and
insertions that lead to it and from it may cost less than that.  Lengths of equal cost are told apart by their audits, the edits' initials, traced from the first turn on.

A turn is one letter: ``s``, ``u``, ``a`` by its role, ``x`` for another, a capital if its text is cut off, ``d`` if it has to go.  Alignments are
remembered by the letters of a conversation, of which there are few kinds.

No conversation is held as a whole: a task reads sorted rows, first the letters of a conversation's turns, then their texts.
What it keeps meanwhile is a letter for each turn, as long as the audit itself.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import batch, column, pieces

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
FAR = 1 << 60
#: Turns up to which lengths are aligned one by one; the effort grows with the cube.
MOST_TURNS = 128
REMEMBERED = 100_000
#: Kinds of sorted rows: a dropped turn, a turn's letters, its text.
DROPPED, MARKS, TEXT = 0, 1, 2
ROLES = {"s": "system", "u": "user", "a": "assistant"}
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def grammar(length: int) -> str | None:
    """The alternating string of a length, or None if there is none."""
    return None if length == 1 else "s" * (length % 2) + "ua" * (length // 2)


def keeps(turn: str, role: str) -> int:
    """Cost of a turn that stands where the role is wanted."""
    cut = CUT_OFF if turn.isupper() else 0
    return cut if turn.lower() == role else FAR if turn == "d" or role == "s" else REROLE + cut


def aligned(turns: str, target: str, incumbent: int) -> tuple[int, str]:
    """Least cost of turning the turns into the target, and its audit; FAR if it is above the incumbent."""
    m, n = len(turns), len(target)
    # Turns from i on that have to go.
    must = [0] * (m + 1)
    for i in reversed(range(m)):
        must[i] = must[i + 1] + (turns[i] == "d")

    def least(deleted: int, shift: int) -> int:
        """Cost of at least so many deletions and a shift by inserting more or fewer."""
        d = max(deleted, -shift)
        return DELETE * d + INSERT * (d + shift)

    def hopeful(i: int, j: int) -> bool:
        return least(must[0] - must[i], j - i) + least(must[i], (n - j) - (m - i)) <= incumbent

    rows: list[dict[int, int]] = [{} for _ in range(m + 1)]
    for i in reversed(range(m + 1)):
        here, below = rows[i], rows[i + 1] if i < m else {}
        # The bound is convex along a row, least where the costlier of both shifts needs no edit.
        middle = min(max(i - (must[0] - must[i]), n - m + i + must[i], 0), n)
        low, high = middle, middle
        while low > 0 and hopeful(i, low - 1):
            low -= 1
        while high < n and hopeful(i, high + 1):
            high += 1
        for j in range(high, low - 1, -1):
            best = 0 if i == m and j == n else FAR
            if i < m:
                best = min(best, DELETE + below.get(j, FAR))
            if j < n:
                if target[j] != "s":
                    best = min(best, INSERT + here.get(j + 1, FAR))
                if i < m:
                    best = min(best, keeps(turns[i], target[j]) + below.get(j + 1, FAR))
            if best < FAR:
                here[j] = best
    cost = rows[0].get(0, FAR)
    if cost > incumbent:
        return FAR, ""
    audit, i, j = [], 0, 0
    while i < m or j < n:
        left = rows[i][j]
        if i < m and rows[i + 1].get(j, FAR) + DELETE == left:
            audit.append("D")
            i += 1
        elif j < n and target[j] != "s" and rows[i].get(j + 1, FAR) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def by_states(turns: str) -> tuple[int, str]:
    """The same for all lengths at once, over the four states of the grammar: nothing yet, after s, after u, after a.

    Linear in the turns; it serves conversations that are too long for one alignment a length.
    """
    wants = ("su", "u", "a", "u")
    after = {"s": 1, "u": 2, "a": 3}
    left = [0, FAR, FAR, 0]
    steps: list[bytes] = []

    def inserted(plain: list[int]) -> list[int]:
        u, a = min(plain[2], plain[3] + INSERT), min(plain[3], plain[2] + INSERT)
        return [min(plain[0], u + INSERT), min(plain[1], u + INSERT), u, a]

    def edit(i: int, state: int, cost: int, here: list[int], below: list[int]) -> str:
        if i < len(turns) and below[state] + DELETE == cost:
            return "D"
        role = wants[state][-1]
        if here[after[role]] + INSERT == cost:
            return "I"
        return "K" if any(keeps(turns[i], r) < REROLE and turns[i].lower() == r and below[after[r]] + keeps(turns[i], r) == cost for r in wants[state]) else "R"

    left = inserted(left)
    ends = [edit(len(turns), s, left[s], left, left) if left[s] and left[s] < FAR else "." for s in range(4)]
    steps.append("".join(ends).encode())
    for i in reversed(range(len(turns))):
        plain = [min([left[s] + DELETE] + [keeps(turns[i], r) + left[after[r]] for r in wants[s]]) for s in range(4)]
        here = inserted(plain)
        steps.append("".join(edit(i, s, min(here[s], FAR), here, left) if here[s] < FAR else "." for s in range(4)).encode())
        left = here
    audit, i, state = bytearray(), 0, 0
    while (letter := steps[len(turns) - i][state : state + 1]) != b".":
        audit += letter
        if letter == b"I":
            state = after[wants[state][-1]]
        elif letter != b"D":
            kept = turns[i].lower()
            state = after[kept if letter == b"K" else wants[state][-1]]
        i += letter != b"I"
    return left[0], audit.decode()


def align(turns: str) -> tuple[int, str]:
    """Least cost of a repair, and of the audits that have it the least as ASCII."""
    m, must = len(turns), turns.count("d")
    if m > MOST_TURNS:
        return by_states(turns)
    best = (DELETE * m, "D" * m)
    # Lengths near the number of turns that may stay come first, so that a good cost soon narrows the bands.
    reach = best[0] // INSERT
    for n in sorted(range(2, m - must + reach + 1), key=lambda n: (abs(n - (m - must)), n)):
        shift = n - (m - must)
        if DELETE * (must + max(0, -shift)) + INSERT * max(0, shift) <= best[0]:
            cost, audit = aligned(turns, grammar(n), best[0])
            if cost < FAR:
                best = min(best, (cost, audit))
    return best


def roles_of(audit: str) -> str:
    """The repaired role initials: as many as edits that are no deletions."""
    return grammar(len(audit) - audit.count("D"))


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults put in by the CRC-32 of ``conversation:turn`` modulo 20, nulls counting as one space.

    0 drops a row (``copies`` is 0), 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"),
    )
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def _text_end(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def repair(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """One row for each conversation: its faults, the cheapest repair's cost and audit, and the SHA-256 of the repaired turns.

    Rows are taken by turn, nulls first, rows of equal turn by role and then by the SHA-256 of role and text. ``copies_col`` tells how many times a row counts, adjacent; a
    conversation all of whose rows count 0 times has zeros, an empty audit and the hash of nothing.  Null roles and texts are one space; a null id is a conversation of its own; an
    empty table gives no rows.

    A turn is a duplicate if its role and text were seen in the conversation before: the first turn of each pair is an aggregate of digests, joined back.  One
    shuffle brings letters and texts of a conversation to one task, which streams them in order.
    """
    blank = F.lit(" ")
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"),
        (F.col(copies_col) if copies_col else F.lit(1)).cast("int").alias("copies"),
    ).withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)))
    live = rows.filter("copies > 0")
    first = live.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("turn").alias("first"), F.bool_or(F.col("turn").isNull()).alias("first_null"))
    ends = F.right(_text_end(F.col("text")), F.lit(1))
    letters = live.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        "copies",
        (ends == "").alias("is_blank"),
        (~ends.isin(*ENDS)).alias("is_cut"),
    ).join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    # Rows of equal turn, role and text lie side by side, where the task tells the first from the others.
    again = F.when(F.col("first_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    none, no = F.lit(None).cast("string"), F.lit(False)
    marks = letters.select("conv_id", F.lit(MARKS).alias("kind"), "turn", "role", "digest", "copies", none.alias("text"), "is_blank", "is_cut", again.alias("again"))
    texts = live.select("conv_id", F.lit(TEXT).alias("kind"), "turn", "role", "digest", "copies", "text", no, no, no)
    dropped = rows.filter("copies <= 0").select("conv_id").distinct().select("conv_id", F.lit(DROPPED), F.lit(None).cast(turns.schema[turn_col].dataType), none, F.lit(None).cast("binary"), F.lit(0), none, no, no, no)
    ordered = marks.union(texts).union(dropped).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest")
    id_type = turns.schema[id_col].dataType
    names = ", ".join(f"{n} long" for n in NAMES)

    def run(batches):
        arrow, known = None, lru_cache(REMEMBERED)(align)
        out, state, current = [], None, object()
        for whole in batches:
            for b in pieces([whole]):
                if arrow is None:
                    arrow = pa.schema([("conv_id", b.schema.field("conv_id").type), *[(n, pa.int64()) for n in NAMES], ("audit", pa.string()), ("repaired_sha256", pa.string())])
                columns = [column(b, n).to_pylist() for n in ("conv_id", "kind", "turn", "role", "digest", "copies", "text", "is_blank", "is_cut", "again")]
                for conv, kind, turn, role, digest, copies, text, is_blank, is_cut, again in zip(*columns):
                    if state is None or conv != current:
                        if state is not None:
                            out.append((current, *state.result()))
                        state, current = Conversation(known), conv
                    if kind == MARKS:
                        state.mark(turn, role, digest, copies, is_blank, is_cut, again)
                    elif kind == TEXT:
                        state.read(role, text, copies)
                if len(out) >= 10_000:
                    yield batch(arrow, *zip(*out))
                    out = []
        if state is not None:
            out.append((current, *state.result()))
        if out:
            yield batch(arrow, *zip(*out))

    return ordered.mapInArrow(run, f"conv_id {id_type.simpleString()}, {names}, audit string, repaired_sha256 string")


class Conversation:
    """One conversation as its rows go by."""

    def __init__(self, align):
        self.align, self.letters, self.counts = align, bytearray(), [0, 0, 0]
        self.low = self.high = self.last = self.before = None
        self.turns = self.illegal = 0
        self.initial, self.audit = None, None

    def mark(self, turn, role: str, digest: bytes, copies: int, is_blank: bool, is_cut: bool, again: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = role[:1]
        for _ in range(copies):
            seen = again or self.before == (turn, digest)
            fault = 0 if is_blank else 1 if seen else 2 if is_cut else None
            if fault is not None:
                self.counts[fault] += 1
            if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before, self.initial = (turn, digest), initial
            letter = initial if initial in ROLES else "x"
            self.letters += (("d" if fault in (0, 1) else letter.upper() if fault == 2 else letter)).encode()

    def solve(self) -> None:
        self.cost, self.audit = self.align(self.letters.decode())
        self.at, self.placed, self.roles = 0, 0, roles_of(self.audit)
        self.hash = hashlib.sha256()

    def put(self, role: str, text: str) -> None:
        self.hash.update((f"\n{role}:{text}" if self.placed else f"{role}:{text}").encode())
        self.placed += 1

    def insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.put(ROLES[self.roles[self.placed]], "")
            self.at += 1

    def read(self, role: str, text: str, copies: int) -> None:
        if self.audit is None:
            self.solve()
        for _ in range(copies):
            self.insert()
            edit = self.audit[self.at]
            if edit != "D":
                self.put(role if edit == "K" else ROLES[self.roles[self.placed]], text)
            self.at += 1

    def result(self) -> tuple:
        if self.audit is None:
            self.solve()
        self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.counts, self.illegal, self.cost, self.audit, self.hash.hexdigest())
