"""Repair of conversations by cost layers of reachable grammar states.

The grammar of role initials is ``(s?(ua)+)?``: four states. Layer c before a
turn is the set of states, four bits, from which the turns to come can be
repaired at a cost of c at most. All layers before a turn are one word: each
edit shifts what holds after the turn by its cost, so one step of bit
operations makes a word of the next one, from the last turn to the first. From
any state the rest costs at most ``REACH`` more than from the best one, so a
word needs that many layers and a number that they start from, however long the
conversation is. The first layer that holds the start state gives the cost;
following the bits forward, with the least letter first, gives the audit.

A conversation is ordered, and its digest is of one text: one task reads it,
turn after turn, backward and then forward. It keeps two words and never the
turns, so a conversation of any length needs no more memory than another. All
three passes sort what one exchange has brought together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import lean

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5  # costs; keeping is free
SPACE_CLASS = r"\x20\x09-\x0D"

# States as bits of a layer: start, after the system turn, after a user's, after an assistant's. Start and the last accept.
START, SYSTEM, USER, ASSISTANT = range(4)
REACH = INSERT * 2 + DELETE
LAYERS = REACH + 1
_ONES = sum(1 << 4 * c for c in range(LAYERS + DELETE))  # the lowest bit of every layer
_KEPT = (1 << 4 * LAYERS) - 1
_ABOVE = ((1 << 4 * DELETE) - 1) << 4 * LAYERS  # beyond its layers a word holds every state
_BEFORE_USER = 1 << START | 1 << SYSTEM | 1 << ASSISTANT


def _with(word: int, state: int) -> int:
    """The layers that hold ``state``, as their lowest bits."""
    return word >> state & _ONES


def _spoken(word: int) -> int:
    """Layers of states from which a user's or an assistant's turn, whichever is due, leads into ``word``."""
    return _with(word, USER) * _BEFORE_USER | _with(word, ASSISTANT) << USER


def _kept(word: int, initial: str) -> int:
    if initial == "u":
        return _with(word, USER) * _BEFORE_USER
    if initial == "a":
        return _with(word, ASSISTANT) << USER
    return _with(word, SYSTEM) << START if initial == "s" else 0


def _closed(word: int, base: int) -> tuple[int, int]:
    """Add insertions, then let the layers start at the first that holds a state."""
    for _ in range(2):  # a third insertion costs more than the layers reach
        word |= _spoken(word) << 4 * INSERT
    while not word & 0xF:
        word, base = word >> 4, base + 1
    return word & _KEPT, base


def last() -> tuple[int, int]:
    """The word after the last turn: what accepts, and what insertions lead there from."""
    return _closed((1 << START | 1 << ASSISTANT) * _ONES, 0)


def step(word: int, base: int, initial: str, fault: int) -> tuple[int, int]:
    """The word before a turn, from the word after it."""
    word |= _ABOVE
    out, more = word << 4 * DELETE, 4 * TRUNCATED * (fault == 3)
    if fault in (0, 3):
        out |= (_kept(word, initial) | _spoken(word) << 4 * REROLE) << more
    return _closed(out & (_KEPT | _ABOVE), base)


def holds(word: int, base: int, state: int, cost: int) -> bool:
    """Whether ``cost`` is enough from ``state`` on."""
    at = cost - base
    return at >= LAYERS or at >= 0 and bool(word >> 4 * at >> state & 1)


def cost_of(word: int, base: int, state: int = START) -> int:
    """The first layer that holds the state."""
    return base + next(c for c in range(LAYERS) if word >> 4 * c >> state & 1)


def _moved(state: int, initial: str) -> int | None:
    """Where a turn with this initial leads, if the grammar has it there."""
    if initial == "u":
        return None if state == USER else USER
    if initial == "a":
        return ASSISTANT if state == USER else None
    return SYSTEM if initial == "s" and state == START else None


class Trace:
    """Follows the bits forward, turn by turn: the cheapest edits whose letters come first."""

    def __init__(self, word: int, base: int):
        self.state, self.left = START, cost_of(word, base)
        self.audit: list[str] = []

    def _inserted(self) -> tuple[str, str]:
        role = "assistant" if self.state == USER else "user"
        self.state, self.left = _moved(self.state, role[0]), self.left - INSERT
        self.audit.append("I")
        return role, ""

    def turn(self, role: str, text: str, fault: int, word: int, base: int) -> Iterator[tuple[str, str]]:
        """What the repaired conversation gets at this turn; ``word`` and ``base`` hold after it."""
        here, more = step(word, base, role[:1], fault), TRUNCATED * (fault == 3)
        while True:
            if holds(word, base, self.state, self.left - DELETE):
                self.left -= DELETE
                self.audit.append("D")
                return
            due = ASSISTANT if self.state == USER else USER
            if holds(*here, due, self.left - INSERT):
                yield self._inserted()
                continue
            to = _moved(self.state, role[:1])
            if to is not None and holds(word, base, to, self.left - more):
                self.state, self.left = to, self.left - more
                self.audit.append("K")
                yield role, text
            else:
                yield ("assistant" if self.state == USER else "user"), text
                self.state, self.left = due, self.left - more - REROLE
                self.audit.append("R")
            return

    def end(self) -> Iterator[tuple[str, str]]:
        while self.state not in (START, ASSISTANT):
            yield self._inserted()


# --- turns ----------------------------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with planted damage, by a checksum of conversation and turn.

    Dropped rows stay, marked ``dropped``, so that no conversation is lost. A
    null counts as one space, but a null turn stays null where turns are compared.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), plain("role").alias("role"), plain("text").alias("text"), F.concat(plain("conv_id"), F.lit(":"), plain("turn")).alias("key"))
    kind = F.crc32(F.col("key").cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies).drop("copy")


def _order(descending: bool = False) -> list[Column]:
    """Turns of a conversation, null first; rows that tie on the turn by role and text, equal ones by ``nth``."""
    keys = [F.col(c) for c in ("turn", "role", "text", "nth")]
    return [k.desc_nulls_last() if descending else k.asc_nulls_first() for k in keys]


def faults(turns: DataFrame) -> DataFrame:
    """Add ``fault``: 1 blank, 2 duplicate, 3 truncated, else 0; the first that holds counts.

    ``turns`` carries conv_id, turn, role, text, dropped. ``nth`` numbers equal
    rows of a conversation. Its rows come to one partition here, and stay there.
    """
    together = turns.repartition("conv_id")
    nth = F.row_number().over(W.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    solid = F.regexp_replace("text", f"[{SPACE_CLASS}]+\\z", "")
    fault = F.when(solid == "", 1).when(F.col("nth") > 1, 2).when(~F.substring(solid, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    return together.withColumn("nth", nth).withColumn("fault", fault)


def layered(turns: DataFrame) -> DataFrame:
    """Add to each turn the word after it (``after``, ``base``), reading every conversation backward."""
    schema = T.StructType([*turns.schema.fields, T.StructField("after", T.LongType()), T.StructField("base", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, word = [], last()
        for batch in batches:
            out = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "first", "fault", "dropped")]
            for key, first, fault, dropped in zip(*columns, strict=True):
                if [key] != conv:
                    conv, word = [key], last()
                out.append(word)
                if not dropped:
                    word = step(*word, first, fault)
            made = [pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return turns.sortWithinPartitions("conv_id", *_order(True)).mapInArrow(lean(run), schema)


class _Conversation:
    """What is known of a conversation while its turns are read forward."""

    def __init__(self, key):
        self.key, self.trace, self.digest, self.parts = key, None, hashlib.sha256(), 0
        self.turns, self.lowest, self.highest, self.turn = 0, None, None, None
        self.counts, self.illegal, self.cost, self.before = [0, 0, 0, 0], 0, 0, None

    def _add(self, kept: Iterator[tuple[str, str]]) -> None:
        for role, text in kept:
            self.digest.update(f"{chr(10) if self.parts else ''}{role}:{text}".encode())
            self.parts += 1

    def read(self, turn, role: str, text: str, fault: int, after: int, base: int) -> None:
        first = role[:1]
        if self.trace is None:
            self.trace = Trace(*step(after, base, first, fault))
            self.cost = self.trace.left
        elif self.before + first not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = first
        self.counts[fault] += 1
        if turn is not None:
            self.turns += turn != self.turn
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = self.turn = turn
        self._add(self.trace.turn(role, text, fault, after, base))

    def row(self) -> tuple:
        if self.trace is not None:
            self._add(self.trace.end())
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        audit = "".join(self.trace.audit) if self.trace else ""
        return self.key, gaps, *self.counts[1:], self.illegal, self.cost, audit, self.digest.hexdigest()


def repaired(layers: DataFrame) -> DataFrame:
    """One row for each conversation, reading it forward along its words."""
    kind = layers.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def flush() -> pa.RecordBatch:
            kinds = [key_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "dropped", "turn", "role", "text", "fault", "after", "base")]
            for key, dropped, *turn in zip(*columns, strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(key)
                if not dropped:
                    now.read(*turn)
            if len(done) >= 2000:
                yield flush()
                done.clear()
        if now is not None:
            done.append(now.row())
            yield flush()

    schema = f"conv_id {kind}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", audit string, repaired_sha256 string"
    return layers.sortWithinPartitions("conv_id", *_order()).mapInArrow(lean(run), schema)


def repair(turns: DataFrame) -> DataFrame:
    """One row for each conversation of ``turns`` (as ``damage`` makes them): faults, cost, audit and digest of the repair.

    Columns: conv_id; gaps, turns missing between the first and the last;
    blank, duplicate, truncated, counts of first faults; illegal, neighbours
    whose initials the grammar doesn't have; cost of the cheapest repair; audit,
    its edits' initials (Keep, Rerole, Delete, Insert), of all cheapest the
    least in ASCII; repaired_sha256 of the repaired ``role:text`` lines. A
    conversation of dropped rows alone has zeros, an empty audit and the empty
    string's digest; one with a null id is a conversation too. Null roles and
    texts are one space, so the row is blank or its role has no place. Repeated
    rows are duplicates; rows that tie on the turn follow by role and text.
    Other columns play no part; an empty table gives no rows.
    """
    narrow = faults(turns).withColumn("first", F.substring("role", 1, 1))
    return repaired(layered(narrow))
