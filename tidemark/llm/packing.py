"""Best-fit packing of documents into sequences, after a dominance reduction.

A length is a whole number of at most ``capacity`` tokens, so an instance is a
histogram: at most ``capacity`` counts, whatever the corpus. The plan is made
on that histogram, many equal pieces at a step:

1. Reduction (Martello and Toth): a small set of pieces is fixed as a finished
   sequence where it dominates every other set that its largest piece could
   lie in, so that some best packing has it. This is so for a piece that
   nothing fits beside, for one and the largest that fits if together they are
   full or no third fits, and for some sets of three.
2. Best fit in decreasing order for what is left: each piece goes where it
   leaves the least room.

Equal sequences have neighbouring numbers. A ``Slots`` row says that pieces of
one length, from one rank on, fill so many places of such a range. Ranks are
dealt without gathering equal lengths: a piece's number among those of its
length in its own partition, after those of the partitions before.

How large a plan gets: the reduction ends a length at each step or is done with
one, and best fit takes a whole range of sequences, or ends a length. A range
taken whole has less than half of its room left, so this happens at most
log2(capacity) times to each; that is, below ``SLOTS_PER_LENGTH * capacity``
rows of 48 bytes (9 MB for 4096), which is what executors are sent.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.scratch import sent_if_small, written
from tidemark.llm.words import lean, slices

CAPACITY = 4096
END_ID = 1
SLOTS_PER_LENGTH = 48
KNOWN_WORDS = 800_000  # that a worker remembers, some 160 MB
KNOWN_MARKS = 10_000
KNOWN_BYTES = 64  # longer words are encoded anew each time


# --- tokens ---------------------------------------------------------------------------------------------------------


PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch  # two pre-tokens at most, and nothing to normalise


def byte_symbols() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it shows, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # fixed values
    hidden = [b for b in range(256) if b not in shown]
    return dict(zip(shown, shown, strict=True)) | {b: 256 + i for i, b in enumerate(hidden)}


class WordIds(dict):
    """Ids of words as little-endian 32-bit numbers; as a dict it remembers short words.

    Holds for tokenizers that drop white space and case before they split:
    what lies between two white spaces is then encoded by itself.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.symbols = byte_symbols()
        self.marks: dict[str, bytes] = {}
        self.model, model = None, self.library.model
        probe = {w.encode() for w in ("straße", "naïveté...", "øre", "où", "unbelievably!?", "a", "hello_", "it'")}
        by_library = self._asked(probe)
        self.model = model
        if any(by_library[w] != ids for w, ids in self._asked(probe).items() if w in probe):
            self.model = None  # not a byte-level model over runs of letters and runs of marks

    def _straight(self, pre_token: str) -> bytes:
        """Ids of one pre-token: its bytes go to the model as they are."""
        ids = [t.id for t in self.model.tokenize(pre_token.encode().decode("latin-1").translate(self.symbols))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _asked(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of unknown words: of letters and then marks from the model itself, of all others from the library."""
        made, rest = {}, []
        for w in words:
            if self.model and (plain := PLAIN(w.decode().lower())):
                letters, marks = plain.groups()
                if not marks:
                    made[w] = self._straight(letters)
                    continue
                stem = letters.encode()
                ids = self.get(stem) or made.get(stem)
                if ids is None:
                    ids = made[stem] = self._straight(letters)
                made[w] = ids + (self.marks.get(marks) or self._mark(marks))
            else:
                rest.append(w)
        found = self.library.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        made.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(rest, found, strict=True))
        return made

    def _mark(self, marks: str) -> bytes:
        ids = self._straight(marks)
        if len(self.marks) < KNOWN_MARKS and len(marks) <= KNOWN_BYTES:
            self.marks[marks] = ids
        return ids

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """Ids of each whole text: words from the memory or, a slice's unknown ones at once, from the library."""
        split = [self.words(t or b"") for t in texts]
        new = self._asked({w for words in split for w in words}.difference(self))
        long = {w: new.pop(w) for w in [w for w in new if len(w) > KNOWN_BYTES]}
        self.update(new)
        for words in split:
            yield b"".join([long[w] if w in long else self[w] for w in words]) if long else b"".join(map(self.__getitem__, words))
        if len(self) > KNOWN_WORDS:
            self.clear()

    def words(self, text: bytes) -> list[bytes]:
        """What ASCII white space divides; in lower case unless that could make one of the special strings."""
        return (text if b"<|" in text else text.lower()).split()


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(key, piece, start, length, ids_crc32, part, nth): every document's tokens and its end, cut into pieces.

    Only documents above ``capacity`` are cut. ``nth`` counts the pieces of a
    length within a partition ``part``.
    """
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "nth"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = word_ids(tokenizer_path), [0] * (capacity + 1)
        for batch in batches:
            for part in slices(batch, "text"):
                at, out = [], []
                number = part.column("part")[0].as_py()
                for row, ids in enumerate(codec.encode(part.column("text").cast(pa.binary()).to_pylist())):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids) >> 2, capacity)):
                        own = ids[start << 2 : start + capacity << 2]
                        at.append(row)
                        out.append((piece, start, len(own) >> 2, zlib.crc32(own), number, seen[len(own) >> 2]))
                        seen[len(own) >> 2] += 1
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(at, pa.int64())), *columns], names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.spark_partition_id().alias("part")).mapInArrow(lean(run), schema)


# --- plan -----------------------------------------------------------------------------------------------------------


@dataclass
class Plan:
    """Sequences by ranges: which ranks of each length go to which sequences, how many to each, and where."""

    capacity: int
    sequences: int = 0
    fixed: int = 0  # of them, by the reduction
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, first rank, first sequence, per sequence, offset
    ranked: dict[int, int] = field(default_factory=dict)

    def put(self, length: int, n: int, sequence: int, each: int, offset: int) -> None:
        first = self.ranked.get(length, 0)
        self.slots.append((length, first, sequence, each, offset))
        self.ranked[length] = first + n

    def opened(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n


def _fix(plan: Plan, count: np.ndarray, lengths: tuple[int, ...]) -> None:
    """As many sequences of exactly these lengths as there are pieces for."""
    n = min(int(count[w]) // lengths.count(w) for w in lengths)
    sequence, offset = plan.opened(n), 0
    plan.fixed += n
    for w in lengths:
        plan.put(w, n, sequence, 1, offset)
        count[w] -= n
        offset += w


def dominating(count: np.ndarray, length: int) -> tuple[int, ...] | None:
    """A set of at most three lengths that dominates every other set with ``length`` as its largest piece; None if none is known.

    That holds for every copy alike: with fewer pieces left, fewer sets compete.
    """
    room, others = len(count) - 1 - length, count.copy()
    others[length] -= 1
    have = np.flatnonzero(others)
    smallest = np.repeat(have[:3], np.minimum(others[have[:3]], 3))[:3]
    fit = int((np.cumsum(smallest) <= room).sum())
    if not fit:
        return (length,)
    below = have[have <= room]
    one = int(below[-1])
    if fit == 1 or one == room:
        return (length, one)
    if fit > 2:
        return None
    # Two fit, three don't: the best pair, its larger length first.
    partner = np.searchsorted(have, room - below, side="right") - 1
    partner = np.minimum(partner, np.arange(len(below)))
    short = (partner == np.arange(len(below))) & (others[below] < 2)  # a length can't pair with itself if there is one piece
    partner = partner - short
    ok = partner >= 0
    if not ok.any():
        return (length, one)
    sums = np.where(ok, below + have[np.maximum(partner, 0)], -1)
    at = int(np.flatnonzero(sums == sums.max())[-1])
    a, b = int(below[at]), int(have[partner[at]])
    if one >= a + b:
        return (length, one)
    above = have[have > b][:2]
    two = np.repeat(above, np.minimum(others[above], 2))[:2]
    return (length, a, b) if one == a and (len(two) < 2 or two.sum() > room) else None


def reduce_instance(plan: Plan, count: np.ndarray) -> None:
    """Fix all sets that are known to dominate, again and again until a pass finds none; ``count`` keeps what is left."""
    before = -1
    while before != plan.fixed:
        before = plan.fixed
        for length in np.flatnonzero(count)[::-1].tolist():
            while count[length] and (found := dominating(count, length)):
                _fix(plan, count, found)


def best_fit(plan: Plan, count: np.ndarray) -> None:
    """Best fit, longest first; sequences with equal room are taken range by range."""
    ranges: dict[int, list[tuple[int, int]]] = {}  # by room: first sequence, how many
    rooms: list[int] = []

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in ranges:
                insort(rooms, room)
            ranges.setdefault(room, []).append((first, n))

    for w in np.flatnonzero(count)[::-1].tolist():
        left = int(count[w])
        while left:
            i = bisect_left(rooms, w)
            if i < len(rooms):
                room = rooms[i]
                first, n = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room], rooms[i]
            else:
                room = plan.capacity
                n = -(-left // (room // w))
                first = plan.opened(n)
            each = room // w
            full = min(n, left // each)
            if full:
                plan.put(w, full * each, first, each, plan.capacity - room)
                keep(room - each * w, first, full)
                left -= full * each
            if full < n and left:  # one more sequence takes the last pieces of this length
                plan.put(w, left, first + full, each, plan.capacity - room)
                keep(room - left * w, first + full, 1)
                full, left = full + 1, 0
            keep(room, first + full, n - full)
        count[w] = 0


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where pieces go, from the number of pieces of each length (1 to ``capacity``)."""
    count = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        count[length] = n
    plan = Plan(capacity)
    reduce_instance(plan, count)
    best_fit(plan, count)
    return plan


# --- packing --------------------------------------------------------------------------------------------------------


class Slots:
    """A plan as sorted arrays, to look places up in bulk."""

    def __init__(self, plan: Plan):
        table = np.array(sorted(plan.slots), dtype=np.int64).reshape(-1, 5)
        self.keys = table[:, 0] << 48 | table[:, 1]
        self.first, self.sequence, self.each, self.offset = table[:, 1:].T

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, length << 48 | rank, side="right") - 1
        nth = rank - self.first[at]
        return self.sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written pieces with ``sequence_id`` and ``offset``; only counts by length reach the driver."""
    counts = written(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = cut.sparkSession.sparkContext.broadcast(Slots(make_plan(histogram, capacity)))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = written(counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("base")), "piece-ranks")
    ranked = cut.join(sent_if_small(bases, F.lit(20)), ["part", "length"])
    ranked = ranked.select("key", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = slots.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    kind = cut.schema["key"].dataType.simpleString()
    return ranked.mapInArrow(lean(run), f"key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each row of ``docs``: its key, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``, so a null, empty or blank text is one
    token. Rows are packed one by one: repeated rows, ties and null keys keep
    pieces of their own. Very long texts are read whole and cut. Other columns
    are left out, whatever their names; an empty table gives no rows. The
    tokenizer must drop white space and case (``WordIds``); its file must be
    readable on every worker.
    """
    cut = written(pieces(docs, tokenizer_path, key, text, capacity, end_id), "pieces")
    return place(cut, capacity).withColumnRenamed("key", key)
