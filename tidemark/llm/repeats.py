"""Substring dedup: passages of ``WINDOW`` words or more that occur twice anywhere.

Suffix trees over groups of suffixes, partitioned by prefixes of variable length.

1. Every suffix of ``WINDOW`` words or more is filed under the ``PREFIX``-word
   sequence of least hash among its first ``WINDOW`` words. Suffixes that agree
   over that depth hold the same sequence, and so do most neighbouring ones: a
   document's consecutive suffixes under one sequence make one branch, which
   travels as one row. About one branch stands for ten suffixes.
2. A sequence that occurs once ends there. Equal branches are one path with
   several leaves: they are counted by partial aggregates, all their suffixes
   are repeats, and one of them stands for all in what follows.
3. The paths of one sequence are a group. Groups of at most ``GROUP_WORDS`` words
   are packed into slabs of bounded memory, and the suffix tree of each slab is
   built to the depth of ``WINDOW`` words: its suffixes in order, with the length
   of the prefix that neighbours share. Internal nodes at that depth are the
   stretches of neighbours that share ``WINDOW`` words; their leaves are repeats,
   and consecutive ones make up the maximal repeats.
4. A larger group is split: its paths are filed again under sequences of twice the
   length, as often as it takes, at last under all ``WINDOW`` words, where equal
   suffixes are equal branches and need no tree.

Nothing is compared in pairs and no group is gathered in one place. Sequences and
branches are compared by 64-bit hashes (branches by two), words in a tree by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.scratch import discard, written
from tidemark.llm.words import lean, slices, span_hash, span_sums, split_words, text_bytes

WINDOW = 35
PREFIX = 8
SLICE = 1 << 20
GROUP_WORDS = 1 << 14  # of one sequence's paths; above, the sequence is lengthened
SLAB_WORDS = 1 << 18  # of the groups whose suffixes are sorted together
PREFIX_BASE, DEPTH_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def sliding_min(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of values[i : i + width] and where it first stands; the last entries see fewer."""
    least, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        if step < len(least):
            later = least[step:] < least[:-step]
            place = np.concatenate([np.where(later, place[step:], place[:-step]), place[-step:]])
            least = np.concatenate([np.minimum(least[:-step], least[step:]), least[-step:]])
        have += step
    return least, place


def branches(data: np.ndarray, offsets: np.ndarray, window: int, prefix: int) -> dict[str, np.ndarray]:
    """Branches of all rows: row, prefix hash, branch hash, first window's word, further windows, loop.

    A loop holds its prefix more than once, so that its own windows may repeat.
    A prefix of a whole window has that window alone in its branches.
    """
    words = split_words(data, offsets)
    n, first = len(words.starts), words.first
    row = words.row_of_word()
    start = np.arange(n)
    whole = start + window <= first[1:][row] if n else np.zeros(0, dtype=bool)
    if not whole.any():
        none = np.zeros(0, dtype=np.int64)
        return {"row": none, "key": none, "branch": none, "start": none, "more": none, "loop": none.astype(bool)}
    sums = span_sums(words.hashes(1), PREFIX_BASE)
    prefixes = span_hash(sums, PREFIX_BASE, start[: n - prefix + 1], start[: n - prefix + 1] + prefix)
    least, place = sliding_min(prefixes, window - prefix + 1)
    at = start[whole]  # beyond the last window's start, least isn't read
    key, owner, place = least[at], row[at], place[at]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (prefix == window)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    begin, more = at[head], at[tail] - at[head]
    deep = span_sums(words.hashes(2), DEPTH_BASE)
    branch = span_hash(deep, DEPTH_BASE, begin, begin + more + window)
    return {"row": owner[head], "key": key[head].view(np.int64), "branch": branch.view(np.int64), "start": begin - first[owner[head]], "more": more, "loop": place[head] != place[tail]}


def suffix_tree(symbols: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix tree to this depth, written flat: the suffixes at ``starts`` in order, and the length that neighbours share.

    Ranks of sequences of 1, 2, 4, ... symbols come from those of half the
    length; all suffixes must have ``depth`` symbols.
    """
    ranks, length = [np.unique(symbols, return_inverse=True)[1]], 1
    while 2 * length <= depth:
        last = ranks[-1]
        ranks.append(np.unique(last[:-length] * (last.max() + 1) + last[length:], return_inverse=True)[1])
        length *= 2
    last = ranks[-1]
    order = starts[np.argsort(last[starts] * (last.max() + 1) + last[starts + depth - length], kind="stable")]
    one, two = order[:-1], order[1:]
    shared = np.zeros(len(one), dtype=np.int64)
    for power in range(len(ranks) - 1, -1, -1):
        fits = np.flatnonzero(shared + (1 << power) <= depth)
        same = ranks[power][one[fits] + shared[fits]] == ranks[power][two[fits] + shared[fits]]
        shared[fits[same]] += 1 << power
    return order, shared


def deep_leaves(paths: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(path, word) of every suffix below an internal node of the tree at depth ``window``."""
    data = np.frombuffer(b"".join(paths), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    words = split_words(data, offsets)
    row = words.row_of_word()
    at = np.arange(len(row))
    starts = at[at + window <= words.first[1:][row]]
    order, shared = suffix_tree(words.hashes(3), starts, window)
    node = np.flatnonzero(shared >= window)
    leaves = np.unique(np.concatenate([order[node], order[node + 1]]))
    return row[leaves], leaves - words.first[row[leaves]]


def _kinds(rows: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    """The schema of an identifier, its print and further fields."""
    return T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("print", T.LongType()), *(T.StructField(n, t) for n, t in more)])


_BRANCH = (("key", T.LongType()), ("branch", T.LongType()), ("start", T.IntegerType()), ("more", T.IntegerType()), ("loop", T.BooleanType()))


def file_suffixes(rows: DataFrame, window: int, prefix: int) -> DataFrame:
    """The branches of all suffixes under their sequences of ``prefix`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = branches(*text_bytes(part.column(2)), window, prefix)
                at = pa.array(found["row"])
                columns = [part.column(0).take(at), part.column(1).take(at), pa.array(found["key"]), pa.array(found["branch"]), pa.array(found["start"], pa.int32()), pa.array(found["more"], pa.int32()), pa.array(found["loop"])]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "print", *(n for n, _ in _BRANCH)])

    return rows.mapInArrow(lean(run), _kinds(rows, *_BRANCH))


_SPELLED = (("key", T.LongType()), ("large", T.BooleanType()), ("start", T.IntegerType()), ("words", T.StringType()))


def spell_out(rows: DataFrame, paths: DataFrame, window: int) -> DataFrame:
    """(id, print, key, large, start, words): the words of each path, read from its text."""
    found = paths.groupBy("id", "print").agg(F.collect_list(F.struct("key", "large", "start", "more")).alias("paths"))
    # Rows alike in identifier and text are read once.
    texts = _with_texts(rows, found, "paths").groupBy("id", "print").agg(F.first("text").alias("text"), F.first("paths").alias("paths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, "text", SLICE)):
            owner, keys, large, starts, spelled = [], [], [], [], []
            for i, (text, found) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                raw = text.encode()
                words = split_words(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
                for p in found:
                    owner.append(i)
                    keys.append(p["key"])
                    large.append(p["large"])
                    starts.append(p["start"])
                    spelled.append(raw[words.starts[p["start"]] : words.ends[p["start"] + p["more"] + window - 1]])
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.int64()), pa.array(large), pa.array(starts, pa.int32()), pa.array(spelled, pa.binary()).cast(pa.string())], names=["id", "print", *(n for n, _ in _SPELLED)])

    return texts.mapInArrow(lean(run), _kinds(rows, *_SPELLED))


def tree_repeats(spelled: DataFrame, window: int) -> DataFrame:
    """(id, print, start, end): ranges of first words of suffixes that share ``window`` words with another of their group."""

    kind, most = spelled.schema["id"].dataType, SLAB_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        held: list[tuple] = []
        size, last = 0, None

        def repeats() -> pa.RecordBatch:
            path, word = deep_leaves([h[3] for h in held], window)
            head = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (word[1:] != word[:-1] + 1)])) if len(path) else np.zeros(0, dtype=np.int64)
            tail = np.append(head[1:], len(path)) - 1 if len(head) else head
            first = np.array([h[2] for h in held])[path[head]] if len(head) else head
            columns = [pa.array([held[p][0] for p in path[head]], id_type), pa.array([held[p][1] for p in path[head]], pa.int64()), pa.array(first + word[head], pa.int32()), pa.array(first + word[tail], pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["id", "print", "start", "end"])

        id_type = to_arrow_type(kind)
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            for i, p, key, _, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode()
                if size > most and key != last:
                    yield repeats()
                    held, size = [], 0
                held.append((i, p, start, words))
                size, last = size + words.count(b" ") + window, key
        if held:
            yield repeats()

    dealt = spelled.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(lean(run), _kinds(spelled, ("start", T.IntegerType()), ("end", T.IntegerType())))


def find_repeats(rows: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """(id, print, start, end): suffixes that agree with another over ``window`` words, as ranges of their first words.

    ``rows`` holds id, print (a hash of the text) and text. Ranges may overlap.
    """
    filed = written(file_suffixes(rows, window, prefix), "branches")
    often = written(filed.groupBy("key").agg(F.count("*").alias("n"), F.max("loop").alias("loop")).where("n > 1 or loop").select(F.col("key").alias("__key")), "shared-sequences")
    shared = written(filed.join(often, _same("key")).drop("__key"), "shared-branches")
    discard(filed, often)
    paths = shared.groupBy("key", "branch").agg(F.count("*").alias("n"), F.max("loop").alias("loop"), F.min(F.struct("print", "start", "id", "more")).alias("first"))
    paths = written(paths, "paths")
    equal = paths.where("n > 1").select(F.col("key").alias("__key"), F.col("branch").alias("__branch"))
    whole = shared.join(equal, _same("key") & _same("branch")).select("id", "print", "start", (F.col("start") + F.col("more")).alias("end"))
    groups = paths.groupBy("key").agg(F.count("*").alias("paths"), F.max("loop").alias("loop"), F.sum(F.col("first.more") + window).alias("words")).where("paths > 1 or loop")
    large = F.lit(False) if prefix == window else F.col("words") > GROUP_WORDS
    groups = written(groups.select(F.col("key").alias("__key"), large.alias("large")), "groups")
    grouped = paths.select("key", "first.id", "first.print", "first.start", "first.more").join(groups, _same("key")).drop("__key")
    spelled = written(spell_out(rows, grouped, window), "spelled-paths")
    out = whole.unionAll(tree_repeats(spelled.where("not large"), window))
    if not groups.where("large").isEmpty():
        paths = spelled.where("large").select(F.struct("id", "print", "start").alias("id"), F.xxhash64("words").alias("print"), F.col("words").alias("text"))
        deeper = find_repeats(paths, window, min(2 * prefix, window))
        out = out.unionAll(deeper.select("id.id", "id.print", (F.col("id.start") + F.col("start")).alias("start"), (F.col("id.start") + F.col("end")).alias("end")))
    return out


def _same(name: str) -> Column:
    return F.col(name) == F.col(f"__{name}")


def _with_texts(rows: DataFrame, found: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """Texts joined to what was found in them."""
    other = found.select(F.col("id").alias("__id"), F.col("print").alias("__print"), column)
    return rows.join(other, (F.col("print") == F.col("__print")) & F.col("id").eqNullSafe(F.col("__id")), how).drop("__id", "__print")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """One row for each row of ``docs``: its key, n_words, n_removed, kept (words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts
    anywhere else, in its own text too; windows are judged on the input. Null
    texts have no words. Rows repeated with key and text count as occurrences
    of each other. Other columns play no part; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = find_repeats(rows, window, prefix).select("id", "print", (F.col("start").cast("long") * (1 << 32) + F.col("end")).alias("range"))
    ranges = written(ranges.groupBy("id", "print").agg(F.collect_set("range").alias("ranges")), "removed-ranges")
    joined = _with_texts(rows, ranges, "ranges", "left").select("id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kept, n_words, n_removed = [], [], []
                for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = t.encode().split()
                    n_words.append(len(words))
                    if found:
                        each = np.array(found, dtype=np.int64)
                        change = np.zeros(len(words) + 1, dtype=np.int64)
                        np.add.at(change, each >> 32, 1)
                        np.add.at(change, (each & 0xFFFFFFFF) + window, -1)
                        stays = np.cumsum(change[:-1]) == 0
                        words = list(compress(words, stays.tolist()))
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=[key, "n_words", "n_removed", "kept"])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return joined.mapInArrow(lean(cut), schema)
