"""N-gram Jaccard join through a token-group matrix.

Documents become sets of word shingles; equal sets are one node. Similar nodes
are put into groups (by size and the least hash of their frequent tokens, which
near copies keep, or the two least of all), and what the groups' members hold
is kept as a sparse matrix of tokens and groups. A node is compared in its own
group, or opens another, only if the matrix lets it reach the threshold with
some node there; nodes that none can reach play no further part:

* Tokens have one global order, frequent ones last. Two sets over the
  threshold share a token in the first few of their tokens (prefix filter) at
  positions that leave room for the overlap (position filter). The matrix
  holds those tokens of each group, with its members' sizes and positions.
* An opened group first bounds the overlap by its members' token union, and
  compares sets only if that reaches the threshold.

A group above ``BLOCK_ROWS`` or ``BLOCK_TOKENS`` is cut into blocks. All other
blocks, and all that open the group, visit the first block, which has a copy for
every ``VISITORS`` of them; two nodes that this has put into one component need
no comparison, so that only nodes outside of the component of the group's pivot
(strays) go on. The pivot is the member of the first block nearest to what most
of its members hold. The distance of two sets, the size of their symmetric
difference, is that of their differences to the pivot, and a stray is too far
from the pivot for a link; so a stray and any set that it links to share a part
of these differences. Prefix and position filters over them, those rare in the
first block first, name the blocks that a stray opens (``_left_over``). What
copies of one text share is in no difference, so a group of copies sends each
set about once, not once for every block. Links
are passed on as stars, never as all pairs. Components come from the links by
min-label propagation with pointer jumping. Counts cover all documents; nothing
is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.scratch import discard, sent_if_small, written
from tidemark.llm.words import lean, mix, slices, span_hash, span_sums, split_words, text_bytes

SHINGLE, PERCENT = 5, 80
BASE = 0xE7037ED1A0B428DB
FREQUENT_DOCS, FREQUENT_TOKENS = 8, 1 << 17
BLOCK_ROWS, BLOCK_TOKENS = 128, 1 << 20
VISITORS = 1024  # visitors of one copy of a block; they are streamed, only the block is held
SLICE = 1 << 20
SENT_BYTES = 4 << 20  # of sets in one batch from a worker
RANKED_TOKENS = 1 << 18  # of prefixes in one batch from a worker


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words than a shingle make one of them all."""
    data, offsets = text_bytes(texts)
    words = split_words(data, offsets, lower=True)
    first, n = words.first, len(words.starts)
    if not n:
        for _ in range(len(offsets) - 1):
            yield np.zeros(0, dtype=np.uint64)
        return
    sums = span_sums(words.hashes(5), BASE)
    start = np.arange(n)
    size = np.diff(first)
    end = np.minimum(start + shingle, first[1:][words.row_of_word()])
    every = span_hash(sums, BASE, start, end)
    for at, count in zip(first[:-1].tolist(), size.tolist(), strict=True):
        if count:
            yield np.unique(every[at : at + max(1, count - shingle + 1)])
        else:
            yield np.zeros(0, dtype=np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of which one at least is shared with any set over the threshold."""
    return n - -(-n * percent // 100) + 1


def is_frequent(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), dtype=bool)
    place = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return frequent[place] == tokens


def counted(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens by hash: over these, frequent tokens are counted and groups are formed."""
    want = prefix_length(len(tokens), percent)
    return tokens[: want + want // 2 + 2]


def ordered_prefix(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a set in the global order: by hash, frequent tokens last."""
    want, some = prefix_length(len(tokens), percent), counted(tokens, percent)
    often = is_frequent(some, frequent)
    if len(some) - often.sum() < want and len(some) < len(tokens):
        some, often = tokens, is_frequent(tokens, frequent)
    return np.concatenate([some[~often], some[often]])[:want]


def group_of(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> int:
    """The group of a set: any rule will do for right results, a good one puts similar sets together."""
    some = counted(tokens, percent)
    often = some[is_frequent(some, frequent)]
    if len(often):
        band = int(np.log(len(tokens)) / np.log(100 / percent))
        name = often[:1] ^ mix(np.array([band], dtype=np.uint64))
    else:
        name = tokens[:1] + (tokens[1:2] if len(tokens) > 1 else np.zeros(1, dtype=np.uint64)) * np.uint64(3)
    return int(mix(name).view(np.int64)[0])


def _need(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of sets of these sizes that reaches the threshold."""
    return F.ceil((a + b) * percent / (100 + percent))


def _frequent(rows: DataFrame, shingle: int, percent: int) -> np.ndarray:
    """Sorted hashes of the most frequent tokens, at most ``FREQUENT_TOKENS``, counted over the sets' first tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                firsts = []
                for tokens in shingle_sets(part.column(0), shingle):
                    firsts.append(counted(tokens, percent) if len(tokens) else tokens)
                token, docs = np.unique(np.concatenate(firsts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(docs, pa.int64())], names=["token", "docs"])

    sums = rows.select("text").mapInArrow(lean(count), "token long, docs long").groupBy("token").agg(F.sum("docs").alias("docs"))
    often = written(sums.where(F.col("docs") >= FREQUENT_DOCS).withColumn("level", F.floor(F.log2("docs") * 8)), "frequent-tokens")
    lowest, total = None, 0
    for r in often.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        total += r.n
        if total > FREQUENT_TOKENS:
            break
        lowest = r.level
    if lowest is None:
        return np.zeros(0, dtype=np.uint64)
    found = often.where(F.col("level") >= lowest).select("token").toArrow()["token"].to_numpy()
    discard(often)
    return np.sort(found.view(np.uint64))


def _sets(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, print, n, d1, d2, grp, prefix) for each row; d1 and d2 are two hashes of the whole set."""
    sent = rows.sparkSession.sparkContext.broadcast(_frequent(rows, shingle, percent))
    schema = T.StructType([rows.schema["id"], rows.schema["print"], *(T.StructField(c, T.LongType()) for c in ("n", "d1", "d2", "grp")), T.StructField("prefix", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n, d1, d2, grp, prefixes = [], [], [], [], []
                for tokens in shingle_sets(part.column(2), shingle):
                    n.append(len(tokens))
                    one, two = digest(tokens)
                    d1.append(one)
                    d2.append(two)
                    grp.append(group_of(tokens, frequent, percent) if len(tokens) else 0)
                    prefixes.append(ordered_prefix(tokens, frequent, percent) if len(tokens) else tokens)
                offsets = np.zeros(len(n) + 1, dtype=np.int32)
                np.cumsum([len(p) for p in prefixes], out=offsets[1:])
                flat = np.concatenate(prefixes).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in (n, d1, d2, grp)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=schema.names)

    return written(rows.mapInArrow(lean(run), schema), "shingle-sets")


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    parts = (mix(tokens ^ np.uint64(0x9FB21C651E98DF25)), mix(tokens + np.uint64(0xD8163841FDE6A8F9)))
    return tuple(int(np.array([p.sum(dtype=np.uint64)]).view(np.int64)[0]) for p in parts)


def _shared(nodes: DataFrame, *within: str) -> DataFrame:
    """``nodes`` by (pos, token) of their prefix: tokens that more than one node has, or more than one of those alike in ``within``."""
    each = nodes.select("*", F.posexplode("prefix").alias("pos", "token")).drop("prefix")
    often = each.groupBy("token", *within).agg(F.count("*").alias("holders")).where("holders > 1").drop("holders")
    often = written(often, "shared-tokens")
    shared = written(each.join(often, ["token", *within]), "shared-prefixes")
    discard(often)
    return shared


def _matrix(shared: DataFrame, percent: int, *group: str) -> DataFrame:
    """The matrix of tokens and groups: sizes of a group's members that hold a token, its first position in them, and how many they are."""
    held = [F.col(g).alias(f"at_{g}") for g in group]
    cells = shared.where(_in_matrix(percent)).groupBy(F.col("token").alias("held"), *held)
    return cells.agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("first"), F.count("*").alias("holders"))


def _in_matrix(percent: int) -> Column:
    """Whether a token's position lets its set be found by a set of its size or more."""
    return F.col("pos") < F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1


def _reaches(percent: int) -> Column:
    """Whether a node may reach the threshold with a group, by one token of the matrix."""
    n, lo, hi = F.col("n"), F.greatest("lo", F.ceil(F.col("n") * percent / 100)), F.least("hi", "n")
    return (F.col("token") == F.col("held")) & (lo <= hi) & (n - F.col("pos") >= _need(n, lo, percent)) & (hi - F.col("first") >= _need(n, hi, percent))


def _hits(shared: DataFrame, percent: int) -> DataFrame:
    """(d1, grp, token, target): groups that hold what a node may reach the threshold with, its own only if another member holds it."""
    alone = (F.col("grp") == F.col("at_grp")) & _in_matrix(percent) & (F.col("holders") == 1)
    return shared.join(_matrix(shared, percent, "grp"), _reaches(percent) & ~alone).select("d1", "grp", "token", F.col("at_grp").alias("target"))


def _met(shared: DataFrame, hits: DataFrame, percent: int) -> DataFrame:
    """(d1): nodes that may reach the threshold with another in their own group, a member or one that opens it.

    Of two such nodes, the larger one hits a cell of the matrix, and the smaller one is among those that the cell is made of.
    """
    cells = hits.select(F.col("token").alias("held"), "target").distinct()
    found = shared.where(_in_matrix(percent)).join(cells, (F.col("token") == F.col("held")) & (F.col("grp") == F.col("target")), "left_semi")
    return hits.where("grp = target").select("d1").unionAll(found.select("d1")).distinct()


def _blocks(nodes: DataFrame) -> DataFrame:
    """(grp, rows, blocks) of each group."""
    groups = nodes.groupBy("grp").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    return groups.select("grp", "rows", F.least(blocks, F.col("rows").cast("int")).alias("blocks"))


def _to(grp: Column, i: Column, j: Column, visits: bool, ranks: Column) -> Column:
    """One place where a set is compared: as a member of block ``i``, or as a visitor; ``j`` tells comparisons of a block apart, ``ranks`` asks for prefixes."""
    return F.struct(grp.alias("grp"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(visits).alias("visits"), ranks.alias("ranks"))


def links(rows: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a1, a2, b1, b2): links between nodes as stars; connected nodes are those of the full link graph."""
    shared = _shared(nodes.select("d1", "n", "grp", "prefix"))
    hits = written(_hits(shared, percent), "hits")
    opened = written(hits.where("grp != target").select("d1", "target").distinct(), "openings")
    met = written(nodes.select("id", "print", "n", "d1", "d2", "grp").join(_met(shared, hits, percent), "d1", "left_semi"), "met-nodes")
    discard(hits, shared)
    targets = opened.groupBy(F.col("target").alias("grp")).agg(F.count("*").alias("guests"))
    groups = _blocks(met).join(targets, "grp", "left").withColumn("guests", F.coalesce("guests", F.lit(0)))
    come = F.col("guests") + F.when(F.col("blocks") > 1, F.col("rows")).otherwise(0)
    groups = groups.where("rows > 1 or guests > 0").select(F.col("grp").alias("__grp"), "blocks", F.floor(come / VISITORS).cast("int").alias("copies"))
    active = written(groups, "active-groups")
    visitors = written(nodes.select("id", "print", "d1", "d2").join(opened, "d1").withColumnRenamed("target", "grp"), "visitors")
    discard(opened)
    at_home = F.col("grp") == F.col("__grp")
    members = met.drop("n").join(active, at_home).drop("__grp").withColumn("block", F.pmod("d1", "blocks").cast("int"))
    first = lambda seat, visits: _to(F.col("grp"), F.lit(0), -seat, visits, F.col("blocks") > 1)
    seats = F.transform(F.sequence(F.lit(0), F.col("copies")), lambda seat: first(seat, False))
    seat = first(F.pmod(F.xxhash64("d1"), F.col("copies") + 1), True)
    own = F.when(F.col("block") == 0, seats).otherwise(F.array(seat))
    wanted = members.select("id", "print", "d1", "d2", F.explode(own).alias("to"))
    wanted = wanted.unionAll(visitors.join(active, at_home).select("id", "print", "d1", "d2", seat.alias("to")))
    made = written(_compared(rows, wanted, shingle, percent), "links")
    found = _stars(made)
    if active.where("blocks > 1").isEmpty():
        return found
    apart = made.where("prefix is not null").select(F.col("a1").alias("d1"), "n", "m", "grp", "prefix")
    return found.unionAll(_stars(_compared(rows, _left_over(members, visitors.join(active, at_home).drop("__grp"), found, apart, percent), shingle, percent)))


def _stars(made: DataFrame) -> DataFrame:
    """The links among the rows of ``_compared``."""
    return made.where("prefix is null").select("a1", "a2", "b1", "b2")


def _left_over(members: DataFrame, visitors: DataFrame, found: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """What groups of several blocks have to compare when all are compared with the first block.

    Two nodes of the pivot's component are connected already, so one of a pair
    is a stray: one outside of it. Strays open blocks but the first, whose sets
    have met all; visitors inside of the pivot's component open parts of strays.
    Both by the matrix of tokens and places, over the differences to the pivot
    (``apart``). A stray opens its own block only for a token that another
    member holds. A place that many open has copies, and one that nobody opens
    isn't sent.
    """
    label = components(found.select(_node("a1", "a2").alias("a"), _node("b1", "b2").alias("b")))
    label = label.select(F.col("node").alias("__node"), "label")

    def known(df: DataFrame) -> DataFrame:
        df = df.where("blocks > 1").withColumn("node", _node("d1", "d2")).join(label, F.col("node") == F.col("__node"), "left")
        return df.withColumn("label", F.coalesce("label", "node")).drop("__node", "node")

    members, visitors = written(known(members), "members"), written(known(visitors), "block-visitors")
    pivots = members.join(apart.where("m = 0").select("grp", "d1").distinct(), ["grp", "d1"]).select("grp", F.col("label").alias("main"))
    labels = members.groupBy("grp", "label").agg(F.count("*").alias("n")).join(pivots, "grp", "left").withColumn("main", F.coalesce("main", F.lit("")))
    main = written(labels.groupBy("grp", "main").agg(F.sum(F.when(F.col("label") != F.col("main"), F.col("n")).otherwise(0)).alias("strays")), "main-components")
    main = sent_if_small(main, F.lit(64)).withColumnRenamed("grp", "__grp")
    away, named, block = F.col("label") != F.col("main"), ["id", "print", "d1", "d2"], F.col("block")
    placed = lambda df: df.join(main, F.col("grp") == F.col("__grp")).withColumn("away", away).drop("__grp", "main", "label")
    members, visitors = placed(members).where(block > 0), placed(visitors)
    part = F.pmod(F.xxhash64("d1"), F.ceil(F.col("strays") / BLOCK_ROWS)).cast("int")
    hosts = members.select(*named, "grp", F.lit(True).alias("late"), block.alias("at"))
    hosts = hosts.unionAll(members.where("away").select(*named, "grp", F.lit(False).alias("late"), part.alias("at")))
    seeking = members.where("away").select(*named, "grp", "away", "block")
    seeking = seeking.unionAll(visitors.where("away or strays > 0").select(*named, "grp", "away", F.lit(-1).alias("block")))
    seeking = written(seeking, "seeking")
    sought = seeking.select(F.col("grp").alias("__grp"), F.col("away").alias("__away")).distinct()
    held = hosts.join(sought, (F.col("grp") == F.col("__grp")) & (F.col("late") == F.col("__away")), "left_semi")
    tokens = _shared(apart.join(sought, F.col("grp") == F.col("__grp"), "left_semi"), "grp")
    tokens = tokens.withColumnsRenamed({"d1": "__d1", "grp": "__grp"})
    of_set = (F.col("d1") == F.col("__d1")) & (F.col("grp") == F.col("__grp"))
    matrix = _apart_matrix(tokens.join(held, of_set), percent, "grp", "late", "at")
    fits = _meets(percent) & (F.col("grp") == F.col("at_grp")) & (F.col("away") == F.col("at_late"))
    alone = F.col("away") & (block == F.col("at_at")) & (F.col("holders") == 1)
    seen = tokens.join(seeking, of_set).join(matrix, fits & ~alone)
    seen = written(seen.select(*named, "grp", F.col("away").alias("late"), F.col("at_at").alias("at")).distinct(), "opened-places")
    guests = seen.groupBy("grp", "late", "at").agg(F.floor(F.count("*") / VISITORS).cast("int").alias("copies"))
    guests = sent_if_small(written(guests, "places"), F.lit(24))
    place = lambda seat, visits: _to(F.col("grp"), F.col("at"), -(seat * 2 + F.when(F.col("late"), 1).otherwise(2)), visits, F.lit(False))
    seats = F.transform(F.sequence(F.lit(0), F.col("copies")), lambda seat: place(seat, False))
    host = hosts.join(guests, ["grp", "late", "at"]).select(*named, F.explode(seats).alias("to"))
    return host.unionAll(seen.join(guests, ["grp", "late", "at"]).select(*named, place(F.pmod("d1", F.col("copies") + 1), True).alias("to")))


def _apart_matrix(tokens: DataFrame, percent: int, *place: str) -> DataFrame:
    """The matrix of tokens and places: sizes of a place's sets whose difference to the pivot shows a token, and bounds for ``_meets``."""
    size, m = (100 - percent) * F.col("n"), (100 + percent) * F.col("m")
    cells = tokens.groupBy(F.col("token").alias("held"), *[F.col(p).alias(f"at_{p}") for p in place])
    room = m + size - (200 + 2 * percent) * F.col("pos")
    return cells.agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(room).alias("room"), F.min(m - size).alias("least"), F.count("*").alias("holders"))


def _meets(percent: int) -> Column:
    """Whether a set may reach the threshold with one of a place, by one token of their differences to the pivot.

    Sets of n and n' tokens, m and m' of them or of the pivot's in their
    differences to it, link if those differ by at most (100 - percent) / (100 +
    percent) * (n + n'); the differences then share m + m' less that, halved,
    and no fewer stand from the first shared token on, in either.
    """
    n, size, m = F.col("n"), (100 - percent) * F.col("n"), (100 + percent) * F.col("m")
    sizes = (F.col("hi") * 100 >= n * percent) & (F.col("lo") * percent <= n * 100)
    return (F.col("token") == F.col("held")) & sizes & (m + size - (200 + 2 * percent) * F.col("pos") >= F.col("least")) & (F.col("room") >= m - size)


def _compared(rows: DataFrame, wanted: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links as stars, of sets of (id, print, d1, d2) brought to the place ``to``; where that asks for them, also (a1, a2, grp, n, m, prefix) of visitors, and of the pivot with m = 0."""
    fetch = written(wanted.groupBy("id", "print", "d1", "d2").agg(F.collect_list("to").alias("to")), "fetch-sets")
    other = sent_if_small(fetch, _width("id") + 24 + 25 * F.size("to")).select(F.col("id").alias("__id"), F.col("print").alias("__print"), "d1", "d2", "to")
    texts = rows.join(other, (F.col("print") == F.col("__print")) & F.col("id").eqNullSafe(F.col("__id"))).select("text", "d1", "d2", "to")

    def packed(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["grp", "i", "j", "visits", "ranks", "d1", "d2", "tokens"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                out: list[tuple] = []
                size = 0
                for tokens, d1, d2, to in zip(shingle_sets(part.column(0), shingle), *(part.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                    raw = tokens.tobytes()
                    for k in to:
                        out.append((k["grp"], k["i"], k["j"], k["visits"], k["ranks"], d1, d2, raw))
                        size += len(raw)
                        if size > SENT_BYTES:
                            yield packed(out)
                            out, size = [], 0
                if out:
                    yield packed(out)

    sent = texts.mapInArrow(lean(send), "grp long, i int, j int, visits boolean, ranks boolean, d1 long, d2 long, tokens binary")
    dealt = sent.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "visits", "d1", "d2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None
        key, found, held = None, [], 0

        def flush():
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["a1", "a2", "b1", "b2", "grp", "n", "m", "prefix"])

        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            for grp, i, j, visits, ranks, d1, d2, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (grp, i, j) != key:
                    if block:
                        found += block.rows(key[0])
                    key, block = (grp, i, j), Block(percent, among=i == j, ranks=ranks)
                block.add((d1, d2), np.frombuffer(tokens, dtype=np.uint64), visits)
            if block:
                ranked = block.take_ranked(key[0])
                found += ranked
                held += sum(len(r[-1]) for r in ranked)
            if len(found) > 10_000 or held > RANKED_TOKENS:
                yield flush()
                found, held = [], 0
        if block:
            found += block.rows(key[0])
        if found:
            yield flush()

    return dealt.mapInArrow(lean(compare), "a1 long, a2 long, b1 long, b2 long, grp long, n long, m long, prefix array<long>")


class Block:
    """Members of a group, against each other and against visitors that come after them.

    With ``ranks``, the prefix of each visitor's difference to the pivot is kept too, what few members' differences hold first.
    """

    def __init__(self, percent: int, among: bool, ranks: bool = False):
        self.percent, self.among, self.names, self.sets, self.parent, self.ready = percent, among, [], [], [], False
        self.ranks, self.ranked = ranks, []

    def add(self, name: tuple[int, int], tokens: np.ndarray, visits: bool) -> None:
        if self.names and name == self.names[-1]:
            return  # the same set, from repeated rows
        if not visits:
            self.names.append(name)
            self.sets.append(tokens)
            self.parent.append(len(self.parent))
            return
        if not self.ready:
            self.prepare()
        self.names.append(name)
        self.parent.append(len(self.parent))
        if self.ranks:
            self.rank(name, tokens)
        for other in self.near(tokens, self.members):
            self.join(len(self.parent) - 1, other)

    def prepare(self) -> None:
        """The members' token union, with the members that hold each token."""
        self.ready, self.members = True, len(self.sets)
        self.size = np.array([len(s) for s in self.sets], dtype=np.int64)
        every = np.concatenate(self.sets) if self.sets else np.zeros(0, dtype=np.uint64)
        holder = np.repeat(np.arange(self.members), self.size)
        order = np.argsort(every, kind="stable")
        every, self.holder = every[order], holder[order]
        head = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.zeros(0, dtype=bool)
        self.union = every[head]
        self.at = np.append(np.flatnonzero(head), len(every))
        if self.ranks:
            self.find_pivot()
        if self.among:
            for i, tokens in enumerate(self.sets):
                for other in self.near(tokens, i):
                    self.join(i, other)
        self.sets = []

    def find_pivot(self) -> None:
        """The member nearest to the tokens that most members hold; without members, the empty set."""
        self.pivot = np.zeros(0, dtype=np.uint64)
        if self.members:
            count = np.diff(self.at)
            most = count * 2 > self.members
            held = np.bincount(self.holder, weights=np.repeat(most, count), minlength=self.members)
            at = int(np.argmin(self.size - 2 * held))
            self.pivot = self.sets[at]
            self.ranked.append((self.names[at], len(self.pivot), 0, np.zeros(0, dtype=np.int64)))

    def rank(self, name: tuple[int, int], tokens: np.ndarray) -> None:
        """Keep what a link's first shared token may be, of a set's difference to the pivot.

        If the set links to the pivot, its partner doesn't, and they share more
        than half of the difference, less what sizes allow. If it doesn't, its
        difference exceeds what a link allows, and the partner has to make up for it.
        """
        apart = np.setxor1d(tokens, self.pivot, assume_unique=True)
        holders = np.zeros(len(apart), dtype=np.int64)
        if len(self.union):
            place = np.minimum(np.searchsorted(self.union, apart), len(self.union) - 1)
            holders = np.where(self.union[place] == apart, self.at[place + 1] - self.at[place], 0)
        lacks = np.isin(apart, self.pivot, assume_unique=True)
        rare = np.where(lacks, 2 * (self.members - holders) + 1, 2 * holders)  # of two as rare, words put in come first
        n, m, whole, part = len(tokens), len(apart), 100 + self.percent, 100 - self.percent
        beyond = whole * m - part * (n + len(self.pivot))
        if beyond > 0:
            shown = m - -(-beyond // 200) + 1
        else:
            shown = -(-(whole * m + part * (n - len(self.pivot))) // (2 * whole))
        first = apart[np.argsort(rare, kind="stable")[: max(0, shown)]]
        self.ranked.append((name, n, m, first.view(np.int64)))

    def take_ranked(self, grp: int) -> list[tuple]:
        """Rows of the prefixes kept since the last call."""
        ranked, self.ranked = self.ranked, []
        return [(*name, None, None, grp, n, m, first) for name, n, m, first in ranked]

    def rows(self, grp: int) -> list[tuple]:
        """Links and prefixes, of a block that is done."""
        return [(*star, None, None, None, None) for star in self.stars()] + self.take_ranked(grp)

    def near(self, tokens: np.ndarray, before: int) -> np.ndarray:
        """Members numbered below ``before`` whose similarity reaches the threshold."""
        if not before or not len(tokens):
            return np.zeros(0, dtype=np.int64)
        place = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        place = place[self.union[place] == tokens]
        if len(place) * 100 < len(tokens) * self.percent:
            return np.zeros(0, dtype=np.int64)  # the bound: no member can reach it
        count = self.at[place + 1] - self.at[place]
        start = np.repeat(self.at[place] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        both = np.bincount(self.holder[start + np.arange(len(start))], minlength=self.members)[:before]
        return np.flatnonzero(both * 100 >= self.percent * (len(tokens) + self.size[:before] - both))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(int(j))
        self.parent[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int, int, int]]:
        """One link from each node to the first of its component."""
        if not self.ready:
            self.prepare()
        return [(*self.names[self.root(i)], *self.names[i]) for i in range(len(self.names)) if self.names[self.root(i)] != self.names[i]]


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of the links reaches.

    Labels spread along links and by pointer jumping, so that rounds grow with
    the logarithm of a component's width. Every round is written, so a lost
    executor costs one round at most.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("hop"))
        moved = labels.join(heard, "node").join(hop, "label").select("node", F.col("label").alias("was"), F.least("label", "heard", "hop").alias("label"))
        moved = written(moved, "labels")
        if moved.where(F.col("was") != F.col("label")).isEmpty():
            return moved.select("node", "label")
        labels = moved.drop("was")


def _width(name: str) -> Column:
    """Bytes of a column's values, written out."""
    return F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))


def _node(one: str, two: str) -> Column:
    return F.concat(F.lpad(F.hex(one), 16, "0"), F.lpad(F.hex(two), 16, "0"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: id, print (a hash of its text), n_shingles, component_id.

    Two documents link when 100 * |intersection| >= percent * |union| of their
    distinct shingles, A-Z in lower case; ``component_id`` is the smallest key
    reachable by links. Null texts and texts without words have no shingles
    and link with nothing. Rows with equal texts always link, repeated rows
    too; null keys never name a component unless it has no other. Other
    columns play no part; an empty table gives no rows.
    """
    return _labelled(docs, key, text, shingle, percent).drop("label")


def _labelled(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """``near_duplicates`` with ``label``, which tells components apart whatever their ids: null without shingles."""
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sets = _sets(rows, shingle, percent)
    node = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "print"))
    nodes = sets.where("n > 0").groupBy("d1", "d2").agg(node.alias("rep"), F.first("n").alias("n"), F.first("grp").alias("grp"), F.first("prefix").alias("prefix"))
    nodes = written(nodes.select("d1", "d2", "rep.id", "rep.print", "n", "grp", "prefix"), "nodes")
    found = links(rows, nodes, shingle, percent).select(_node("a1", "a2").alias("a"), _node("b1", "b2").alias("b"))
    labels = components(written(found, "stars"))
    named = nodes.select("d1", "d2", "id", _node("d1", "d2").alias("node")).join(labels, "node")
    named = written(named.select("d1", "d2", "id", "label"), "named")
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    linked = named.join(least, "label").select("d1", "d2", "component_id", "label")
    alone = nodes.select("d1", "d2", F.col("id").alias("own"))
    of_node = alone.join(linked, ["d1", "d2"], "left").select("d1", "d2", F.coalesce("component_id", "own").alias("component_id"), F.coalesce("label", _node("d1", "d2")).alias("label"))
    # Written, so that a join of many rows of one node is one that adaptive execution can split.
    of_node = written(of_node, "node-components")
    full = sets.where("n > 0").select("id", "print", "n", "d1", "d2").join(of_node, ["d1", "d2"]).select("id", "print", F.col("n").alias("n_shingles"), "component_id", "label")
    empty = sets.where("n = 0").select("id", "print", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(None).cast("string").alias("label"))
    return full.unionAll(empty)


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns: the one that names it.

    A component is known by its node label, so ids may be null or repeat. Documents without shingles stay too. Of rows alike in key and text, one stays.
    """
    whole = docs.select(F.struct("*").alias("doc"), F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"))
    made = written(_labelled(docs, key, text, shingle, percent).drop("component_id"), "components")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "print"))
    chosen = made.where("n_shingles > 0").groupBy("label").agg(best.alias("best")).select("best.id", "best.print")
    chosen = written(chosen.unionAll(made.where("n_shingles = 0").select("id", "print").distinct()), "chosen")
    sent = sent_if_small(chosen, _width("id") + 8).select(F.col("id").alias("__id"), F.col("print").alias("__print"))
    some = whole.join(sent, F.col("id").eqNullSafe(F.col("__id")) & (F.col("print") == F.col("__print")), "left_semi")
    if made.groupBy("id", "print").count().where("count > 1").isEmpty():
        return some.select("doc.*")
    return some.groupBy("id", "print").agg(F.first("doc").alias("doc")).select("doc.*")
