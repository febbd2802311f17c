"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample (``SAMPLE_ROWS``, ``SAMPLE_FLOATS``);
every row is then put under its leaf. A query visits leaves best-bin-first: a
priority queue gives the nearest unopened node, whose children go back into
the queue. How many leaves a query visits is calibrated: for at most
``CALIBRATION_QUERIES`` queries the true neighbours are found by a scan of all
rows, and the visits are widened until the target recall is reached. What was
measured goes with the result. A query set that grows with the table costs its
square times the share of rows visited: with clustered vectors a few per cent,
with random ones of many dimensions about half.

The search joins packs of queries to blocks of vectors by leaf. Blocks hold a
bounded number of rows, so that a crowded leaf is many blocks, which adaptive
execution can deal to many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import written
from tidemark.llm.words import lean

SAMPLE_ROWS = 32_768
SAMPLE_FLOATS = 4 << 20
BRANCHES = 8
LEAF_ROWS = 32  # of the sample, or as many as stand for FEW_ROWS of the table
FEW_ROWS = 128
CALIBRATION_QUERIES = 256
TARGET_RECALL, LEAST_RECALL = 0.94, 0.9
BLOCK_ROWS = 2048
PACK_ROWS = 256
CHUNK_ROWS = 8192  # compared at once with a pack
FAR = 1e150  # components beyond have squares that overflow


@dataclass
class Tree:
    """Nodes by number; ``first`` and ``count`` give a node's children, ``leaf`` a leaf's number or -1."""

    centers: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: at each node, the nearest child."""
        x = bounded(x)
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(self.count[node])
            if not len(open_):
                return self.leaf[node]
            for n in np.unique(node[open_]):
                rows = open_[node[open_] == n]
                children = self.centers[self.first[n] : self.first[n] + self.count[n]]
                near = (children * children).sum(axis=1)[None] - 2 * x[rows] @ children.T
                node[rows] = self.first[n] + near.argmin(axis=1)

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves for a query, best bin first."""
        q = bounded(q)
        queue = [(0.0, 0)]
        while queue:
            _, n = heapq.heappop(queue)
            if not self.count[n]:
                yield int(self.leaf[n])
                continue
            at = slice(self.first[n], self.first[n] + self.count[n])
            away = ((self.centers[at] - q) ** 2).sum(axis=1)
            for i, d in enumerate(away.tolist()):
                heapq.heappush(queue, (d, int(self.first[n]) + i))


def bounded(x: np.ndarray) -> np.ndarray:
    """Vectors as the tree sees them: components beyond ``FAR`` count as that, so that sums of squares stay finite."""
    return np.clip(x, -FAR, FAR)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    label = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        label = ((centers * centers).sum(axis=1)[None] - 2 * x @ centers.T).argmin(axis=1)
        for c in range(k):
            if (mine := label == c).any():
                centers[c] = x[mine].mean(axis=0)
    return centers, label


def fit_tree(x: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 17) -> Tree:
    """Split the sample by k-means again and again until parts have at most ``leaf_rows`` rows or can't be split."""
    rng, x = np.random.default_rng(seed), bounded(x)
    centers, first, count, leaf, queue, n_leaves = [x.mean(axis=0)], [0], [0], [-1], [(0, np.arange(len(x)))], 0
    while queue:
        node, rows = queue.pop(0)
        kinds: list[np.ndarray] = []
        if len(rows) > leaf_rows:
            part, label = _kmeans(x[rows], branches, rng)
            kinds = [rows[label == c] for c in range(branches)]
            kept = [c for c in range(branches) if len(kinds[c])]
            kinds = [kinds[c] for c in kept] if len(kept) > 1 else []
        if not kinds:
            leaf[node], n_leaves = n_leaves, n_leaves + 1
            continue
        first[node], count[node] = len(centers), len(kinds)
        for c, mine in zip(kept, kinds, strict=True):
            queue.append((len(centers), mine))
            centers.append(part[c])
            first.append(0)
            count.append(0)
            leaf.append(-1)
    return Tree(np.array(centers, dtype=np.float64), np.array(first), np.array(count), np.array(leaf))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().cast(pa.float64())).reshape(len(column), dim)


def distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, scaled by a power of two where squares would overflow or vanish."""
    apart = one - two
    away = np.sqrt((apart**2).sum(axis=1))
    most = np.abs(apart).max(axis=1, initial=0.0)
    odd = ((most > FAR) | (most < 1 / FAR)) & (most > 0) & np.isfinite(most)
    if odd.any():
        scale = 2.0 ** np.floor(np.log2(most[odd]))
        away[odd] = scale * np.sqrt(((apart[odd] / scale[:, None]) ** 2).sum(axis=1))
    return away


class Nearest:
    """The k nearest (query, id, distance, leaf) so far, held in bounded memory."""

    def __init__(self, k: int, most: int = 400_000):
        self.k, self.most, self.parts, self.rows = k, most, [], 0

    def offer(self, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, leaves: np.ndarray | None = None) -> None:
        """Compare queries and vectors, a part of them at once; a row with a query's id is not among its nearest."""
        leaves = np.full(len(ids), -1) if leaves is None else leaves
        far = max(np.abs(queries).max(initial=0.0), np.abs(vectors).max(initial=0.0)) > FAR
        square = (vectors * vectors).sum(axis=1)
        step = max(1, (1 << 20) // max(len(vectors) * (vectors.shape[1] if far else 1), 1))
        for at in range(0, len(queries), step):
            q, own = queries[at : at + step], query_ids[at : at + step]
            other = own[:, None] != ids[None]
            if far or len(ids) <= self.k:
                qi, ri = np.nonzero(other)
            else:
                near = np.where(other, square[None] - 2 * q @ vectors.T, np.inf)
                kth = np.partition(near, self.k - 1, axis=1)[:, self.k - 1]
                slack = 1e-9 * (square.max() + (q * q).sum(axis=1) + 1)
                qi, ri = np.nonzero((near <= (kth + slack)[:, None]) & other)
            self.keep(own[qi], ids[ri], distances(vectors[ri], q[qi]), leaves[ri])

    def keep(self, *found: np.ndarray) -> None:
        best = self.best(*found)
        self.parts.append(best)
        self.rows += len(best[0])
        if self.rows > self.most:
            self.parts = [self.result()]
            self.rows = len(self.parts[0][0])
            self.most = max(self.most, 2 * self.rows)

    def best(self, q: np.ndarray, ids: np.ndarray, away: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((ids, away, q))
        q, ids, away, leaf = q[order], ids[order], away[order], leaf[order]
        head = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, dtype=np.int64)
        keep = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q)))) < self.k
        return q[keep], ids[keep], away[keep], leaf[keep]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        return self.best(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))

    def batch(self) -> pa.RecordBatch:
        q, ids, away, leaf = self.result()
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ids, pa.int64()), pa.array(away, pa.float64()), pa.array(leaf, pa.int32())], names=["query_id", "vec_id", "score", "leaf"])


_NEAR = "query_id long, vec_id long, score double, leaf int"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows with an id whose vector is neither null nor zero and holds only finite numbers."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite).where(F.exists("v", lambda x: x != 0))


def _top(found: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window as W

    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pack(rows: list, dim: int) -> tuple[bytes, bytes]:
    ids, vectors = zip(*rows, strict=True)
    return np.array(ids, dtype=np.int64).tobytes(), np.concatenate(vectors).astype(np.float64).tobytes()


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(vectors, dtype=np.float64).reshape(-1, dim)


def _packs(rows: DataFrame, dim: int, leaves_of, size: int, names: tuple[str, str, str]) -> DataFrame:
    """Rows gathered by leaf into packs of at most ``size``; ``leaves_of(matrix)`` gives each row's leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        full: list[tuple] = []

        def out(items):
            return pa.RecordBatch.from_arrays([pa.array([i[0] for i in items], pa.int32()), pa.array([i[1] for i in items], pa.binary()), pa.array([i[2] for i in items], pa.binary())], names=list(names))

        total = 0
        for batch in batches:
            ids, x = batch.column(0).to_pylist(), _matrix(batch.column(1), dim)
            for i, (key, leaves) in enumerate(zip(ids, leaves_of(x), strict=True)):
                for leaf in leaves:
                    held.setdefault(leaf, []).append((key, x[i]))
                    total += 1
                    if len(held[leaf]) >= size:
                        full.append((leaf, *_pack(held.pop(leaf), dim)))
                        total -= size
            if total * dim * 8 > 48 << 20:
                full += [(leaf, *_pack(r, dim)) for leaf, r in held.items()]
                held, total = {}, 0
            for at in range(0, len(full), 32):
                yield out(full[at : at + 32])
            full = []
        full = [(leaf, *_pack(r, dim)) for leaf, r in held.items()]
        for at in range(0, len(full), 64):
            yield out(full[at : at + 64])

    return rows.mapInArrow(lean(run), f"{names[0]} int, {names[1]} binary, {names[2]} binary")


@dataclass
class Index:
    """A fitted tree, the blocks of all rows by leaf, and the dimension."""

    tree: Tree
    blocks: DataFrame
    dim: int


def build_index(rows: DataFrame) -> Index | None:
    """Fit the tree on a sample of (id, v) rows and put every row into a block of its leaf; None without rows.

    The dimension is the most frequent one; rows of another take no part, as
    they have no distance to the others. Rows have an id and a vector that
    ``usable`` lets pass; ids may repeat.
    """
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        return None
    dim, most = dims.dim, max(BRANCHES, min(SAMPLE_ROWS, SAMPLE_FLOATS // max(dims.dim, 1)))
    part = min(1.0, most / dims.n)
    rows = rows.where(F.size("v") == dim)
    sample = rows.where(F.pmod(F.xxhash64(F.lit("tree"), "id"), F.lit(1 << 20)) < part * (1 << 20)).orderBy("id").limit(2 * most).select("v").toArrow()
    if not sample.num_rows:
        sample = rows.orderBy("id").limit(most).select("v").toArrow()
    tree = fit_tree(_matrix(sample["v"].combine_chunks(), dim), leaf_rows=max(LEAF_ROWS, int(FEW_ROWS * part)))
    sent = rows.sparkSession.sparkContext.broadcast(tree)
    blocks = _packs(rows, dim, lambda x: [(int(n),) for n in sent.value.assign(x)], BLOCK_ROWS, ("leaf", "ids", "vectors"))
    return Index(tree, written(blocks, "ann-blocks"), dim)


def calibrate(index: Index, queries: DataFrame, k: int, target: float = TARGET_RECALL) -> tuple[int, float]:
    """Leaves to visit, and the recall this gives on the calibration queries (all leaves and 1 without queries)."""
    n = queries.count()
    part = min(1.0, CALIBRATION_QUERIES / max(n, 1))
    chosen = queries.where(F.pmod(F.xxhash64(F.lit("calibrate"), "id"), F.lit(1 << 20)) < part * (1 << 20)).orderBy("id").limit(2 * CALIBRATION_QUERIES).toArrow()
    if not chosen.num_rows:
        return index.tree.leaves, 1.0
    ids, x = np.asarray(chosen["id"].combine_chunks()), _matrix(chosen["v"].combine_chunks(), index.dim)
    sent, dim = index.blocks.sparkSession.sparkContext.broadcast((ids, x)), index.dim

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, held, rows = Nearest(k), [], 0

        def compare():
            found = [_unpack(i, v, dim) for _, i, v in held]
            near.offer(*sent.value, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), np.repeat([h[0] for h in held], [len(f[0]) for f in found]))

        for batch in batches:
            for block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(block)
                rows += len(block[1]) // 8
                if rows >= CHUNK_ROWS:
                    compare()
                    held, rows = [], 0
        if held:
            compare()
        yield near.batch()

    from pyspark.sql import Window as W

    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    true = index.blocks.mapInArrow(lean(scan), _NEAR).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    leaves: dict[int, list[int]] = {}
    for r in true.select("query_id", "leaf").collect():  # at most k a calibration query
        leaves.setdefault(r.query_id, []).append(r.leaf)
    needed: list[int] = []
    for i, q in zip(ids.tolist(), x, strict=True):
        place = {leaf: n for n, leaf in enumerate(index.tree.visit(q), 1)}
        needed += [place[leaf] for leaf in leaves.get(i, [])]
    visits, recall = 1, 0.0 if needed else 1.0
    while needed:
        recall = float(np.mean(np.array(needed) <= visits))
        if recall >= target or visits >= index.tree.leaves:
            break
        visits += max(1, visits // 16)  # widen
    return min(visits, index.tree.leaves), recall


def own_rows(index: Index, queries: DataFrame) -> int:
    """The most rows that share one query's key, 1 at least."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, dtype=np.int64))], names=["id"])

    each = index.blocks.select("ids").mapInArrow(lean(ids), "id long").join(queries, "id", "left_semi")
    return max(1, each.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0)


def search(index: Index, queries: DataFrame, k: int, visits: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found in the leaves that each query visits.

    A query visits ``visits`` leaves, and more until they hold k rows that
    can't be its own: rows that share a query's key aren't its neighbours.
    Queries of another dimension than the index have no rows here.
    """
    rows_of = np.zeros(index.tree.leaves, dtype=np.int64)
    for r in index.blocks.groupBy("leaf").agg(F.sum(F.length("ids") / 8).cast("long").alias("n")).collect():  # one row a leaf of the tree
        rows_of[r.leaf] = r.n
    known = queries.where(F.size("v") == index.dim).select("id")
    sent, dim = index.blocks.sparkSession.sparkContext.broadcast((index.tree, rows_of, own_rows(index, known))), index.dim

    def leaves_of(x: np.ndarray):
        tree, rows, own = sent.value
        for q in x:
            taken, held = [], 0
            for leaf in tree.visit(q):
                if len(taken) >= visits and held >= k + own:
                    break
                taken.append(leaf)
                held += int(rows[leaf])
            yield taken

    asked = queries.where(F.size("v") == dim)
    # Few tasks make full packs; a task holds a bounded part of its packs at any time.
    packs = _packs(asked.coalesce(max(1, asked.count() // (16 * PACK_ROWS))), dim, leaves_of, PACK_ROWS, ("leaf", "query_ids", "queries"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, pack, held, rows = Nearest(k), None, [], 0

        def compare():
            blocks = [_unpack(i, v, dim) for i, v in held]
            found.offer(*_unpack(*pack, dim), np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks]))

        for batch in batches:
            for qi, qv, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and ((qi, qv) != pack or rows >= CHUNK_ROWS):
                    compare()
                    held, rows = [], 0
                pack, rows = (qi, qv), rows + len(i) // 8
                held.append((i, v))
        if held:
            compare()
        yield found.batch()

    # Packs hold each query once for every leaf it visits: more than their input shows, and never broadcast.
    pairs = packs.hint("merge").join(index.blocks, "leaf").select("query_ids", "queries", "ids", "vectors")
    return _top(pairs.mapInArrow(lean(near), _NEAR), k)


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10, target: float = TARGET_RECALL) -> DataFrame:
    """Each query's k nearest other rows by Euclidean distance in double precision, and how they were found.

    Columns: query_id, rank, vec_id, score; leaves and visits of the tree, and
    the recall that these visits had on the calibration queries. A recall below
    ``LEAST_RECALL`` is an error.

    Null, zero and non-finite vectors, vectors of another dimension than most,
    and rows without a key take no part. A row is never its own neighbour,
    known by its key: rows that share a query's key aren't either. A query key
    on several rows is searched once, with the least of its vectors. Ties go
    to the smaller key. With fewer than k candidates, all are found. Repeated
    rows are candidates each; other columns play no part.
    """
    rows = usable(vectors, key, vector)
    index = build_index(rows)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, leaves int, visits int, recall double")
    queries = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    queries = written(queries, "ann-queries")
    visits, recall = calibrate(index, queries.where(F.size("v") == index.dim), k, target)
    if recall < min(target, LEAST_RECALL):
        raise RuntimeError(f"recall of {recall} after {visits} of {index.tree.leaves} leaves")
    return search(index, queries, k, visits).select("*", F.lit(index.tree.leaves).alias("leaves"), F.lit(visits).alias("visits"), F.lit(recall).alias("recall"))
