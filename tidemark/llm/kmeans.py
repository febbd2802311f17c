"""Centroid clustering in integers, with the group bounds of Yinyang k-means.

Centroids are cut into groups once. Every vector keeps an upper bound of the
distance to its centroid and a lower bound for each group of the others. When
centroids have moved, bounds move by as much; a vector whose upper bound is
below all its lower ones stays (global filter), else only groups that its exact
distance doesn't rule out are scanned (group filter), every centroid of them
exactly. Results are those of a full scan: components are integers, distances
too, and bounds are only used with a margin for their rounding.

Vectors are written once, in buckets by row. Bounds are a narrow table in the
same buckets, written anew each round and read beside the vectors without an
exchange. Its last row of a task holds what moved: sums and counts that the
clusters of that task won and lost, added up by Spark to one row a cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import delete, shared_folder
from tidemark.llm.words import lean

SCALE = 1024
LARGEST = 1 << 27  # of a component: 64 squared differences of such stay within a long
FLOAT_EXACT = 1 << 20  # up to here they are exact as doubles
GROUP_SIZE = 4
BUCKET_ROWS = 500_000
MARGIN = 1e-9


def integers(vectors: DataFrame, vector: str, dims: int) -> Column:
    """Components as floor(1024 * x); null unless there are ``dims``, none null or non-finite."""
    x = F.col(vector)
    plain = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    whole = lambda v: F.floor(v.cast("double") * F.lit(float(SCALE)))
    size = lambda v: F.when(F.abs(v.cast("double")) < LARGEST / SCALE, whole(v).cast("int")).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST // SCALE}")).cast("int"))
    return F.when((F.size(x) == dims) & F.forall(x, plain), F.transform(x, size))


def groups_of(centroids: np.ndarray, size: int = GROUP_SIZE) -> np.ndarray:
    """The group of each centroid: a few rounds of k-means over the centroids, from the first and those farthest from the chosen."""
    x, n = centroids.astype(np.float64), max(1, -(-len(centroids) // size))
    seeds = [0]
    while len(seeds) < n:
        seeds.append(int(((x[:, None] - x[seeds][None]) ** 2).sum(2).min(1).argmax()))
    centers = x[seeds]
    for _ in range(5):
        label = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        centers = np.stack([x[label == g].mean(0) if (label == g).any() else centers[g] for g in range(n)])
    return np.unique(label, return_inverse=True)[1]


@dataclass
class Round:
    """Centroids of a round, their groups, and how far each has moved since the last."""

    centroids: np.ndarray
    group: np.ndarray
    moved: np.ndarray

    def distances(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to the centroids ``which``."""
        c = self.centroids[which]
        if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= FLOAT_EXACT:
            a, b = x.astype(np.float64), c.astype(np.float64)
            return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
        return np.stack([((x - v) ** 2).sum(1) for v in c], axis=1)

    def own_distance(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        away = x - self.centroids[cluster]
        return (away * away).sum(1)

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster, upper and lower bounds of rows that have none yet."""
        k, n_groups = len(self.centroids), int(self.group.max()) + 1
        away = self.distances(x, np.arange(k))
        cluster = away.argmin(1)
        roots = np.sqrt(away.astype(np.float64))
        upper = roots[np.arange(len(x)), cluster]
        roots[np.arange(len(x)), cluster] = np.inf
        lower = np.stack([roots[:, self.group == g].min(1) for g in range(n_groups)], axis=1)
        return cluster, upper, lower

    def next(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same after the centroids have moved, and how many distances that took."""
        n_groups, scanned = lower.shape[1], 0
        cluster, upper = cluster.copy(), upper + self.moved[cluster]
        lower = lower - np.array([self.moved[self.group == g].max() for g in range(n_groups)])
        open_ = np.flatnonzero(upper * (1 + MARGIN) >= lower.min(1) * (1 - MARGIN))  # global filter
        best = self.own_distance(x[open_], cluster[open_])
        scanned += len(open_)
        upper[open_] = np.sqrt(best.astype(np.float64))
        again = upper[open_] * (1 + MARGIN) >= lower[open_].min(1) * (1 - MARGIN)
        open_, best = open_[again], best[again]
        was, own = cluster[open_].copy(), best.copy()
        for g in range(n_groups):  # group filter; upper bounds are exact now
            at = np.flatnonzero(np.sqrt(own.astype(np.float64)) * (1 + MARGIN) >= lower[open_, g] * (1 - MARGIN))
            which = np.flatnonzero(self.group == g)
            if not len(at):
                continue
            away = self.distances(x[open_[at]], which)
            scanned += away.size
            is_own = which[None] == was[at][:, None]
            rest = np.where(is_own, np.iinfo(np.int64).max, away)
            near = rest.argmin(1)
            least, number = rest[np.arange(len(at)), near], which[near]
            better = (least < best[at]) | (least == best[at]) & (number < cluster[open_[at]])
            roots = np.where(is_own, np.inf, np.sqrt(away.astype(np.float64)))
            # The group's bound leaves out the row's new centroid, which may be in it.
            roots[np.flatnonzero(better), near[better]] = np.inf
            self._left(lower, open_[at], better, cluster, best, at, was)
            lower[open_[at], g] = roots.min(1)
            best[at] = np.where(better, least, best[at])
            cluster[open_[at]] = np.where(better, number, cluster[open_[at]])
        lost = cluster[open_] != was
        rows, old = open_[lost], self.group[was[lost]]
        lower[rows, old] = np.minimum(lower[rows, old], np.sqrt(own[lost].astype(np.float64)))
        upper[open_] = np.sqrt(best.astype(np.float64))
        return cluster, upper, lower, scanned

    def _left(self, lower, rows, better, cluster, best, at, was) -> None:
        """A centroid that was the nearest for a while, of a group scanned before, counts for that group's bound again."""
        once = better & (cluster[rows] != was[at])
        some, old = rows[once], self.group[cluster[rows[once]]]
        lower[some, old] = np.minimum(lower[some, old], np.sqrt(best[at[once]].astype(np.float64)))


class _Tables:
    """Bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def write(self, df: DataFrame) -> str:
        name = f"tidemark_kmeans_{uuid.uuid4().hex}"
        self.paths[name] = f"{shared_folder(self.spark)}/tidemark/{self.spark.sparkContext.applicationId}/{name}"
        df.write.bucketBy(self.buckets, "row").option("path", self.paths[name]).format("parquet").saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        delete(self.spark, self.paths.pop(name))

    def beside(self, vectors: str, bounds: str) -> DataFrame:
        """Vectors with their bounds; both are in the same buckets, so nothing is exchanged."""
        narrow = self.spark.table(bounds).select("row", "cluster", "upper", "lower")
        return self.spark.table(vectors).select("row", "x").join(narrow.hint("shuffle_hash"), "row")


def _array(batch: pa.RecordBatch, name: str, dims: int, kind: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), dims)


def _pass(table: DataFrame, now: Round, start: bool, last: bool) -> DataFrame:
    """New bounds of all rows, with a task's gains and losses in its last row; in the last pass distances instead."""
    k, dims, n_groups = *now.centroids.shape, int(now.group.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, scanned, held = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0, None

        def made(row, cluster, upper, lower, distance, gains) -> pa.RecordBatch:
            n = len(row)
            nested = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * n_groups), pa.array(lower.ravel()))
            total = pa.array([None] * (n - 1) + [gains], pa.list_(pa.int64()))
            columns = [row, pa.array(cluster, pa.int32()), pa.array(upper), nested, pa.array(distance, pa.int64()), total]
            return pa.RecordBatch.from_arrays(columns, names=["row", "cluster", "upper", "lower", "distance", "gains"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _array(batch, "x", dims, "int64")
            if start:
                was, (cluster, upper, lower) = None, now.first(x)
                scanned += x.shape[0] * k
            else:
                was = batch.column(batch.schema.get_field_index("cluster")).to_numpy().astype(np.int64)
                upper = batch.column(batch.schema.get_field_index("upper")).to_numpy()
                cluster, upper, lower, n = now.next(x, was, upper, _array(batch, "lower", n_groups, "float64"))
                scanned += n
            moved = np.arange(len(x)) if was is None else np.flatnonzero(cluster != was)
            for sign, of in ((1, cluster), (-1, was)):
                if of is not None:
                    np.add.at(sums, of[moved], sign * x[moved])
                    np.add.at(counts, of[moved], sign)
            distance = now.own_distance(x, cluster) if last else np.zeros(len(x), np.int64)
            if held is not None:
                yield made(*held, None)
            held = batch.column(batch.schema.get_field_index("row")), cluster, upper, lower, distance
        if held is not None:
            yield made(*held, [*np.concatenate([counts[:, None], sums], axis=1).ravel().tolist(), scanned])

    return table.mapInArrow(lean(run), "row long, cluster int, upper double, lower array<double>, distance long, gains array<long>")


def _gains(bounds: DataFrame) -> dict[int, int]:
    """Gains added up over tasks, by position; their number depends on the centroids alone."""
    each = bounds.where("gains is not null").select(F.posexplode("gains").alias("at", "n"))
    return {r["at"]: r["n"] for r in each.groupBy("at").agg(F.sum("n").alias("n")).collect()}


def _chosen(vectors: DataFrame, key: str, k: int, salt: int) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, in that order; rows of one id by their components."""
    own = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))).cast("binary"), 256)
    rows = vectors.select(own.alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r.x for r in rows], dtype=np.int64)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10, salt: int = 3, report: list | None = None) -> DataFrame:
    """One row for each kept vector: its key, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with another number of components, or with a null or non-finite
    one, or null altogether, are left out, as is every other column. Rows are
    clustered one by one, so repeated rows and null keys keep rows of their
    own. With fewer than ``k`` kept vectors, each starts a cluster; with none
    there are no rows. A component whose integer is beyond ``LARGEST`` is an
    error, as distances wouldn't fit. ``report`` gets the distances computed
    in each round.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), integers(vectors, vector, dims).alias("x")).where("x is not null")
    n = own.count()
    tables = _Tables(spark, max(spark.sparkContext.defaultParallelism, -(-n // BUCKET_ROWS)))
    kept = tables.write(own.repartition(tables.buckets, "row"))
    kind = vectors.schema[key].dataType.simpleString()
    if not n:
        return spark.createDataFrame([], f"{key} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = _chosen(spark.table(kept), "key", k, salt)
    k, group = len(centroids), groups_of(centroids)
    sums, counts, moved, bounds = [[0] * dims for _ in range(k)], [0] * k, np.zeros(k), None
    for r in range(rounds + 1):
        table = spark.table(kept).select("row", "x") if bounds is None else tables.beside(kept, bounds)
        made = tables.write(_pass(table, Round(centroids, group, moved), bounds is None, r == rounds))
        if bounds is not None:
            tables.drop(bounds)
        bounds, gains = made, _gains(spark.table(made))
        if report is not None:
            report.append(gains[k * (dims + 1)])
        if r < rounds:
            for c in range(k):
                at = c * (dims + 1)
                counts[c] += gains[at]
                sums[c] = [s + gains[at + 1 + i] for i, s in enumerate(sums[c])]
            new = np.array([[s // counts[c] for s in sums[c]] if counts[c] else centroids[c].tolist() for c in range(k)], dtype=np.int64)
            moved = np.sqrt(((new - centroids) ** 2).sum(1).astype(np.float64)) * (1 + MARGIN)
            centroids = new
    final = spark.table(bounds)
    inertia = {r.cluster: int(r.n) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), ",".join(map(str, centroids[c].tolist()))) for c in range(k)]
    known = F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid string"))  # k rows
    out = spark.table(kept).select("row", "key").join(final.select("row", "cluster", "distance").hint("shuffle_hash"), "row").join(known, "cluster")
    return out.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256"))
