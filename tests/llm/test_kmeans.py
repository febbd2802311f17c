"""Centroid clustering against a full scan in Python's integers, over whole tables and small ones."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import kmeans
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, dims=64, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        sums, counts = [[0] * dims for _ in centroids], [0] * len(centroids)
        for _, v in kept:
            n = nearest(v)[1]
            counts[n] += 1
            sums[n] = [a + b for a, b in zip(sums[n], v)]
        centroids = [[s // counts[n] for s in sums[n]] if counts[n] else c for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, n, d in found)


def test_op11(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    made = QUERIES["op11_centroid_clusters"](spark, SF)
    assert Counter(map(tuple, made.collect())) == brute(rows)


def test_edges(spark):
    """Nulls, other dimensions, copies, ties, repeated and null ids, negative values, clashing columns."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(200)]
    rows += [(7, [1.0, 1.0, 1.0, 1.0])] * 90 + [(None, [0.5, -0.25, 0.1, -1e-9])] * 2
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0, None, 1.0, 1.0]), (304, [float("nan")] * 4), (305, [float("inf"), 0.0, 0.0, 0.0]), (306, [0.0] * 4)]
    df = spark.createDataFrame([(i, v, 1, "x", 2.0, 3) for i, v in rows], "vec_id long, embedding array<double>, cluster int, row string, upper double, distance int").repartition(7)
    made = kmeans.cluster(df, dims=4)
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, made.collect())) == brute(rows, 4)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few(spark, n):
    rows = [(i, [float(i), 2.0]) for i in range(n)] + [(99, None)]
    made = kmeans.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dims=2)
    assert Counter(map(tuple, made.collect())) == brute(rows, 2)


def test_huge_components(spark):
    rows = [(i, [130_000.0 * (-1) ** i, float(i)]) for i in range(20)]
    assert Counter(map(tuple, kmeans.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dims=2).collect())) == brute(rows, 2)
    with pytest.raises(Exception, match="a component beyond"):
        kmeans.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dims=2)


def test_bounds_save_distances(spark):
    """On clustered vectors most are filtered; results stay those of a full scan (the numbers behind ``report``)."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(20, 8)) * 4
    x = centers[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 0.1
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    report = []
    made = kmeans.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dims=8, k=20, report=report)
    assert Counter(map(tuple, made.collect())) == brute(rows, 8, 20)
    assert report[0] == 4000 * 20 and sum(report[1:]) < 0.25 * 4000 * 20 * 10


def test_no_exchange(spark):
    """Vectors and their bounds meet without being moved."""
    tables = kmeans._Tables(spark, 4)
    v = tables.write(spark.range(100).selectExpr("id as row", "array(1, 2) as x").repartition(4, "row"))
    b = tables.write(spark.range(100).selectExpr("id as row", "1 as cluster", "1d as upper", "array(1d) as lower"))
    joined = tables.beside(v, b)
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
