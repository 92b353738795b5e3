"""Centroid clustering against plain loops over whole numbers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import centroids as C


def brute(rows: list, k: int = 8, rounds: int = 10, dims: int = 64) -> Counter:
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in order[:k]]

    def nearest(v: list) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        at = [[sum(x) // len(x) for x in zip(*(v for (_, v), o in zip(kept, own, strict=True) if o == j), strict=True)] or c for j, c in enumerate(at)]
    last = [nearest(v) for _, v in kept]
    each = Counter()
    for d, j in last:
        each[j] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return Counter((i, j, d, each[j], sum(each.values()), name[j]) for (i, _), (d, j) in zip(kept, last, strict=True))


def vectors(n: int = 400, dims: int = 64) -> list:
    rng = random.Random(4)
    middle = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(11)]
    rows = [(i, [float(np.float32(m + rng.gauss(0, 0.2))) for m in middle[i % 11]]) for i in range(n)]
    rows += [(0, rows[0][1]), (None, rows[1][1]), (None, rows[2][1]), (5, rows[6][1])]  # repeated rows, ids of two vectors, no id
    rows += [(900, None), (901, []), (902, [1.0] * (dims - 1)), (903, [None] + [1.0] * (dims - 1)), (904, [float("nan")] * dims), (905, [float("inf")] * dims)]
    rows += [(906, [0.0] * dims), (907, [-0.0] * dims), (908, [1e3] * dims), (909, [-1e-9] * dims)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, v array<int>, near string, cluster int"


def folder(spark, path, rows) -> str:
    spark.createDataFrame([(*r, 1, [1], "x", 2) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_clusters_equal_plain_loops(spark, tmp_path):
    rows = vectors()
    found = C.centroid_clusters(spark, folder(spark, tmp_path, rows))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_fewer_vectors_than_centroids_ties_and_none(spark, tmp_path):
    few = [(i, [float(i % 2)] * 64) for i in range(5)]  # equal centroids: the smaller number takes all
    assert Counter(map(tuple, C.centroid_clusters(spark, folder(spark, tmp_path / "few", few)).collect())) == brute(few)
    none = C.centroid_clusters(spark, folder(spark, tmp_path / "none", [(1, None)]))
    assert none.collect() == [] and len(none.columns) == 6


def test_sql_equals_the_query(spark, tmp_path):
    import duckdb

    path = folder(spark, tmp_path, vectors(150))
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from read_parquet('{path}/embeddings.parquet/*.parquet')")
    found = db.execute(C.SQL)
    columns = [c[0] for c in found.description]
    assert Counter(map(tuple, found.fetchall())) == Counter(map(tuple, C.centroid_clusters(spark, path).select(columns).collect()))


def test_bounds_skip_only_farther_centroids():
    rng = np.random.default_rng(6)
    middle = rng.integers(-4000, 4000, (8, 16))
    v = (middle[rng.integers(0, 8, 3000)] + rng.integers(-200, 200, (3000, 16))).astype(np.int64)
    v[:50] = (middle[0] + middle[1]) // 2  # ties and near ties
    at = C.Centroids(middle, C.pick_pivots(v[:256], 8))
    cluster, distance, looked = at.nearest(v, C.lengths(v, at.pivots))
    every = ((v[:, None] - middle[None]) ** 2).sum(2)
    assert (distance == every.min(1)).all() and (cluster == every.argmin(1)).all()
    assert looked < 0.35 * every.size  # most centroids are never looked at


def test_components_beyond_64_bit_distances_fail(spark):
    kept = C.whole_numbers(spark.createDataFrame([(1, [1e6] * 64)], "vec_id long, embedding array<double>"))
    with pytest.raises(ValueError, match="64 bits"):
        C.clustered(kept)
