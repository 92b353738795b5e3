"""Centroid clustering over integer vectors with a LAESA pivot table.

Vectors become integers once, and their distances to a few fixed pivots are written beside them.  In a
round the centroids' distances to the same pivots are computed anew (a few numbers), and by the
triangle inequality no vector can be nearer to a centroid than its pivot distances differ from the
centroid's.  A vector looks at the centroids by rising bound and computes exact integer distances until
the next bound is over the best distance found.  Bounds are floats and give way by ``SLACK``, so they
only skip centroids that are truly farther; every result is exact and independent of partitioning.

1. Vectors with exactly ``DIMENSIONS`` components, none null or non-finite, are kept; component x becomes floor(``SCALE`` * x).
2. The kept vectors of least hash are the first centroids; the pivots are picked from the ``POOL``
   vectors of least hash, each the one with the largest distances to those before.
3. Tasks add up the components of the vectors that they assign; sums by centroid and component are
   decimals, so they cannot overflow.  Per round ``k`` * (dimensions + 2) numbers reach the driver.

Defined results: a null or empty list is no vector; a vector without id comes last among the first
centroids but is assigned; repeated rows are vectors each, and among equal hashes the lesser components
come first; fewer vectors than centroids mean fewer centroids; an empty table gives no row.  Integers
of ``LARGEST`` and over would let a distance leave 64 bits: they fail with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.corpus import table, written

DIMENSIONS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
PIVOTS, POOL = 8, 256
#: Integers stay under this: 64 squared differences of two of them fit in 63 bits.
LARGEST = 1 << 27
#: Share of the distances by which a float bound gives way.
SLACK = 1e-9
SIZE, LOOKED_AT = -1, -2


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v) of the kept vectors: their components as integers."""
    x = F.col(f"`{column}`")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return vectors.filter((F.size(x) == dimensions) & ~bad).select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double"))).alias("v"))


def least_hashed(kept: DataFrame, most: int, seed: int = SEED) -> np.ndarray:
    """The ``most`` vectors of least lowercase-hex SHA-256 of ``<seed>:<vec_id>``, in that order."""
    rows = kept.select("v", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"))
    found = rows.orderBy(F.col("h").asc_nulls_last(), "v").limit(most).select("v").collect()
    return _checked(np.array([r.v for r in found], np.int64) if found else np.zeros((0, 0), np.int64))


def _checked(v: np.ndarray) -> np.ndarray:
    if v.size and max(int(v.max()), -int(v.min())) >= LARGEST:
        raise ValueError(f"a component of {LARGEST} and over: squared distances would not fit in 64 bits")
    return v


def squares(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` and of ``c``, paired."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def lengths(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances."""
    return np.stack([np.sqrt(squares(v, p).astype(float)) for p in pivots], 1) if len(pivots) else np.zeros((len(v), 0))


def pick_pivots(pool: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Rows of ``pool``: the first, then each the farthest, by summed distance, from those before."""
    chosen, far = [0] if len(pool) else [], np.zeros(len(pool))
    while 0 < len(chosen) < min(most, len(pool)):
        far += np.sqrt(squares(pool, pool[chosen[-1]]).astype(float))
        far[chosen] = -1
        chosen.append(int(np.argmax(far)))
    return pool[chosen]


@dataclass
class Centroids:
    """Centroids and the pivots that bound their distances."""

    places: np.ndarray
    pivots: np.ndarray

    def nearest(self, v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance) of each vector from its pivot distances ``near``; also how many distances were computed."""
        own = lengths(self.places, self.pivots)
        n, k = len(v), len(self.places)
        bound = np.zeros((n, k))
        for p in range(own.shape[1]):
            apart = np.abs(near[:, p, None] - own[None, :, p]) - SLACK * (near[:, p, None] + own[None, :, p] + 1)
            np.maximum(bound, apart, out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        best = np.full(n, np.iinfo(np.int64).max)
        cluster = np.full(n, k)
        active, looked = np.arange(n), 0
        for j in range(k):
            c = order[active, j]
            # bounds rise along the order: whoever is past its best distance is done
            open_ = bound[active, c] <= np.sqrt(best[active].astype(float)) * (1 + SLACK)
            active, c = active[open_], c[open_]
            if not len(active):
                break
            d = squares(v[active], self.places[c])
            looked += len(active)
            better = (d < best[active]) | ((d == best[active]) & (c < cluster[active]))
            best[active[better]], cluster[active[better]] = d[better], c[better]
        return cluster, best, looked


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def pivot_table(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``kept`` with ``near``, the distances to the pivots, written."""
    kind = kept.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _checked(_matrix(batch.column("v"), np.int64))
                near = lengths(v, pivots)
                cut = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.ListArray.from_arrays(pa.array(cut.to_numpy() * v.shape[1]), pa.array(v.ravel().astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut.to_numpy() * near.shape[1]), pa.array(near.ravel()))], ["vec_id", "v", "near"])

    return written(kept.mapInArrow(run, f"vec_id {kind}, v array<int>, near array<double>"), "pivots")


def sums(vectors: DataFrame, at: Centroids) -> np.ndarray:
    """(centroids, dimensions + 2): per centroid the sums of its vectors' components, their number, and (row 0) the distances computed."""
    k, dims = at.places.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size, looked = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), np.int64)
                cluster, _, n = at.nearest(v, _matrix(batch.column("near"), float))
                for c in range(k):
                    total[c] += v[cluster == c].sum(0)
                size += np.bincount(cluster, minlength=k)
                looked += n
        if looked:
            cells = np.concatenate([total, size[:, None], np.where(np.arange(k) == 0, looked, 0)[:, None]], 1)
            place = np.tile([*range(dims), SIZE, LOOKED_AT], k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(k), dims + 2), pa.int32()), pa.array(place, pa.int32()), pa.array(cells.ravel())],
                ["cluster", "place", "total"])

    found = vectors.select("v", "near").mapInArrow(run, "cluster int, place int, total long").groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out = np.zeros((k, dims + 2), object)
    for r in found:
        out[r.cluster, r.place] = int(r.total)  # SIZE and LOOKED_AT count from the end
    return out[:, [*range(dims), SIZE, LOOKED_AT]]


def moved(at: Centroids, total: np.ndarray) -> Centroids:
    """Non-empty centroids at the floor of their vectors' mean, the others as they are."""
    size = total[:, -2]
    places = [[int(s) // int(n) for s in row[:-2]] if n else old for row, n, old in zip(total, size, at.places.tolist(), strict=True)]
    return Centroids(np.array(places, np.int64), at.pivots)


def assigned(vectors: DataFrame, at: Centroids) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, best, _ = at.nearest(_matrix(batch.column("v"), np.int64), _matrix(batch.column("near"), float))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(best)],
                                                 ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def clustered(kept: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS) -> tuple[DataFrame, Centroids]:
    """((vec_id, cluster, distance) of the vectors of :func:`whole_numbers`, written; the final centroids)."""
    pool = least_hashed(kept, max(k, POOL), seed)
    at = Centroids(pool[:k], pick_pivots(pool, pivots))
    vectors = pivot_table(kept, at.pivots)
    for _ in range(rounds if len(pool) else 0):
        at = moved(at, sums(vectors, at))
    return written(assigned(vectors, at), "assigned"), at


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, at = clustered(whole_numbers(table(spark, sf_dir, "embeddings")))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.places.tolist()]
    names: Column = F.element_at(F.array(*[F.lit(d) for d in digest]), F.col("cluster") + 1) if digest else F.lit(None).cast("string")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    # a row a centroid: bounded by k
    each = F.broadcast(found.groupBy("cluster").agg(total.alias("cluster_inertia")))
    whole = F.broadcast(found.agg(total.alias("inertia")))
    return found.join(each, "cluster").join(whole).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", names.alias("centroid_sha256"))


def _sql() -> str:
    """The rounds written out one after the other."""
    apart = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = lambda r: (f"n{r} as materialized (select uid, v, arg_min(k, (d, k)) k, min(d) d from (select v.uid, v.v, c.k, {apart} d from v, c{r} c) "  # noqa: E731
                      "group by uid, v)")
    move = lambda r: (f"c{r + 1} as materialized (select c.k, coalesce(m.v, c.v) v from c{r} c left join (select k, list(place order by i) v from "  # noqa: E731
                      "(select k, i, (s - ((s % n) + n) % n) // n place from (select k, i, sum(x)::hugeint s, count(*)::hugeint n from "
                      f"(select k, unnest(v) x, generate_subscripts(v, 1) i from n{r}) group by k, i)) group by k) m using (k))")
    rounds = ",\n".join(f"{near(r)},\n{move(r)}" for r in range(ROUNDS))
    return f"""
with kept as (select vec_id, embedding e from embeddings where len(embedding) = {DIMENSIONS}
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
v as materialized (select row_number() over () uid, vec_id, list_transform(e, lambda x: floor({SCALE} * x::double)::hugeint) v from kept),
c0 as materialized (select row_number() over (order by h nulls last, v) - 1 k, v
                    from (select sha256('{SEED}:' || vec_id) h, v from v order by h nulls last, v limit {CENTROIDS})),
{rounds},
{near(ROUNDS)}
select vec_id, k::int as cluster, d::bigint distance, (sum(d) over (partition by k))::bigint cluster_inertia, (sum(d) over ())::bigint inertia,
       sha256(array_to_string(c.v, ',')) centroid_sha256
from n{ROUNDS} join v using (uid) join c{ROUNDS} c using (k)
"""


SQL = _sql()
