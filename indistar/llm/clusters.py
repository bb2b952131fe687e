"""Centroid clustering in exact integers with PCA-rotated filtering.

Vectors become integers once and are stored with their leading coordinates
under a PCA rotation and the norm of the rest.  For a centroid rotated alike,
the squared distance of the leading parts plus the squared difference of the
rest norms is never above the true squared distance, so it leaves a centroid
out where it is above a distance already known.  The centroids that survive are
verified in integers.  The rotation only decides how many survive, never the
result.  Each round is one pass that sums up every cluster in its task; the
driver holds the centroids and one row of sums for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialise

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
LEAD = 16  # rotated coordinates that are stored
SEED = "3"
LARGEST = 1 << 26  # of an integer component: squared distances of 64 such components fit a long
_SLACK = 1e-5  # float32 coordinates: far above their rounding, as a share of (|x| + |c|)^2


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, x``: rows with exactly ``dims`` finite components, as integers."""
    v = F.col("v")
    usable = (F.size(v) == dims) & F.forall(v, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))))
    whole = F.transform(v, lambda y: F.floor(F.lit(float(scale)) * y))
    far = F.exists(v, lambda y: F.abs(y) * scale >= LARGEST)
    refused = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<bigint>")
    return vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(usable) \
        .select("vec_id", F.when(far, refused).otherwise(whole).cast("array<int>").alias("x"))


def _matrix(column: pa.Array, dims: int, dtype=np.int64) -> np.ndarray:
    return column.flatten().to_numpy().astype(dtype).reshape(-1, dims)


def rotation(rows: DataFrame, dims: int, lead: int) -> np.ndarray:
    """The ``lead`` directions of largest variance over all vectors, as columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for b in batches:
            x = np.ones((b.num_rows, dims + 1))
            x[:, :dims] = _matrix(b.column(0), dims)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    sums = rows.select("x").mapInArrow(run, "i int, row array<double>").groupBy("i").agg(
        *[F.sum(F.col("row")[j]).alias(f"c{j}") for j in range(dims + 1)]).collect()
    gram = np.zeros((dims + 1, dims + 1))
    for r in sums:
        gram[r[0]] = r[1:]
    n = max(gram[dims, dims], 1.0)
    mean = gram[dims, :dims] / n
    _, vectors = np.linalg.eigh(gram[:dims, :dims] / n - np.outer(mean, mean))
    return vectors[:, ::-1][:, :lead]


def _rotated(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = x @ turn
    return p, np.sqrt(np.maximum((x.astype(float) ** 2).sum(1) - (p ** 2).sum(1), 0))


def _store(rows: DataFrame, turn: np.ndarray, dims: int) -> DataFrame:
    """``vec_id, x, lead, rest`` for each vector, written once."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, rest = _rotated(_matrix(b.column(1), dims), turn)
            flat = pa.array(p.astype(np.float32).ravel())
            lead = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, turn.shape[1]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lead, pa.array(rest)], names=["vec_id", "x", "lead", "rest"])

    return materialise(rows.mapInArrow(run, f"vec_id {kind}, x array<int>, lead array<float>, rest double"), "vectors")


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
            turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each integer vector, ties to the smaller
    number, and how many distances were verified."""
    q, away = _rotated(centroids, turn)
    scale = (np.sqrt((lead ** 2).sum(1) + rest ** 2)[:, None] + np.sqrt((q ** 2).sum(1) + away ** 2)) ** 2
    bound = ((lead ** 2).sum(1)[:, None] - 2 * lead @ q.T + (q ** 2).sum(1) + (rest[:, None] - away) ** 2) - _SLACK * scale - 1
    best = bound.argmin(1)
    first = best.copy()
    distance = ((x - centroids[best]) ** 2).sum(1)
    verified = len(x)
    for j, c in enumerate(centroids):
        left = np.flatnonzero((bound[:, j] <= distance) & (first != j))
        d = ((x[left] - c) ** 2).sum(1)
        verified += len(left)
        won = (d < distance[left]) | ((d == distance[left]) & (j < best[left]))
        best[left[won]], distance[left[won]] = j, d[won]
    return best, distance, verified


def _batch(b: pa.RecordBatch, dims: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _matrix(b.column("x"), dims), _matrix(b.column("lead"), lead, float), b.column("rest").to_numpy()


def _moved(store: DataFrame, centroids: list[list[int]], turn: np.ndarray, dims: int) -> list[list[int]]:
    """The next centroids: floors of the exact means; empty ones stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array(centroids, np.int64)
        n, sums = np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64)
        for b in batches:
            x, lead, rest = _batch(b, dims, turn.shape[1])
            best, _, _ = nearest(x, lead, rest, c, turn)
            for j in range(len(c)):
                mine = best == j
                n[j] += mine.sum()
                sums[j] += x[mine].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(c)), pa.int32()), pa.array(n), pa.array(list(sums), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "s"])

    rows = store.select("x", "lead", "rest").mapInArrow(run, "cluster int, n long, s array<long>").groupBy("cluster").agg(
        F.sum("n"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(dims)]).collect()
    out = list(centroids)
    for cluster, n, *sums in rows:
        if n:
            out[cluster] = [s // n for s in sums]
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, lead: int = LEAD,
                    seed: str = SEED) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``
    for each kept vector.

    Null vectors, vectors of another length and those with a null or non-finite
    component are left out.  Centroids start as the ``clusters`` vectors whose
    id has the least SHA-256 after ``seed:`` (rows with the same id: the least
    vector first; null ids last); with fewer vectors there are fewer centroids.
    Ties go to the smaller number, empty centroids stay, repeated rows and ids
    give one row each, an empty table none; other columns are not read.  A
    component of 65,536 or more in size is an error: distances must fit a long.
    """
    rows = integer_vectors(vectors, id_col, vec_col, dims, scale)
    kind = rows.schema["vec_id"].dataType.simpleString()
    shape = f"vec_id {kind}, cluster int, distance long"
    named = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    centroids = [list(r.x) for r in named.orderBy(F.col("h").asc_nulls_last(), "x").limit(clusters).collect()]
    if not centroids:
        return vectors.sparkSession.createDataFrame(
            [], f"{shape}, cluster_inertia long, inertia long, centroid_sha256 string")
    turn = rotation(rows, dims, lead)
    store = _store(rows, turn, dims)
    for _ in range(rounds):
        before, centroids = centroids, _moved(store, centroids, turn, dims)
        if centroids == before:  # the rounds left would all give the same
            break

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array(centroids, np.int64)
        for b in batches:
            best, distance, _ = nearest(*_batch(b, dims, turn.shape[1]), c, turn)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    found = materialise(store.mapInArrow(run, shape), "clusters")
    sums = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}
    sha = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    about = vectors.sparkSession.createDataFrame(
        [(j, s, sum(sums.values()), sha[j]) for j, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(  # a row for each centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
