"""Centroid clustering with n-simplex projection and exact integer arithmetic.

A few of the first centroids that span a well-conditioned simplex are the pivots.
Each vector's distances to the pivots are turned once into apex coordinates: its
place in the pivots' hull and its altitude over it.  They are stored beside the
vector.  The distance of two apexes is a lower bound of the vectors' distance and,
with one altitude turned over, an upper bound.  A centroid whose lower bound
exceeds a vector's least upper bound is dropped; the others are compared exactly,
in integers.  Each task sums its vectors by cluster, so a round shuffles one row
a cluster, component and task, and only ``k`` centroids pass through the driver.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; rows without an id are clustered, and as first
centroids they come after all others; repeated rows are vectors of their own, also
as first centroids; with fewer than ``k`` vectors each is a first centroid; equal
distances go to the smaller cluster; an empty cluster keeps its centroid; an empty
table gives an empty table.  Other columns are ignored.  A component beyond 2^27
in size stops the run with an error, as squared distances must fit in 63 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ship_package, stored

SCALE = 64
#: Most pivots, and least squared altitude of a pivot against the largest squared distance.
PIVOTS, LEAST_ALTITUDE = 8, 1e-6
#: Rounding of the bounds, as a share of the squared distances to the first pivot.
SLACK = 1e-5
LARGEST = 1 << 27
#: Components below it keep squared distances of 64 components exact in doubles.
IN_DOUBLES = 1 << 22
ROWS = 4096


def quantised(vectors: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that take part, and their components floor(64 x)."""
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(vectors), length), False).to_numpy(zero_copy_only=False))
    x = pc.list_flatten(vectors.take(pa.array(rows))).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, length)
    sound = np.isfinite(x).all(axis=1)  # a null is NaN here
    rows, x = rows[sound], np.floor(x[sound] * SCALE)
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component exceeds {LARGEST} in size")
    return rows, x.astype(np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All exact squared distances of rows of ``x`` and rows of ``y``."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) < IN_DOUBLES and x.shape[1] <= 64:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


class Simplex:
    """The simplex of the pivots, known by their distances."""

    def __init__(self, candidates: np.ndarray):
        between = squared(candidates, candidates).astype(np.float64)
        chosen = [0]
        while True:
            self.pivots = candidates[chosen]
            d = between[np.ix_(chosen, chosen)]
            gram = (d[0, 1:, None] + d[0, None, 1:] - d[1:, 1:]) / 2
            self.to_first = d[0, 1:]
            self.base = np.linalg.cholesky(gram) if len(chosen) > 1 else np.zeros((0, 0))
            altitude = self.apexes(between[:, chosen])[:, -1] ** 2
            altitude[chosen] = 0
            best = int(altitude.argmax())
            if len(chosen) == PIVOTS or altitude[best] <= LEAST_ALTITUDE * between.max():
                return
            chosen.append(best)

    def apexes(self, d: np.ndarray) -> np.ndarray:
        """Apex coordinates of points by their squared distances to the pivots; the altitude comes last."""
        d = d.astype(np.float64)
        products = (d[:, :1] + self.to_first - d[:, 1:]) / 2
        hull = np.linalg.solve(self.base, products.T).T if len(self.base) else products
        altitude = np.sqrt(np.maximum(d[:, 0] - (hull * hull).sum(axis=1), 0))
        return np.concatenate([hull, altitude[:, None]], axis=1)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances, by the apexes of both sides."""
    base = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    h, g = a[:, -1:], b[None, :, -1]
    slack = SLACK * ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) + 1)
    return base + (h - g) ** 2 - slack, base + (h + g) ** 2 + slack


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid (the smaller number of equals) and the exact squared distance."""
    low, high = bounds(apex, theirs)
    r, c = np.nonzero(low <= high.min(axis=1, keepdims=True))
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    for i in range(0, len(r), 1 << 16):
        j = slice(i, i + (1 << 16))
        gap = x[r[j]] - centroids[c[j]]
        exact[r[j], c[j]] = np.einsum("ij,ij->i", gap, gap)
    found = exact.argmin(axis=1)
    return found, exact[np.arange(len(x)), found]


def _rows(column: pa.Array, dtype) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1] or 1, dtype=np.int32)[: len(x) + 1], pa.array(x.ravel(), kind))


def first_centroids(vectors: DataFrame, k: int, length: int) -> np.ndarray:
    """The ``k`` vectors of smallest hash of their id."""

    def run(batches):
        for b in batches:
            rows, x = quantised(b.column(1), length)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), _lists(x, pa.int32())], names=["vec_id", "q"])

    kept = vectors.mapInArrow(run, "vec_id long, q array<int>")
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    seeds = kept.orderBy(order.asc_nulls_last(), "q").limit(k).collect()
    return np.array([r.q for r in seeds], np.int64).reshape(-1, length)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, length: int = 64) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of the vectors ``vec_id, embedding``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = first_centroids(rows, k, length)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    simplex = Simplex(centroids)

    def project(batches):
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                own, x = quantised(part.column(1), length)
                apex = simplex.apexes(squared(x, simplex.pivots))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), _lists(x, pa.int32()), _lists(apex, pa.float64())], names=["vec_id", "q", "apex"])

    points = stored(rows.mapInArrow(lean(project), "vec_id long, q array<int>, apex array<double>"), "simplex")

    def found(batches, centroids, theirs):
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                x = _rows(part.column("q"), np.int64)
                yield part.column("vec_id"), x, *nearest(x, _rows(part.column("apex"), np.float64), centroids, theirs)

    for _ in range(rounds):
        theirs = simplex.apexes(squared(centroids, simplex.pivots))

        def sums(batches, centroids=centroids, theirs=theirs):
            total, n = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
            for _, x, own, _ in found(batches, centroids, theirs):
                n += np.bincount(own, minlength=len(n))
                np.add.at(total, own, x)
            c, at = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(c.ravel().astype(np.int32)), pa.array(at.ravel().astype(np.int32)), pa.array(total.ravel()), pa.array(np.repeat(n, length))], names=["cluster", "at", "s", "n"])

        parts = points.mapInArrow(lean(sums), "cluster int, at int, s long, n long").filter("n > 0")
        for r in parts.groupBy("cluster", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():  # k rows of components
            centroids[r["cluster"], r["at"]] = r["s"] // r["n"]
    theirs = simplex.apexes(squared(centroids, simplex.pivots))

    def last(batches):
        for ids, _, own, d in found(batches, centroids, theirs):
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    assigned = stored(points.mapInArrow(lean(last), "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
