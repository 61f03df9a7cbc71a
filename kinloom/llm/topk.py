"""Exact top-k search by multi-resolution segment statistics.

Every vector is cut into segments of equal length, at a coarse and a finer
resolution, and each segment is summed up by its mean and deviation.  For two
segments of length L with means m, n and deviations s, t the squared distance is
at least L((m - n)^2 + (s - t)^2), hence the inner product at most
L(m n + s t).  A candidate whose bound lies below a query's k-th best score so
far is dropped, coarse to fine; the survivors' products are computed exactly.

Queries go through in blocks of bounded size: a block is broadcast, each task
reads its candidates once and keeps k rows a query, and one window ranks what
the tasks kept.

Defined results: vectors that are null or hold a null or non-finite component,
and rows without an id, take no part; a shorter vector counts as padded with
zeros; rows with the query's id are its own; equal scores go to the smaller id
(and repeated ids each count); an empty table gives an empty table.  Other
columns of the input are ignored.  Scores must fit in 63 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, ship_package, stored

#: Segments of the two resolutions.
RESOLUTIONS = (4, 16)
#: Components of a block of queries, and rows of a block of candidates.
QUERY_COMPONENTS, CANDIDATES = 1 << 20, 1024
#: Share of pairs left from which a whole matrix is cheaper than single pairs.
DENSE = 0.2
SCALE = 64


def quantised(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows that take part and their components floor(64 x), padded to one length."""
    rows = vectors.to_pylist()
    keep, out = [], []
    for i, v in enumerate(rows):
        if v is not None and None not in v:
            x = np.asarray(v, np.float64)
            if np.isfinite(x).all():
                keep.append(i)
                out.append(x)
    width = max((len(x) for x in out), default=0)
    full = np.zeros((len(out), width))
    for r, x in zip(full, out):
        r[: len(x)] = x
    return np.array(keep, np.int64), np.floor(full * SCALE)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that their product bounds the vectors' product."""
    n, width = x.shape
    length = -(-max(width, 1) // segments)
    full = np.zeros((n, segments * length))
    full[:, :width] = x
    full = full.reshape(n, segments, length)
    return np.concatenate([full.mean(axis=2), full.std(axis=2)], axis=1) * np.sqrt(length)


class Block:
    """A block of queries with the best rows found so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.stats = [statistics(x, s) for s in RESOLUTIONS]
        self.q = np.zeros(0, np.int64)
        self.v = np.zeros(0, np.int64)
        self.s = np.zeros(0, np.int64)
        self.least = np.full(len(ids), -np.inf)

    def _products(self, c: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
        """Exact products of the pairs."""
        top = np.abs(self.x).max(initial=0.0) * np.abs(c).max(initial=0.0) * c.shape[1]
        a, b = (self.x, c) if top < 2**53 else (self.x.astype(np.int64), c.astype(np.int64))
        if len(qi) > DENSE * len(self.x) * len(c):
            return (a @ b.T)[qi, ci].astype(np.int64)
        parts = [np.einsum("ij,ij->i", a[qi[i : i + 65536]], b[ci[i : i + 65536]]) for i in range(0, len(qi), 65536)]
        return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)

    def offer(self, ids: np.ndarray, c: np.ndarray) -> None:
        width = max(self.x.shape[1], c.shape[1])
        if self.x.shape[1] < width:
            self.x = np.pad(self.x, ((0, 0), (0, width - self.x.shape[1])))
            self.stats = [statistics(self.x, s) for s in RESOLUTIONS]
        c = np.pad(c, ((0, 0), (0, width - c.shape[1])))
        qi = ci = None
        for own, segments in zip(self.stats, RESOLUTIONS):
            theirs = statistics(c, segments)
            slack = 1e-9 * (1 + np.linalg.norm(own, axis=1) * np.linalg.norm(theirs, axis=1).max(initial=0))
            line = self.least - slack
            if qi is None:
                qi, ci = np.nonzero(own @ theirs.T >= line[:, None])
            elif len(qi) > DENSE * len(self.ids) * len(ids):
                bound = own @ theirs.T
                kept = bound[qi, ci] >= line[qi]
                qi, ci = qi[kept], ci[kept]
            else:
                kept = np.concatenate([np.einsum("ij,ij->i", own[qi[i : i + 65536]], theirs[ci[i : i + 65536]]) >= line[qi[i : i + 65536]] for i in range(0, len(qi), 65536)] or [np.zeros(0, bool)])
                qi, ci = qi[kept], ci[kept]
        score = self._products(c, qi, ci)
        kept = (score >= self.least[qi]) & (ids[ci] != self.ids[qi])
        q, v, s = np.concatenate([self.q, qi[kept]]), np.concatenate([self.v, ids[ci[kept]]]), np.concatenate([self.s, score[kept]])
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        rank = np.arange(len(q)) - first[q]
        last = rank == self.k - 1
        self.least[q[last]] = s[last]
        top = rank < self.k
        self.q, self.v, self.s = q[top], v[top], s[top]


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k rows of highest inner product."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), "embedding")
    asked = rows.filter(is_query)
    n, width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    n_blocks = max(1, -(-n * max(width, 1) // QUERY_COMPONENTS))
    found = None
    for b in range(n_blocks):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).toArrow()  # about QUERY_COMPONENTS numbers
        keep, x = quantised(part.column("embedding"))
        ids = part.column("vec_id").to_numpy()[keep].astype(np.int64)
        sent = spark.sparkContext.broadcast((ids, x))

        def run(batches, sent=sent):
            block = Block(*sent.value, k)
            for batch in batches:
                for i in range(0, batch.num_rows if len(block.ids) else 0, CANDIDATES):
                    some = batch.slice(i, CANDIDATES)
                    kept, c = quantised(some.column(1))
                    if len(kept):
                        block.offer(some.column(0).to_numpy()[kept], c)
            yield pa.RecordBatch.from_arrays([pa.array(block.ids[block.q]), pa.array(block.v), pa.array(block.s)], names=["query_id", "vec_id", "score"])

        kept = rows.mapInArrow(lean(run), "query_id long, vec_id long, score long")
        kept = stored(kept, "topk") if n_blocks > 1 else kept
        found = kept if found is None else found.union(kept)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
