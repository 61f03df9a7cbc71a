import hashlib

import numpy as np
import pytest
from helpers import rows, same_as_sql, with_clashes

from kinloom.llm import simplex_clusters as S
from kinloom.llm.sql import ORACLE_SQL

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 0) for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors, k, rounds, length):
    """Lloyd's rounds with Python integers."""
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in vectors if v is not None and len(v) == length and all(x is not None and np.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(q) for _, q in seeds]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        own = [near(q)[1] for _, q in kept]
        for j in range(len(c)):
            mine = [q for (_, q), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(q)) for i, q in kept]
    each = {}
    for _, d, j in last:
        each[j] = each.get(j, 0) + d
    return [(i, j, d, each[j], sum(each.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in last]


def same(spark, vectors, ids=None, k=5, rounds=3, length=8):
    ids = list(range(len(vectors))) if ids is None else ids
    got = rows(S.cluster(frame(spark, vectors, ids).repartition(3), k, rounds, length))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(repr, got)) == sorted(map(repr, brute(list(zip(ids, vectors)), k, rounds, length)))
    return sorted(got, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_against_sql(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 64))
    v = (centres[rng.integers(0, 6, 400)] + 0.3 * rng.normal(size=(400, 64))).astype("float32")
    v[100:160] = v[100]
    df = with_clashes(frame(spark, [x.tolist() for x in v]).repartition(3), "cluster", "distance", "q")
    same_as_sql(spark, S.cluster(df), ORACLE_SQL["op12_simplex_clusters"], embeddings=df)


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    same(spark, rng.normal(size=(120, 8)).astype("float32").tolist())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(i % 3), 1.0, -2.0] for i in range(9)]
    odd = [None, [], [1.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [1.0, None, 1.0], [1.0, 2.0, 3.0, 4.0]]
    got = same(spark, good + odd + [[7.0, 7.0, 7.0], [8.0, 7.0, 7.0]], ids=[*range(8), 7, *range(20, 27), None, None], k=3, length=3)
    assert [r[0] for r in got] == [*range(8), 7, None, None]


@pytest.mark.parametrize("vectors", [[], [None], [[1.0]]])
def test_nothing_to_cluster(spark, vectors):
    df = S.cluster(frame(spark, vectors))
    assert rows(df) == [] and df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_equal_vectors_leave_clusters_empty(spark):
    got = same(spark, [[0.5] * 8] * 12, k=4)
    assert {r[1] for r in got} == {0}
    got = same(spark, [[0.5] * 8, [1.5] * 8], k=4)
    assert sorted(r[1] for r in got) == [0, 1]


def test_large_components(spark):
    rng = np.random.default_rng(3)
    same(spark, (rng.normal(size=(40, 8)) * 1e5).astype("float32").tolist())
    with pytest.raises(Exception, match="exceeds"):
        S.cluster(frame(spark, [[3e7] * 8]), length=8).collect()


@pytest.mark.parametrize("spread", [1, 30, 3000])
def test_bounds_hold(spread):
    rng = np.random.default_rng(4)
    x = rng.integers(-spread, spread + 1, size=(300, 12))
    x[:40] = x[0] + np.arange(40)[:, None] * np.eye(12, dtype=int)[0]  # points on a line
    for seeds in (x[:16], x[50:66], x[[0] * 16]):
        s = S.Simplex(seeds)
        a, b = s.apexes(S.squared(x, s.pivots)), s.apexes(S.squared(seeds, s.pivots))
        low, high = S.bounds(a, b)
        true = S.squared(x, seeds)
        assert (low <= true).all() and (true <= high).all()


def test_bounds_drop_centroids():
    rng = np.random.default_rng(5)
    centres = rng.integers(-60, 60, size=(16, 64))
    x = centres[rng.integers(0, 16, 500)] + rng.integers(-4, 5, size=(500, 64))
    s = S.Simplex(centres)
    low, high = S.bounds(s.apexes(S.squared(x, s.pivots)), s.apexes(S.squared(centres, s.pivots)))
    assert (low <= high.min(axis=1, keepdims=True)).mean() < 0.5
