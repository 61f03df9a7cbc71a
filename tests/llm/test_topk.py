import numpy as np
import pytest
from helpers import rows, same_as_sql
from pyspark.sql import functions as F

from kinloom.llm import topk
from kinloom.llm.sql import ORACLE_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 0, "x") for i, v in zip(ids, vectors)], SCHEMA)


def run(df, k=20):
    return topk.search(df, F.col("vec_id") % 20 == 0, k)


def test_against_sql(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 24)).astype("float32")
    v[100:160] = v[100]  # a group of equal vectors: ties go to the smaller id
    df = frame(spark, [x.tolist() for x in v]).repartition(3)
    same_as_sql(spark, run(df), ORACLE_SQL["op1_topk"], embeddings=df)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_COMPONENTS", 40)
    rng = np.random.default_rng(2)
    df = frame(spark, [x.tolist() for x in rng.normal(size=(200, 8)).astype("float32")])
    same_as_sql(spark, run(df), ORACLE_SQL["op1_topk"], embeddings=df)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], None, [nan, 1.0], [inf, 0.0], [1.0, None], [2.0, 2.0], [1.0], [], [-1.0, -1.0], [2.0, 2.0], [9.0, 9.0]]
    got = sorted(rows(run(frame(spark, vectors, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, None]))))
    assert got == [(0, 1, 5, 24576), (0, 2, 9, 24576), (0, 3, 6, 4096), (0, 4, 7, 0), (0, 5, 8, -12288)]


@pytest.mark.parametrize("vectors", [[], [[1.0, 1.0]], [None]])
def test_nothing_to_find(spark, vectors):
    assert rows(run(frame(spark, vectors))) == []


def test_bound_holds():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 37)), rng.normal(size=(60, 37))
    for s in topk.RESOLUTIONS:
        assert (topk.statistics(a, s) @ topk.statistics(b, s).T >= a @ b.T - 1e-9).all()
