import math
import re

import numpy as np
import pytest
from helpers import docs, rows, same_as_sql, with_clashes

from kinloom.llm import lexical_nra as N
from kinloom.llm.sql import ORACLE_SQL

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def tokens(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, k=10):
    """``item, rank, doc, score`` by scoring all documents."""
    own = [(i, tokens(t)) for i, t in texts]
    n_docs, n_terms = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    asked = {}
    for i, t in items:
        if t is not None:
            asked.setdefault(i, set()).update(tokens(t))
    out = []
    for i, wanted in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in d for _, d in own) + 1))) for t in wanted}
        scored = []
        for doc, d in own:
            m = 100 - 90 + (90 * len(d) * n_docs) // n_terms if n_terms else 0
            s = sum(w[t] * ((10**9 * d.count(t)) // (1000 * d.count(t) + 8 * m)) for t in wanted if t in d)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(i, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def items(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string")


def run(df, asked, k=10):
    return sorted(rows(N.search(df, asked, k)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(seed, n, words=40, length=30):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, words + 1)
    return [" ".join(f"w{x}" for x in rng.choice(words, rng.integers(0, length), p=p / p.sum())) for _ in range(n)]


@pytest.mark.parametrize(("documents", "depth"), [(4096, 64), (16, 1), (50, 4)])
def test_against_brute_force(spark, monkeypatch, documents, depth):
    monkeypatch.setattr(N, "DOCUMENTS", documents)
    monkeypatch.setattr(N, "DEPTH", depth)
    texts = corpus(1, 300)
    texts[40:90] = [texts[40]] * 50  # equal scores go to the smaller id
    asked = [(i, t) for i, t in enumerate(corpus(2, 15))] + [(99, "W1, w2; w1! nowhere")]
    got = run(docs(spark, texts).repartition(3), items(spark, asked))
    assert got == brute(list(enumerate(texts)), asked)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(N, "QUERY_CHARS", 100)
    texts, asked = corpus(3, 100), list(enumerate(corpus(4, 10)))
    assert run(docs(spark, texts), items(spark, asked), 3) == brute(list(enumerate(texts)), asked, 3)


def test_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    same_as_sql(spark, N.search(d, b), ORACLE_SQL["op13_lexical_nra"], documents=d, benchmark=b)


def test_terms():
    for text in ["Ab-c d_e 1x2", "\x00a\x7fb\x80c", "É日本 ÀZ", "", " ", "İx y", "a b"]:
        assert [t.decode() for t in N.terms(text.encode())] == tokens(text)


def test_odd_rows_and_columns(spark):
    texts = ["a b", None, "", "!!!", "a b", "a c", "a b " * 50000, "z", "b"]
    ids = [1, 2, 3, 4, 1, None, 6, 7, None]
    asked = [(1, "a b"), (2, None), (3, ""), (4, "zz"), (5, "Z"), (1, "c"), (None, "a"), (7, "a a a")]
    df = with_clashes(docs(spark, texts, ids=ids), "rank", "score", "n", "terms", "tf")
    got = run(df, with_clashes(items(spark, asked), "doc_id", "q", "score"))
    assert got == brute(list(zip(ids, texts)), asked)


def test_nothing_to_find(spark):
    assert run(docs(spark, []), items(spark, [(1, "a")])) == []
    assert run(docs(spark, ["a"]), items(spark, [])) == []
    assert run(docs(spark, [None, ""]), items(spark, [(1, "a")])) == []


def test_reading_stops_before_the_lists_end():
    """Documents that cannot reach the line are not read to the end of every list."""
    import pyarrow as pa

    n = 2000
    own = [[0, 1]] * 5 + [[1]] * (n - 5)
    part = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([10] * n, pa.int64()), pa.array(own, pa.list_(pa.int32())), pa.array([[9] * len(x) if len(x) > 1 else [1] for x in own], pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tf"])
    lists = N.Postings(part, np.array([5000, 3]), n, 10 * n)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            if isinstance(at, slice):
                Counted.read += at.stop - at.start
            return super().__getitem__(at)

    lists.doc = lists.doc.view(Counted)
    reach, scores = N.search_block(lists, np.array([0, 1]), 5, 1)
    assert sorted(reach.tolist()) == [0, 1, 2, 3, 4] and len(set(scores.tolist())) == 1
    assert Counted.read < n
