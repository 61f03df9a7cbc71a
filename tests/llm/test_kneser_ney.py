import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import docs, rows, with_clashes

from kinloom.llm import kneser_ney as K

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "ünï the 日本 cat", "that is that"]


class Brute:
    """Interpolated modified Kneser-Ney with dictionaries."""

    def __init__(self, texts):
        seen = Counter()
        for t in texts:
            s = (K.START,) * (K.ORDER - 1) + tuple(K.classes(t)) + (K.END,)
            seen.update(s[i - K.ORDER + 1 : i + 1] for i in range(K.ORDER - 1, len(s)))
        self.c = {K.ORDER: seen}
        for k in range(K.ORDER - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d, self.total, self.cut = {}, {}, {}
        for k, c in self.c.items():
            n = [sum(v == i for v in c.values()) for i in range(1, 5)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
            self.d[k] = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i - 0.05) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
            self.total[k], self.cut[k] = Counter(), defaultdict(float)
            for g, v in c.items():
                self.total[k][g[:-1]] += v
                self.cut[k][g[:-1]] += self.d[k][min(v, 3) - 1]

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / K.CLASSES
        ctx, v = g[:-1], self.c[k][g]
        if not self.total[k][ctx]:
            return self.p(g[1:])
        own = (v - self.d[k][min(v, 3) - 1]) / self.total[k][ctx] if v else 0.0
        return own + self.cut[k][ctx] / self.total[k][ctx] * self.p(g[1:])

    def ln(self, t):
        s = (K.START,) * (K.ORDER - 1) + tuple(K.classes(t)) + (K.END,)
        return sum(math.log(self.p(s[i - K.ORDER + 1 : i + 1])) for i in range(K.ORDER - 1, len(s)))


@pytest.mark.parametrize("block_bytes", [1 << 26, 20])
def test_scores_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(K, "BLOCK_BYTES", block_bytes)
    trained = K.train(docs(spark, TEXTS))
    model, new = Brute(TEXTS), [*TEXTS, "the cat is a dog", "zzz 日", "qq", None, "", *["the cat sat"] * 5]
    got = [(r.doc_id, r.text, r.lp, r.n) for r in K.score(docs(spark, new), trained, "lp", "n").collect()]
    assert sorted(g[0] for g in got) == list(range(len(new)))
    for i, t, lp, n in got:
        assert t == new[i] and n == (len(t) + 1 if t else 0)
        assert lp == pytest.approx(model.ln(t) if t else 0.0, rel=1e-4)


def test_texts_are_shuffled_once(spark):
    scored = K.score(docs(spark, TEXTS), K.train(docs(spark, TEXTS)), "lp", "n")
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastNestedLoop" not in plan and "CartesianProduct" not in plan
    assert "ReusedExchange [doc_id" in plan


def test_probabilities_add_up():
    model = Brute(TEXTS)
    ctx = tuple(K.classes("the "))
    assert sum(model.p(ctx + (c,)) for c in range(K.CLASSES)) == pytest.approx(1.0)


def test_table_finds_and_misses():
    keys = np.arange(1, 5000, 3, dtype=np.int64) * 7919
    table = K.Table(keys, np.arange(len(keys)).astype(np.float32))
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert np.isnan(table.find(keys + 1)).all()


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    d, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out, names = K.classify(d, marks.filter("doc_id % 2 = 0"))
    got = out.select("doc_id", names["keep"]).join(marks.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    assert got[got.quality == 1].keep.mean() >= 0.95
    assert got[got.quality == 0].keep.mean() <= 0.1


def test_odd_rows_and_columns(spark):
    clean = [f"the cat sat on the mat number {i} and the dog was here" for i in range(80)]
    texts = [*clean, None, "", "@@@ ### $$$ %%% ^^^ &&& *** !!! " * 30, "the cat sat", "the cat sat", "the cat " * 30000]
    ids = [*range(80), 80, 81, 82, 83, 83, None]
    langs = ["en"] * 70 + [None] * 10 + ["en", None, "en", "xx", "xx", "en"]
    df = with_clashes(docs(spark, texts, ids=ids, langs=langs), "keep", "perplexity", "lp", "mid", "language")
    out, names = K.classify(df, labels(spark, [(i, 1, 0) for i in range(80)] + [(0, 0, 0), (None, 1, 0), (5, None, None)]))
    assert out.columns[: len(df.columns)] == df.columns and out.count() == len(texts)
    kept = {r.doc_id: r[names["keep"]] for r in out.collect()}
    assert kept[80] and kept[81] and kept[83] and not kept[82] and all(kept[i] for i in range(80))


def test_without_trusted_text_everything_stays(spark):
    out, names = K.classify(docs(spark, ["a", None, "!!"]), labels(spark, []))
    assert [r[names["keep"]] for r in out.collect()] == [True] * 3
    out, names = K.classify(docs(spark, []), labels(spark, [(1, 1, 0)]))
    assert rows(out) == []


def test_a_block_holds_its_grams_once():
    rng = np.random.default_rng(3)
    met, slices = K.Grams(), [np.unique(rng.integers(0, 150_000, 120_000)) for _ in range(60)]
    for g in slices:
        met.add(g)
        assert len(met.have) + sum(map(len, met.waiting)) < K.MERGE + 300_000  # 4 million with repeats
    assert np.array_equal(met.all(), np.unique(np.concatenate(slices)))
    assert len(K.Grams().all()) == 0


def test_a_worker_holds_little_text():
    assert 860_000_000 / K.block_count(860_000_000, 6) <= 1 << 24  # packed and unpacked, beside a JVM that has grown
    assert K.block_count(0, 6) == 6
