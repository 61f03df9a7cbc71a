import zlib

import numpy as np
import pytest
from helpers import docs, rows, with_clashes

from kinloom.llm import language_mixture as M

EN = "the cat sat on the mat and the dog was with them in the house "
FR = "le chat est sur la table et les chiens sont dans la maison avec nous "
DE = "der hund und die katze sind nicht in dem haus und auch nicht im garten "


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def model():
    texts, langs = [EN * 5, FR * 5, DE * 5], ["en", "fr", "de"]
    counts = np.zeros((1 << 12, 3), np.int64)
    of, g, n = M.profiles(texts, 1 << 12)
    np.add.at(counts, (g, of), n)
    return M.Model(langs, counts)


def brute_profile(text, buckets):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    words = clean.split()
    padded = " " + " ".join(words) + " " if words else " "
    out = {}
    for i in range(len(padded) - 2):
        a, b, c = (ord(x) for x in padded[i : i + 3])
        key = a << 42 | b << 21 | c
        key = (key ^ key >> 31) * 0x9E3779B97F4A7C15 % (1 << 64)
        g = key >> (64 - (buckets.bit_length() - 1))
        out[g] = out.get(g, 0) + 1
    return out


def test_profiles_against_brute_force():
    texts = ["Hello, world!", "", "a", "ÉTÉ 日本 x1y", "  two   spaces ", "😀 ok", "퟿ z"]
    of, g, n = M.profiles(texts, 1 << 10)
    for i, t in enumerate(texts):
        assert dict(zip(g[of == i].tolist(), n[of == i].tolist())) == brute_profile(t, 1 << 10)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(M, "PIECE", 50)
    of, g, n = M.profiles([EN * 10], 1 << 10)
    want = {}
    for i in range(0, len(EN * 10), 50):
        for k, v in brute_profile((EN * 10)[i : i + 50], 1 << 10).items():
            want[k] = want.get(k, 0) + v
    assert dict(zip(g.tolist(), n.tolist())) == want and set(of) == {0}


def brute_fit(p, n, langs, steps):
    share = [1 / len(langs)] * len(langs)
    for _ in range(steps):
        new = [0.0] * len(langs)
        for row, c in zip(p, n):
            total = sum(row[k] * s for k, s in zip(langs, share))
            for j, k in enumerate(langs):
                new[j] += c * row[k] * share[j] / total
        share = [x / sum(n) for x in new]
    return share, sum(c * np.log(sum(row[k] * s for k, s in zip(langs, share))) for row, c in zip(p, n))


def test_mixtures_against_brute_force(model):
    for text in [EN, FR + EN, DE * 3 + FR * 3, "the", "qqq zzz", EN + FR + DE]:
        profile = brute_profile(text, model.buckets)
        p, n = [model.p[g].astype(float).tolist() for g in profile], list(profile.values())
        every, _ = brute_fit(p, n, range(3), M.STEPS)
        order = sorted(range(3), key=lambda k: (-round(every[k], 12), k))
        best = None
        for size in range(1, 4):
            share, fit = brute_fit(p, n, order[:size], M.SET_STEPS if size > 1 else 0)
            fit -= M.PENALTY * size * np.log(sum(n) + 1)
            if best is None or fit > best[0]:
                best = (fit, order[:size], share)
        lang, score, parts = model.predict([text])[0]
        share, k = min((-s, k) for s, k in zip(best[2], best[1]))
        assert lang == model.names[k]
        assert score == pytest.approx((every[k] * sum(n) + M.PRIOR / 3) / (sum(n) + M.PRIOR), abs=1e-6)
        assert sorted(x.split(":")[0] for x in parts.split(",")) == sorted(model.names[j] for j in best[1])


def test_mixed_documents_have_all_their_languages(model):
    lang, _, parts = model.predict([EN * 12 + FR * 6])[0]
    assert lang == "en" and [x.split(":")[0] for x in parts.split(",")] == ["en", "fr"]
    assert model.predict([EN * 12])[0][2] == "en:1.000"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = M.identify(df).join(df.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == df.count()
    assert (got.held_out == [held(i) for i in got.doc_id]).all()
    own = got[got.held_out]
    assert (own.lang_pred == own.lang).mean() >= 0.98
    assert got.score.between(0, 1).all()


def test_learns_only_from_its_documents(spark):
    ids = [i for i in range(60)]
    # held-out documents carry wrong languages, which must change nothing
    langs = ["zz" if held(i) else ["en", "fr"][i % 2] for i in ids]
    texts = [[EN, FR][i % 2] for i in ids]
    got = M.identify(docs(spark, texts, ids=ids, langs=langs)).collect()
    assert {(r.doc_id, r.lang_pred) for r in got} == {(i, ["en", "fr"][i % 2]) for i in ids}


def test_hot_language_and_few_languages(spark):
    texts = [EN] * 200 + [FR] * 3
    got = M.identify(docs(spark, texts, ids=list(range(203)), langs=["en"] * 200 + ["fr"] * 3).repartition(7)).collect()
    assert {(r.doc_id, r.lang_pred) for r in got} == {(i, "en" if i < 200 else "fr") for i in range(203)}


def test_odd_rows_and_columns(spark):
    texts = [EN, FR, None, "", "123 !?", EN, EN, "日本", (EN + FR) * 40000]
    ids = [1, 2, 3, 4, 5, 1, None, 7, 8]
    langs = ["en", "fr", "en", "en", None, "en", "xx", None, None]
    assert not any(held(i) for i in (1, 2))
    df = with_clashes(docs(spark, texts, ids=ids, langs=langs), "lang_pred", "score", "held_out", "languages")
    got = M.identify(df).collect()
    assert len(got) == len(texts)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert [x[0] for x in by[1]] == ["en", "en"] and by[2][0][0] == "fr" and by[None][0][0] == "en"
    assert by[3] == by[4] == by[5] == [("und", 0.0)]
    assert by[7][0][0] in ("en", "fr") and by[7][0][1] == 0.5
    assert by[8][0][0] in ("en", "fr")


def test_nothing_to_learn_and_nothing_to_predict(spark):
    got = M.identify(docs(spark, ["abc", None], ids=[1, 2], langs=[None, None])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert rows(M.identify(docs(spark, []))) == []
