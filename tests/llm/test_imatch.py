import random

import pytest
from helpers import docs, rows, same_as_sql, with_clashes

from kinloom.llm import imatch
from kinloom.llm.sql import ORACLE_SQL


def corpus(n, seed=5):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(3)) for _ in range(400)]
    return [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_against_sql(spark):
    texts = [*corpus(120), None, "", "É Ü one two", "Same text here", "Same text here", "  spaced \t out \n words "]
    df = with_clashes(docs(spark, texts), "run", "pos", "term")
    same_as_sql(spark, imatch.fingerprints(df), ORACLE_SQL["op2_imatch"], documents=df)


def test_equal_texts_have_equal_fingerprints_and_edits_stay_near(spark):
    texts = corpus(150, 6)
    texts[40] = texts[90]
    out = {r.doc_id: r for r in imatch.fingerprints(docs(spark, texts)).collect()}
    assert out[40].fingerprint == out[90].fingerprint
    near = [r.near_edited for r in out.values()]
    far = [r.near_next for r in out.values()]
    assert sum(near) / len(near) > sum(far) / len(far) + 0.1
    assert all(0 <= x <= 1 for x in near + far)


@pytest.mark.parametrize("texts, ids", [(["a b c"], [1]), ([None], [None]), (["a b", "a b", "c"], [4, 4, None])])
def test_small_tables(spark, texts, ids):
    out = imatch.fingerprints(docs(spark, texts, ids=ids)).collect()
    assert len(out) == len(texts)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in out) == sorted((i is None, i or 0, len(t or "")) for i, t in zip(ids, texts))


def test_empty_table(spark):
    assert rows(imatch.fingerprints(docs(spark, []))) == []


def test_hot_copies_keep_their_fingerprints(spark):
    """Two texts hold two thirds of all rows: an edit stays nearer than another text."""
    texts = corpus(120, 7)
    hot, cold = max(texts, key=len), sorted(texts, key=len)[-2]
    rows_ = [*texts, *[hot] * 120, *[cold] * 120]
    random.Random(1).shuffle(rows_)
    df = docs(spark, rows_)
    out = {r.doc_id: r for r in imatch.fingerprints(df).collect()}
    copies = [r for i, r in out.items() if rows_[i] in (hot, cold)]
    assert all(r.fingerprint not in ("-", "=") and ":" in r.fingerprint for r in copies)
    assert len({r.fingerprint for r in copies}) == 2
    other = [r.near_next for i, r in out.items() if rows_[i] in (hot, cold) and rows_[i - 1] not in (rows_[i],) and i]
    near = [r.near_edited for i, r in out.items() if rows_[i] in (hot, cold) and i and rows_[i - 1] != rows_[i]]
    assert sum(near) / len(near) > sum(other) / len(other) + 0.1
    same_as_sql(spark, imatch.fingerprints(df), ORACLE_SQL["op2_imatch"], documents=df)


def test_texts_without_band_terms(spark):
    texts = ["only1 here1", "here1 only1 only1", "other2 words2", None, "", " \t"]
    df = docs(spark, texts)
    out = {r.doc_id: r for r in imatch.fingerprints(df, band=(0.9, 1.0)).collect()}
    assert out[0].fingerprint == out[1].fingerprint and out[0].fingerprint.startswith("=")
    assert out[2].fingerprint.startswith("=") and out[2].fingerprint != out[0].fingerprint
    assert [out[i].fingerprint for i in (3, 4, 5)] == ["-"] * 3
    assert out[1].near_next == 1.0 and out[2].near_next == 0.0 and out[4].near_next == 1.0


def test_many_rows_without_an_id_and_a_long_text(spark):
    texts = [*corpus(90, 8), "word " * 60000]
    df = docs(spark, texts, ids=[None if i % 3 else i for i in range(91)])
    same_as_sql(spark, imatch.fingerprints(df), ORACLE_SQL["op2_imatch"], documents=df)
