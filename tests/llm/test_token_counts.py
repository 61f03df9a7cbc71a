import public_tokenizers
import tiktoken
from helpers import DOCS, docs, rows, with_clashes
from pyspark.sql import functions as F

from kinloom.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["one line", "two\nlines here\n", "\n\nafter", "", None, "日本語 🙂\nünï çödé", "a b " * 20000, "x" * 30000 + "\ny"]


def brute(text, starts):
    """Token by token, with offsets found by decoding."""
    enc = T.load(PATH).encoding
    ids = enc.encode_ordinary(text)
    raw, at, counts, crossing = text.encode(), 0, [0] * len(starts), [0] * len(starts)
    char_of = [k for k, c in enumerate(text) for _ in c.encode()]
    bounds = [*starts, len(text)]
    for i in ids:
        n = len(enc.decode_single_token_bytes(i))
        s, e = char_of[at], char_of[at + n - 1] + 1
        at += n
        share = [max(0, min(e, bounds[k + 1]) - max(s, bounds[k])) for k in range(len(starts))]
        k = share.index(max(share))
        counts[k] += 1
        crossing[k] += sum(x > 0 for x in share) > 1
    assert at == len(raw)
    return counts, crossing


def test_lines_against_brute_force(spark):
    df = with_clashes(docs(spark, TEXTS), "section", "start", "n_tokens")
    got = {}
    for r in T.count_tokens(df, PATH).orderBy("doc_id", "section").collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.n_tokens, r.n_crossing))
    for i, t in enumerate(TEXTS):
        t = t or ""
        starts = T.line_starts(t)
        n, x = brute(t, starts) if len(t) < 1000 else (None, None)
        assert [(s, e) for s, e, _, _ in got[i]] == list(zip(starts, [*starts[1:], len(t)]))
        if n is not None:
            assert [c for _, _, c, _ in got[i]] == n and [c for _, _, _, c in got[i]] == x
        assert sum(c for _, _, c, _ in got[i]) == len(T.load(PATH).encoding.encode_ordinary(t))


def test_crossing_tokens_go_to_the_larger_share(spark):
    text = "hello wonderful 日本 world again"
    cuts = [[0, c] for c in range(1, len(text))]
    df = spark.createDataFrame([(k, text, "en", "s", len(text), c) for k, c in enumerate(cuts)], DOCS + ", cuts array<long>")
    got = {}
    for r in T.count_tokens(df, PATH, "cuts").orderBy("doc_id", "section").collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.n_crossing))
    for k, c in enumerate(cuts):
        n, x = brute(text, c)
        assert got[k] == list(zip(n, x))
    assert any(x for v in got.values() for _, x in v)


def test_null_sections_repeated_rows_and_empty_table(spark):
    df = docs(spark, ["a b", "a b"], ids=[5, 5]).withColumn("cuts", F.lit(None).cast("array<long>"))
    assert rows(T.count_tokens(df, PATH, "cuts")) == [(5, 0, 0, 3, 2, 0)] * 2
    assert rows(T.count_tokens(df.limit(0), PATH)) == []


def test_uses_the_public_ranks():
    assert isinstance(T.load(PATH).encoding, tiktoken.Encoding)
