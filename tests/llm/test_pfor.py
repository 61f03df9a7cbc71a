import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import docs, rows, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinloom.llm import pfor

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "a\x1cb \x85 c\xa0d", "É é ΑΣ ΣΑΣ. İ ǅ", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "it's'LL", "x" * 5000, "日本 ́x", "\r\n a\tb", "word " * 40000]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=400), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, percentile):
    x = np.array(ids, np.int64)
    assert pfor.decode_blocks(*pfor.encode_blocks(x, percentile)).tolist() == ids


def test_index_finds_blocks():
    x = np.arange(1000) % 77
    starts, blocks = pfor.encode_blocks(x)
    assert pfor.decode_blocks(starts, blocks, 3, 5).tolist() == x[384:640].tolist()


def test_outliers_go_to_the_exception_list():
    x = np.r_[np.arange(120) % 4, [2**31] * 8].astype(np.int64)
    starts, blocks = pfor.encode_blocks(x)
    assert len(blocks) == 7 + 128 * 2 // 8 + 8 * 5
    assert pfor.decode_blocks(starts, blocks).tolist() == x.tolist()


def test_chunks_match_whole_texts():
    whole = Tokenizer.from_file(PATH)
    ids, n = pfor.ChunkEncoder(PATH).encode(pa.array([*TEXTS, None]), 2)
    want = [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in [*TEXTS, ""]]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == sum(want, [])


@pytest.fixture(scope="module")
def both():
    return pfor.ChunkEncoder(PATH), Tokenizer.from_file(PATH)


def test_commas_after_every_letter_of_the_class(both):
    enc, whole = both
    texts = [f"B{chr(c)}{mark} x" for c in [*range(0x41, 0x7B), *range(0xC0, 0x250)] for mark in (",", ".", "\u0307,", "\u0301.")]
    ids, n = enc.encode(pa.array(texts), 2)
    got = [x[:-1].tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [t for t, g, w in zip(texts, got, whole.encode_batch(texts, add_special_tokens=False)) if g != w.ids] == []


def test_capitals_before_marks(both):
    enc, whole = both
    texts = [f"a{chr(c)}{chr(m)}{more} b" for c in range(0x41, 0x5B) for m in range(0x300, 0x370) for more in ("", "\u0327", "\u0331", ",")]
    ids, n = enc.encode(pa.array(texts), 2)
    got = [x[:-1].tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [ascii(t) for t, g, w in zip(texts, got, whole.encode_batch(texts, add_special_tokens=False)) if g != w.ids] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abI\u0130ıſßéΣς日'.., \n\t\xa0\u0301\u0307\u0327"), max_size=30), min_size=1, max_size=5))
def test_random_chunks_match_whole_texts(both, texts):
    enc, whole = both
    ids, n = enc.encode(pa.array(texts), 2)
    want = [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == sum(want, [])


def test_file_in_order_of_ids(spark, tmp_path):
    whole = Tokenizer.from_file(PATH)
    ids = [7, 3, None, 9, 3, 1, 12, 11, 10, 8]
    df = with_clashes(docs(spark, TEXTS, ids=ids), "part", "start")
    path = f"file://{tmp_path}/t"
    pfor.write_token_file(df, path, PATH, 2)
    got = rows(pfor.read_token_file(spark, path))
    order = sorted(zip(ids, TEXTS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at, want = 0, []
    for i, t in order:
        x = [*whole.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert sorted(got, key=lambda r: r[1]) == want


def test_rows_without_id_are_spread(spark, tmp_path):
    whole, path = Tokenizer.from_file(PATH), f"file://{tmp_path}/t"
    texts = [f"row {i} of the text" for i in range(300)] + ["the same text"] * 300 + [f"with id {i}" for i in range(300)]
    df = docs(spark, texts, ids=[None] * 600 + list(range(300))).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pfor.write_token_file(df, path, PATH, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = [r.n for r in spark.read.parquet(path).select("part", pfor.F.size("lengths").alias("n")).groupBy("part").agg(pfor.F.sum("n").alias("n")).collect()]
    assert sum(held) == 900 and len(held) == 4 and max(held) <= 300
    got = sorted(rows(pfor.read_token_file(spark, path)), key=lambda r: r[1])
    coded = [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in [*sorted(texts[:600]), *texts[600:]]]
    assert [r[0] for r in got] == [None] * 600 + list(range(300))
    assert [r[3] for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in coded]
    assert [r[1] for r in got] == [0, *np.cumsum([len(x) for x in coded])[:-1].tolist()]


def test_empty_table(spark):
    assert rows(pfor.token_file(docs(spark, []), PATH, 2)) == []


@pytest.mark.parametrize("n", [1, 127, 128, 129])
def test_short_last_block(n):
    x = np.full(n, 49407)
    assert pfor.decode_blocks(*pfor.encode_blocks(x)).tolist() == x.tolist()
