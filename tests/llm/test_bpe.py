import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import docs, rows, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = ["", " ", "  a", "a  b", "a\n\nb \n c", "\x1c\x1d x\x85y\xa0z", "it's I'll 'S ''s", "<|endoftext|>a <|endoftext|><|endoftext|>", "ab" * 9000, " " * 3000 + "x", "é İ ſ K ½ ² ٣", "日本語 テキスト", "🙂🙂 a🙂", "\r\n\t x", " 's", "x ", " x"]


@pytest.fixture(scope="module")
def ours():
    return bpe.ByteBpe(PATH)


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", EDGES)
def test_matches_the_library(ours, theirs, text):
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_batches_match_single_texts(ours):
    texts = [*EDGES, None, *EDGES]
    assert list(ours.encode_all(pa.array(texts))) == [ours.encode(t or "") for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab c'tsreé\n\t .,0日 "), max_size=40))
def test_random_texts(text):
    a, b = bpe.load(PATH), Tokenizer.from_file(PATH) if not hasattr(test_random_texts, "t") else test_random_texts.t
    test_random_texts.t = b
    assert a.encode(text) == b.encode(text, add_special_tokens=False).ids
    assert a.decode(a.encode(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab'.é \n\t\x85\xa0\u2003", " \xa0", " \xa0 \xa0 "]), max_size=20).map("".join), min_size=1, max_size=5))
def test_random_batches_match_the_library(ours, theirs, texts):
    assert list(ours.encode_all(pa.array(texts))) == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("run", [" \xa0 \xa0 ", " \xa0" * 4 + " ", "\n \n", "\xa0 \t"])
def test_spaces_among_other_white_space_stay_together(ours, theirs, run):
    texts = ["plain text", "a" + run + "b", run + "b", "a" + run]
    assert list(ours.encode_all(pa.array(texts))) == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


def test_partial_characters_decode_like_the_library(ours, theirs):
    ids = theirs.encode("日本🙂", add_special_tokens=False).ids
    for cut in range(len(ids)):
        assert ours.decode(ids[:cut]) == theirs.decode(ids[:cut], skip_special_tokens=False)


def test_stale_queue_entries_are_skipped(ours):
    assert ours.merge([ours.byte_id[ord("a")]] * 5) == ours.encode("aaaaa")


def test_frames(spark, theirs):
    df = with_clashes(docs(spark, ["a b", None, "", "a b", "long " * 30000], ids=[1, 2, 3, 1, None]), "ids", "n_tokens", "ids_sha256")
    got = sorted(rows(bpe.digest(df, PATH)), key=str)
    want = []
    for i, t in [(1, "a b"), (2, ""), (3, ""), (1, "a b"), (None, "long " * 30000)]:
        ids = theirs.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert rows(bpe.digest(df.limit(0), PATH)) == []


def test_encode_then_decode(spark):
    df = docs(spark, ["Hello wörld", None, "x  y"])
    back = bpe.decode(bpe.encode(df, PATH), PATH)
    assert sorted(rows(back)) == [(0, "Hello wörld"), (1, ""), (2, "x  y")]
