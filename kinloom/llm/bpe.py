"""Byte-level BPE encoding and decoding.

A text is cut into pretokens by the vocabulary's split pattern; each pretoken's
bytes form a doubly linked list of symbols, and a priority queue of
(merge rank, position) joins the best adjacent pair until none is left.  A
queue entry whose pair has meanwhile changed is stale and skipped.  Decoding
concatenates the vocabulary strings and maps them back to bytes.

Defined results: a null text encodes as the empty text; the special token's
string inside a text becomes its id; every input row yields one output row
(repeated rows stay repeated, a null id stays null); an empty table gives an
empty table.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, lean, ship_package, slices

#: Unicode White_Space, and the split pattern of the vocabulary.
WHITE_SPACE = r"\t-\r\x20\x85\xa0  -     　"
COARSE = rf" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
FINE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
#: A space inside a run of white space, which is one pretoken up to the run's last character.
INSIDE_RUN = rf"[{WHITE_SPACE}]\x20[{WHITE_SPACE}]"

#: Entries in each of a worker's two generations of cached pretokens.
CACHE_ENTRIES = 230_000
#: Bits of a queue key that hold the position, in lists of up to 2**13 symbols.
POSITION_BITS = 13
#: Bytes of text encoded at once.
TEXT_BYTES = 5 << 20
#: Longer pretokens are not cached, which bounds the cache's bytes.
CACHE_LENGTH = 48


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in out)
    return out | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        to_byte = {c: b for b, c in alphabet.items()}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.byte_id = [vocab[alphabet[b]] for b in range(256)]
        n_ids = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        #: by left id: right id -> rank << POSITION_BITS, the queue's key without the position
        by_left: list[dict[int, int]] = [{} for _ in range(n_ids)]
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            by_left[vocab[a]][vocab[b]] = r << POSITION_BITS
        self.rank = [d.get for d in by_left]
        self.joined = [vocab[a + b] for a, b in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelled = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.vocab_bytes = [spelled.get(i, b"") for i in range(n_ids)]
        self.id_text = [str(i) for i in range(n_ids)]
        self.coarse = regex.compile(COARSE)
        self.fine = regex.compile(FINE)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        #: ids of pretokens and of chunks: those of late, and those before
        self._new: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges to a list of symbols, lowest rank first, leftmost among equals."""
        n, rank, joined = len(symbols), self.rank, self.joined
        more = max(0, n.bit_length() - POSITION_BITS)  # a long list needs wider positions
        bits = POSITION_BITS + more
        mask = (1 << bits) - 1
        after = [*range(1, n + 1)]
        before = [*range(-1, n - 1)]
        queue = []
        for i, right in enumerate(symbols[1:]):
            if (r := rank[symbols[i]](right)) is not None:
                queue.append(r << more | i)
        heapify(queue)
        while queue:
            key = heappop(queue)
            i = key & mask
            if (left := symbols[i]) < 0 or (j := after[i]) >= n or (r := rank[left](symbols[j])) is None or r << more != key - i:
                continue  # stale: one of the two has been merged meanwhile
            symbols[i] = new = joined[key >> bits]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank[new](symbols[k])) is not None:
                    heappush(queue, r << more | i)
            if i and (r := rank[symbols[h := before[i]]](new)) is not None:
                heappush(queue, r << more | h)
        return [s for s in symbols if s >= 0]

    def _ids(self, chunk: str, whole: bool) -> tuple[int, ...]:
        """Ids of a chunk that no pretoken crosses; ``whole``: it is one pretoken."""
        if (ids := self._new.get(chunk)) is not None:
            return ids
        if (ids := self._old.get(chunk)) is None:
            words = [chunk] if whole else self.fine.findall(chunk)
            if len(words) == 1:
                ids = tuple(self.merge([*map(self.byte_id.__getitem__, chunk.encode())]))
            else:
                ids = tuple(chain.from_iterable([self._ids(w, True) for w in words]))
        if len(chunk) <= CACHE_LENGTH:
            if len(self._new) >= CACHE_ENTRIES:
                self._new, self._old = {}, self._new
            self._new[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            for chunk in self.coarse.findall(part):
                got = self._new.get(chunk)
                ids += self._ids(chunk, False) if got is None else got
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.vocab_bytes.__getitem__, ids)).decode("utf-8", errors="replace")


    def encode_all(self, texts: pa.Array):
        """``encode`` of each text in turn; null texts are empty.

        Texts are cut at single spaces, each space left to what follows it, and
        each distinct chunk is encoded once.  Where a cut could divide white
        space that belongs together (a space of any run has white space on both
        sides, or ends the text), or a special token's string may occur, the
        text is encoded on its own.
        """
        texts = pc.fill_null(texts, "")
        plain = pc.invert(pc.or_(pc.match_substring(texts, "  "), pc.ends_with(texts, " ")))
        plain = pc.and_not(plain, pc.match_substring_regex(texts, INSIDE_RUN))
        for t in self.special:
            plain = pc.and_not(plain, pc.match_substring(texts, t))
        lists = pc.split_pattern(pc.if_else(plain, texts, ""), " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = [self._ids(" " + w, False) for w in words]
        at = coded.indices.to_numpy()
        ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
        for k, cut in enumerate(plain.to_pylist()):
            if not cut:
                yield self.encode(texts[k].as_py())
                continue
            first, end = ends[k], ends[k + 1]
            yield [*self.encode(words[at[first]]), *chain.from_iterable(map(known.__getitem__, at[first + 1 : end].tolist()))]


def load(path: str) -> ByteBpe:
    return kept(f"bpe {path}", lambda: ByteBpe(path))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` for every row."""
    ship_package(docs.sparkSession)

    def run(batches):
        bpe = load(tokenizer)
        for b in batches:
            for part in slices(b, 1, TEXT_BYTES):
                ids = pa.array(list(bpe.encode_all(part.column(1))), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lean(run, f"bpe {tokenizer}"), f"{id_col} {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` for every row of ids; null ids decode as the empty text."""
    ship_package(encoded.sparkSession)

    def run(batches):
        bpe = load(tokenizer)
        for b in batches:
            texts = [bpe.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(lean(run, f"bpe {tokenizer}"), f"{id_col} {kind}, text string")


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode every row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    ship_package(docs.sparkSession)

    def run(batches):
        bpe = load(tokenizer)
        for b in batches:
            for part in slices(b, 1, TEXT_BYTES):
                n, ids_sha, text_sha = [], [], []
                for ids in bpe.encode_all(part.column(1)):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(bpe.id_text.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run, f"bpe {tokenizer}"), out)
