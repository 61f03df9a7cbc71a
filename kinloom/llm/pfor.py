"""Token-ID files in patched frame-of-reference blocks.

Ids are cut into blocks of 128.  A block stores its minimum, the differences to
it packed at the width that a chosen percentile of them fits, and the larger
differences in an exception list.  A segment is a run of blocks that holds
whole documents; its index has the byte at which each block starts.  The table
file is Parquet, one row a segment: ``part`` (write task, ascending with the
document id), ``seg``, ``first`` (ids of the task before the segment),
``doc_ids``, ``lengths``, ``n_ids``, ``block_starts`` (little-endian u32) and
``blocks``.

Block layout, little-endian: u32 minimum, u8 width, u8 ids - 1, u8 exceptions,
ceil(128 * width / 8) packed bytes (short blocks are padded with zeros), u8
position and u32 difference of each exception.

Documents are dealt by ranges of their id, rows of one id by the start of their
text, its hash and the task that read them, so no task holds a group that grows:
texts are encoded where they are written.  Defined results: a null text encodes
as the empty text (the end id alone); rows with a null id come first; repeated
ids are kept in the order of the first ``HEAD`` characters of their texts, then
of a hash of the text; an empty table gives an empty file.
Other columns of the input are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, lean, run_dir, ship_package, slices

BLOCK = 128
#: Characters of a text that order the rows of one id.
HEAD = 64
#: Ids after which a segment is closed.
SEGMENT_IDS = 1 << 16
#: Share of a block's differences that the packed width must hold.
PERCENTILE = 0.9
#: Distinct white-space separated chunks whose ids a worker keeps; two generations.
CACHE_ENTRIES = 400_000
CACHE_LENGTH = 48
#: Chunks given to the library at once, those of letters in texts of so many, and bytes of text encoded at once.
ENCODED_AT_ONCE, WORDS_A_TEXT = 10_000, 500
SLICE_BYTES = 10 << 20

SEGMENT_SCHEMA = "part int, seg int, first long, doc_ids array<long>, lengths array<int>, n_ids long, block_starts binary, blocks binary"


def _bits(x: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, bytes]:
    """``(block_starts, blocks)`` of a run of ids below 2**32."""
    n = len(ids)
    if not n:
        return b"", b""
    n_blocks = -(-n // BLOCK)
    full = np.full(n_blocks * BLOCK, ids[-1], np.uint32)
    full[:n] = ids
    last = n - (n_blocks - 1) * BLOCK
    full = full.reshape(n_blocks, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    diff[-1, last:] = 0
    counts = np.full(n_blocks, BLOCK)
    counts[-1] = last
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _bits(np.partition(diff, rank, axis=1)[:, rank])
    over = diff > ((np.int64(1) << width) - 1).astype(np.uint32)[:, None]
    n_over = over.sum(axis=1)
    inside = np.where(over, np.uint32(0), diff)
    packed: list[bytes] = [b""] * n_blocks
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            cells = inside[at].astype("<u2") if w <= 16 else inside[at]
            bits = np.unpackbits(cells.view(np.uint8).reshape(len(at), BLOCK, -1), axis=2, bitorder="little")[:, :, :w]
            rows = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little").tobytes()
            size = BLOCK * int(w) // 8
            for i, k in enumerate(at.tolist()):
                packed[k] = rows[i * size : (i + 1) * size]
    head = np.empty((n_blocks, 7), np.uint8)
    head[:, :4] = low.astype("<u4")[:, None].view(np.uint8)
    head[:, 4], head[:, 5], head[:, 6] = width, counts - 1, n_over
    heads, at = head.tobytes(), np.nonzero(over)
    positions, rests = at[1].astype(np.uint8).tobytes(), diff[at].astype("<u4").tobytes()
    out, done = [], 0
    for k, e in enumerate(n_over.tolist()):
        out.append(heads[7 * k : 7 * k + 7])
        out.append(packed[k])
        if e:
            out.append(positions[done : done + e])
            out.append(rests[4 * done : 4 * (done + e)])
            done += e
    size = 7 + BLOCK * width // 8 + 5 * n_over
    return (np.cumsum(size) - size).astype("<u4").tobytes(), b"".join(out)


def decode_blocks(block_starts: bytes, blocks: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` up to ``stop``, found by the index."""
    starts = np.frombuffer(block_starts, "<u4")[first:stop].astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.int64)
    raw = np.frombuffer(blocks, np.uint8)
    low = sum(raw[starts + i].astype(np.int64) << (8 * i) for i in range(4))
    width, counts, n_over = raw[starts + 4].astype(np.int64), raw[starts + 5].astype(np.int64) + 1, raw[starts + 6].astype(np.int64)
    diff = np.zeros((len(starts), BLOCK), np.int64)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            size = BLOCK * int(w) // 8
            bits = np.unpackbits(raw[(starts[at] + 7)[:, None] + np.arange(size)], axis=1, bitorder="little")
            cells = np.zeros((len(at), BLOCK, 16 if w <= 16 else 32), np.uint8)
            cells[:, :, :w] = bits.reshape(len(at), BLOCK, w)
            diff[at] = np.packbits(cells.reshape(len(at), -1), axis=1, bitorder="little").view("<u2" if w <= 16 else "<u4")
    if n_over.any():
        block = np.repeat(np.arange(len(starts)), n_over)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        lists = (starts + 7 + BLOCK * width // 8)[block]
        rest = raw[(lists + n_over[block] + 4 * nth)[:, None] + np.arange(4)]
        diff[block, raw[lists + nth]] = rest.view("<u4")[:, 0]
    ids = (diff + low[:, None]).reshape(-1)
    short = BLOCK - int(counts[-1])
    return ids[: len(ids) - short] if short else ids


class ChunkEncoder:
    """The tokenizers library's ids of a text, with its ids of each distinct chunk kept.

    Holds for vocabularies whose normalizer and split never join characters
    across a space, TAB, CR or LF, drop white space and lower the case.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        #: Which ids end a word of the vocabulary's split.
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Little-endian u32 ids of each of some distinct chunks."""
        new, old = self._new, self._old
        out = list(map(new.get, chunks))
        missing = []
        for k, ids in enumerate(out):
            if ids is None:
                c = chunks[k]
                if (ids := old.get(c)) is None:
                    missing.append(k)
                else:
                    new[c] = out[k] = ids
        for k, ids in zip(missing, self._encoded([chunks[k] for k in missing])):
            out[k] = ids
            if len(chunks[k]) <= CACHE_LENGTH:
                new[chunks[k]] = ids
        if len(new) >= CACHE_ENTRIES:
            self._new, self._old = {}, new
        return out

    def _encoded(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks by the library.  Chunks of letters are words of the vocabulary's
        split, so many of them are given to it as one text and cut where words end."""
        out: list[bytes] = [b""] * len(chunks)
        words = [k for k, c in enumerate(chunks) if c.isalpha() and "\u0130" not in c]
        single = [k for k, c in enumerate(chunks) if not c.isalpha() or "\u0130" in c]
        runs = [words[i : i + WORDS_A_TEXT] for i in range(0, len(words), WORDS_A_TEXT)]
        for i in range(0, len(runs), ENCODED_AT_ONCE // WORDS_A_TEXT):
            some = runs[i : i + ENCODED_AT_ONCE // WORDS_A_TEXT]
            for run, e in zip(some, self.tokenizer.encode_batch_fast([" ".join([chunks[k] for k in run]) for run in some], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                stops = 4 * (np.flatnonzero(self._ends[ids]) + 1)
                if len(stops) != len(run):  # a vocabulary of another split
                    single += run
                    continue
                raw, first = ids.tobytes(), 0
                for k, stop in zip(run, stops.tolist()):
                    out[k] = raw[first:stop]
                    first = stop
        for i in range(0, len(single), ENCODED_AT_ONCE):
            some = single[i : i + ENCODED_AT_ONCE]
            for k, e in zip(some, self.tokenizer.encode_batch_fast([chunks[k] for k in some], add_special_tokens=False)):
                out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``end_id`` after each, and the number of each."""
        texts = pc.fill_null(texts, "")
        # A-Z meet a-z in the normalizer; a special token's string must stay as it is, and so must a capital before
        # a mark: the normalizer composes first, and h, i, j, t, w, y have other composites than their capitals
        as_is = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, r"[A-Z]\p{M}"))
        texts = pc.if_else(as_is, texts, pc.ascii_lower(texts))
        for c in "\t\n\r":
            texts = pc.replace_substring(texts, c, " ")
        # a run of these after a Latin letter and before white space is split off by the vocabulary too: fewer chunks
        # (not after U+0130: in lower case it ends in a combining mark, which joins the run)
        texts = pc.replace_substring_regex(texts, r"([a-z\x{df}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}])([.,!?;:$&%#*]+) ", r"\1 \2 ")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        pieces = [*self._chunks(coded.dictionary.to_pylist()), int(end_id).to_bytes(4, "little")]
        size = np.array([len(p) // 4 for p in pieces], np.int32)
        start = np.cumsum(size, dtype=np.int32) - size
        known = np.frombuffer(b"".join(pieces), "<u4")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        at = np.insert(coded.indices.to_numpy(), offsets[1:] - offsets[0], len(pieces) - 1)
        n = size[at]
        ends = np.cumsum(n, dtype=np.int32)
        ids = known[np.repeat(start[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        docs = np.cumsum(np.diff(offsets) + 1)
        return ids, np.diff(ends[docs - 1].astype(np.int64), prepend=0) if len(docs) else docs


def load(path: str) -> ChunkEncoder:
    return kept(f"pfor {path}", lambda: ChunkEncoder(path))


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int, percentile: float = PERCENTILE) -> None:
    """Encode every row's text and write the ids, ``end_id`` after each, by ascending ``doc_id``."""
    ship_package(docs.sparkSession)

    def run(batches):
        enc, part, seg = load(tokenizer), TaskContext.get().partitionId(), 0
        ids, held, payload, first = [], [], 0, 0

        def close():
            run_ids = np.concatenate(held)
            starts, blocks = encode_blocks(run_ids, percentile)
            row = [[part], [seg], [first], [ids], [[len(h) for h in held]], [len(run_ids)], [starts], [blocks]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
            names = ["part", "seg", "first", "doc_ids", "lengths", "n_ids", "block_starts", "blocks"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

        for b in batches:
            for part_of in slices(b, 1, SLICE_BYTES):
                flat, lengths = enc.encode(part_of.column(1), end_id)
                for i, got in zip(part_of.column(0).to_pylist(), np.split(flat, np.cumsum(lengths)[:-1])):
                    ids.append(i)
                    held.append(got)
                    payload += len(got)
                    if payload >= SEGMENT_IDS:
                        yield close()
                        seg, first, ids, held, payload = seg + 1, first + payload, [], [], 0
        if held:
            yield close()

    order = ["doc_id", F.substring("text", 1, HEAD), F.xxhash64("text")]
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.spark_partition_id().alias("task"))
        .repartitionByRange(*order, "task")  # rows equal up to the task are alike, so any of them may come first
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(lean(run, f"pfor {tokenizer}"), SEGMENT_SCHEMA)
        .write.parquet(path)
    )


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the blocks.

    ``start`` is the number of ids before the document in the whole file: the
    ids of earlier write tasks (one small row each), of earlier segments of the
    task, and of earlier documents of the segment.
    """
    ship_package(spark)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def run(batches):
        for b in batches:
            docs, starts, counts, crcs = [], [], [], []
            for ids, lengths, block_starts, blocks, first, before in zip(*(c.to_pylist() for c in b.columns)):
                raw = memoryview(decode_blocks(block_starts, blocks).astype("<u4").tobytes())
                at, place = 0, first + before
                for n in lengths:
                    starts.append(place)
                    crcs.append(zlib.crc32(raw[at : at + 4 * n]))
                    at += 4 * n
                    place += n
                docs += ids
                counts += lengths
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, starts, counts, crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one number a write task is broadcast: no more than the write had partitions
    located = segments.join(F.broadcast(before), "part")
    return located.select("doc_ids", "lengths", "block_starts", "blocks", "first", "before").mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the documents' token file to the shared folder and read it back."""
    path = run_dir(docs.sparkSession, "tokens")
    write_token_file(docs, path, tokenizer, end_id)
    return read_token_file(docs.sparkSession, path)
