"""Token counts of sections by offset-mapped attribution.

A whole document is encoded once.  The bytes of each token give its character
span: from the character that holds its first byte to the one that holds its
last.  The spans are interval-joined to the document's sections, sorted by their
starts.  A token that crosses a boundary counts for the section that holds most
of its characters, and for the earlier one if two hold equally many; so the
sections' counts add up to the document's.

Defined results: a null text is empty and has one empty section without tokens;
characters outside every given section count for the section before them, or
the first; every input row is treated on its own (repeated rows and null ids
stay); an empty table gives an empty table.  Other columns of the input are
ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ship_package, slices


class Counter:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids = np.asarray(self.encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self.length[ids])
        starts = ends - self.length[ids]
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) != len(text):
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            starts, ends = char[starts], char[ends - 1] + 1
        return starts, ends


def line_starts(text: str) -> list[int]:
    """Sections by line: each line with its line feed; a final line feed opens no section."""
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def attribute(starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, n_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and tokens that cross a boundary, of each section."""
    first = np.maximum(np.searchsorted(section_starts, starts, "right") - 1, 0)
    last = np.maximum(np.searchsorted(section_starts, ends - 1, "right") - 1, 0)
    bounds = np.append(section_starts, n_chars)
    bounds[0] = 0
    for i in np.flatnonzero(first != last).tolist():
        held = range(int(first[i]), int(last[i]) + 1)
        first[i] = max(held, key=lambda s: (min(ends[i], bounds[s + 1]) - max(starts[i], bounds[s]), -s))
    crossing = np.maximum(np.searchsorted(section_starts, starts, "right") - 1, 0) != last
    n = len(section_starts)
    return np.bincount(first, minlength=n), np.bincount(first[crossing], minlength=n)


@lru_cache(maxsize=1)
def load(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, ranks: str, sections_col: str | None = None) -> DataFrame:
    """``doc_id, section, start, end, n_tokens, n_crossing``, a row for each section of each row.

    ``sections_col`` names an array of ascending section starts (characters,
    the first 0); without it the sections are the lines of the text.
    """
    ship_package(docs.sparkSession)
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches):
        counter = load(ranks)
        for b in batches:
            for part in slices(b):
                out: list[list] = [[] for _ in names]
                given = part.column(2).to_pylist() if sections_col else None
                for k, (doc, value) in enumerate(zip(part.column(0).to_pylist(), part.column(1))):
                    text = value.as_py() or ""
                    at = np.asarray((given[k] if given else None) or line_starts(text), np.int64)
                    n, crossing = attribute(*counter.spans(text), at, len(text))
                    out[0] += [doc] * len(at)
                    out[1] += range(len(at))
                    out[2] += at.tolist()
                    out[3] += [*at[1:].tolist(), len(text)]
                    out[4] += n.tolist()
                    out[5] += crossing.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    cols = [F.col("doc_id").cast("long"), F.col("text").cast("string")] + ([F.col(sections_col).cast("array<long>")] if sections_col else [])
    return docs.select(*cols).mapInArrow(lean(run), ", ".join(f"{n} long" for n in names))
