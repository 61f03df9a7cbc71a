"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns near hits, checksums.

One Aho-Corasick pass over the lower-cased text finds the keywords of every
kind; only there is the kind's pattern tried, anchored at the hit.  A run of
hexadecimal digits has no keyword, so that kind is one linear scan.  Kinds
beyond the base ones are accepted only if the checksum inside them holds.

Defined results: a null or empty text has no secrets; every input row yields
one output row (repeated rows and null ids stay); an empty table gives an empty
table.  Other columns of the input are ignored.  Offsets are code points, end
exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ship_package

#: The base kinds in their order, then those with a checksum.
KINDS = ("assign", "access", "hex", "checked")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access", "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked"}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    """CRC-32 of the body as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def ascii_lower(text: str) -> str:
    """Lower-case A-Z only, so that offsets stay those of the text."""
    return text.encode().lower().decode()


def scan(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of every secret, in order."""
    found: list[tuple[int, int, int]] = []
    last = dict.fromkeys(KINDS, 0)
    hits = sorted((end - n + 1, kind) for end, (n, kind) in automaton().iter(ascii_lower(text)))
    for at, kind in hits:
        if at < last[kind]:
            continue  # inside the previous match of this kind
        if kind == "assign":
            if m := ASSIGN.match(text, at):
                last[kind] = m.end()
                if m.end() - m.start(2) >= ASSIGN_VALUE:
                    found.append((at, 0, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, at):
                last[kind] = m.end()
                if m.end() - at >= ACCESS_LENGTH:
                    found.append((at, 1, m.end()))
        elif (m := CHECKED.match(text, at)) and base62_crc(m[1]) == m[2]:
            last[kind] = m.end()
            found.append((at, 3, m.end()))
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def spans_text(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row."""
    ship_package(docs.sparkSession)
    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches):
        for b in batches:
            counts, shas, spans = ([], [], []), [], []
            for t in b.column(1):
                found = scan(t.as_py() or "")
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in found))
                shas.append(hashlib.sha256(spans_text([x for x in found if x[1] < 3]).encode()).hexdigest())
                spans.append(spans_text(found))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()), pa.array(spans, pa.string())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(lean(run), f"{id_col} {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """The same rows and columns, each secret's span replaced by ``mark``.

    Overlapping spans are replaced as one; null texts stay null.
    """
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text or not (found := scan(text)):
            return text
        out, end = [], 0
        for s, _, e in found:
            if s >= end:
                out += [text[end:s], mark]
            end = max(end, e)
        return "".join([*out, text[end:]])

    def run(batches):
        for b in batches:
            texts = pa.array([clean(t.as_py()) for t in b.column(at)], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return docs.mapInArrow(lean(run), docs.schema)
