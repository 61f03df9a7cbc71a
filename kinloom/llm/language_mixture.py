"""Language identification by multilingual mixtures.

Character trigrams of the lower-cased letters (all else is one space) are counted
by language over every document that may be learned from.  A trigram is one of
``BUCKETS`` hash buckets, fewer if there are many languages, so the model has at
most ``CELLS`` numbers whatever the corpus; map tasks count whole buckets before
the shuffle.  Each language's likelihoods hold ``DRAWN`` parts of the mean of all
languages, so a trigram that no language has tells nothing.

A document is a mixture: expectation-maximisation estimates the share of every
language from its trigrams' likelihoods.  The languages enter in the order of
their shares; each set of the first 1, 2, ... languages is fitted anew, and the set
of the best log-likelihood, less ``PENALTY`` ln(trigrams) for each language, is
selected.  The prediction is its largest language.  The score is that language's
share among all languages, drawn towards equal shares by ``PRIOR`` trigrams.

Defined results: a text that is null or has no letter is ``und`` with score 0, as
is every text if nothing can be learned; documents without an id or a language are
predicted, not learned from; equal shares go to the language that sorts first by
code point; repeated rows are rows of their own; an empty table gives an empty
table.  Texts are read in pieces of ``PIECE`` characters, so long ones take no
more memory; a piece ends with a space.  Other columns are ignored.  More than
``LANGUAGES`` learned languages stop the run with an error.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ship_package, slices

BUCKETS, CELLS, LANGUAGES = 1 << 18, 1 << 23, 1 << 13
#: One document in so many, by the CRC-32 of its id, is held out.
HELD = 5
DRAWN, PRIOR, PENALTY = 0.01, 2.0, 8.0
#: Steps of expectation-maximisation over all languages and over each set; most languages of a set.
STEPS, SET_STEPS, SET = 12, 8, 4
PIECE, TEXT_BYTES = 1 << 20, 1 << 20
NONE = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.frompyfunc(lambda c: chr(c).isalpha(), 1, 1)(np.arange(0x110000)).astype(bool)


def trigrams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each trigram, and the number of its text."""
    texts = [t.lower() for t in texts]
    size = np.array([len(t) + 2 for t in texts], np.int64)
    c = np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), "<u4") if texts else np.zeros(0, np.uint32)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    c = np.where(letters()[c], c, np.uint32(32))
    space = c == 32
    stay = np.ones(len(c), bool)
    stay[1:] = ~(space[1:] & space[:-1]) | (of[1:] != of[:-1])
    c, of = c[stay].astype(np.uint64), of[stay]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    key = c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]
    key = (key ^ key >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    inside = of[:-2] == of[2:]
    return (key >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)[inside], of[:-2][inside]


def profiles(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and count of the distinct trigrams, by text."""
    if len(texts) == 1 and len(texts[0]) > PIECE:
        n = np.zeros(buckets, np.int64)
        for i in range(0, len(texts[0]), PIECE):
            n += np.bincount(trigrams([texts[0][i : i + PIECE]], buckets)[0], minlength=buckets)
        g = np.flatnonzero(n)
        return np.zeros(len(g), np.int64), g, n[g]
    g, of = trigrams(texts, buckets)
    key = np.sort(of.astype(np.int64) * buckets + g)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first] // buckets, key[first] % buckets, np.diff(np.append(first, len(key)))


class Model:
    """Likelihoods of the buckets (rows) in the languages (columns)."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names, self.buckets = names, counts.shape[0]
        share = counts / np.maximum(counts.sum(axis=0), 1)
        mean = share.sum(axis=1, keepdims=True) / max(len(names), 1) + 1e-9
        self.p = ((1 - DRAWN) * share + DRAWN * mean).astype(np.float32)

    @staticmethod
    def _fit(p: np.ndarray, n: np.ndarray, start: np.ndarray, total: np.ndarray, steps: int, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the columns of ``p`` in each run of rows, and the log-likelihoods."""
        of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(p))))
        for _ in range(steps):
            r = p * share[of]
            r *= (n / np.maximum(r.sum(axis=1), 1e-30))[:, None]
            share = np.add.reduceat(r, start, axis=0) / total[:, None]
        return share, np.add.reduceat(n * np.log(np.maximum((p * share[of]).sum(axis=1), 1e-30)), start)

    def mixtures(self, of: np.ndarray, g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each text: its number, the shares among all languages, the selected set (-1: none) and its shares."""
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        p, n = self.p[g].astype(np.float64), n.astype(np.float64)
        total = np.add.reduceat(n, start)
        every, _ = self._fit(p, n, start, total, STEPS, np.full((len(start), len(self.names)), 1 / len(self.names)))
        order = np.argsort(-every, axis=1, kind="stable")
        best = np.full(len(start), -np.inf)
        width = min(SET, len(self.names))
        chosen, shares = np.full((len(start), width), -1), np.zeros((len(start), width))
        run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(p))))
        for size in range(1, width + 1):
            some = order[:, :size]
            share, fit = self._fit(np.take_along_axis(p, some[run], axis=1), n, start, total, SET_STEPS if size > 1 else 0, np.full((len(start), size), 1 / size))
            fit -= PENALTY * size * np.log(total + 1)
            won = fit > best
            best[won] = fit[won]
            chosen[won, :size], shares[won, :size] = some[won], share[won]
        drawn = (every * total[:, None] + PRIOR / len(self.names)) / (total + PRIOR)[:, None]
        return of[start], drawn, chosen, shares

    def predict(self, texts: list[str]) -> list[tuple[str, float, str]]:
        """Language, score and the selected mixture (``en:0.7,fr:0.3``) of each text."""
        out = [(NONE, 0.0, "")] * len(texts)
        asked = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not asked or not self.names:
            return out
        of, drawn, chosen, shares = self.mixtures(*profiles([texts[i] for i in asked], self.buckets))
        for i, d, s, w in zip(of, drawn, chosen, shares):
            parts = sorted((-x, c) for c, x in zip(s, w) if c >= 0)
            top = parts[0][1]
            out[asked[i]] = (self.names[top], min(float(d[top]), 1.0), ",".join(f"{self.names[c]}:{-x:.3f}" for x, c in parts))
        return out


def train(docs: DataFrame) -> Model:
    """The model of all documents ``text, lang``."""
    spark = docs.sparkSession
    ship_package(spark)
    names = [r["lang"] for r in docs.select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    names.sort()
    buckets = min(BUCKETS, 1 << (CELLS // max(len(names), 1)).bit_length() - 1)
    number = {name: i for i, name in enumerate(names)}

    def run(batches):
        n = np.zeros(buckets * len(names), np.int64)
        for b in batches:
            for part in slices(b, 0, TEXT_BYTES):
                lang = np.array([number[x] for x in part.column(1).to_pylist()], np.int64)
                of, g, c = profiles(part.column(0).to_pylist(), buckets)
                np.add.at(n, g * len(names) + lang[of], c)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["cell", "n"])

    counts = np.zeros(buckets * len(names), np.int64)
    if names:
        rows = docs.select("text", "lang").mapInArrow(lean(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CELLS
        counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return Model(names, counts.reshape(buckets, len(names)))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(rows.filter("not held_out and doc_id is not null and lang is not null and text is not null"))
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for part in slices(b, 2, TEXT_BYTES * 8 // max(8, len(sent.value.names))):
                found = sent.value.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([f[j] for f in found], kind) for j, kind in enumerate((pa.string(), pa.float64(), pa.string())))], names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(lean(run), "doc_id long, held_out boolean, lang_pred string, score double, languages string")
