"""Ranked lexical search by NRA (no random access) over impact-sorted posting lists.

A first pass cuts the texts into terms and stores, for each document, its length
and the counts of the terms that the queries use.  From these come the number of
documents, their lengths and the document frequencies, hence the integer impact of
every posting.  Then each task reads its documents in blocks: a block's postings
are sorted by term and falling impact, and for each query the lists of its terms
are read in step, deeper each time.  A document's lower bound is the sum of the
impacts read, its upper bound adds the last impact read of every list in which it
was not met yet.  Reading ends when every document whose upper bound reaches the
k-th best lower bound has equal bounds, so members, ties and scores are final.  A
task keeps ``k`` documents a query, whose scores are the line for its later blocks,
and one window ranks what the tasks kept: the best of a whole are among the best
of its parts.  Queries go through in blocks of bounded size.

Defined results: null texts have no terms; documents without terms do not count in
N; documents without an id are ranked after their equals; repeated documents each
count and are ranked each; queries that share an id are one query with the terms of
all, those without an id included; a query without terms, or an empty table, gives
no rows.  Other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, ship_package, slices, stored

#: Characters of a block of queries.
QUERY_CHARS = 1 << 22
#: Documents of a block, and at most so many cells of (query term, document).
DOCUMENTS, CELLS = 4096, 1 << 24
#: Postings read of each list in the first step; every step doubles them.
DEPTH = 64
TEXT_BYTES = 4 << 20
#: Terms are runs of these bytes (digits, letters, all of UTF-8 beyond ASCII), with A-Z lower-cased; all others are cut out.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TERM_BYTES).split()


class Queries:
    """A block of queries: the vocabulary of their terms, and each query's terms in it."""

    def __init__(self, texts: dict):
        self.ids = list(texts)
        self.vocabulary: dict[bytes, int] = {}
        self.terms = [np.array(sorted({self.vocabulary.setdefault(t, len(self.vocabulary)) for x in texts[i] for t in terms(x)}), np.int64) for i in self.ids]


def _int_lists(values: list[int], sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int32()))


def index(docs: DataFrame, queries) -> DataFrame:
    """``doc_id, n, terms, tf``: each document's length and the counts of its query terms."""

    def run(batches):
        find = queries.value.vocabulary.get
        for b in batches:
            for part in slices(b, 1, TEXT_BYTES):
                n, size, own, tf = [], [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    words = terms(text or b"")
                    counts = Counter(map(find, words))
                    counts.pop(None, None)
                    n.append(len(words))
                    size.append(len(counts))
                    own += counts.keys()
                    tf += counts.values()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), _int_lists(own, size), _int_lists(tf, size)], names=["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(lean(run), "doc_id long, n long, terms array<int>, tf array<int>")


class Postings:
    """The postings of a block of documents, by term and falling impact."""

    def __init__(self, part: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int):
        sizes = pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False)
        term = pc.list_flatten(part.column("terms")).to_numpy().astype(np.int64)
        tf = pc.list_flatten(part.column("tf")).to_numpy().astype(np.int64)
        m = 100 - 90 + 90 * part.column("n").to_numpy() * n_docs // max(n_terms, 1)
        doc = np.repeat(np.arange(part.num_rows), sizes)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        order = np.lexsort((-impact, term))
        self.doc, self.impact, self.n = doc[order], impact[order], part.num_rows
        self.start = np.searchsorted(term[order], np.arange(len(weights) + 1))


def search_block(lists: Postings, terms: np.ndarray, k: int, line: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a block that can be among the best ``k`` of a query, with final scores.

    ``line``: the least score that still counts (the k-th best so far, or 1).
    """
    first, last = lists.start[terms], lists.start[terms + 1]
    first, last = first[last > first], last[last > first]
    lower = np.zeros(lists.n, np.int64)
    met = np.zeros((len(first), lists.n), bool)
    at, depth = first.copy(), DEPTH
    while True:
        for t in range(len(first)):
            run = slice(at[t], min(at[t] + depth, last[t]))
            lower[lists.doc[run]] += lists.impact[run]
            met[t, lists.doc[run]] = True
            at[t] = run.stop
        depth *= 2
        rest = np.where(at < last, lists.impact[at - 1], 0)
        upper = lower + rest.sum()
        for t in np.flatnonzero(rest):
            upper -= np.where(met[t], rest[t], 0)
        kth = int(np.partition(lower, -k)[-k]) if lists.n >= k else 0
        reach = np.flatnonzero(upper >= max(line, kth, 1))
        if (upper[reach] == lower[reach]).all():
            return reach, lower[reach]


class Best:
    """The best ``k`` documents of every query of a block, so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(n)]  # (-score, without id, id)

    def line(self, q: int) -> int:
        return -self.found[q][-1][0] if len(self.found[q]) == self.k else 1

    def offer(self, q: int, ids: list, scores: list) -> None:
        own = self.found[q] + [(-s, i is None, i or 0) for i, s in zip(ids, scores)]
        self.found[q] = sorted(own)[: self.k]

    def rows(self) -> pa.RecordBatch:
        flat = [(q, None if none else i, -s) for q, own in enumerate(self.found) for s, none, i in own]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in flat], kind) for j, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["q", "doc_id", "score"])


def _ranked_of(docs: DataFrame, texts: dict, k: int) -> DataFrame:
    """``item_id, doc_id, score``: what the tasks keep of one block of queries."""
    spark = docs.sparkSession
    queries = Queries(texts)
    sent = spark.sparkContext.broadcast(queries)
    own = stored(index(docs, sent), "nra")
    n_docs, n_terms = own.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(queries.vocabulary), np.int64)
    for r in own.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("c")).toLocalIterator():  # one number a query term
        df[r["t"]] = r["c"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    rows = max(1, min(DOCUMENTS, CELLS // max([1, *map(len, queries.terms)])))

    def run(batches):
        best = Best(len(queries.terms), k)
        for b in batches:
            for i in range(0, b.num_rows, rows):
                part = b.slice(i, rows)
                lists, ids = Postings(part, weights, n_docs, n_terms), part.column("doc_id")
                for q, own in enumerate(queries.terms):
                    reach, scores = search_block(lists, own, k, best.line(q))
                    if len(reach):
                        best.offer(q, ids.take(pa.array(reach)).to_pylist(), scores.tolist())
        yield best.rows()

    kept = own.mapInArrow(lean(run), "q int, doc_id long, score long")
    names = spark.createDataFrame(list(enumerate(queries.ids)), "q int, item_id long")
    return kept.join(F.broadcast(names), "q").select("item_id", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``k`` documents of every item."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // QUERY_CHARS))
    found = None
    for b in range(n_blocks):
        texts: dict = {}
        for r in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).collect():  # about QUERY_CHARS characters
            texts.setdefault(r["item_id"], []).append(r["text"].encode())
        kept = _ranked_of(rows, texts, k)
        kept = stored(kept, "nra-best") if n_blocks > 1 else kept
        found = kept if found is None else found.union(kept)
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
