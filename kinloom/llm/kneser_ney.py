"""Quality classifier: interpolated modified Kneser-Ney model of characters.

The model is trained on trusted text: all documents labelled good, but for one
in five that is held back for the thresholds.  Characters are folded to 12-bit
classes, so that a 5-gram is one long and its shorter grams are bit fields of
it.  Map tasks count their own 5-grams; counts, continuation counts, discounts,
probabilities and back-off weights are then joins and aggregations sharded by
gram and context.

Scoring is joins too.  Documents are dealt to blocks of about ``BLOCK_BYTES`` of
text, their texts compressed.  A block hands on each of its 5-grams once; the
different 5-grams of all blocks get their ln p by joins with the tables of the
orders, longest first, and go back to the blocks that hold them.  There a
document's characters are looked up and summed.  The texts are shuffled once,
however large the model; no part of it passes through the driver, and a worker
holds the text and the 5-grams of one block.

A document is rejected if its mean negative log-probability a character exceeds
the limit of its language: the 99 % quantile of the held-back trusted documents,
raised by ``MARGIN`` times its distance from their median and at least ``FLOOR``
above it.  Short documents are
drawn towards the median by ``PRIOR`` characters, so that a few odd characters do
not reject them.

Defined results: a null or empty text is kept (no evidence); a document without
language, or of one without held-back documents, is measured by the limit over
all languages; without any trusted document everything is kept; a document with
contradicting labels is not trusted; repeated rows and null ids are rows of their
own; an empty table gives an empty table.  Extra columns pass through ``classify``
untouched, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, only, release_memory, ship_package, slices, stored

ORDER, BITS = 5, 12
#: UTF-8 bytes of text that a worker holds at a time, packed and unpacked, with their 5-grams (each once, 12 bytes
#: at half load).  A task gets several blocks, one after the other; smaller ones hand on more 5-grams in all.
BLOCK_BYTES = 1 << 24
#: One trusted document in so many is held back for the limits.
HELD = 5
QUANTILE, MARGIN, PRIOR = 0.99, 1.0, 200
#: Least distance of a limit from the median (nats a character), for a language of few or like documents.
FLOOR = 0.1
START, END, FOLD, CLASSES = 4095, 4094, 2046, 1 << BITS
TEXT_BYTES = 1 << 18
#: Grams of slices of text that wait to be merged with those met before.
MERGE = 1 << 19


def classes(text: str) -> np.ndarray:
    """Character classes: code points below 2048 are their own, the others share the rest."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.where(c < 2048, c, 2048 + c % FOLD)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram that ends in each character and in the end of each text, and the text's number."""
    runs, of = [], []
    for k, t in enumerate(texts):
        if t:
            runs += [np.full(ORDER - 1, START, np.int64), classes(t), np.array([END])]
            of.append(np.full(len(runs[-2]) + ORDER, k))
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c, of = np.concatenate(runs), np.concatenate(of)
    n = len(c) - ORDER + 1
    value = np.zeros(n, np.int64)
    for i in range(ORDER):
        value = value << BITS | c[i : i + n]
    inside = of[:n] == of[ORDER - 1 :]
    return value[inside], of[:n][inside]


class Grams:
    """The different ones of all grams added.

    They are merged whenever ``MERGE`` more wait, or as many as there are already: a
    batch of long texts repeats its grams in every slice, and would hold them all."""

    def __init__(self):
        self.have, self.waiting, self.n = np.zeros(0, np.int64), [], 0

    def add(self, new: np.ndarray) -> None:
        self.waiting.append(new)
        self.n += len(new)
        if self.n >= max(MERGE, len(self.have)):
            self.all()

    def all(self) -> np.ndarray:
        if self.waiting:
            self.have, self.waiting, self.n = np.unique(np.concatenate([self.have, *self.waiting])), [], 0
        return self.have


def _counts(docs: DataFrame) -> DataFrame:
    """``g, c`` over all documents ``text``, counted in each task before the shuffle."""

    def run(batches):
        for b in batches:
            for part in slices(b, 0, 2 * TEXT_BYTES):
                g, _ = grams(part.column(0).to_pylist())
                g, c = np.unique(g, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c.astype(np.int64))], names=["g", "c"])

    return docs.select("text").mapInArrow(lean(run), "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def train(docs: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """The model of the documents ``text``: for each order, from 1, ``g, w`` (a seen gram's ln p) and ``ctx, v`` (a seen context's ln weight)."""
    ship_package(docs.sparkSession)
    seen = {ORDER: stored(_counts(docs), "kn-counts")}
    for k in range(ORDER - 1, 0, -1):  # how many different characters stand before
        seen[k] = stored(seen[k + 1].groupBy(F.col("g").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("g")).agg(F.count("*").alias("c")), "kn-counts")
    tables, lower = [], None
    for k in range(1, ORDER + 1):
        n = [x or 0 for x in seen[k].agg(*[F.sum((F.col("c") == i).cast("long")) for i in range(1, 5)]).first()]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        cut = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i - 0.05) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
        level = F.least("c", F.lit(3))
        rows = seen[k].withColumn("ctx", F.shiftright("g", BITS))
        ctx = rows.groupBy("ctx").agg(F.sum("c").alias("total"), *[F.sum((level == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3)])
        gamma = sum(F.col(f"n{i}") * cut[i - 1] for i in (1, 2, 3)) / F.col("total")
        ctx = stored(ctx.select("ctx", "total", gamma.alias("gamma")), "kn-contexts")
        discount = F.when(level == 1, cut[0]).when(level == 2, cut[1]).otherwise(cut[2])
        rows = rows.join(ctx, "ctx").withColumn("own", (F.col("c") - discount) / F.col("total"))
        if lower is None:
            rows = rows.withColumn("p", F.col("own") + F.col("gamma") / CLASSES)
        else:
            rows = rows.withColumn("low", F.col("g").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1))).join(lower, "low").withColumn("p", F.col("own") + F.col("gamma") * F.col("lower_p"))
        lower = stored(rows.select(F.col("g").alias("low"), F.col("p").alias("lower_p")), "kn-grams")
        tables.append((lower.select(F.col("low").alias("g"), F.log("lower_p").alias("w")), ctx.select("ctx", F.log("gamma").alias("v"))))
    return tables


class Table:
    """Open addressing over sorted-out keys; a missing key gives NaN."""

    def __init__(self, keys: np.ndarray, w: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.w = np.full(1 << bits, np.nan, np.float32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]
            placed = self.keys[slot] == keys[left]
            self.w[slot[placed]] = w[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.w[slot], np.float32(np.nan))
        left = np.flatnonzero((at != keys) & (at != -1))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            at = self.keys[slot]
            hit = at == keys[left]
            out[left[hit]] = self.w[slot[hit]]
            on = ~hit & (at != -1)
            left, slot = left[on], slot[on]
        return out


def _log_p(found: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``g, w`` of the different 5-grams ``g``: ln p of the longest end of it that was seen, and the weights of the contexts before.

    A gram that has its ln p meets the further tables under a key of its own that
    is in none of them, so that no key gathers the grams that are done.
    """
    rows = found.select(F.col("g").alias("gram"), F.lit(None).cast("double").alias("got"), F.lit(0.0).alias("weight"))
    for k in range(ORDER, 0, -1):
        seen, ctx = model[k - 1]
        if k == 1:
            seen = F.broadcast(seen)  # a row a class
        if k <= 2:
            ctx = F.broadcast(ctx)  # a row a class, or one
        end = F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1))
        done, own = F.col("got").isNotNull(), -1 - F.col("gram")
        rows = rows.withColumn("g", F.when(done, own).otherwise(end)).join(seen, "g", "left").select("gram", F.coalesce("got", "w").alias("got"), "weight")
        rows = rows.withColumn("ctx", F.when(done, own).otherwise(F.shiftright(end, BITS))).join(ctx, "ctx", "left")
        rows = rows.select("gram", "got", (F.col("weight") + F.coalesce("v", F.lit(0.0))).alias("weight"))
    return rows.select(F.col("gram").alias("g"), (F.coalesce("got", F.lit(-math.log(CLASSES))) + F.col("weight")).cast("float").alias("w"))


def _pack(at: int):
    """Batches with the text column compressed (null stays null)."""

    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = [None if t is None else zip_.compress(t.encode()) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(texts, pa.binary()), *b.columns[at + 1 :]], names=b.schema.names)

    return run


def _unpack(column) -> list[str | None]:
    unzip = zstandard.ZstdDecompressor()
    return [None if t is None else unzip.decompress(t).decode() for t in column.to_pylist()]


def block_count(size: int, at_least: int) -> int:
    """Blocks that ``size`` bytes of text are dealt to."""
    return max(-(-size // BLOCK_BYTES), at_least)


def score(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]], lp: str, n: str) -> DataFrame:
    """The rows of ``docs`` with two more columns: ln p of the text, and the characters scored."""
    spark, at = docs.sparkSession, docs.columns.index("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = block_count(size, spark.sparkContext.defaultParallelism)
    block = _fresh(docs, "block")
    packed_schema = T.StructType([T.StructField(f.name, T.BinaryType() if i == at else f.dataType, True) for i, f in enumerate(docs.schema)])
    packed = docs.mapInArrow(lean(_pack(at)), packed_schema)
    # the task's number spreads rows that are equal in all
    dealt = F.pmod(F.xxhash64(*[c for c in ("doc_id", "text") if c in docs.columns], F.spark_partition_id()), F.lit(blocks))
    packed = packed.withColumn(block, dealt).repartition(blocks, block)

    def grams_of(batches):
        have = {}
        for b in batches:
            ids = b.column(b.num_columns - 1).to_numpy()
            for i in np.unique(ids).tolist():
                part, met = b.filter(pa.array(ids == i)), have.setdefault(i, Grams())
                for s in slices(part, at, TEXT_BYTES):
                    met.add(np.unique(grams(_unpack(s.column(at)))[0]))
        for number, met in have.items():
            g = met.all()
            for i in range(0, len(g), 1 << 16):
                part = g[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), number)), pa.array(part)], names=["of_block", "g"])

    # the blocks' grams are shuffled once: the aggregate needs both columns, so it reads the same exchange as the join
    found = packed.mapInArrow(lean(grams_of), "of_block long, g long").repartition("g")
    different = found.groupBy("g").agg(F.max("of_block").alias("some")).filter("some >= 0").select("g")
    known = found.join(_log_p(different, model), "g").select("of_block", "g", "w")
    out_schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema], T.StructField(lp, T.DoubleType()), T.StructField(n, T.LongType())])

    def scored(rows, words):
        table = Table(words.column("g").to_numpy(), words.column("w").to_numpy())
        kinds = [pa.field(f.name, pa.string()) if i == at else f for i, f in enumerate(rows.schema)][:-1]
        schema, out = pa.schema([*kinds, pa.field(lp, pa.float64()), pa.field(n, pa.int64())]), []
        for b in rows.to_batches():
            for part in slices(b, at, TEXT_BYTES):
                texts = _unpack(part.column(at))
                g, of = grams(texts)
                w = table.find(g)
                if np.isnan(w).any():
                    raise ValueError("a gram of this block has no probability: the block was dealt differently on a second reading")
                sums, seen = np.bincount(of, w, part.num_rows), np.bincount(of, minlength=part.num_rows)
                cols = [*part.columns[:at], pa.array(texts, pa.string()), *part.columns[at + 1 : -1], pa.array(sums, pa.float64()), pa.array(seen, pa.int64())]
                out.append(pa.RecordBatch.from_arrays(cols, schema=schema))
        release_memory()
        return pa.Table.from_batches(out, schema)

    return packed.groupBy(block).cogroup(known.groupBy("of_block")).applyInArrow(scored, out_schema)


def _fresh(docs: DataFrame, name: str) -> str:
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return name


def limits(held: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``lang, mid, top``: the median and the limit of each language; language null: over all."""
    loss = score(held, model, "lp", "n").filter("n > 0").select("lang", (-F.col("lp")).alias("loss"), "n")
    loss = stored(loss, "kn-held")
    both = loss.filter("lang is not null").unionByName(loss.withColumn("lang", F.lit(None).cast("string")))
    mid = stored(both.groupBy("lang").agg(F.percentile_approx(F.col("loss") / F.col("n"), 0.5, 10_000).alias("mid")), "kn-mid")
    drawn = both.join(mid, both["lang"].eqNullSafe(mid["lang"])).select(mid["lang"], "mid", ((F.col("loss") + PRIOR * F.col("mid")) / (F.col("n") + PRIOR)).alias("s"))
    return drawn.groupBy("lang", "mid").agg(F.percentile_approx("s", QUANTILE, 10_000).alias("q")).select("lang", "mid", F.greatest(F.col("q") + MARGIN * (F.col("q") - F.col("mid")), F.col("mid") + FLOOR).alias("top"))


def classify(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows of ``docs`` with three more columns: perplexity, the limit in the same unit, and ``keep``.

    Also the names of these columns (``perplexity``, ``limit``, ``keep``), which
    differ from their usual ones where ``docs`` has such a column already.
    """
    ship_package(docs.sparkSession)
    names = {k: _fresh(docs, k) for k in ("perplexity", "limit", "keep")}
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("low")).filter("low = 1 and doc_id is not null").select("doc_id")
    good = stored(good, "trusted")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD)) == 0
    text = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    model = train(only(text, good.filter(~held), "doc_id", "left_semi").select("text"))
    of = stored(limits(only(text, good.filter(held), "doc_id", "left_semi"), model), "kn-limits")
    lp, n, key, mid, top = (_fresh(docs, c) for c in ("lp", "n", "language", "mid", "top"))
    whole = of.filter("lang is null").first()
    scored = score(docs, model, lp, n)
    by_lang = of.filter("lang is not null").select(F.col("lang").alias(key), F.col("mid").alias(mid), F.col("top").alias(top))
    out = scored.join(by_lang, scored["lang"].cast("string") == F.col(key), "left")
    default = (F.lit(whole["mid"]), F.lit(whole["top"])) if whole else (F.lit(0.0), F.lit(float("inf")))
    m, t = F.coalesce(F.col(mid), default[0]), F.coalesce(F.col(top), default[1])
    drawn = (PRIOR * m - F.col(lp)) / (F.col(n) + PRIOR)
    out = out.withColumn(names["perplexity"], F.when(F.col(n) > 0, F.exp(-F.col(lp) / F.col(n)))).withColumn(names["limit"], F.exp(t)).withColumn(names["keep"], (F.col(n) == 0) | (drawn <= t))
    return out.select(*docs.columns, *names.values()), names
