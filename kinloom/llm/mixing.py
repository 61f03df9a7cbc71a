"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots.  Slot ``k`` maps the golden-ratio point
``frac((k + 1/2) * phi)`` through the sources' cumulative shares to a source;
the slots are ranked per source, and the slot of rank ``r`` takes block
``r mod n`` of the source's ``n`` blocks.  Blocks hold equally many words of
the source's documents in a shuffled (hashed) order.  A source whose slots have
met its target lets further slots pass, one that is short after the last point
gets the rest at the end, and a source's last slot takes only the words that are
still missing; so every source meets its target to the word.

``slots`` gives the sequence itself, ``pieces`` the words of each document that a
slot takes, ``mix`` sums them up by document, and ``mixed`` emits whole documents:
those whose words are all taken, in whole rounds of their source and in its last,
partial round, and for the words that are then missing the document of the
nearest size, if that brings the source nearer to its target or it had none.

Ranks and word positions are prefix sums in two levels (square-root sized
chunks, then rows of a chunk), so that no task holds a whole source.  The order
key is the hash of id and size, so rows without an id are spread like others.

Defined results: a null text has size 0; a document of size 0 is taken 0 times;
null sources are one source, ordered last; every input row yields one output
row and rows of equal ids count on their own; an empty table gives an empty
table; long texts are only counted.  Other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

#: Words of a block.
BLOCK_WORDS = 256
#: Cells of the unit interval by which slots and sources meet.
CELLS = 4096
PHI = (math.sqrt(5) - 1) / 2


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """``source, sid, source_size, target`` from one row ``source, source_size`` a source.

    The total is shared by weight; a source stops at ``cap`` times its size and
    its excess is shared again among the rest.  With the sources by the level at
    which they stop, the first that stays below gives the level of all that do.
    One row a source is all that the ordered windows hold.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("w", w)
    limit = F.col("source_size").cast("double") * cap
    whole = Window.orderBy(F.col("stop"), F.col("sid"))
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    everything = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("limit", limit).withColumn("stop", limit / F.col("w"))
    rest = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    level = rest / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    rows = rows.withColumn("level", F.min(F.when(F.col("stop") >= F.col("level"), F.struct("stop", "sid", "level"))).over(everything)["level"])
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("w"), F.col("limit")))
    return rows.select("source", "sid", "source_size", target.alias("target"))


def _plan(shares: DataFrame, block_words: int) -> DataFrame:
    """Blocks, words wanted and slots of each source."""
    want = F.round("target").cast("long")
    return (
        shares.filter("source_size > 0")
        .withColumn("want", want)
        .withColumn("n_blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("rest", F.col("want") % F.col("source_size"))
        .withColumn("slots", F.expr("want div source_size") * F.col("n_blocks") + F.ceil(F.col("rest") / block_words).cast("long"))
    )


def _points(first: int, n: int, spark, phi: float) -> DataFrame:
    """``k, x``: slot numbers and their points."""
    high = (phi * (1 << 20)) % 1.0  # with it the point of a large slot number keeps its digits
    x = ((F.col("k") % (1 << 20) + 0.5) * phi + F.expr(f"k div {1 << 20}") * high) % 1.0
    return spark.range(first, first + n).withColumnRenamed("id", "k").withColumn("x", x)


def schedule(plan: DataFrame, n_slots: int, block_words: int = BLOCK_WORDS, phi: float = PHI) -> DataFrame:
    """``slot, sid, block, words``: which block each slot takes, and how many of its first words at most."""
    share = F.sum("slots").over(Window.orderBy("sid"))
    ranges = plan.select("sid", "slots", ((share - F.col("slots")) / n_slots).alias("lo"), (share / n_slots).alias("hi"))
    cells = ranges.filter("slots > 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.floor(F.col("hi") * CELLS).cast("int"), F.lit(CELLS - 1)))))
    chunk = max(1, math.isqrt(n_slots))
    slots = _points(0, n_slots, plan.sparkSession, phi).withColumn("cell", F.least(F.floor(F.col("x") * CELLS), F.lit(CELLS - 1)).cast("int"))
    slots = slots.join(cells.select("sid", "cell", "lo", "hi"), "cell").filter("x >= lo and x < hi").select("k", "sid", F.expr(f"k div {chunk}").alias("chunk"))
    counts = slots.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("sid", "chunk", (F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("k")) - 1
    ranked = slots.withColumn("inside", inside).join(before, ["sid", "chunk"]).select("sid", "k", (F.col("before") + F.col("inside")).alias("r"))
    held = counts.groupBy("sid").agg(F.sum("n").alias("held"))
    short = plan.join(held, "sid", "left").select("sid", "slots", F.coalesce("held", F.lit(0)).alias("held")).filter("held < slots")
    lacking = F.sum(F.col("slots") - F.col("held")).over(Window.orderBy("sid"))
    late = short.withColumn("from", lacking - (F.col("slots") - F.col("held")) - F.col("held") + n_slots)
    late = late.select("sid", "from", F.explode(F.expr("sequence(held, slots - 1)")).alias("r"))
    ranked = ranked.unionByName(late.select("sid", (F.col("from") + F.col("r")).alias("k"), "r"))
    taken = ranked.join(plan.select("sid", "n_blocks", "slots", "rest"), "sid").filter("r < slots")
    cut = (F.col("r") == F.col("slots") - 1) & (F.col("rest") % block_words > 0)
    return taken.select(F.col("k").alias("slot"), "sid", (F.col("r") % F.col("n_blocks")).alias("block"), F.when(cut, F.col("rest") % block_words).otherwise(block_words).alias("words"))


class Mix:
    """The mix of some documents: ``shares`` by source, ``slots``, ``pieces`` and sums ``by_row``."""

    def __init__(self, docs: DataFrame, row: Column, weights: tuple[float, ...], cap: int, block_words: int, phi: float):
        sized = stored(docs.select(row.cast("long").alias("row"), "doc_id", "source", word_count(F.col("text").cast("string")).alias("size")), "sizes")
        self.shares = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "shares")
        plan = _plan(self.shares, block_words)
        n_slots, n_docs = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0], sized.count()
        key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
        bucket = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / (1 << 32) * max(1, math.isqrt(n_docs))).cast("int")
        shares = self.shares.withColumnRenamed("source", "of")
        rows = sized.join(shares, F.col("source").eqNullSafe(F.col("of"))).select("row", "doc_id", "size", "sid", "source_size", "target", key.alias("h")).withColumn("bucket", bucket)
        sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
        before = sums.select("sid", "bucket", (F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n")).alias("before"))
        order = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
        placed = rows.withColumn("inside", F.sum("size").over(order) - F.col("size")).join(before, ["sid", "bucket"]).withColumn("pos", F.col("before") + F.col("inside"))
        #: Each row's place in its source's sequence of words.
        self.placed = stored(placed.select("row", "doc_id", "size", "sid", "source_size", "target", "pos"), "placed")
        whole = self.placed.filter("size > 0")
        cuts = whole.withColumn("block", F.explode(F.expr(f"sequence(pos div {block_words}, (pos + size - 1) div {block_words})")))
        self.slots = stored(schedule(plan, n_slots, block_words, phi), "slots") if n_slots else None
        if n_slots:
            at = F.col("block") * block_words
            first, last = F.greatest(F.col("pos"), at), F.least(F.col("pos") + F.col("size"), at + F.col("words"))
            pieces = cuts.join(self.slots, ["sid", "block"]).withColumn("n", last - first).filter("n > 0")
            #: Which words of a row a slot takes: ``n`` words from ``first`` on.
            self.pieces = pieces.select("slot", "row", "doc_id", (first - F.col("pos")).alias("first"), "n")

    def by_row(self) -> DataFrame:
        keep = ["row", "doc_id", "size", "source_size", "target"]
        if self.slots is None:
            return self.placed.select(*keep, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot"))
        sums = self.pieces.groupBy(F.col("row").alias("of")).agg(F.sum("n").alias("taken"), F.min("slot").alias("first_slot"))
        joined = self.placed.join(sums, F.col("row") == F.col("of"), "left")
        return joined.select(*keep, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")

    def whole(self) -> DataFrame:
        """``row, times, slot``: how often each row is emitted, if at all, and its first slot."""
        taken = self.by_row().filter("size > 0").select(F.col("row").alias("of"), "taken", "first_slot")
        want = F.round("target").cast("long")
        rows = self.placed.filter("size > 0").join(taken, F.col("row") == F.col("of"))
        # how often the slots take the row's words to the last one
        rows = rows.withColumn("want", want).withColumn("whole", F.expr("taken div size")).withColumn("rounds", F.expr("want div source_size"))
        rows = rows.withColumn("inside", F.col("whole") > F.col("rounds"))
        rows = stored(rows.select("row", "size", "sid", "source_size", "pos", "want", "whole", "rounds", "inside", "first_slot"), "whole")
        covered = rows.groupBy("sid").agg(F.max(F.when(F.col("inside"), F.col("pos") + F.col("size"))).alias("covered"))
        missing = F.expr("want % source_size") - F.coalesce("covered", F.lit(0))
        outside = rows.filter(~F.col("inside")).join(covered, "sid").withColumn("missing", missing).filter("missing > 0")
        gap = F.abs(F.col("size") - F.col("missing"))
        nearest = outside.groupBy("sid").agg(F.min(F.struct(gap.alias("gap"), "pos", "row", "missing", "rounds", "covered")).alias("best"))
        useful = (F.col("best.gap") < F.col("best.missing")) | (F.col("best.rounds") == 0) & F.col("best.covered").isNull()
        extra = nearest.filter(useful).select(F.col("best.row").alias("row"), F.lit(1).alias("more"))
        times = (F.col("whole") + F.coalesce("more", F.lit(0))).cast("int").alias("times")
        return rows.join(extra, "row", "left").select("row", times, F.col("first_slot").alias("slot")).filter("times > 0")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, block_words: int = BLOCK_WORDS, phi: float = PHI) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_slot`` for every row; ``first_slot``: of those that take it, null if none does."""
    return Mix(docs, F.monotonically_increasing_id(), weights, cap, block_words, phi).by_row().drop("row")


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, block_words: int = BLOCK_WORDS, phi: float = PHI, in_order: bool = False) -> DataFrame:
    """The rows of ``docs`` that the mix takes, whole and as often as it does, each source to within one document.

    Every row counts on its own, also without an id or with that of another;
    rows without words are not taken.  ``in_order`` sorts them by their first slot,
    so that sources interleave by the schedule; it shuffles the texts once more.
    """
    key, times, slot = (_fresh(docs, c) for c in ("row", "times", "slot"))
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = Mix(rows, F.col(key), weights, cap, block_words, phi).whole().withColumnsRenamed({"row": key, "times": times, "slot": slot})
    # the texts are hashed to their numbers and not sorted: these are the small side of each task
    out = rows.join(stored(found, "times").hint("shuffle_hash"), key)
    out = out.orderBy(slot, key) if in_order else out
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def _fresh(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
