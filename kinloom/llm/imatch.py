"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose document frequency lies in a band of the
inverse document frequency.  A text of more than one row in ``1 / HEAVY`` counts
once there, by the row of its smallest id: at most ``1 / HEAVY`` texts are that
frequent, so their hashes are broadcast, and however many copies a text has they
do not lift its terms above the band.  Each of 16 randomised subsets of the lexicon is
nested by level: a term is in subset ``j`` at level ``l`` if the ``j``-th hash
of the term has ``l`` leading zero bits, so a level halves the subset.  A
document with ``n`` lexicon terms uses levels ``floor(log2 n)`` and the next
one, at which a subset holds about one of its terms; its fingerprint is the
hash of the sorted distinct terms it has in each subset at either level.  Two
fingerprints are compared at the levels they share: likeness is the share of
equal hashes among the subsets that are not empty in both.

Everything runs on built-in functions.  The lexicon is broadcast: with band
limit ``f`` it has at most (mean distinct terms of a document) / ``f`` terms,
and beyond ``LEXICON_ROWS`` an ordinary join is used.

Defined results: a null text is empty; without lexicon terms a fingerprint is the
hash of all distinct terms, after ``=``, alike (1) only to an equal one, and ``-``
for a text without terms; rows follow each other by descending
id, null ids last, rows of equal ids by their texts; a single row is its own
next; an empty table gives an empty table.  Other columns of the input are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Band of document frequency, as shares of all documents, and the least count.
BAND, LEAST = (0.001, 0.05), 2
SUBSETS, DIGITS = 16, 6
#: Share of all rows above which the rows of one text count once.
HEAVY = 1e-4
#: Terms up to which the lexicon is broadcast (about 200 bytes each).
LEXICON_ROWS = 400_000
#: Runs of documents by id for each shuffle partition.
RUNS = 4
NO_ID = -(1 << 63)


def _words(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"[\x20\x09-\x0D]+"))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``term, levels``: the terms in the band and the level up to which each is in each subset."""
    n = docs.count()
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    heavy = hashed.groupBy("h").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"))
    heavy = stored(heavy.filter(F.col("copies") > max(1, n * HEAVY)), "heavy")  # at most 1 / HEAVY rows
    once = hashed.join(F.broadcast(heavy), "h", "left").filter(F.col("copies").isNull() | F.col("doc_id").eqNullSafe(F.col("first")))
    rows = stored(once.groupBy().agg(F.count("*").alias("n")), "counted").first()["n"]
    low, high = max(LEAST, math.ceil(band[0] * rows)), max(LEAST, math.floor(band[1] * rows))
    df = once.select(F.explode(_words(F.col("text"))).alias("term")).filter("term <> ''").groupBy("term").agg(F.count("*").alias("df"))
    hashes = [F.md5(F.concat(F.lit(f"{i}:"), "term")) for i in range(SUBSETS // 4)]
    level = lambda j: (32 - F.length(F.bin(F.conv(F.substring(hashes[j // 4], 8 * (j % 4) + 1, 8), 16, 10).cast("long")))).cast("tinyint")
    return df.filter(F.col("df").between(low, high)).select("term", F.array(*[level(j) for j in range(SUBSETS)]).alias("levels"))


def fingerprints_of(found: DataFrame, names: list[str]) -> DataFrame:
    """Each named array of ``(term, levels)`` becomes ``level, low, high``: the subsets' hashes at the document's level and the next.

    One projection a step: an array is sorted once, and the sparser subsets are
    taken from the denser ones.
    """
    keep = [c for c in found.columns if c not in names]
    level = lambda n: F.when(F.size(n) > 0, F.floor(F.log2(F.size(n).cast("double"))).cast("int"))
    step = found.select(*keep, *[F.sort_array(n).alias(n) for n in names], *[level(n).alias(f"{n}_level") for n in names])
    within = lambda n, j: F.filter(n, lambda t: F.element_at(t["levels"], j + 1) >= F.col(f"{n}_level"))
    step = step.select(*keep, *[f"{n}_level" for n in names], *[F.array(*[within(n, j) for j in range(SUBSETS)]).alias(n) for n in names])

    def hashed(kept: Column) -> Column:
        return F.when(F.size(kept) > 0, F.substring(F.md5(F.array_join(F.transform(kept, lambda t: t["term"]), " ")), 1, DIGITS)).otherwise(F.lit("-"))

    def prints(n: str) -> Column:
        lev = F.col(f"{n}_level")
        low = F.transform(n, hashed)
        high = F.transform(n, lambda s, j: hashed(F.filter(s, lambda t: F.element_at(t["levels"], j + 1) > lev)))
        return F.when(lev.isNotNull(), F.struct(lev.alias("level"), low.alias("low"), high.alias("high"))).alias(n)

    return step.select(*keep, *[prints(n) for n in names])


def all_terms(text: Column) -> Column:
    """Hash of all distinct terms of a text; null without any."""
    terms = F.array_remove(_words(text), "")
    return F.when(F.size(terms) > 0, F.substring(F.md5(F.array_join(F.array_sort(terms), " ")), 1, 12))


def as_text(print_: Column, all_: Column) -> Column:
    joined = F.concat_ws(":", print_["level"].cast("string"), F.concat_ws("", print_["low"]), F.concat_ws("", print_["high"]))
    return F.coalesce(F.when(print_.isNotNull(), joined), F.concat(F.lit("="), all_), F.lit("-"))


def likeness(a: Column, b: Column, all_a: Column, all_b: Column) -> Column:
    """Share of equal hashes at the levels two fingerprints share; without lexicon terms, whether all terms are equal."""

    def share(x: Column, y: Column) -> Column:
        pairs = F.arrays_zip(x.alias("x"), y.alias("y"))
        some = F.size(F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-")))
        same = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != "-")))
        return F.when(some > 0, same / some).otherwise(F.lit(0.0))

    lev = a["level"] - b["level"]
    value = (
        F.when(lev == 0, (share(a["low"], b["low"]) + share(a["high"], b["high"])) / 2)
        .when(lev == 1, share(a["low"], b["high"]))
        .when(lev == -1, share(a["high"], b["low"]))
        .otherwise(F.lit(0.0))
    )
    return F.when(a.isNull() & b.isNull(), all_a.eqNullSafe(all_b).cast("double")).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(value)


def _search(values: list[int], x: Column) -> Column:
    """How many of the ascending values are at most ``x``, in two steps of about sqrt(n)."""
    step = max(1, math.isqrt(len(values)))
    rows = [values[i : i + step] for i in range(0, len(values), step)]
    full = F.size(F.filter(F.array(*[F.lit(r[-1]).cast("long") for r in rows]), lambda v: v <= x))
    inside = F.element_at(F.array(*[F.array(*[F.lit(v).cast("long") for v in r]) for r in rows]), F.least(full + 1, F.lit(len(rows))))
    rest = F.size(F.filter(inside, lambda v: v <= x))
    return F.when(full >= len(rows), F.lit(len(values))).otherwise(full * step + rest)


def in_order(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``run, pos, k, doc_id, text, next_text`` by descending id within runs of ids, and ``run, next_run``."""
    keyed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_runs = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RUNS
    cuts = keyed.agg(F.percentile_approx("k", [i / n_runs for i in range(1, n_runs)], 100 * n_runs)).first()[0] or []
    runs = keyed.withColumn("run", _search(sorted(set(cuts)), F.col("k")) if cuts else F.lit(0))
    heads = runs.groupBy("run").agg(F.max("k").alias("k"))
    order = Window.orderBy(F.col("run").desc())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = stored(heads.select("run", "k", F.coalesce(F.lead("run").over(order), F.first("run").over(whole)).alias("next_run"), F.coalesce(F.lead("k").over(order), F.first("k").over(whole)).alias("next_k")), "runs")
    # one text a run: the one that follows the run's last row
    starts = keyed.join(F.broadcast(following.select(F.col("next_k").alias("k"), "run")), "k").groupBy("run").agg(F.min("text").alias("start_text"))
    inside = Window.partitionBy("run").orderBy(F.col("k").desc(), "text")
    rows = runs.withColumn("pos", F.row_number().over(inside)).withColumn("next_text", F.lead("text").over(inside))
    rows = rows.join(starts, "run", "left").withColumn("last", F.col("next_text").isNull()).withColumn("next_text", F.coalesce("next_text", "start_text"))
    return rows.drop("start_text", "k"), following.select("run", "next_run")


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    terms = stored(lexicon(docs, band), "lexicon")
    if terms.count() <= LEXICON_ROWS:
        terms = F.broadcast(terms)
    rows, following = in_order(docs)
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cut)"), F.expr("substring(next_text, 1, cut)"))
    rows = rows.withColumn("cut", cut).withColumn("edited", edited)
    facts = rows.select("run", "pos", "last", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), all_terms(F.col("text")).alias("own_all"), all_terms(F.col("edited")).alias("new_all"))
    # the id goes along so that both branches read the texts by one and the same exchange
    each = rows.select("run", "pos", "doc_id", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("t"))
    each = each.select("run", "pos", "doc_id", "t.which", F.explode(_words(F.col("t.text"))).alias("term")).join(terms, "term")
    of = lambda w: F.collect_list(F.when(F.col("which") == w, F.struct("term", "levels")))
    found = each.groupBy("run", "pos", "doc_id").agg(of(0).alias("own"), of(1).alias("new"))
    found = fingerprints_of(found, ["own", "new"]).drop("doc_id")
    out = facts.join(found, ["run", "pos"], "left").join(F.broadcast(following), "run")
    out = out.select("run", "pos", F.when(F.col("last"), F.col("next_run")).otherwise(F.col("run")).alias("to_run"), F.when(F.col("last"), 1).otherwise(F.col("pos") + 1).alias("to_pos"), "doc_id", "n_chars", "edited_sha256", "own", "new", "own_all", "new_all")
    out = stored(out, "prints")
    after = out.select(F.col("run").alias("to_run"), F.col("pos").alias("to_pos"), F.col("own").alias("then"), F.col("own_all").alias("then_all"))
    return out.join(after, ["to_run", "to_pos"], "left").select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own"), F.col("own_all")).alias("fingerprint"), as_text(F.col("new"), F.col("new_all")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new"), F.col("own_all"), F.col("new_all")).alias("near_edited"),
        likeness(F.col("own"), F.col("then"), F.col("own_all"), F.col("then_all")).alias("near_next"),
    )
