"""Record linkage joins: semi-join reduction, code-list joins and full-outer
merges with coalesced keys."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Rows up to which a code list is broadcast.
CODE_ROWS = 50_000


# Bytes of a broadcast list of keys.
KEY_BYTES = 160 << 20
# Keys of a list; a list is searched from its start.
LIST_KEYS = 16


def semi_reduce(big: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``keys`` (a left-semi join: no fan-out).

    The keys are deduplicated first; the distinct is a partial aggregation,
    so a key repeated on many rows reaches the join as one row per map
    partition instead of making the build side as skewed as the data.

    ``big`` is not moved: its rows are wide, and their shuffle would be several times
    the input.  The keys are broadcast in lists of about ``LIST_KEYS`` by their hash,
    which takes a third of the space of a row a key.  They are counted first, so
    they had better be stored.  Beyond ``KEY_BYTES`` both sides are shuffled; the keys
    are hashed then, and ``big`` is not sorted: its wide rows would spill.
    """
    cols = [on] if isinstance(on, str) else list(on)
    ids = keys.select(*cols).distinct()
    if [big.schema[c].dataType for c in cols] == [ids.schema[c].dataType for c in cols]:
        ids = ids.filter(functools.reduce(operator.and_, [F.col(c).isNotNull() for c in cols]))
        length = functools.reduce(operator.add, [F.octet_length(F.col(c).cast("string")) + 16 for c in cols])
        found = ids.agg(F.count(F.lit(1)).alias("n"), F.sum(length + 8).alias("size")).first()
        if (found["size"] or 0) <= KEY_BYTES:
            key = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
            place = F.pmod(F.xxhash64(*cols), F.lit(max(1, found["n"] // LIST_KEYS)))
            lists = ids.groupBy(place.alias("_key_place")).agg(F.collect_list(key).alias("_key_list"))
            out = big.join(F.broadcast(lists), (place == F.col("_key_place")) & F.array_contains("_key_list", key), "left_semi")
            # the key first, as a join on it gives them
            return out if big.columns[: len(cols)] == cols else out.select(*cols, *[c for c in big.columns if c not in cols])
    return big.join(ids.hint("shuffle_hash"), on=on, how="left_semi")


def stem_ranges(c: str, stems: set[str]) -> Column:
    """The smallest range of each first letter that holds all stems of that letter."""
    by_letter: dict[str, list[str]] = {}
    for stem in sorted(stems):
        by_letter.setdefault(stem[:1], []).append(stem)
    return functools.reduce(operator.or_, [F.col(c).between(v[0], v[-1]) for v in by_letter.values()])


def code_join(
    df: DataFrame,
    codes: DataFrame,
    code3_col: str = "diagnosis_3char",
    code4_col: str = "diagnosis",
    list3_col: str = "diagnosis_3char",
    list4_col: str = "diagnosis_4char",
    stems: set[str] | None = None,
) -> DataFrame:
    """Inner join on ``df.code3 = list.3char OR df.code4 = list.4char``.

    A disjunctive condition would plan as a nested-loop join.  Instead every
    record carries its two candidate keys ('3:<code3>', '4:<code4>') through a
    ``explode`` and meets the code list, keyed the same way, in one
    equi-join: one pass over the records, and a record matching several
    code-list rows yields one row per match, exactly like the OR join.  Each
    code-list row must set exactly one of the two codes.  The list is broadcast
    if it has at most ``CODE_ROWS`` rows (the shipped ones have a few hundred).

    ``stems`` (the 3-character stems of all list codes, when ``code3`` is the
    first three characters of ``code4``) enables an early filter.
    """
    extra = [c for c in codes.columns if c not in (list3_col, list4_col)]
    if stems is not None:
        # a match on either code implies the record's 3-character stem is one
        # of the list's stems: drop everything else before the row-doubling
        # explode (a hashed IN filter, evaluated in the scan stage).  A long IN
        # list is not pushed into a Parquet scan, ranges by first letter are: they
        # skip the row groups of files that are clustered on the stem
        df = df.filter(stem_ranges(code3_col, stems)).filter(F.col(code3_col).isin(*sorted(stems)))
    key = F.when(F.col(list3_col).isNotNull(), F.concat(F.lit("3:"), F.col(list3_col))).otherwise(
        F.concat(F.lit("4:"), F.col(list4_col))
    )
    keyed = codes.select(key.alias("_code_key"), *extra)
    few = codes.limit(CODE_ROWS + 1).count() <= CODE_ROWS
    cand = F.array(F.concat(F.lit("3:"), F.col(code3_col)), F.concat(F.lit("4:"), F.col(code4_col)))
    return df.withColumn("_code_key", F.explode(cand)).join(F.broadcast(keyed) if few else keyed, "_code_key").drop("_code_key")


def full_merge(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN on ``keys`` with the keys coalesced (``USING`` semantics)."""
    return a.join(b, on=list(keys), how="full")
