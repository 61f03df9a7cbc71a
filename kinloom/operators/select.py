"""Record selection per group: first/best/nearest/latest record, top-k slots.

``keep_first`` / ``top_k`` are ``row_number() <= k`` over a window.  Spark
plans that pattern as a *WindowGroupLimit*: a partial per-group limit runs on
the map side before the shuffle, so even a group holding a third of all rows
reaches the reducer as at most ``k`` rows per map partition.  Every sort key
states its NULL placement, and callers add a unique tie-break so results are
deterministic.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_col
from .union import union_all

OrderKey = Column | str


def _order(order: Sequence[OrderKey]) -> list[Column]:
    # a bare name means ascending with NULLs last
    return [as_col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def rank_within(keys: Sequence[str], order: Sequence[OrderKey]) -> Column:
    """``row_number()`` per ``keys`` in ``order`` (1-based)."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order)))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey], k: int, rank_col: str = "_rank") -> DataFrame:
    """The first ``k`` rows of each group, with their rank in ``rank_col``."""
    return df.withColumn(rank_col, rank_within(keys, order)).filter(F.col(rank_col) <= k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey]) -> DataFrame:
    """One row per group: the first in ``order``."""
    return top_k(df, keys, order, 1, "_rank").drop("_rank")


def first_value_by(value: Column | str, order: Sequence[Column], where: Column | None = None) -> Column:
    """Aggregate: ``value`` of the row that sorts first by ``order`` (ascending,
    NULLs last) among rows where ``where`` holds; NULL if none.

    A partial-aggregating replacement for "min(order) per group, then join
    back for the value": ``min_by`` over a struct key whose NULL flags sort
    missing values last.
    """
    parts = []
    for o in order:
        parts += [o.isNull(), o]
    key = F.struct(*parts)
    if where is not None:
        key = F.when(where, key)
    return F.min_by(as_col(value), key)


def asof_latest(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, Column]],
    on: Sequence[str],
    left_time: str,
    tie_break: Sequence[Callable[[str], Column]] = (),
) -> DataFrame:
    """Backward as-of pick from several sides at once: for each left row, of each
    right side the row with the latest time not after ``left_time``, as struct
    ``_r<i>`` (NULL if none).  ``on`` and ``left_time`` tell left rows apart.

    No join meets keys alone, so nothing fans out: every right side is first cut
    to one row a key and time (its first by ``tie_break``, applied to all of its
    columns in order), then all sides and the left rows are sorted together by
    time, and the last record of each side is carried forward.  What meets in one
    task are a key's distinct times.  Rows without a key or a time match nothing.
    """
    keyed = [F.col(k).isNotNull() for k in on]
    parts = []
    for i, (df, time) in enumerate(rights):
        own = df.withColumn("_t", time).filter(functools.reduce(operator.and_, [*keyed, F.col("_t").isNotNull()]))
        order = [f(c) for f in tie_break for c in df.columns]
        one = keep_first(own, [*on, "_t"], order) if order else own.dropDuplicates([*on, "_t"])
        parts.append(one.select(*on, "_t", F.struct(*[c for c in df.columns if c not in on]).alias(f"_r{i}")))
    # at equal times the left row comes last
    parts.append(left.select(*on, F.col(left_time).alias("_t"), F.lit(True).alias("_left")).filter(
        functools.reduce(operator.and_, [*keyed, F.col("_t").isNotNull()])).distinct())
    rows = union_all(parts)
    so_far = Window.partitionBy(*on).orderBy(F.col("_t"), F.col("_left").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = rows.select(*on, "_t", "_left", *[F.last(f"_r{i}", ignorenulls=True).over(so_far).alias(f"_r{i}")
                                                for i in range(len(rights))])
    return carried.filter("_left").drop("_left").withColumnRenamed("_t", left_time)


def rank_skew_safe(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank_col: str) -> DataFrame:
    """``row_number()`` per ``keys`` in ``order`` (columns, ascending, NULLs last)
    without putting a whole group in one task.

    A plain window sends every row of a group to one task, so a group holding a
    large share of the data is sorted by a single executor.  Here a group is cut
    into slices of equal values of its first two order columns (of two columns, of
    the first one).  A row is numbered
    within its slice, after the rows of earlier slices; these are prefix sums, at
    two levels, over the counts of the slices, which are aggregated map-side.  The
    slices are values and not sampled, so the plan needs no stored copy of the rows
    and a repeated task sees the same ones.  What meets in one task is a slice, the
    distinct first values of a group, or the second ones of a first value.
    ``order`` must be a total order (end it with a unique column) for the rank to be
    unique.
    """
    slices, rest = list(order[:-1][:2]), order[len(order[:-1][:2]):]
    if not slices:
        raise ValueError("rank_skew_safe needs two order columns or more")
    by_slice = [*keys, *slices]
    n = df.groupBy(*by_slice).agg(F.count(F.lit(1)).alias("_n"))

    def before(rows: DataFrame, within: Sequence[str], by: str) -> Column:
        window = Window.partitionBy(*within).orderBy(F.col(by).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    first = slices[0]
    outer = n.groupBy(*keys, first).agg(F.sum("_n").alias("_n"))
    outer = outer.select(*keys, first, before(outer, keys, first).alias("_outer"))
    inner = n.withColumn("_inner", before(n, [*keys, first], slices[1]) if len(slices) > 1 else F.lit(0))
    offsets = _join_null_safe(inner, outer, [*keys, first]).select(*by_slice, (F.col("_inner") + F.col("_outer")).alias("_offset"))
    out = _join_null_safe(df, offsets, by_slice)
    number = F.row_number().over(Window.partitionBy(*by_slice).orderBy(*_order(rest)))
    return out.withColumn(rank_col, (F.col("_offset") + number).cast("int")).drop("_offset")


def _join_null_safe(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``a`` with the other columns of ``b``; NULL keys match."""
    renamed = b.withColumnsRenamed({c: f"_on_{c}" for c in on})
    cond = functools.reduce(operator.and_, [a[c].eqNullSafe(renamed[f"_on_{c}"]) for c in on])
    return a.join(renamed, cond).drop(*[f"_on_{c}" for c in on])
