"""Value cleaning, predicates over column templates, bands and ordinals."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def nullif_in(c: str | Column, values: Iterable) -> Column:
    """NULL when the value is one of ``values`` (missing codes), else unchanged."""
    c = as_col(c)
    return F.when(c.isin(*list(values)), F.lit(None)).otherwise(c)


def nullif_empty(c: str | Column) -> Column:
    return nullif_in(c, [""])


def clean_int(c: str | Column, missing: Iterable[str] = ("",)) -> Column:
    """Text -> INT with missing codes nulled; unparseable text -> NULL."""
    return nullif_in(c, missing).try_cast("int")


def in_range_or_null(c: str | Column, lo, hi) -> Column:
    c = as_col(c)
    return F.when(c.between(lo, hi), c)


def is_in(c: str | Column, values: Iterable) -> Column:
    """Membership that is never NULL (``%in%`` semantics)."""
    return F.coalesce(as_col(c).isin(*list(values)), F.lit(False))


def any_of(preds: Sequence[Column]) -> Column:
    """OR over a template of predicates, with NULL treated as false."""
    return F.coalesce(functools.reduce(operator.or_, preds), F.lit(False))


def flag(pred: Column) -> Column:
    """0/1 integer flag; NULL predicate -> 0 (``CASE WHEN p THEN 1 ELSE 0``)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def count_non_null(cols: Sequence[str | Column]) -> Column:
    return functools.reduce(operator.add, [as_col(c).isNotNull().cast("int") for c in cols])


def sum_na_rm(cols: Sequence[str | Column]) -> Column:
    """Row-wise sum skipping NULLs; all-NULL -> 0 (``rowSums(na.rm=TRUE)``)."""
    return functools.reduce(operator.add, [F.coalesce(as_col(c), F.lit(0)) for c in cols])


def ordinal_rank(c: str | Column, levels: Sequence[str]) -> Column:
    """1-based position of the value in ``levels``; absent or NULL -> NULL."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), as_col(c))
    return F.nullif(pos, F.lit(0)).cast("int")


def ordinal_label(rank: str | Column, levels: Sequence[str]) -> Column:
    """Inverse of ``ordinal_rank``."""
    r = as_col(rank)
    return F.when(r.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in levels]), r))


def decode(c: str | Column, mapping: dict, default=None) -> Column:
    """Literal map lookup as a CASE ladder (small code maps)."""
    c = as_col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def cut(c: str | Column, breaks: Sequence[float], right: bool = True) -> Column:
    """Bin like R ``cut``: labels '[a,b)' (left-closed) or '(a,b]' (right-closed).

    Values outside every bin -> NULL.  Infinite breaks print as ``Inf`` /
    ``-Inf``.
    """
    c = as_col(c)

    def fmt(x):
        if x == float("inf"):
            return "Inf"
        if x == float("-inf"):
            return "-Inf"
        return str(int(x)) if float(x).is_integer() else str(x)

    out = None
    for lo, hi in zip(breaks[:-1], breaks[1:]):
        if right:
            label = f"({fmt(lo)},{fmt(hi)}]"
            cond = (c > lo if lo != float("-inf") else F.lit(True)) & (c <= hi if hi != float("inf") else F.lit(True))
        else:
            label = f"[{fmt(lo)},{fmt(hi)})"
            cond = (c >= lo if lo != float("-inf") else F.lit(True)) & (c < hi if hi != float("inf") else F.lit(True))
        cond = c.isNotNull() & cond
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def suppress_small(c: str | Column, threshold: int = 10) -> Column:
    """Disclosure control: counts below ``threshold`` become '*', others text."""
    c = as_col(c)
    return F.when(c < threshold, F.lit("*")).otherwise(c.cast("string"))
