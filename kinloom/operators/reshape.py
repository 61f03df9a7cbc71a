"""Wide <-> long reshaping and schema-harmonising unions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .select import keep_first
from .union import union_all  # noqa: F401


def unpivot_positions(
    df: DataFrame,
    ids: Sequence[str],
    cols: Sequence[str],
    position_col: str,
    value_col: str,
) -> DataFrame:
    """Wide-to-long in one scan (Spark ``Expand``), with the 1-based position of
    the source column in ``cols`` instead of its name."""
    long = df.unpivot(list(ids), list(cols), "_src", value_col)
    pos = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("_src")).cast("int")
    return long.withColumn(position_col, pos).drop("_src")


def _one_row_a_cell(df: DataFrame, keys: Sequence[str], slot_col: str, slots: Sequence, values: Sequence[str],
                    on_duplicate: str) -> DataFrame:
    if on_duplicate == "fail":
        bad = df.groupBy(*keys, slot_col).agg(F.count(F.lit(1)).alias("_n"))
        bad = bad.filter((F.col("_n") > 1) | ~F.coalesce(F.col(slot_col).isin(*slots), F.lit(False)))
        if n := bad.count():
            raise ValueError(f"{n} cells of {[*keys, slot_col]} are filled twice or lie outside the slots")
    elif on_duplicate == "first":
        df = keep_first(df, [*keys, slot_col], list(values))
    elif on_duplicate != "unique":
        raise ValueError(f"on_duplicate: {on_duplicate}")
    return df


def pivot_slots(
    df: DataFrame,
    keys: Sequence[str],
    slot_col: str,
    slots: Sequence,
    values: dict[str, str],
    name: Callable[[str, object], str],
    on_duplicate: str = "fail",
) -> DataFrame:
    """Long -> wide with explicit slot values (fixed schema).

    ``values`` maps output stem -> source column.  A cell is one row: with
    ``on_duplicate="fail"`` two rows for a cell, or a slot outside ``slots``,
    raise (one aggregate job); with ``"first"`` the cell takes the whole row that
    comes first in the order of all value columns, never columns of several;
    ``"unique"`` states that the caller has numbered the rows of a key.
    Missing cells are NULL.  Output column names come from ``name(stem, slot)``.
    """
    df = _one_row_a_cell(df, keys, slot_col, slots, list(values.values()), on_duplicate)
    aggs = [F.max(F.col(src)).alias(stem) for stem, src in values.items()]
    wide = df.groupBy(*keys).pivot(slot_col, list(slots)).agg(*aggs)
    renames = {}
    for s in slots:
        for stem in values:
            src = f"{s}_{stem}" if len(values) > 1 else f"{s}"
            renames[src] = name(stem, s)
    return wide.withColumnsRenamed(renames)


def pivot_arrays(
    df: DataFrame,
    keys: Sequence[str],
    slot_col: str,
    slots: Sequence,
    values: Sequence[str],
    name: Callable[[str, object], str],
    on_duplicate: str = "fail",
) -> DataFrame:
    """``pivot_slots`` for many value columns: one aggregate gathers a key's cells,
    at most one for each slot, and each output column reads its cell by slot.

    ``pivot_slots`` keeps a buffer for each slot and value; with hundreds of them
    Spark sorts the rows instead of hashing the keys.  ``on_duplicate`` as there,
    which bounds the gathered cells by the number of slots."""
    cells = _one_row_a_cell(df, keys, slot_col, slots, values, on_duplicate).filter(F.col(slot_col).isin(*slots))
    number = F.array_position(F.array(*[F.lit(s) for s in slots]), F.col(slot_col)).cast("int")
    wide = cells.groupBy(*keys).agg(F.collect_list(F.struct(number.alias("slot"), F.struct(*values).alias("cell"))).alias("_cells"))
    at = F.map_from_entries("_cells")
    row = wide.select(*keys, F.transform(F.sequence(F.lit(1), F.lit(len(slots))), lambda i: F.element_at(at, i)).alias("_row"))
    return row.selectExpr(*[f"`{k}`" for k in keys], *[f"_row[{i}].`{v}` AS `{name(v, s)}`" for i, s in enumerate(slots) for v in values])


def harmonise(df: DataFrame, mapping: dict[str, str | int | None], types: dict[str, str] | None = None) -> DataFrame:
    """Select ``source AS target`` for each target; a number is a literal, ``None`` a typed NULL.

    Text that cannot be cast is NULL (``sources.casts`` counts it)."""
    types = types or {}
    # SQL text: one call to the JVM a table instead of several a column
    cols = []
    for target, source in mapping.items():
        value = f"`{source}`" if isinstance(source, str) else "NULL" if source is None else str(source)
        cols.append(f"try_cast({value} AS {types.get(target, 'string')}) AS `{target}`")
    return df.selectExpr(*cols)
