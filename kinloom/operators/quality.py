"""Data-quality checks returned as DataFrames (so they run distributed and
can be written or asserted on by the caller)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (``n_rows``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when any key occurs more than once (a single aggregate job)."""
    n = duplicate_keys(df, keys).count()
    if n:
        raise AssertionError(f"{n} duplicated keys for {list(keys)}")


def count_where(df: DataFrame, cond) -> DataFrame:
    """One-row frame with the number of rows satisfying ``cond``."""
    return df.agg(F.count_if(cond).alias("n"))


def profile(df: DataFrame) -> DataFrame:
    """Export sidecar: one row per column, observation count on the first row only.

    The count is one aggregate row; the column names (schema metadata) are
    attached by exploding a literal array on that row, so no join is needed.
    """
    names = F.array(*[F.struct(F.lit(i + 1).alias("p"), F.lit(c).alias("n")) for i, c in enumerate(df.columns)])
    one = df.agg(F.count(F.lit(1)).alias("_n")).select(F.inline(names), "_n")
    return one.select(
        F.col("p").alias("col_position"),
        F.col("n").alias("col_names"),
        F.when(F.col("p") == 1, F.col("_n")).alias("observations"),
    )
