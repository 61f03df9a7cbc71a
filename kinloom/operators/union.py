"""Unions by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name; columns absent in a part become NULL.

    Halves are joined pairwise: Spark analyses a plan at every step, so a chain of
    many parts would be analysed again and again."""
    dfs = list(dfs)
    while len(dfs) > 1:
        dfs = [dfs[i].unionByName(dfs[i + 1], allowMissingColumns=allow_missing) if i + 1 < len(dfs) else dfs[i]
               for i in range(0, len(dfs), 2)]
    return dfs[0]
