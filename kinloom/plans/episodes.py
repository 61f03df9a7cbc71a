"""Hospital episodes: yearly extracts as one table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import union_all
from ..sources.mappings import EPISODE_RENAMES


def episodes_harmonised(tables: Mapping[int, DataFrame] | DataFrame) -> DataFrame:
    """Yearly extracts (by reporting year) -> one table with the raw names of
    the baby-tail fields replaced and the year as ``reporting_year_start``.
    A field that a year's extract lacks is NULL there.

    Extracts of one layout may come as one table with ``reporting_year_start``, such as
    a folder stored by year: that is one scan, and a plan of the size of one year."""
    if isinstance(tables, DataFrame):
        renames = {raw: target for raw, target in EPISODE_RENAMES if raw in tables.columns}
        return tables.withColumnsRenamed(renames)
    parts = []
    for year, df in sorted(tables.items()):
        renames = {raw: target for raw, target in EPISODE_RENAMES if raw in df.columns}
        parts.append(df.withColumnsRenamed(renames).withColumn("reporting_year_start", F.lit(year)))
    return union_all(parts)
