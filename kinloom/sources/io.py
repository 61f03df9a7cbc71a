"""Readers and writers.

Sources: Parquet (single dataset or hive-partitioned directory), CSV with a
header (a UTF-8 byte-order mark on the first column name is removed), JDBC
with partitioned reads, and small driver-side code lists.  Sinks: Parquet
(optionally partitioned), CSV, a metadata sidecar, and disclosure-controlled
count tables.  Writers return the output path; Spark raises on failure, so a
stage never continues past a failed write.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.values import suppress_small
from ..operators.quality import profile
from ..operators.reshape import union_all

#: Files that a task of ``write_partitioned(by_task=True)`` holds open; with more values it sorts its rows.
OPEN_FILES = 4

_BOM = "﻿"


# --------------------------------------------------------------------------- sources


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Hive-partitioned dataset (``key=value`` folders) with its declared schema,
    if given; filters on the partition column prune folders at planning time."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", path).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    renames = {c: c.lstrip(_BOM) for c in df.columns if c.startswith(_BOM)}
    return df.withColumnsRenamed(renames) if renames else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Relational source; with a partition column the read is split into
    ``num_partitions`` parallel range queries instead of one connection."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


# Dataset themes, the keyword of their table names, and names left out.
THEMES = {
    "hospital": ("episodes", ()),
    "registrations": ("civil|notifications", ()),
    "census": ("census", ()),
    "absence": ("absence", ()),
    "key_stages": ("ks[0-9]", ()),
}


def theme_tables(names: Iterable[str]) -> dict[str, list[str]]:
    """Table names by dataset theme."""
    names = list(names)
    return {theme: discover_tables(names, key, left_out) for theme, (key, left_out) in THEMES.items()}


def discover_tables(names: Iterable[str], theme: str, exclusions: Iterable[str] = ()) -> list[str]:
    """Table names matching a theme keyword (case-insensitive), minus exclusions.

    Raises ``ValueError`` on an empty theme; returns ``[]`` when nothing matches.
    """
    if not theme:
        raise ValueError("theme must be a non-empty keyword")
    pattern = re.compile(theme, re.IGNORECASE)
    excluded = {e.lower() for e in exclusions}
    return sorted(n for n in names if pattern.search(n) and n.lower() not in excluded)


def year_from_name(name: str) -> int:
    """The one year (1900 to 2099) in a yearly table's name."""
    years = set(re.findall(r"(?<!\d)(?:19|20)\d{2}(?!\d)", name))
    if len(years) != 1:
        raise ValueError(f"not one year in {name}")
    return int(years.pop())


def tables_by_year(names: Iterable[str]) -> dict[int, str]:
    """Table names by year; two tables of one year are an error."""
    out: dict[int, str] = {}
    for name in names:
        year = year_from_name(name)
        if out.setdefault(year, name) != name:
            raise ValueError(f"two tables of {year}: {out[year]}, {name}")
    return out


def catalog_tables(spark: SparkSession, theme: str, exclusions: Iterable[str] = ()) -> list[str]:
    return discover_tables([t.name for t in spark.catalog.listTables()], theme, exclusions)


def row_counts(views: Mapping[str, DataFrame], theme: str = ".", exclusions: Iterable[str] = ()) -> DataFrame:
    """(table_name, n_rows) for each view whose name matches ``theme``; each
    count is a distributed aggregate and the results are unioned."""
    names = discover_tables(views.keys(), theme, exclusions)
    parts = [views[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in names]
    if not parts:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], "table_name string, n_rows long")
    return union_all(parts)


# --------------------------------------------------------------------------- sinks


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_by: str | Sequence[str], mode: str = "overwrite",
                      sort_by: Sequence[str] = (), only_partitions: bool = False, by_task: bool = False) -> str:
    """Hive-partitioned Parquet.

    A ``rebalance`` hint clusters rows on the partition columns so each task
    writes few files per value, while AQE splits a partition value that is
    too large for one task (one reporting year can hold a large share of all
    rows) and coalesces small ones.  A plain ``repartition(col)`` would send a
    whole year to a single task.  ``sort_by`` orders the rows of each file, so
    that row-group statistics let a filter on it skip most of a file.
    ``only_partitions`` replaces the partitions that ``df`` has rows of and leaves
    the files of all others alone.

    ``by_task`` is for rows that lie together already, such as those made from yearly
    tables: each task writes its own rows, with up to ``OPEN_FILES`` files open, and
    nothing is shuffled or sorted.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    out = df if by_task else df.hint("rebalance", *cols)
    if sort_by:
        out = out.sortWithinPartitions(*cols, *sort_by)
    writer = out.write.mode(mode).partitionBy(*cols)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_partitions else "static")
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    if by_task and not sort_by:
        conf.set(key, str(OPEN_FILES))
    try:
        writer.parquet(path)
    finally:
        conf.set(key, before)
    return path


def write_code_list(codes: DataFrame, path: str) -> str:
    """A code list as one CSV file (the lists are small and fixed)."""
    codes.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_with_metadata(df: DataFrame, path: str) -> tuple[str, str]:
    """CSV export plus a sidecar listing the column names and row count."""
    data = write_csv(df, path)
    meta = write_csv(profile(df), path.rstrip("/") + "_metadata")
    return data, meta


def suppressed(df: DataFrame, count_col: str = "cnt", threshold: int = 10) -> DataFrame:
    """Counts below ``threshold`` replaced by '*' (others as text)."""
    return df.withColumn(count_col, suppress_small(count_col, threshold))


def write_suppressed_csv(df: DataFrame, directory: str, name: str, count_col: str = "cnt", threshold: int = 10,
                         date: _dt.date | None = None) -> str:
    """Disclosure-safe output, written under a date-prefixed name."""
    stamp = (date or _dt.date.today()).isoformat()
    return write_csv(suppressed(df, count_col, threshold), f"{directory.rstrip('/')}/{stamp}_{name}")
