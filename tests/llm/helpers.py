"""Small frames and checks shared by the operator tests."""

import duckdb
import pandas as pd

from oracle_compare import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, sources=None, langs=None):
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    sources = sources or ["s"] * n
    langs = langs or ["en"] * n
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in zip(ids, texts, langs, sources)], DOCS)


def with_clashes(df, *names):
    """The same frame with extra columns of the names an operator uses itself."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df


def same_as_sql(spark, frame, sql, **tables):
    """Compare a frame with SQL over the given Spark tables."""
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"_{name}", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}")
    ok, message = compare(frame, sql, con)
    assert ok, message


def rows(df):
    return [tuple(r) for r in df.collect()]


__all__ = ["DOCS", "docs", "with_clashes", "same_as_sql", "rows", "pd"]
