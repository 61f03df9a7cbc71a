"""kinloom: longitudinal, record-linked cohort building on Spark DataFrames.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
is built from built-in Spark expressions, so Catalyst plans the whole chain
(filter/column pushdown into Parquet, partial aggregation, AQE joins).

Layout
------
functions/  column-level helpers: sentinel dates, month arithmetic, bands, codes
operators/  DataFrame-level building blocks: keep_first, code_join, unpivot, pivot
sources/    readers and writers, and the deterministic fixture views
plans/      the cohort stages (one module per stage) and the pipeline runner
"""

__version__ = "0.1.0"
