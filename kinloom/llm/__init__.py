"""Operators for training-data pipelines.

One module per operator; ``queries.py`` registers them over the given tables
and ``sql.py`` holds the DuckDB formulation where SQL can express one.  Nothing
outside this package imports it.
"""
