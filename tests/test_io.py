"""Readers and writers round-trip through a scratch folder."""

import datetime as dt
import os

import pytest

from kinloom.sources import io as IO


def test_parquet_partitioned_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 2001, 1), ("b", 2002, 5)], "k string, reporting_year_start int, cnt long")
    p = IO.write_parquet(df, str(tmp_path / "plain"))
    assert IO.read_parquet(spark, p).count() == 2
    part = IO.write_partitioned(df, str(tmp_path / "part"), "reporting_year_start")
    assert {"reporting_year_start=2001", "reporting_year_start=2002"} <= set(os.listdir(part))
    back = IO.read_partitioned(spark, part)
    assert back.filter("reporting_year_start = 2002").count() == 1
    out = IO.write_suppressed_csv(df, str(tmp_path), "counts", date=dt.date(2025, 1, 2))
    assert out.endswith("2025-01-02_counts")
    assert sorted(r.cnt for r in IO.read_csv(spark, out).collect()) == ["*", "*"]
    data, meta = IO.write_with_metadata(df, str(tmp_path / "export"))
    rows = sorted(IO.read_csv(spark, meta).collect(), key=lambda r: int(r.col_position))
    assert [r.col_names for r in rows] == ["k", "reporting_year_start", "cnt"] and rows[0].observations == "2"


def test_csv_bom_header_is_stripped(spark, tmp_path):
    f = tmp_path / "map.csv"
    f.write_text("﻿abs_2012,col_target\nAcademicYear,abs_academic_year\n", encoding="utf-8")
    df = IO.read_csv(spark, str(f))
    assert df.columns == ["abs_2012", "col_target"]


def test_discover_tables():
    names = ["hes_apc_2001", "HES_APC_2002", "deaths_2001", "census"]
    assert IO.discover_tables(names, "hes_apc", exclusions=["hes_apc_2001"]) == ["HES_APC_2002"]
    assert IO.discover_tables(names, "nothing") == []
    with pytest.raises(ValueError):
        IO.discover_tables(names, "")


def test_theme_tables_and_empty_counts(spark):
    themes = IO.theme_tables(["fx_episodes", "fx_mb_links", "fx_ks2", "fx_census_02", "fx_civil_births"])
    assert themes["key_stages"] == ["fx_ks2"] and themes["hospital"] == ["fx_episodes"]
    assert IO.row_counts({"a": spark.range(3)}, "b").collect() == []
    assert [tuple(r) for r in IO.row_counts({"a": spark.range(3)}, "a").collect()] == [("a", 3)]


def test_code_list_export(spark, tmp_path):
    from kinloom.functions import codes as C

    path = IO.write_code_list(C.cancer_codes(spark), str(tmp_path / "codes"))
    assert spark.read.option("header", True).csv(path).count() == 117


def test_catalog_tables(spark):
    spark.range(1).createOrReplaceTempView("apc_1999_view")
    assert IO.catalog_tables(spark, "apc_") == ["apc_1999_view"]
    assert IO.catalog_tables(spark, "apc_", exclusions=["APC_1999_VIEW"]) == []
    spark.catalog.dropTempView("apc_1999_view")
