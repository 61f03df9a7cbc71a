"""Sources found by name, declared columns, drift report, all yearly tables."""

import pytest
from pyspark.sql import functions as F

from kinloom.plans.pipeline import Pipeline, Stage, conform
from kinloom.plans import cohort_pipeline as CP
from kinloom.sources import fixtures as FX
from kinloom.sources import mappings as M
from kinloom.sources import schemas as S
from kinloom.sources.catalog import Catalog, catalog_sources, drift

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def catalog(spark):
    return FX.fixture_catalog(spark, SF)


def changed(catalog, name, change):
    return Catalog(catalog.names, lambda n: change(catalog.read(n)) if n == name else catalog.read(n))


def test_all_yearly_tables_are_found(catalog):
    assert sorted(catalog.yearly("census")) == list(range(2002, 2023))
    assert sorted(catalog.yearly("absence")) == [*range(2006, 2020), 2022]
    src = catalog_sources(catalog)
    assert sorted(src.census) == M.CENSUS_YEARS and len(src.absence) == 15
    assert all(list(src.census[y]().columns) == S.census_table(y).names for y in (2002, 2009, 2022))


def test_a_session_catalogue(spark):
    for name in ("apc_view_1999", "apc_view_2000", "my_census_2011"):
        spark.range(1).createOrReplaceTempView(name)
    found = Catalog.of_session(spark)
    assert found.yearly("census") == {2011: "my_census_2011"} and found.read("my_census_2011").count() == 1
    with pytest.raises(ValueError, match="one table expected"):
        found.single("ks1")
    for name in ("apc_view_1999", "apc_view_2000", "my_census_2011"):
        spark.catalog.dropTempView(name)


def test_a_dropped_column_fails_at_load(spark, catalog):
    src = catalog_sources(changed(catalog, "fx_census_2011", lambda df: df.drop("SENprovision_SPR11")))
    with pytest.raises(ValueError, match="fx_census_2011 is not as declared: SENprovision_SPR11 string \\(is missing\\)"):
        src.census[2011]()
    src = catalog_sources(changed(catalog, "fx_civil_deaths", lambda df: df.withColumn("REG_DATE_OF_DEATH", F.lit("x"))))
    with pytest.raises(ValueError, match="REG_DATE_OF_DEATH int \\(is string\\)"):
        src.civil_deaths()
    src = catalog_sources(changed(catalog, "fx_bridging", lambda df: df.withColumn("more", F.lit(1))))
    assert src.bridging().columns == S.SOURCES["bridging"].names


def test_a_stage_must_give_its_declared_columns(spark, tmp_path):
    stages = {"s": Stage(lambda: spark.range(2).selectExpr("id AS a"), (), schema=S._columns("l: a\ns: b"))}
    with pytest.raises(ValueError, match="b string"):
        Pipeline(spark, stages, workdir=str(tmp_path / "w")).get("s")
    assert conform(spark.range(1).selectExpr("id", "1 AS x"), S._columns("l: id")).columns == ["id"]


def test_every_written_stage_is_declared(spark, catalog):
    stages = CP.cohort_stages(spark, catalog_sources(catalog))
    written = {n for n, s in stages.items() if s.write}
    assert {n for n in written if stages[n].schema is None} == {"cohort"}  # checked by its parts and field lists
    run = Pipeline(spark, stages, on_bad="report")
    for name in ("summary", "birth_cohort", "cancer", "census", "sen_wide"):
        assert run.get(name).columns == S.STAGES[name].names


def test_drift_report(spark, catalog):
    small = Catalog(("fx_census_2010", "fx_census_2011", "fx_absence_2006"), catalog.read)
    got = {(r.year, r.column_name): (r.status, r.n_rows, r.n_filled) for r in drift(small, ["census", "absence"]).collect()}
    n = catalog.read("fx_census_2011")
    assert got[2011, "CensusTerm_SPR11"] == ("unexpected", n.count(), n.filter("CensusTerm_SPR11 IS NOT NULL").count())
    assert {s for (y, c), (s, _, _) in got.items() if y != 2011} == {"ok"}
    bad = changed(small, "fx_census_2010", lambda df: df.drop("MSOA_SPR10").withColumn("Gender_SPR10", F.lit(1)))
    got = {(r.year, r.column_name): (r.status, r.n_filled) for r in drift(bad, ["census"]).collect()}
    assert got[2010, "MSOA_SPR10"] == ("missing", None) and got[2010, "Gender_SPR10"][0] == "type"
