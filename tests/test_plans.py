"""Plan-shape checks over the registered queries, and fixture parity."""

import pytest

import __spark_entry__ as E
from kinloom.plans import queries as QM
from kinloom.sources import fixtures as FX
from oracle import sql as O
from oracle_compare import compare, duck_connect

SMOKE = "/root/testdata/sf0.001"
# queries that run their stages through the writing pipeline execute eagerly;
# their stages are covered by the single-stage queries below
STAGED = {"education_combined", "sen_absence_long", "sen_absence_wide", "cohort_assembled",
          "age_and_school_year_bands", "eligibility_flag", "suppressed_counts", "export_profile",
          "dq_duplicate_keys"}


@pytest.mark.parametrize("key", sorted(set(QM.QUERIES) - STAGED))
def test_no_nested_loop_or_cartesian(spark, key):
    df = E.queries()[key](spark, SMOKE)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, key


@pytest.mark.parametrize("view", ["fx_episodes", *FX.PERSON_VIEWS, "fx_census_2008", "fx_census_2013", "fx_absence_2009", "fx_ks2",
                                  "fx_ks4_a", "fx_ks5_b"])
def test_fixture_views_identical_in_both_engines(spark, view):
    df = FX.all_views(spark, SMOKE)[view]
    ok, msg = compare(df, O.build(view), duck_connect(SMOKE))
    assert ok, msg


_SPARK_T = {"string": "S", "int": "I", "bigint": "L", "double": "D", "date": "DATE", "boolean": "B"}
_DUCK_T = {"VARCHAR": "S", "INTEGER": "I", "BIGINT": "L", "DOUBLE": "D", "DATE": "DATE", "BOOLEAN": "B"}


@pytest.mark.parametrize("key", sorted(set(QM.QUERIES) - STAGED))
def test_column_types_match_oracle(spark, key):
    df = E.queries()[key](spark, SMOKE)
    got = {f.name: _SPARK_T.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rows = duck_connect(SMOKE).execute(f"DESCRIBE {E.oracle_sql()[key]}").fetchall()
    want = {r[0]: _DUCK_T.get(r[1], r[1]) for r in rows}
    assert got == want


def _logical(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def test_picks_need_no_join(spark):
    from kinloom.plans import birth_details as BD
    from kinloom.plans import education as ED

    src = FX.fixture_sources(spark, SMOKE)
    # spread over a stored copy so that only the operator's own plan counts
    ks5 = ED.ks5_best(*[spark.createDataFrame([], f().schema) for f in (src.ks5_a, src.ks5_b)])
    census = spark.createDataFrame([], ED.census_harmonised({y: f() for y, f in src.census.items()}).schema)
    infants = spark.createDataFrame([], QM.QUERIES["infant_records"](spark, SMOKE).schema)
    assert "Join" not in _logical(ks5)
    assert "Join" not in _logical(ED.sen_best_record(census))
    # one full join each: with the links, and of ethnicity with geography
    assert _logical(BD.birth_information(infants, spark.createDataFrame([], src.mother_baby_links().schema))).count("Join") <= 1
    assert _logical(BD.ethnicity_geo(infants)).count("Join") <= 1


def test_education_parts_meet_in_one_aggregate(spark):
    from kinloom.plans import education as ED

    year = {"census": "census_academic_year_start", "ks1": "ks1_academic_year_start", "ks2": "ks2_academic_year_start",
            "ks4": "ks4_academic_year_start", "ks5": "ks5_academic_year_start"}
    pupils = spark.createDataFrame([("a", 2000)], "dfe_id string, school_start_year int")
    parts = [spark.createDataFrame([("a", 2001)], f"dfe_id string, {c} int") for c in year.values()]
    assert "FullOuter" not in _logical(ED.education_combined(pupils, *parts))


def test_unmatched_keys_are_spread(spark):
    from pyspark.sql import functions as F

    from kinloom.plans.cohort import _spread

    df = spark.range(1000).selectExpr("CAST(NULL AS string) AS k", "CAST(id AS string) AS p")
    assert df.select(F.pmod(F.hash(_spread("k", "p")), F.lit(8)).alias("b")).groupBy("b").count().agg(F.max("count")).first()[0] < 250
