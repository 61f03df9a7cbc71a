"""Stage semantics on hand-written micro fixtures (each names the rule it pins)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from kinloom.functions import codes as C
from kinloom.plans import birth_cohort as BC
from kinloom.plans import cohort as CO
from kinloom.plans import first_diagnosis as FD
from kinloom.plans.diagnoses import diagnoses_long
from kinloom.plans.registrations import id_lookup, registrations_summary
from kinloom.sources.fixtures import EPISODE_COLUMNS


def episodes(spark, rows):
    """Episode records with every raw column; unspecified fields are NULL."""
    base = {c: None for c in EPISODE_COLUMNS}
    base.update({"epistat": "3", "reporting_year_start": 2010, "mydob": "032010"})
    data = [tuple({**base, **r}[c] for c in EPISODE_COLUMNS) for r in rows]
    schema = ", ".join(f"{c} {'int' if c == 'reporting_year_start' else 'string'}" for c in EPISODE_COLUMNS)
    return spark.createDataFrame(data, schema)


def test_registrations_deaths_only_and_year_only(spark):
    births = spark.createDataFrame([("P1", "2010-03-05", "1", "0"), (None, "", "2", "1")],
                                   "TOKEN_PERSON_ID string, DOREG string, SEX_CHILD string, STILLBIRTH_IND string")
    deaths = spark.createDataFrame([("P2", 20120000)], "TOKEN_PERSON_ID string, REG_DATE_OF_DEATH int")
    out = {r.token_person_id: r for r in registrations_summary(births, deaths).collect()}
    # deaths-only person: counts default to 0, which later satisfies the live-registration override
    assert out["P2"].birth_records == 0 and out["P2"].birth_stillbirth_records == 0
    assert out["P2"].death_date == dt.date(2012, 1, 1) and out["P2"].death_date_year_precision_only == 1
    assert out[None].birth_records == 1  # registrations without a person id stay a group of their own


def test_id_lookup_missing_id_sorts_first(spark):
    br = spark.createDataFrame([("D2", "P1"), ("D1", "P1"), (None, "P2"), ("D3", "P2"), ("D4", "P3")],
                               "PUPIL_REF_MATCHING_ANONYMOUS string, pseudo string")
    out = {r.nhs_id: (r.dfe_id, r.dfe_id_problematic) for r in id_lookup(br).collect()}
    assert out == {"P1": ("D1", 1), "P2": (None, 1), "P3": ("D4", 0)}


def test_smallest_coded_age_keeps_three_valued_logic(spark):
    ep = episodes(spark, [
        # start age missing (NULL), valid end age: NOT IN on NULL is NULL, so no age is taken
        {"token_person_id": "P1", "epikey": "e1", "startage": None, "endage": "7002",
         "epistart": "2010-03-02", "epiend": "2010-03-03", "admidate": "2010-03-02"},
        {"token_person_id": "P2", "epikey": "e2", "startage": "010", "endage": "7003",
         "epistart": "2010-03-02", "epiend": "2010-03-04", "admidate": "2010-03-02"},
    ])
    summary = BC.person_summary(BC.timeline_anchor(BC.birth_record_flags(BC.clean_infant_records(ep))))
    out = {r.token_person_id: r for r in summary.collect()}
    assert out["P1"].min_epiage is None and out["P1"].min_epiage_epidate is None
    assert out["P2"].min_epiage == 7003 and out["P2"].min_epiage_epidate == dt.date(2010, 3, 4)
    # no record within a month of birth is "no data" (NULL), not 0
    assert out["P1"].n_sexbaby == 0


def test_n_sexbaby_null_without_records_near_birth(spark):
    ep = episodes(spark, [{"token_person_id": "P1", "epikey": "e1", "admidate": "2015-06-01", "sexbaby": "1"}])
    summary = BC.person_summary(BC.timeline_anchor(BC.birth_record_flags(BC.clean_infant_records(ep))))
    assert summary.first().n_sexbaby is None


def test_cancer_slots_missing_admission_quirk(spark):
    ep = episodes(spark, [
        {"token_person_id": "P1", "epikey": "e1", "diag_01": "C910", "admidate": None, "epistart": "2011-01-05"},
        {"token_person_id": "P1", "epikey": "e2", "diag_01": "C715", "admidate": "2012-02-01"},
        {"token_person_id": "P2", "epikey": "e3", "diag_01": "C819", "admidate": "", "epistart": "",
         "epiend": "", "disdate": ""},
    ])
    with pytest.raises(ValueError):
        FD.first_cancer_slots(diagnoses_long(ep), C.cancer_codes(spark))
    slots = FD.first_cancer_slots(diagnoses_long(ep), C.cancer_codes(spark), on_missing="report")
    out = {r.token_person_id: r for r in slots.collect()}
    r = out["P1"]
    # admission dates all missing for the group: earliest stays NULL although a date exists; flagged
    assert (r.cancer_group_1, r.cancer_earliest_diagnosis_1, r.cancer_earliest_diagnosis_problematic_1) == (
        "Leukaemia", None, 1)
    assert (r.cancer_group_2, r.cancer_earliest_diagnosis_2) == ("Brain / CNS", dt.date(2012, 2, 1))
    assert "P2" not in out  # rows lacking all dates are left out ("report" mode)
    missing = FD.missing_all_dates(diagnoses_long(ep), C.cancer_codes(spark), C.congenital_codes(spark))
    assert {r.dataset: r.missing_all_dates for r in missing.collect()}["cancer"] == 1


def test_unparseable_dates_stop_or_are_counted(spark):
    ep = episodes(spark, [{"token_person_id": "P1", "epikey": "e1", "diag_01": "C910", "admidate": "2010-13-45",
                           "epistart": "2011-01-05"}])
    dx = diagnoses_long(ep)
    with pytest.raises(ValueError, match="unparseable"):
        FD.first_cancer_slots(dx, C.cancer_codes(spark))
    assert FD.first_cancer_slots(dx, C.cancer_codes(spark), on_missing="report").count() == 1
    assert {r.field: r.unparseable for r in FD.unparseable_dates(dx).collect()}["admidate"] == 1


def test_congenital_gestation_group_blanked(spark):
    ep = episodes(spark, [
        {"token_person_id": "P1", "epikey": "e1", "diag_03": "Q250", "admidate": "2011-01-05"},
        {"token_person_id": "P1", "epikey": "e2", "cause": "Q900", "admidate": "2010-06-01"},
        {"token_person_id": "P2", "epikey": "e3", "diag_02": "Q2561", "admidate": "2011-01-05"},
    ])
    out = {r.token_person_id: r for r in FD.first_congenital(diagnoses_long(ep), C.congenital_codes(spark)).collect()}
    assert out["P1"].ca_other == dt.date(2010, 6, 1) and out["P1"].ca_ga_mte_37wks_only is None
    assert out["P2"].ca_ga_mte_37wks_only == dt.date(2011, 1, 5) and out["P2"].ca_other is None


def test_eligibility_clauses(spark):
    good = dict(any_birth_record=1, min_dob=dt.date(2005, 1, 1), any_missing_episode_min_date=0, n_dob=1,
                min_months_after_dob=0, birth_records=1, death_records=None, birth_registration_date=dt.date(2005, 1, 10),
                notification_dob=dt.date(2005, 1, 1), death_date=None, death_date_year_precision_only=None,
                any_termination_record=0, any_stillbirth_record=0, birth_stillbirth_records=0,
                notification_stillbirth=None, resgor_england_months_since_min_dob=1, resgor_england=1,
                mi_resgor_england=None)
    cases = [
        good,
        {**good, "n_dob": 2},                                         # two dates of birth
        {**good, "min_dob": dt.date(1997, 3, 1)},                     # outside the birth window
        {**good, "birth_stillbirth_records": None, "notification_stillbirth": "5"},  # notified live birth
        # death known only to the year of birth: 1 January precedes the birth but is allowed
        {**good, "min_dob": dt.date(2005, 3, 1), "birth_registration_date": dt.date(2005, 3, 9),
         "notification_dob": dt.date(2005, 3, 1), "death_date": dt.date(2005, 1, 1),
         "death_date_year_precision_only": 1},
        {**good, "death_date": dt.date(2004, 1, 1), "death_date_year_precision_only": 0},  # death before birth
        {**good, "resgor_england": 0},                                # first residence outside England
        {**good, "any_birth_record": None},                           # undetermined -> FALSE
    ]
    cols = list(good)
    types = {"min_dob": "date", "birth_registration_date": "date", "notification_dob": "date", "death_date": "date",
             "notification_stillbirth": "string"}
    schema = ", ".join(f"{c} {types.get(c, 'bigint')}" for c in cols)
    df = spark.createDataFrame([tuple(c[k] for k in cols) for c in cases], schema)
    got = [r[0] for r in df.select(CO.eligibility(df)).collect()]
    assert got == [True, False, False, True, True, False, False, False]


def test_pipeline_runs_resumes_and_exports(spark, tmp_path):
    from kinloom.plans.cohort_pipeline import run_cohort
    from kinloom.sources.fixtures import fixture_sources

    src = fixture_sources(spark, "/root/testdata/sf0.001")
    work, export = str(tmp_path / "work"), str(tmp_path / "export")
    out = run_cohort(spark, src, work, export_dir=export, on_bad="report")
    n = out["cohort"].count()
    assert n > 0 and len(out["cohort"].columns) == 380
    assert (tmp_path / "work" / "cohort" / "_SUCCESS").exists()
    assert (tmp_path / "work" / "diagnoses" / "reporting_year_start=2000").exists()  # hive-partitioned stage
    assert not (tmp_path / "work" / "timeline").exists()  # no output needs it
    assert out["undated"].count() == 2 and out["unparseable_dates"].count() == 4
    assert {"civil_births", "episodes", "cancer"} <= {r.source for r in out["counts"].collect()}
    meta = spark.read.option("header", True).csv(export + "_metadata")
    assert meta.count() == 380
    # resume: every written stage is read back, nothing is recomputed from sources
    written = (tmp_path / "work" / "birth_cohort" / "_SUCCESS").stat().st_mtime_ns
    again = run_cohort(spark, src, work, resume=True, on_bad="report")
    assert again["cohort"].count() == n
    assert (tmp_path / "work" / "birth_cohort" / "_SUCCESS").stat().st_mtime_ns == written


def test_resume_rebuilds_what_a_changed_source_feeds(spark, tmp_path):
    from kinloom.plans.pipeline import Pipeline, Stage

    def build(rows):
        path = str(tmp_path / "src")
        spark.range(rows).write.mode("overwrite").parquet(path)
        stages = {
            "a": Stage(lambda: spark.read.parquet(path), ()),
            "other": Stage(lambda: spark.range(3), ()),
            "b": Stage(lambda a: a.selectExpr("id * 2 AS x"), ("a",), write=True),
        }
        return Pipeline(spark, stages, workdir=str(tmp_path / "w"), resume=True).run(["b", "other"])

    def stamp(name):
        return (tmp_path / "w" / name / "_SUCCESS").stat().st_mtime_ns

    assert build(5)["b"].count() == 5
    first = stamp("b"), stamp("other")
    assert build(9)["b"].count() == 9
    assert stamp("b") != first[0] and stamp("other") == first[1]


def test_run_stops_on_bad_data(spark, tmp_path):
    import pytest

    from kinloom.plans.cohort_pipeline import cohort_stages
    from kinloom.plans.pipeline import Pipeline, Stage
    from kinloom.sources.fixtures import fixture_sources

    from kinloom.plans.episodes import episodes_harmonised

    src = fixture_sources(spark, "/root/testdata/sf0.001")
    stages = cohort_stages(spark, src)
    with pytest.raises(ValueError, match="admidate on"):  # text that is no date, in the extracts
        Pipeline(spark, stages).get("congenital")
    stages["episodes"] = Stage(lambda: episodes_harmonised(src.episodes()), (), write=False)
    with pytest.raises(ValueError, match="dates missing"):
        Pipeline(spark, stages).get("congenital")
    twice = {"s": Stage(lambda: spark.range(2).selectExpr("1 AS k"), (), unique=("k",))}
    with pytest.raises(AssertionError):
        Pipeline(spark, twice, workdir=str(tmp_path / "u")).get("s")


def test_yearly_census_names(spark):
    from kinloom.sources import mappings as M

    assert M.census_mapping(2007)["census_special_provision_indicator"] == "SENUnitIndicator_SPR07"
    assert M.census_mapping(2006)["census_special_provision_indicator"] == "SpecialProvisionIndicator_SPR06"
    assert [M.census_mapping(y)["census_msoa01"] for y in (2002, 2012, 2014, 2015)] == ["MSOA_02", "MSOA_SPR12", "MSOA01_SPR14", None]
    assert all(list(M.census_mapping(y)) == M.CENSUS_TARGETS for y in M.CENSUS_YEARS)


def test_no_machine_local_checkpoint_folder_on_a_cluster():
    import pytest

    from kinloom.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_sen_absence_repair(spark):
    """Repeated pupils: the rule on one join gives what pairing the two sides gives."""
    from kinloom.plans import education as ED

    pupils = spark.createDataFrame([("a", 2000), ("a", 2001), ("b", 2000), ("c", 2000), ("c", 2000)], "dfe_id string, school_start_year int")
    sen = spark.createDataFrame(
        [(p, y, nc, "N", None, None, 0) for p in "abc" for y, nc in ((2001, "1"), (2002, None), (2003, "3"), (2004, None), (None, "9"))],
        "dfe_id string, academic_year_start int, sen_NC_year_actual string, sen_status string, sen_primary_type string, "
        "sen_secondary_type string, sen_any_special_provision int")
    absence = spark.createDataFrame(
        [(p, y, *range(1, 10)) for p in "abc" for y in (2003, 2004, 2005)],
        "dfe_id string, abs_academic_year_start int, " + ", ".join(f"{c} int" for c in ED.ABS_VALUES))
    got = ED.sen_absence_long(pupils, sen, absence)
    seen = {}
    for r in got.collect():
        seen.setdefault((r.dfe_id, r.senabs_academic_year_start), []).append((r.sen_status, r.abs_records))
    assert {y: v for (p, y), v in seen.items() if p == "b"} == {2001: [("N", None)], 2002: [("N", None)], 2003: [("N", 1)], 2004: [("N", 1)], 2005: [(None, 1)]}
    assert {y: len(v) for (p, y), v in seen.items() if p == "a"} == {2001: 2, 2002: 2, 2004: 4, 2005: 2}
    assert {y: len(v) for (p, y), v in seen.items() if p == "c"} == {2001: 2, 2002: 4, 2004: 4, 2005: 2}
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("FullOuter") == 1


def test_yearly_extracts_harmonise(spark):
    from kinloom.plans import episodes as EP

    a = spark.createDataFrame([("p", "2500")], "token_person_id string, birweit_1 string")
    b = spark.createDataFrame([("q", "3000", "1")], "token_person_id string, birweit string, birordr_1 string")
    out = EP.episodes_harmonised({2001: b, 1998: a})
    assert sorted((r.reporting_year_start, r.token_person_id, r.birweit, r.birordr) for r in out.collect()) == [
        (1998, "p", "2500", None), (2001, "q", "3000", "1")]
    from kinloom.sources import io as IO

    assert IO.tables_by_year(["APC_1998", "Absence_2001_3Term"]) == {1998: "APC_1998", 2001: "Absence_2001_3Term"}
    with pytest.raises(ValueError):
        IO.tables_by_year(["x1998", "y1998"])
    for name in ("apc", "apc_1998_2001", "apc_19981"):
        with pytest.raises(ValueError):
            IO.year_from_name(name)


def test_diagnoses_read_back_prunes_folders(spark):
    from kinloom.plans.queries import QUERIES

    back = QUERIES["diagnoses_read_back"](spark, "/root/testdata/sf0.001")
    text = back.filter("reporting_year_start >= 2010")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reporting_year_start" in text
