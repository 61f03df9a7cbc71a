"""Declared columns of every source and stage.

A source is checked when it is loaded, a stage when it is built or read back; a
missing column, or one of another type, is an error there and not a NULL later.
Columns that are not declared are left out.
"""

from __future__ import annotations

from pyspark.sql import types as T

from . import mappings as M

_TYPES = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "f": T.DoubleType(), "d": T.DateType(), "b": T.BooleanType()}


def _columns(text: str) -> T.StructType:
    """``type: name name ...`` on each line; types are s, i, l, f (double), d (date) and b."""
    out = T.StructType()
    for line in text.strip().splitlines():
        kind, names = line.split(":")
        for name in names.split():
            out = out.add(name, _TYPES[kind.strip()])
    return out


def _join(*parts: T.StructType, leave: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([f for p in parts for f in p.fields if f.name not in leave])


def _pick(schema: T.StructType, names: list[str], **renamed: str) -> T.StructType:
    return T.StructType([T.StructField(renamed.get(n, n), schema[n].dataType) for n in names])


_DIAGNOSES = " ".join(f"diag_{k:02d}" for k in range(1, 21))

# The columns that the extracts must have.
EPISODES = _columns(f"""
    s: token_person_id epikey epistat admidate epistart epiend disdate epiorder mydob startage endage admiage activage
    s: sex sexbaby birordr numbaby birstat neocare dismeth classpat epitype admimeth biresus delmeth delstat
    s: well_baby_ind hrgnhs sushrg suscorehrg birweit gestat matage ethnos resgor cr_residence oacode6 msoa01 msoa11
    s: imd04_decile {_DIAGNOSES} cause
    i: reporting_year_start
""")
_BORN = "{0}_PupilMatchingRefAnonymous {0}_ACADYR {0}_NFTYPE {0}_GENDER {0}_YEAROFBIRTH {0}_MONTHOFBIRTH"


def _key_stage(name: str, rest: str, school: bool = True) -> T.StructType:
    own = f"{name.lower()}_laestab_anon {name}_ToE_CODE" if school else ""
    return _join(_columns(f"s: {_BORN.format(name)} {own}"), _columns(rest))


SOURCES = {
    "civil_births": _columns("s: TOKEN_PERSON_ID DOREG SEX_CHILD STILLBIRTH_IND"),
    "civil_deaths": _columns("s: TOKEN_PERSON_ID\ni: REG_DATE_OF_DEATH"),
    "birth_notifications": _columns("s: TOKEN_PERSON_ID BABY_BIRTH_DATE BABY_ETHNICITY BABY_SEX LIVE_STILL NUM_BIRTHS"),
    "bridging": _columns("s: PUPIL_REF_MATCHING_ANONYMOUS pseudo"),
    "mother_baby_links": _columns("""
        s: tokenid mtokenid link matage_clean gestat_clean birweit_clean sexbaby_clean delmeth_clean birstat_clean
        s: sibling_n imd04_decile_cat_clean mdel_my
    """),
    "ks1": _key_stage("KS1", "s: KS1_TRIALFLAG KS1_READING KS1_READ_OUTCOME KS1_WRITING KS1_WRIT_OUTCOME KS1_MATHS KS1_MATH_OUTCOME"),
    "ks2": _key_stage("KS2", """
        s: KS2_NATRES KS2_READMRK KS2_READLEV KS2_READOUTCOME KS2_MATTOTMRK KS2_MATMRK KS2_MATLEV KS2_MATOUTCOME
        i: KS2_READHIGH KS2_READEXP KS2_MATHIGH KS2_MATEXP
    """),
    "ks4_a": _key_stage("KS4", """
        s: KS4_NATRES KS4_APENG KS4_APENG_PTQ KS4_HGMATH KS4_HGMATH_PTQ
        i: KS4_LEVEL2_EM KS4_LEVEL2_EM_PTQ
        f: KS4_HPGENG KS4_HPGENG_PTQ KS4_HPGMATH KS4_HPGMATH_PTQ KS4_PTSCNEWE KS4_PTSCNEWE_PTQ
    """),
    "ks4_b": _key_stage("KS4", """
        s: KS4_NATRES KS4_APENG_PTQ_EE KS4_APENG_91 KS4_HGMATH_PTQ_EE KS4_HGMATH_91
        i: KS4_LEVEL2_EM_PTQ_EE KS4_LEVEL2_EM_94
        f: KS4_HPGENG_PTQ_EE KS4_HPGMATH_PTQ_EE KS4_PTSCNEWE_PTQ_EE KS4_ATT8
    """),
    "ks5_a": _key_stage("KS5", "s: KS5_GAS_MATH KS5_GA_MATH\nf: KS5_TOTPTSE_ALEV"),
    "ks5_b": _key_stage("KS5", "s: KS5_GAS_MATH KS5_GA_MATH\nf: KS5_TOTPTSE_ALEV", school=False),
}
#: Census fields that arrive as numbers, by target.
_CENSUS_NUMBERS = {"census_FSM_eligible", "census_part_time", "census_special_provision_indicator", *M.CENSUS_INT_TARGETS}


def _yearly(mapping: dict, number) -> T.StructType:
    return T.StructType([T.StructField(source, _TYPES["i" if number(target) else "s"])
                         for target, source in mapping.items() if isinstance(source, str)])


def census_table(year: int) -> T.StructType:
    return _yearly(M.census_mapping(year), lambda t: t in _CENSUS_NUMBERS)


def absence_table(year: int) -> T.StructType:
    return _yearly(M.absence_mapping(year), lambda t: t not in M.ABSENCE_TEXT_TARGETS)


def episodes_table() -> T.StructType:
    """A yearly extract: raw names of the baby-tail fields, the year in the table's name."""
    raw = {target: source for source, target in M.EPISODE_RENAMES}
    names = [n for n in EPISODES.names if n != "reporting_year_start"]
    return _pick(EPISODES, names, **raw)


# --------------------------------------------------------------------------- stages

_FLAGS = "birth_record termination_record stillbirth_record singleton_diag_birth_record multiple_birth_record"
_FLAGGED = _columns(f"""
    s: token_person_id epikey
    i: reporting_year_start
    d: episode_min_date epistart epiend
    i: epiorder
    d: mydob
    s: startage endage sex sexbaby
    i: activage admiage resgor_england {_FLAGS}
""")
_PERSON_DATES = _columns("d: min_recorded_date\ni: any_missing_episode_min_date")
_SUMMARY = _columns("""
    s: token_person_id
    i: any_missing_episode_min_date
    l: n_sex
    i: any_birth_record any_termination_record any_stillbirth_record any_multiple_birth_record
    i: any_singleton_diag_birth_record
    l: records_within_1_month_of_dob records recs_28days recs_3yrs
    i: reporting_year_start any_baby min_startage min_endage min_months_after_dob
    d: first_admi last_admi min_dob
    l: n_dob
    i: min_age max_age
    s: sex_earliest sexbaby_earliest
    l: n_sexbaby
    i: min_epiage
    d: min_epiage_epidate
    i: resgor_england resgor_england_months_since_min_dob
""")
_REGISTRATIONS = _columns("""
    l: birth_records
    d: birth_registration_date
    s: birth_sex
    l: birth_stillbirth_records death_records
    d: death_date
    i: death_date_year_precision_only
""")
_NOTIFICATIONS = _columns("""
    d: notification_dob
    s: notification_ethnicity notification_sex notification_stillbirth notification_num_births
""")
_BIRTH_COHORT = _join(_SUMMARY, _REGISTRATIONS, _NOTIFICATIONS, _columns("s: dfe_id\ni: dfe_id_problematic"))
_CANCER = _join(_columns("s: token_person_id"), *[
    _columns(f"s: cancer_group_{n}\nd: cancer_earliest_diagnosis_{n}\ni: cancer_earliest_diagnosis_problematic_{n}")
    for n in range(1, 5)])
_CONGENITAL = _columns("""
    s: token_person_id
    d: ca_down_syndrome ca_ga_mte_37wks_only ca_neurofibromatosis ca_other ca_tuberous_sclerosis
""")
_MOTHERS = _columns("""
    s: mi_token_person_id_mother
    d: mi_mdel_my
    s: mi_msoa01 mi_msoa11 mi_imd04_decile mi_resgor mi_cr_residence
    d: mi_episode_min_date mi_episode_max_date
""")
_BIRTH_INFO = _columns("""
    s: token_person_id
    i: bi_valid
    d: bi_admidate bi_episode_min_date
    l: bi_records_before_8yrs
    i: bi_gestat bi_birweit bi_matage
    s: bi_sexbaby bi_imd04_decile mb_token_person_id_mother
    i: mb_matage mb_gestat mb_birweit
    s: mb_sexbaby mb_imd04_decile
    d: mb_mdel_my
""")
_ETH_GEO = _columns("""
    s: token_person_id eth_ethnicity_broad
    i: eth_ethnicity_coding_system eth_months_since_dob
    l: eth_ethnicity_broad_n
    s: geo_oacode6 geo_msoa01 geo_msoa11
    i: geo_months_since_dob
""")
_CENSUS = T.StructType([T.StructField(t, _TYPES["i" if t in M.CENSUS_INT_TARGETS else "s"]) for t in M.CENSUS_TARGETS])
_ABSENCE = T.StructType([T.StructField(row[3], _TYPES["s" if row[3] in M.ABSENCE_TEXT_TARGETS else "i"]) for row in M.ABSENCE_FIELDS])


def _results(stage: str, rest: str) -> T.StructType:
    head = f"""
        i: {stage}_academic_year_start
        s: {stage}_school_id {stage}_school_type_edubase {stage}_school_type_aat {stage}_gender {stage}_birth_year
        s: {stage}_birth_month
    """
    return _join(_columns(head), _columns(rest))


_EDUCATION = _join(
    _columns("s: dfe_id census_NC_year_actual\ni: census_academic_year_start"),
    _results("ks1", """
        s: ks1_2003_school_trial_status ks1_reading_1997_2014 ks1_reading_2015_2021 ks1_writing_1997_2014
        s: ks1_writing_2015_2021 ks1_maths_1997_2014 ks1_maths_2015_2021
    """),
    _results("ks2", """
        s: ks2_dfe_national_result_included ks2_reading_mark ks2_reading_1998_2014 ks2_reading_2015_onward
        i: ks2_reading_above_expected_level_2015_onward ks2_reading_at_or_above_expected_level_2015_onward
        s: ks2_maths_mark_1995_2014 ks2_maths_mark_2015_onward ks2_maths_1995_2014 ks2_maths_2015_onward
        i: ks2_maths_above_expected_level_2015_onward ks2_maths_at_or_above_expected_level_2015_onward
    """),
    _results("ks4", """
        s: ks4_dfe_national_result_included
        i: ks4_level2
        f: ks4_best8_score
        s: ks4_english_grade
        f: ks4_english_points
        s: ks4_maths_grade
        f: ks4_maths_points
    """),
    _results("ks5", "f: ks5_total_points\ns: ks5_aslevel_maths_grade ks5_alevel_maths_grade"),
)
_SEN_CELL = _columns("""
    i: senabs_academic_year_start
    s: sen_NC_year_actual sen_status sen_primary_type sen_secondary_type
    i: sen_any_special_provision
    l: abs_records abs_annual_possible abs_annual_absent_total abs_summed_possible abs_summed_absent_total
    l: abs_summed_absent_illness_medical abs_summer6th_possible abs_summer6th_absent_total
    l: abs_summer6th_absent_illness_medical
""")
_SEN_WIDE = _join(_columns("s: dfe_id"), *[
    T.StructType([T.StructField(f"{f.name}_Y{n:02d}", f.dataType) for f in _SEN_CELL.fields]) for n in range(-2, 14)])

STAGES = {
    "episodes": EPISODES,
    "births": SOURCES["civil_births"],
    "deaths": SOURCES["civil_deaths"],
    "notifications_raw": SOURCES["birth_notifications"],
    "bridging": SOURCES["bridging"],
    "links": SOURCES["mother_baby_links"],
    "diagnoses": _columns("""
        s: token_person_id epikey admidate epistart epiend disdate epiorder startage
        i: reporting_year_start diagnostic_position
        s: diagnosis diagnosis_3char
    """),
    "infants": EPISODES,
    "infant_ids": _join(_columns("s: token_person_id"), _PERSON_DATES),
    "flagged": _join(_FLAGGED, _PERSON_DATES),
    "summary": _SUMMARY,
    "registrations": _join(_columns("s: token_person_id"), _REGISTRATIONS),
    "ids": _columns("s: dfe_id nhs_id\ni: dfe_id_problematic"),
    "notifications": _join(_columns("s: token_person_id"), _NOTIFICATIONS),
    "birth_cohort": _BIRTH_COHORT,
    "cancer_coded": _columns("""
        s: cancer_group token_person_id
        i: reporting_year_start
        s: epikey
        i: diagnostic_position
        d: admidate epistart epiend disdate
        b: _bad_text
        d: min_date
    """),
    "cancer": _CANCER,
    "congenital_coded": _columns("s: token_person_id ca_group\nd: min_date\nb: _bad_text"),
    "congenital": _CONGENITAL,
    "undated": _columns("s: dataset\nl: missing_all_dates"),
    "unparseable_dates": _columns("s: field\nl: unparseable"),
    "repeated_pupil_years": _columns("l: repeated_pupil_years"),
    "mothers": _MOTHERS,
    "birth_info": _BIRTH_INFO,
    "eth_geo": _ETH_GEO,
    "census": _CENSUS,
    "absence_collated": _ABSENCE,
    "ks1_raw": SOURCES["ks1"],
    "ks2_raw": SOURCES["ks2"],
    "ks4_a": SOURCES["ks4_a"],
    "ks4_b": SOURCES["ks4_b"],
    "ks5_a": SOURCES["ks5_a"],
    "ks5_b": SOURCES["ks5_b"],
    "pupils": _columns("s: dfe_id\ni: school_start_year"),
    "education": _EDUCATION,
    "sen_long": _join(_columns("s: dfe_id senabs_school_year_nominal"), _SEN_CELL),
    "sen_wide": _SEN_WIDE,
}


def missing(have: T.StructType, declared: T.StructType) -> list[str]:
    """What a table lacks or holds in another type."""
    there = {f.name: f.dataType for f in have.fields}
    return [f"{f.name} {f.dataType.simpleString()} (is {there[f.name].simpleString() if f.name in there else 'missing'})"
            for f in declared.fields if there.get(f.name) != f.dataType]
