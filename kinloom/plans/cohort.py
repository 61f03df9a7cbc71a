"""Final cohort: assembly of all feature tables on the person, derived ages
and school years with bands, and the eligibility flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.dates import completed_years, nominal_school_year, school_start_year
from ..functions.values import cut, is_in

# The output columns taken from each feature table.
BIRTH_INFO_FIELDS = [
    "bi_valid", "bi_admidate", "bi_episode_min_date", "bi_records_before_8yrs", "bi_gestat", "bi_birweit",
    "bi_matage", "bi_sexbaby", "bi_imd04_decile", "mb_token_person_id_mother", "mb_matage", "mb_gestat",
    "mb_birweit", "mb_sexbaby", "mb_imd04_decile", "mb_mdel_my",
]
MOTHER_FIELDS = ["mi_msoa01", "mi_msoa11", "mi_imd04_decile", "mi_resgor", "mi_cr_residence",
                 "mi_episode_min_date", "mi_episode_max_date"]
ETH_GEO_FIELDS = ["eth_ethnicity_broad", "eth_ethnicity_coding_system", "eth_months_since_dob",
                  "eth_ethnicity_broad_n", "geo_oacode6", "geo_msoa01", "geo_msoa11", "geo_months_since_dob"]
CANCER_FIELDS = [f"cancer_{c}_{n}" for n in range(1, 5)
                 for c in ("group", "earliest_diagnosis", "earliest_diagnosis_problematic")]
CONGENITAL_FIELDS = ["ca_down_syndrome", "ca_neurofibromatosis", "ca_tuberous_sclerosis", "ca_other",
                     "ca_ga_mte_37wks_only"]
KS_FIELDS = [
    "census_academic_year_start", "ks1_school_id", "ks1_academic_year_start", "ks1_reading_1997_2014",
    "ks1_reading_2015_2021", "ks1_writing_1997_2014", "ks1_writing_2015_2021", "ks1_maths_1997_2014",
    "ks1_maths_2015_2021", "ks2_academic_year_start", "ks2_school_id", "ks2_dfe_national_result_included",
    "ks2_reading_mark", "ks2_reading_1998_2014", "ks2_reading_2015_onward",
    "ks2_reading_above_expected_level_2015_onward", "ks2_reading_at_or_above_expected_level_2015_onward",
    "ks2_maths_mark_1995_2014", "ks2_maths_mark_2015_onward", "ks2_maths_1995_2014", "ks2_maths_2015_onward",
    "ks2_maths_above_expected_level_2015_onward", "ks2_maths_at_or_above_expected_level_2015_onward",
    "ks4_academic_year_start", "ks4_school_id", "ks4_dfe_national_result_included", "ks4_level2",
    "ks4_best8_score", "ks4_english_grade", "ks4_english_points", "ks4_maths_grade", "ks4_maths_points",
    "ks5_academic_year_start", "ks5_school_id", "ks5_total_points", "ks5_aslevel_maths_grade",
    "ks5_alevel_maths_grade",
]

# Band breaks for age (years, left-closed) and school year (right-closed).
AGE_BREAKS = [0, 1, 5, 10, 15, 20, 25, float("inf")]
SCHOOL_YEAR_BREAKS = [float("-inf"), 2, 6, 11, float("inf")]
COHORT_DOB_FROM, COHORT_DOB_TO = "1997-04-01", "2023-04-01"


def _spread(key: str, by: str) -> Column:
    """``key``, or where it is NULL a value that equals no id and differs from row to row."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(by)))


def assemble(
    birth_cohort: DataFrame,
    birth_info: DataFrame,
    mothers: DataFrame,
    eth_geo: DataFrame,
    cancer: DataFrame,
    congenital: DataFrame,
    sen_absence_wide: DataFrame,
    education: DataFrame,
    senabs_fields: list[str],
) -> DataFrame:
    """Successive LEFT JOINs of the feature tables onto the birth cohort.

    Person-keyed tables join on the person id, the mother table on (mother,
    delivery month), pupil-keyed tables on the pupil id.  Each right side is
    at most one row per key except the mother-baby links (reproduced fan-out).
    """
    p = "token_person_id"
    # person-keyed joins first: the left side stays hash-partitioned on the
    # person across them (one shuffle of the wide side instead of one per join)
    out = birth_cohort.join(birth_info.select(p, *BIRTH_INFO_FIELDS), p, "left")
    out = out.join(eth_geo.select(p, *ETH_GEO_FIELDS), p, "left")
    out = out.join(cancer.select(p, *CANCER_FIELDS), p, "left")
    out = out.join(congenital.select(p, *CONGENITAL_FIELDS), p, "left")
    mi = mothers.select(
        F.col("mi_token_person_id_mother").alias("mb_token_person_id_mother"),
        F.col("mi_mdel_my").alias("mb_mdel_my"),
        *MOTHER_FIELDS,
    )
    # rows without a mother or a pupil id match nothing; a key made of their
    # person id, which no id starts like, spreads them over the tasks that a
    # NULL key would send to one
    out = out.withColumn("_mother", _spread("mb_token_person_id_mother", p))
    mi = mi.withColumnsRenamed({"mb_token_person_id_mother": "_mother", "mb_mdel_my": "_month"})
    mi = mi.filter(F.col("_mother").isNotNull() & F.col("_month").isNotNull())
    out = out.join(mi, [out["_mother"] == mi["_mother"], out["mb_mdel_my"] == mi["_month"]], "left")
    out = out.drop("_mother", "_month").withColumnsRenamed({p: "nhs_id", "mb_token_person_id_mother": "mb_nhs_id_mother"})
    # pupil-keyed joins last, again sharing one partitioning of the left side
    out = out.withColumn("_pupil", _spread("dfe_id", "nhs_id"))
    for features in (sen_absence_wide.select("dfe_id", *senabs_fields), education.select("dfe_id", *KS_FIELDS)):
        out = out.join(features.withColumnRenamed("dfe_id", "_pupil"), "_pupil", "left")
    return out.drop("_pupil")


def _england(resgor: Column, cr: Column) -> Column:
    """Mother's residency: region code first, then country of residence."""
    by_region = F.when(is_in(resgor, C.ENGLAND_RESGOR), 1).when(is_in(resgor, C.NON_ENGLAND_RESGOR), 0)
    by_country = F.when((F.length(cr) == 3) & (cr != "Q99"), 1).when(is_in(cr, C.NON_ENGLAND_CR_RESIDENCE), 0)
    return F.coalesce(by_region, by_country)


def derive(cohort: DataFrame) -> DataFrame:
    """Residency of the mother, school start year, age and school year (with
    bands) at first cancer diagnosis and at death."""
    out = cohort.withColumns(
        {
            "mi_resgor_england": _england(F.col("mi_resgor"), F.col("mi_cr_residence")),
            "school_start_year": school_start_year("min_dob"),
        }
    )
    cols = {}
    for stem, event in (("cancer_earliest_diagnosis_1", "cancer_earliest_diagnosis_1"), ("death", "death_date")):
        age = completed_years("min_dob", event)
        sy = nominal_school_year(event, "school_start_year")
        cols[f"{stem}_age"] = age
        cols[f"{stem}_age_cat"] = cut(age, AGE_BREAKS, right=False)
        cols[f"{stem}_school_year"] = sy
        cols[f"{stem}_school_year_cat"] = cut(sy, SCHOOL_YEAR_BREAKS, right=True)
    return out.withColumns(cols)


def eligibility(df: DataFrame) -> Column:
    """The 13-clause cohort inclusion rule; an undetermined (NULL) result is
    FALSE.  Clauses use SQL three-valued logic, which matches the vectorised
    logical rules they were specified in; membership tests are never NULL."""
    c = F.col
    notified_still = c("notification_stillbirth")
    clauses = [
        c("any_birth_record") == 1,
        (c("min_dob") >= F.lit(COHORT_DOB_FROM).cast("date")) & (c("min_dob") < F.lit(COHORT_DOB_TO).cast("date")),
        c("any_missing_episode_min_date") == 0,
        c("n_dob") == 1,
        c("min_months_after_dob") > -2,
        c("birth_records").isNull() | (c("birth_records") < 2),
        c("death_records").isNull() | (c("death_records") < 2),
        c("birth_registration_date").isNull() | (c("birth_registration_date") >= c("min_dob")),
        c("birth_registration_date").isNull() | c("notification_dob").isNull()
        | (c("birth_registration_date") >= c("notification_dob")),
        c("death_date").isNull() | (c("death_date") >= c("min_dob"))
        | ((c("death_date_year_precision_only") == 1) & (F.add_months(c("death_date"), 12) > c("min_dob"))),
        ((c("any_termination_record") == 0) & (c("any_stillbirth_record") == 0) & c("birth_stillbirth_records").isNull()
         & (notified_still.isNull() | (notified_still == "")))
        | (is_in(notified_still, ["1", "5"]) & c("birth_stillbirth_records").isNull())
        | (c("birth_stillbirth_records") == 0),
        c("resgor_england_months_since_min_dob").isNull() | (c("resgor_england_months_since_min_dob") > 6)
        | ((c("resgor_england_months_since_min_dob") <= 6) & (c("resgor_england") == 1)),
        c("mi_resgor_england").isNull() | (c("mi_resgor_england") == 1),
    ]
    rule = clauses[0]
    for cl in clauses[1:]:
        rule = rule & cl
    return F.coalesce(rule, F.lit(False))


def with_eligibility(df: DataFrame) -> DataFrame:
    return df.withColumn("cohort_eligible", eligibility(df))
