"""Pupil side: harmonised census and absence, best key-stage record per
pupil-year, latest key-stage result by the expected year, and SEN/absence by
nominal school year (long and wide)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import academic_year_start, school_start_year
from ..functions.values import decode, flag, is_in, ordinal_label, ordinal_rank, sum_na_rm
from ..operators.link import full_merge
from ..operators.quality import duplicate_keys
from ..operators.reshape import harmonise, pivot_arrays, union_all
from ..operators.select import asof_latest, keep_first
from ..sources import mappings as M

# --------------------------------------------------------------------------- census / absence


def census_harmonised(tables: Mapping[int, DataFrame]) -> DataFrame:
    """Yearly census tables (keyed by collection year) -> one 22-column table."""
    parts = []
    for year, df in tables.items():
        mapping = M.census_mapping(year)
        types = {t: ("int" if t in M.CENSUS_INT_TARGETS else "string") for t in mapping}
        parts.append(harmonise(df, mapping, types))
    return union_all(parts)


def absence_collated(tables: Mapping[int, DataFrame]) -> DataFrame:
    """Yearly absence tables (keyed by table year) -> one 21-column table."""
    parts = []
    for year, df in tables.items():
        mapping = M.absence_mapping(year)
        types = {t: ("string" if t in M.ABSENCE_TEXT_TARGETS else "int") for t in mapping}
        parts.append(harmonise(df, mapping, types))
    return union_all(parts)


ABS_VALUES = [
    "abs_records", "abs_annual_possible", "abs_annual_absent_total", "abs_summed_possible",
    "abs_summed_absent_total", "abs_summed_absent_illness_medical", "abs_summer6th_possible",
    "abs_summer6th_absent_total", "abs_summer6th_absent_illness_medical",
]


def absence_summary(collated: DataFrame) -> DataFrame:
    """Per pupil and academic year: record count and NULL-skipping sums; the
    measures an era did not collect are NULL (2005: annual and illness; before
    2012: the sixth half-term)."""
    terms = ["autumn", "spring", "summer"]
    summed = collated.groupBy("dfe_id", academic_year_start("abs_academic_year").alias("abs_academic_year_start")).agg(
        F.count(F.lit(1)).alias("abs_records"),
        F.sum(sum_na_rm(["abs_annual_possible"])).alias("abs_annual_possible"),
        F.sum(sum_na_rm(["abs_annual_absent_total"])).alias("abs_annual_absent_total"),
        F.sum(sum_na_rm([f"abs_{t}_possible" for t in terms])).alias("abs_summed_possible"),
        F.sum(sum_na_rm([f"abs_{t}_absent_total" for t in terms])).alias("abs_summed_absent_total"),
        F.sum(sum_na_rm([f"abs_{t}_absent_{r}" for r in ("illness", "medical") for t in terms])).alias(
            "abs_summed_absent_illness_medical"),
        F.sum(sum_na_rm(["abs_summer6th_possible"])).alias("abs_summer6th_possible"),
        F.sum(sum_na_rm(["abs_summer6th_absent_total"])).alias("abs_summer6th_absent_total"),
        F.sum(sum_na_rm(["abs_summer6th_absent_illness", "abs_summer6th_absent_medical"])).alias(
            "abs_summer6th_absent_illness_medical"),
    )
    y = F.col("abs_academic_year_start")
    blank_2005 = ["abs_annual_possible", "abs_annual_absent_total", "abs_summed_absent_illness_medical"]
    blank_pre2012 = ["abs_summer6th_possible", "abs_summer6th_absent_total", "abs_summer6th_absent_illness_medical"]
    out = summed.withColumns({c: F.when(y == 2005, F.lit(None)).otherwise(F.col(c)) for c in blank_2005})
    return out.withColumns({c: F.when(y < 2012, F.lit(None)).otherwise(F.col(c)) for c in blank_pre2012})


# --------------------------------------------------------------------------- key stages

# Grade scales (ascending) and pass thresholds.
KS1_GRADES = ["D", "W", "1", "2", "2C", "2B", "2A", "3", "4", "4+"]
KS1_LEVEL2PLUS = KS1_GRADES[3:]
KS2_PRE2015_GRADES = ["B", "N", "T", "2", "3", "4", "5", "6"]
KS2_LEVEL4PLUS = KS2_PRE2015_GRADES[5:]
KS5_GRADES = ["*", "A", "B", "C", "D", "E"]  # best first
# expected academic-year offsets from school start
KS_OFFSETS = {"ks1_census": 2, "ks1": 2, "ks2": 6, "ks4": 11, "ks5": 13}


def _tie_break(cols: Sequence[str]) -> list[Column]:
    # equal sort keys: prefer a fixed order over all output columns so that
    # the choice among tied records is deterministic
    return [F.col(c).asc_nulls_first() for c in cols]


def _missing_first(cols: Sequence[str]) -> list[Column]:
    """Parts of a struct that sorts ascending with missing values first."""
    return [p for c in cols for p in (F.col(c).isNotNull(), F.col(c))]


def ks1_census_presence(census: DataFrame) -> DataFrame:
    """Pupil-years recorded in school year group 2 (from 2003/2004)."""
    return census.filter(
        (F.col("census_NC_year_actual") == "2") & (F.col("census_academic_year") >= "2003/2004")
    ).select(
        "dfe_id", "census_NC_year_actual", academic_year_start("census_academic_year").alias("census_academic_year_start")
    ).distinct()


# Exam extract field names and their target names.
KS1_COLUMNS = {
    "KS1_PupilMatchingRefAnonymous": "dfe_id", "ks1_laestab_anon": "ks1_school_id",
    "KS1_ToE_CODE": "ks1_school_type_edubase", "KS1_NFTYPE": "ks1_school_type_aat", "KS1_GENDER": "ks1_gender",
    "KS1_YEAROFBIRTH": "ks1_birth_year", "KS1_MONTHOFBIRTH": "ks1_birth_month",
    "KS1_TRIALFLAG": "ks1_2003_school_trial_status", "KS1_READING": "ks1_reading_1997_2014",
    "KS1_READ_OUTCOME": "ks1_reading_2015_2021", "KS1_WRITING": "ks1_writing_1997_2014",
    "KS1_WRIT_OUTCOME": "ks1_writing_2015_2021", "KS1_MATHS": "ks1_maths_1997_2014",
    "KS1_MATH_OUTCOME": "ks1_maths_2015_2021",
}


def ks1_best(ks1: DataFrame) -> DataFrame:
    """KS1 from 2003/2004; up to 2004 one record per pupil-year (most level-2+
    passes, then highest summed grade positions); later years as recorded."""
    d = ks1.filter(F.col("KS1_ACADYR") >= "2003/2004").select(
        *[F.col(s).alias(t) for s, t in list(KS1_COLUMNS.items())[:1]],
        academic_year_start("KS1_ACADYR").alias("ks1_academic_year_start"),
        *[F.col(s).alias(t) for s, t in list(KS1_COLUMNS.items())[1:]],
    )
    subjects = ["ks1_reading_1997_2014", "ks1_writing_1997_2014", "ks1_maths_1997_2014"]
    passes = sum(is_in(c, KS1_LEVEL2PLUS).cast("int") for c in subjects)
    points = sum_na_rm([ordinal_rank(c, KS1_GRADES) for c in subjects])
    early = d.filter(F.col("ks1_academic_year_start") <= 2004)
    best = keep_first(
        early.withColumns({"_p": passes, "_pts": points}),
        ["dfe_id", "ks1_academic_year_start"],
        [F.col("_p").desc(), F.col("_pts").desc(), *_tie_break(d.columns)],
    ).drop("_p", "_pts")
    return best.unionByName(d.filter(F.col("ks1_academic_year_start") > 2004))


# Exam extract field names and their target names.
KS2_COLUMNS = {
    "KS2_PupilMatchingRefAnonymous": "dfe_id", "ks2_laestab_anon": "ks2_school_id",
    "KS2_ToE_CODE": "ks2_school_type_edubase", "KS2_NFTYPE": "ks2_school_type_aat", "KS2_GENDER": "ks2_gender",
    "KS2_YEAROFBIRTH": "ks2_birth_year", "KS2_MONTHOFBIRTH": "ks2_birth_month",
    "KS2_NATRES": "ks2_dfe_national_result_included", "KS2_READMRK": "ks2_reading_mark",
    "KS2_READLEV": "ks2_reading_1998_2014", "KS2_READOUTCOME": "ks2_reading_2015_onward",
    "KS2_READHIGH": "ks2_reading_above_expected_level_2015_onward",
    "KS2_READEXP": "ks2_reading_at_or_above_expected_level_2015_onward",
    "KS2_MATTOTMRK": "ks2_maths_mark_1995_2014", "KS2_MATMRK": "ks2_maths_mark_2015_onward",
    "KS2_MATLEV": "ks2_maths_1995_2014", "KS2_MATOUTCOME": "ks2_maths_2015_onward",
    "KS2_MATHIGH": "ks2_maths_above_expected_level_2015_onward",
    "KS2_MATEXP": "ks2_maths_at_or_above_expected_level_2015_onward",
}


def ks2_best(ks2: DataFrame) -> DataFrame:
    """KS2 from 2007/2008, one record per pupil-year.  Missing national-result
    flags sort first under the descending order (as recorded)."""
    d = ks2.filter(F.col("KS2_ACADYR") >= "2007/2008").select(
        F.col("KS2_PupilMatchingRefAnonymous").alias("dfe_id"),
        academic_year_start("KS2_ACADYR").alias("ks2_academic_year_start"),
        *[F.col(s).alias(t) for s, t in list(KS2_COLUMNS.items())[1:]],
    )
    keys = ["dfe_id", "ks2_academic_year_start"]
    natres = F.col("ks2_dfe_national_result_included").desc_nulls_first()
    subj_pre = ["ks2_reading_1998_2014", "ks2_maths_1995_2014"]
    pre = d.filter(F.col("ks2_academic_year_start") <= 2014).withColumns(
        {
            "_p": sum(is_in(c, KS2_LEVEL4PLUS).cast("int") for c in subj_pre),
            "_pts": sum_na_rm([ordinal_rank(c, KS2_PRE2015_GRADES) for c in subj_pre]),
        }
    )
    pre = keep_first(pre, keys, [natres, F.col("_p").desc(), F.col("_pts").desc(), *_tie_break(d.columns)])
    post = d.filter(F.col("ks2_academic_year_start") > 2014).withColumns(
        {
            "_p": sum_na_rm(["ks2_reading_at_or_above_expected_level_2015_onward",
                             "ks2_maths_at_or_above_expected_level_2015_onward"]),
            "_hp": sum_na_rm(["ks2_reading_above_expected_level_2015_onward",
                              "ks2_maths_above_expected_level_2015_onward"]),
            "_m": sum_na_rm([F.col("ks2_maths_mark_2015_onward").try_cast("int"),
                             F.col("ks2_reading_mark").try_cast("int")]),
        }
    )
    post = keep_first(
        post, keys, [natres, F.col("_p").desc(), F.col("_hp").desc(), F.col("_m").desc(), *_tie_break(d.columns)]
    )
    return pre.drop("_p", "_pts").unionByName(post.drop("_p", "_hp", "_m"))


def _pick(primary: str, fallback: str) -> Column:
    """``primary`` unless NULL, else ``fallback`` (CASE WHEN primary IS NULL)."""
    return F.coalesce(F.col(primary), F.col(fallback))


def ks4_best(ks4_a: DataFrame, ks4_b: DataFrame) -> DataFrame:
    """KS4 from 2012/2013 across two extract eras, one record per pupil-year:
    national flag, level 2, best-8 score (all descending, missing first)."""
    common = [
        F.col("KS4_PupilMatchingRefAnonymous").alias("dfe_id"),
        academic_year_start("KS4_ACADYR").alias("ks4_academic_year_start"),
        F.col("ks4_laestab_anon").alias("ks4_school_id"),
        F.col("KS4_ToE_CODE").alias("ks4_school_type_edubase"),
        F.col("KS4_NFTYPE").alias("ks4_school_type_aat"),
        F.col("KS4_GENDER").alias("ks4_gender"),
        F.col("KS4_YEAROFBIRTH").alias("ks4_birth_year"),
        F.col("KS4_MONTHOFBIRTH").alias("ks4_birth_month"),
        F.col("KS4_NATRES").alias("ks4_dfe_national_result_included"),
    ]
    a = ks4_a.filter(F.col("KS4_ACADYR") >= "2012/2013").select(
        *common,
        _pick("KS4_LEVEL2_EM", "KS4_LEVEL2_EM_PTQ").alias("ks4_level2"),
        _pick("KS4_PTSCNEWE_PTQ", "KS4_PTSCNEWE").alias("ks4_best8_score"),
        _pick("KS4_APENG_PTQ", "KS4_APENG").alias("ks4_english_grade"),
        _pick("KS4_HPGENG_PTQ", "KS4_HPGENG").alias("ks4_english_points"),
        _pick("KS4_HGMATH_PTQ", "KS4_HGMATH").alias("ks4_maths_grade"),
        _pick("KS4_HPGMATH_PTQ", "KS4_HPGMATH").alias("ks4_maths_points"),
    )
    b = ks4_b.select(
        *common,
        _pick("KS4_LEVEL2_EM_PTQ_EE", "KS4_LEVEL2_EM_94").alias("ks4_level2"),
        F.when(F.col("KS4_ACADYR") == "2014/2015", F.col("KS4_PTSCNEWE_PTQ_EE")).otherwise(F.col("KS4_ATT8"))
        .alias("ks4_best8_score"),
        _pick("KS4_APENG_PTQ_EE", "KS4_APENG_91").alias("ks4_english_grade"),
        F.col("KS4_HPGENG_PTQ_EE").alias("ks4_english_points"),
        _pick("KS4_HGMATH_PTQ_EE", "KS4_HGMATH_91").alias("ks4_maths_grade"),
        F.col("KS4_HPGMATH_PTQ_EE").alias("ks4_maths_points"),
    )
    d = a.unionByName(b)
    order = [F.col(c).desc_nulls_first() for c in ("ks4_dfe_national_result_included", "ks4_level2", "ks4_best8_score")]
    return keep_first(d, ["dfe_id", "ks4_academic_year_start"], [*order, *_tie_break(d.columns)])


def ks5_best(ks5_a: DataFrame, ks5_b: DataFrame) -> DataFrame:
    """KS5 from 2013/2014: the record with the most points per pupil-year, plus
    the best AS and A-level maths grades over all of that pupil-year's records
    (grades outside the scale count as missing)."""
    common = [
        F.col("KS5_PupilMatchingRefAnonymous").alias("dfe_id"),
        academic_year_start("KS5_ACADYR").alias("ks5_academic_year_start"),
    ]
    tail = [
        F.col("KS5_NFTYPE").alias("ks5_school_type_aat"),
        F.col("KS5_GENDER").alias("ks5_gender"),
        F.col("KS5_YEAROFBIRTH").alias("ks5_birth_year"),
        F.col("KS5_MONTHOFBIRTH").alias("ks5_birth_month"),
        F.col("KS5_TOTPTSE_ALEV").alias("ks5_total_points"),
        F.col("KS5_GAS_MATH").alias("ks5_aslevel_maths_grade"),
        F.col("KS5_GA_MATH").alias("ks5_alevel_maths_grade"),
    ]
    a = ks5_a.filter(F.col("KS5_ACADYR") >= "2013/2014").select(
        *common, F.col("ks5_laestab_anon").alias("ks5_school_id"),
        F.col("KS5_ToE_CODE").alias("ks5_school_type_edubase"), *tail
    )
    b = ks5_b.select(
        *common, F.lit(None).cast("string").alias("ks5_school_id"),
        F.lit(None).cast("string").alias("ks5_school_type_edubase"), *tail
    )
    d = a.unionByName(b)
    keys = ["dfe_id", "ks5_academic_year_start"]
    # one aggregate a pupil-year: the record with the most points (missing points
    # and grades first), and the best grades over all of its records
    kept = [c for c in d.columns if c not in ("ks5_aslevel_maths_grade", "ks5_alevel_maths_grade")]
    points = F.col("ks5_total_points")
    order = F.struct(points.isNotNull(), -points, *_missing_first(
        ["ks5_alevel_maths_grade", "ks5_aslevel_maths_grade", *d.columns]))
    best = d.groupBy(*keys).agg(
        F.min_by(F.struct(*[c for c in kept if c not in keys]), order).alias("_r"),
        F.min(ordinal_rank("ks5_aslevel_maths_grade", KS5_GRADES)).alias("_as"),
        F.min(ordinal_rank("ks5_alevel_maths_grade", KS5_GRADES)).alias("_a"),
    )
    return best.select(
        *[c if c in keys else F.col(f"_r.{c}").alias(c) for c in kept],
        ordinal_label("_as", KS5_GRADES).alias("ks5_aslevel_maths_grade"),
        ordinal_label("_a", KS5_GRADES).alias("ks5_alevel_maths_grade"),
    )


def cohort_pupils(cohort: DataFrame) -> DataFrame:
    """(dfe_id, school_start_year) of cohort members with a pupil id."""
    return cohort.filter(F.col("dfe_id").isNotNull()).select(
        "dfe_id", school_start_year("min_dob").cast("int").alias("school_start_year")
    )


def education_combined(pupils: DataFrame, ks1_census: DataFrame, ks1: DataFrame, ks2: DataFrame,
                       ks4: DataFrame, ks5: DataFrame) -> DataFrame:
    """Per pupil, of each key stage the record of the latest year not after school
    start + its offset (a bounded backward as-of pick); pupils without any are left
    out.  A pupil id with several start years takes the latest one.

    A record's time is its year less the offset, so that one pick over all key
    stages is bounded by the start year."""
    bound = pupils.groupBy("dfe_id").agg(F.max("school_start_year").alias("_ssy"))
    parts = [
        (ks1_census, "census_academic_year_start", "ks1_census"),
        (ks1, "ks1_academic_year_start", "ks1"),
        (ks2, "ks2_academic_year_start", "ks2"),
        (ks4, "ks4_academic_year_start", "ks4"),
        (ks5, "ks5_academic_year_start", "ks5"),
    ]
    picked = asof_latest(bound, [(df, F.col(year) - KS_OFFSETS[name]) for df, year, name in parts], ["dfe_id"], "_ssy",
                         tie_break=[lambda c: F.col(c).asc_nulls_first()])
    picked = picked.filter(F.coalesce(*[F.col(f"_r{i}").isNotNull() | F.lit(None) for i in range(len(parts))], F.lit(False)))
    return picked.select("dfe_id", *[F.col(f"_r{i}.{c}").alias(c)
                                     for i, (df, _, _) in enumerate(parts) for c in df.columns if c != "dfe_id"])


# --------------------------------------------------------------------------- SEN and absence

# SEN provision severity and enrolment preference.
SEN_ORDER = {"N": 0, "A": 1, "P": 2, "Q": 3, "S": 4, "K": 5, "E": 6}
ENROL_ORDER = {"C": 1, "M": 2, "S": 3, "F": 4, "O": 5, "G": 6}
SEN_VALUES = ["sen_NC_year_actual", "sen_status", "sen_primary_type", "sen_secondary_type",
              "sen_any_special_provision"]
NOMINAL_YEARS = list(range(-2, 14))


def sen_best_record(census: DataFrame) -> DataFrame:
    """Per pupil-year the census record with the most severe SEN provision
    (then record status, missing first; then enrolment preference), and
    whether any record of that pupil-year has special provision."""
    d = census.select(
        "dfe_id",
        academic_year_start("census_academic_year").alias("academic_year_start"),
        "census_record_status", "census_enrol_status", "census_NC_year_actual", "census_SEN_status",
        "census_SEN_primary_type", "census_SEN_secondary_type", "census_special_provision_indicator",
        decode("census_SEN_status", SEN_ORDER).alias("_sen"),
        decode("census_enrol_status", ENROL_ORDER).alias("_enrol"),
    )
    keys = ["dfe_id", "academic_year_start"]
    # severity: greatest first, missing last
    order = F.struct(F.col("_sen").isNull(), -F.col("_sen"), *_missing_first(["census_record_status"]),
                     F.col("_enrol").isNull(), F.col("_enrol"),
                     *_missing_first(["census_SEN_status", "census_NC_year_actual", "census_SEN_primary_type",
                                      "census_SEN_secondary_type"]))
    best = d.groupBy(*keys).agg(
        F.min_by(F.struct("census_NC_year_actual", "census_SEN_status", "census_SEN_primary_type",
                          "census_SEN_secondary_type"), order).alias("_r"),
        F.max(flag(F.col("census_special_provision_indicator").isin("1"))).alias("_special"),
    )
    known = F.col("dfe_id").isNotNull() & F.col("academic_year_start").isNotNull()
    return best.select(
        *keys,
        F.col("_r.census_NC_year_actual").alias("sen_NC_year_actual"),
        F.col("_r.census_SEN_status").alias("sen_status"),
        F.col("_r.census_SEN_primary_type").alias("sen_primary_type"),
        F.col("_r.census_SEN_secondary_type").alias("sen_secondary_type"),
        F.when(known, F.col("_special")).alias("sen_any_special_provision"),
    )


def sen_absence_long(pupils: DataFrame, sen: DataFrame, absence: DataFrame) -> DataFrame:
    """SEN and absence per cohort pupil-year (FULL JOIN, keys coalesced),
    duplicate pupil-years repaired by pairing their SEN-only and absence-only
    rows, restricted to nominal years Y-2..Y13.

    ``sen`` and ``absence`` have one row a pupil-year, so only a pupil id that
    occurs several times in ``pupils`` repeats a pupil-year.  ``_k`` counts a
    pupil id's rows and ``_m`` those of the same start year; with them the
    repair is a rule on the row of a single join.  Of a repeated pupil-year

    * a row with one side only stays; without a school year it is both the
      SEN-only and the absence-only row of its start year, and each pairs with
      each (``_m`` rows instead of one);
    * a row with both sides stays as absence only if it has no school year, and
      goes otherwise.
    """
    keys = ["dfe_id", "academic_year_start"]
    counts = {"_k": Window.partitionBy("dfe_id"), "_m": Window.partitionBy("dfe_id", "school_start_year")}
    p = pupils.withColumns({c: F.count(F.lit(1)).over(w) for c, w in counts.items()})
    p = p.withColumnRenamed("school_start_year", "_ssy").select("dfe_id", F.struct("_ssy", "_k", "_m").alias("_p"))
    # a pupil-year without a year has no nominal year
    s = p.join(sen.filter(F.col("academic_year_start").isNotNull()), "dfe_id")
    s = s.select(*keys, F.col("_p").alias("_ps"), *SEN_VALUES)
    a = p.join(absence.filter(F.col("abs_academic_year_start").isNotNull()), "dfe_id")
    a = a.select("dfe_id", F.col("abs_academic_year_start").alias("academic_year_start"), F.col("_p").alias("_pa"),
                 *ABS_VALUES)
    j = full_merge(s, a, keys).withColumn("_p", F.coalesce("_ps", "_pa"))
    ssy = F.coalesce(F.col("_ps._ssy"), F.col("_pa._ssy"))
    single = F.col("_p._k") == 1
    no_absence, no_year = F.col("abs_records").isNull(), F.col("sen_NC_year_actual").isNull()
    j = j.withColumn("_ssy", ssy).filter(single | no_absence | no_year)
    both = ~single & F.col("_ps").isNotNull() & F.col("_pa").isNotNull()
    paired = ~single & no_absence & no_year
    times = F.explode(F.sequence(F.lit(1), F.when(paired, F.col("_p._m")).otherwise(F.lit(1)).cast("int"))).alias("_t")
    nominal = F.col("academic_year_start") - F.col("_ssy")
    j = j.withColumn("_nominal", nominal).filter((F.col("_nominal") > -3) & (F.col("_nominal") < 14))
    return j.select(
        "dfe_id",
        F.concat(F.lit("Y"), F.format_string("%02d", F.col("_nominal"))).alias("senabs_school_year_nominal"),
        F.col("academic_year_start").alias("senabs_academic_year_start"),
        *[F.when(~both, F.col(c)).alias(c) for c in SEN_VALUES], *ABS_VALUES, times,
    ).drop("_t")


def repeated_pupil_years(long: DataFrame) -> DataFrame:
    """How many pupil-years have more than one row."""
    return duplicate_keys(long, ["dfe_id", "senabs_academic_year_start"]).agg(
        F.count(F.lit(1)).alias("repeated_pupil_years"))


SENABS_VARIABLES = ["senabs_academic_year_start", *SEN_VALUES, *ABS_VALUES]


def nominal_label(n: int) -> str:
    return f"Y{n:02d}"


def sen_absence_wide(long: DataFrame, on_duplicate: str = "fail") -> DataFrame:
    """One row per pupil, ``<variable>_Y<nn>`` for 15 variables x Y-2..Y13.

    A pupil-year with two rows stops the run, or (``"first"``) gives the whole
    row that is first in the order of its values."""
    labels = [nominal_label(n) for n in NOMINAL_YEARS]
    return pivot_arrays(
        long, ["dfe_id"], "senabs_school_year_nominal", labels, SENABS_VARIABLES,
        name=lambda stem, lab: f"{stem}_{lab}", on_duplicate=on_duplicate,
    )
