"""Birth information (weight, gestation, mother's age) and ethnicity /
geography per person, each taken from the most suitable infant record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DATE_SENTINELS, clean_date, months_diff, parse_mmyyyy, parse_year_month
from ..functions.values import count_non_null, decode, flag, in_range_or_null, nullif_empty, nullif_in
from ..operators.link import full_merge
from ..operators.select import first_value_by

DATE_FIELDS = ["admidate", "disdate", "epiend", "epistart"]
# earliest episode first; unique by epikey
RECORD_ORDER = ["episode_min_date", "admidate", "epistart", "epiend", "epikey"]


def _dated(records: DataFrame) -> DataFrame:
    dates = {c: clean_date(c, DATE_SENTINELS, empty_is_null=False) for c in DATE_FIELDS}
    dates["mydob"] = parse_mmyyyy("mydob")
    out = records.withColumns(dates)
    out = out.withColumn("episode_min_date", F.least(*[F.col(c) for c in DATE_FIELDS]))
    return out.withColumn("months_since_dob", months_diff("mydob", "episode_min_date"))


def _of_persons(best: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Of one row a person, those of the persons ``ids`` (one row each).  The records are
    aggregated first, so that a task hands on a row a person and not all records.  An inner
    join: a semi-join would be pushed below the aggregate, and move every record."""
    return best if ids is None else best.join(ids.select("token_person_id").hint("shuffle_hash"), "token_person_id")


def birth_information(infant_records: DataFrame, links: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per person the first record within one month of birth that carries a
    birth weight, gestation or mother's age (``bi_valid`` = 1); persons with
    none get their first record (``bi_valid`` = 0).  FULL JOIN with the
    mother-baby links (which are not deduplicated).

    With ``ids`` (a row for each infant person) the records may be those of all persons.
    One aggregate whose first sort key is "usable and near birth" replaces the
    rank / filtered-rank / fallback-union chain.
    """
    d = _dated(infant_records).withColumns(
        {
            "birweit": nullif_in("birweit", ["9999"]).try_cast("int"),
            "matage": in_range_or_null(nullif_in("matage", ["999"]).try_cast("int"), 8, 60),
            "gestat": nullif_in("gestat", ["99"]).try_cast("int"),
        }
    )
    d = d.withColumn("num_non_null", count_non_null(["birweit", "matage", "gestat"]))
    usable = F.col("num_non_null") > 0
    d = d.withColumn("_near", F.coalesce(usable & (F.abs(F.col("months_since_dob")) < 2), F.lit(False)))
    # one aggregate a person: the first record, near ones before others, and the count
    fields = ["_near", "admidate", "episode_min_date", "gestat", "birweit", "matage", "sexbaby", "imd04_decile"]
    best = d.groupBy("token_person_id").agg(
        first_value_by(F.struct(*fields), [~F.col("_near"), *[F.col(c) for c in RECORD_ORDER]]).alias("_r"),
        F.sum(flag((F.col("months_since_dob") <= 95) & usable)).alias("bi_records_before_8yrs"),
    )
    bi = _of_persons(best, ids).select("token_person_id", "bi_records_before_8yrs", "_r.*").select(
        "token_person_id",
        flag(F.col("_near")).alias("bi_valid"),
        F.col("admidate").alias("bi_admidate"),
        F.col("episode_min_date").alias("bi_episode_min_date"),
        "bi_records_before_8yrs",
        F.col("gestat").alias("bi_gestat"),
        F.col("birweit").alias("bi_birweit"),
        F.col("matage").alias("bi_matage"),
        F.col("sexbaby").alias("bi_sexbaby"),
        F.col("imd04_decile").alias("bi_imd04_decile"),
    )
    mb = links.select(
        F.col("tokenid").alias("token_person_id"),
        F.col("mtokenid").alias("mb_token_person_id_mother"),
        F.col("matage_clean").try_cast("int").alias("mb_matage"),
        F.col("gestat_clean").try_cast("int").alias("mb_gestat"),
        F.col("birweit_clean").try_cast("int").alias("mb_birweit"),
        F.col("sexbaby_clean").alias("mb_sexbaby"),
        F.col("imd04_decile_cat_clean").alias("mb_imd04_decile"),
        parse_year_month("mdel_my").alias("mb_mdel_my"),
    )
    out = full_merge(bi, mb, ["token_person_id"])
    return out.withColumn("bi_valid", F.coalesce("bi_valid", F.lit(0)))


# Ethnicity coding (1995 digits recoded to 2001 letters) and broad groups.
ETHNICITY_1995 = [str(i) for i in range(10)]
ETHNICITY_2001 = ["A", "B", "C", "D", "E", "F", "G", "H", "J", "K", "L", "M", "N", "P", "R", "S", "X", "Z"]
ETHNICITY_KEPT = ["A", "B", "C", "D", "E", "F", "G", "H", "J", "K", "L", "M", "N", "P", "R", "S"]
ETHNICITY_RECODE = {"0": "A", "1": "M", "2": "N", "3": "P", "4": "H", "5": "J", "6": "K", "7": "R", "8": "8"}
ETHNICITY_BROAD = {
    "White": ["A", "B", "C"],
    "Mixed or multiple ethnic groups": ["D", "E", "F", "G"],
    "Asian or Asian British": ["H", "J", "K", "L", "R"],
    "Black, Black British, Caribbean or African": ["M", "N", "P"],
    "Other ethnic group": ["S"],
    "Mixed or multiple ethnic groups or Other ethnic group": ["8"],
}
ETHNICITY_SWITCH_YEAR = 2013


def ethnicity_geo(infant_records: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per person: valid ethnicity nearest to the birth month (and the number
    of distinct broad groups seen), and the area codes nearest to it; a person
    with either has a row.  ``ids`` as in ``birth_information``."""
    e = F.col("ethnos")
    ry = F.col("reporting_year_start")
    coding = (
        F.when(e.isin(*ETHNICITY_1995), 1995)
        .when(e.isin(*ETHNICITY_2001), 2001)
        .when((e == "99") & (ry < ETHNICITY_SWITCH_YEAR), 1995)
        .when((e == "99") & (ry >= ETHNICITY_SWITCH_YEAR), 2001)
    )
    ethnicity = decode(e, ETHNICITY_RECODE)
    ethnicity = ethnicity.when(e.isin(*ETHNICITY_KEPT), e)
    broad = None
    for label, codes in ETHNICITY_BROAD.items():
        cond = F.col("ethnicity").isin(*codes)
        broad = F.when(cond, F.lit(label)) if broad is None else broad.when(cond, F.lit(label))
    d = _dated(infant_records).withColumns(
        {
            "ethnicity_coding_system": coding,
            "ethnicity": ethnicity,
            "oacode6": nullif_empty("oacode6"),
            "msoa01": nullif_empty("msoa01"),
            "msoa11": nullif_empty("msoa11"),
        }
    ).withColumn("ethnicity_broad", broad)
    key = [F.abs(F.col("months_since_dob")), *[F.col(c) for c in RECORD_ORDER]]
    eth, geo = F.col("ethnicity").isNotNull(), F.col("msoa01").isNotNull()
    seen = [F.max(flag(F.col("ethnicity_broad") == g)) for g in ETHNICITY_BROAD]  # one flag for each broad group
    # both picks in one aggregate: the records are read and shuffled once
    best = d.filter(eth | geo).groupBy("token_person_id").agg(
        first_value_by(F.struct("ethnicity_broad", "ethnicity_coding_system", "months_since_dob"), key, where=eth).alias("_e"),
        F.when(F.count_if(eth) > 0, sum(seen[1:], seen[0])).cast("long").alias("eth_ethnicity_broad_n"),
        first_value_by(F.struct("oacode6", "msoa01", "msoa11", "months_since_dob"), key, where=geo).alias("_g"),
    )
    return _of_persons(best, ids).select(
        "token_person_id",
        F.col("_e.ethnicity_broad").alias("eth_ethnicity_broad"),
        F.col("_e.ethnicity_coding_system").alias("eth_ethnicity_coding_system"),
        F.col("_e.months_since_dob").alias("eth_months_since_dob"),
        "eth_ethnicity_broad_n",
        F.col("_g.oacode6").alias("geo_oacode6"),
        F.col("_g.msoa01").alias("geo_msoa01"),
        F.col("_g.msoa11").alias("geo_msoa11"),
        F.col("_g.months_since_dob").alias("geo_months_since_dob"),
    )
