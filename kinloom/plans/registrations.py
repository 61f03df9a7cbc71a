"""Civil registrations, ID crosswalk and birth notifications (person grain)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import clean_date, parse_mmyyyy, parse_yyyymmdd_int
from ..functions.values import flag


def registrations_summary(births: DataFrame, deaths: DataFrame) -> DataFrame:
    """Births per person FULL JOIN deaths per person; absent counts are 0.

    Both sides are aggregated (partial aggregation, so a hot key is combined
    map-side) before the join; the join is then one row per key per side.
    """
    b = births.groupBy(F.col("TOKEN_PERSON_ID").alias("token_person_id")).agg(
        F.min(clean_date("DOREG", sentinels=())).alias("birth_registration_date"),
        F.min("SEX_CHILD").alias("birth_sex"),
        F.count(F.lit(1)).alias("birth_records"),
        F.sum(flag(F.col("STILLBIRTH_IND") == "1")).alias("birth_stillbirth_records"),
    )
    year_only = flag((F.col("REG_DATE_OF_DEATH") % 10000) == 0)
    d = deaths.groupBy(F.col("TOKEN_PERSON_ID").alias("token_person_id")).agg(
        F.min(parse_yyyymmdd_int("REG_DATE_OF_DEATH")).alias("death_date"),
        F.max(year_only).alias("death_date_year_precision_only"),
        F.count(F.lit(1)).alias("death_records"),
    )
    j = b.join(d, "token_person_id", "full")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "token_person_id",
        F.coalesce("birth_records", zero).alias("birth_records"),
        "birth_registration_date",
        "birth_sex",
        F.coalesce("birth_stillbirth_records", zero).alias("birth_stillbirth_records"),
        F.coalesce("death_records", zero).alias("death_records"),
        "death_date",
        "death_date_year_precision_only",
    )


def id_lookup(bridging: DataFrame) -> DataFrame:
    """One pupil id per person: the first in byte order, missing ids first;
    ``dfe_id_problematic`` = 1 when the person has more than one link row."""
    dfe = F.col("PUPIL_REF_MATCHING_ANONYMOUS")
    return bridging.groupBy(F.col("pseudo").alias("nhs_id")).agg(
        F.when(F.count_if(dfe.isNull()) > 0, F.lit(None)).otherwise(F.min(dfe)).alias("dfe_id"),
        flag(F.count(F.lit(1)) > 1).alias("dfe_id_problematic"),
    ).select("dfe_id", "nhs_id", "dfe_id_problematic")


def birth_notifications(notifications: DataFrame) -> DataFrame:
    return notifications.select(
        F.col("TOKEN_PERSON_ID").alias("token_person_id"),
        parse_mmyyyy("BABY_BIRTH_DATE", sentinels=()).alias("notification_dob"),
        F.col("BABY_ETHNICITY").alias("notification_ethnicity"),
        F.col("BABY_SEX").alias("notification_sex"),
        F.col("LIVE_STILL").alias("notification_stillbirth"),
        F.col("NUM_BIRTHS").alias("notification_num_births"),
    )
