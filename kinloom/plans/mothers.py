"""Mothers' delivery episode: for each (mother, delivery month) the best
completed hospital episode of the mother that starts in that month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DATE_SENTINELS, clean_date, months_diff, parse_year_month
from ..functions.values import decode
from ..operators.select import keep_first

DATE_FIELDS = ["admidate", "disdate", "epiend", "epistart"]

# Preference order of patient class and episode type for a delivery.
CLASSPAT_ORDER = {"5": 0, "8": 1}
EPITYPE_ORDER = {"2": 0, "5": 1, "3": 2, "6": 3}


def mothers_delivery_episode(links: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row per distinct (mother, delivery month) with a matching episode.

    The episodes, cut to the columns and dates that the pick needs, are joined once on
    (mother, month of the episode's earliest date) — an equi-join, because the month
    interval has equal bounds; it drops other persons as a semi-join before it would,
    and the best episode is picked where the join has put the rows.  Best episode:
    smallest month distance, episode-type order, patient-class order,
    earliest date, then episode key.
    """
    deliveries = links.select(
        F.col("mtokenid").alias("token_person_id"), "mdel_my"
    ).distinct().select("token_person_id", parse_year_month("mdel_my").alias("mb_mdel_my"))
    recs = episodes.filter(F.col("epistat") == "3")
    dates = {c: clean_date(c, DATE_SENTINELS, empty_is_null=False) for c in DATE_FIELDS}
    recs = recs.withColumns(dates).select(
        "token_person_id",
        "epikey",
        decode("classpat", CLASSPAT_ORDER, 2).alias("classpat_order"),
        decode("epitype", EPITYPE_ORDER, 4).alias("epitype_order"),
        "msoa01", "msoa11", "imd04_decile", "resgor", "cr_residence",
        F.least(*[F.col(c) for c in DATE_FIELDS]).alias("episode_min_date"),
        F.greatest(*[F.col(c) for c in DATE_FIELDS]).alias("episode_max_date"),
    ).withColumn("episode_min_month", F.trunc("episode_min_date", "MM"))
    j = deliveries.join(
        recs,
        (deliveries.token_person_id == recs.token_person_id) & (recs.episode_min_month == deliveries.mb_mdel_my),
    ).drop(recs.token_person_id)
    best = keep_first(
        j,
        ["token_person_id", "mb_mdel_my"],
        [
            F.abs(months_diff("mb_mdel_my", "episode_min_date")).asc_nulls_last(),
            F.col("epitype_order").asc_nulls_last(),
            F.col("classpat_order").asc_nulls_last(),
            F.col("episode_min_date").asc_nulls_last(),
            F.col("epikey").asc_nulls_last(),
        ],
    )
    return best.select(
        F.col("token_person_id").alias("mi_token_person_id_mother"),
        F.col("mb_mdel_my").alias("mi_mdel_my"),
        F.col("msoa01").alias("mi_msoa01"),
        F.col("msoa11").alias("mi_msoa11"),
        F.col("imd04_decile").alias("mi_imd04_decile"),
        F.col("resgor").alias("mi_resgor"),
        F.col("cr_residence").alias("mi_cr_residence"),
        F.col("episode_min_date").alias("mi_episode_min_date"),
        F.col("episode_max_date").alias("mi_episode_max_date"),
    )
