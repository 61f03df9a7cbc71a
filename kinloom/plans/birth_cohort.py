"""Birth cohort: infant selection, per-episode birth flags, timeline anchoring,
the per-person summary, and its enrichment with registrations,
notifications and the pupil-id crosswalk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.dates import DATE_SENTINELS, DOB_SENTINELS, clean_date, days_between, months_diff, parse_mmyyyy
from ..functions.values import any_of, clean_int, flag, nullif_empty
from ..operators.link import semi_reduce
from ..operators.select import first_value_by, rank_skew_safe

DATE_FIELDS = ["admidate", "epistart", "epiend", "disdate"]
DIAG_FIELDS = [f"diag_{k:02d}" for k in range(1, 21)]
HRG_FIELDS = ["hrgnhs", "sushrg", "suscorehrg"]
INT_AGE_FIELDS = ["activage", "admiage"]
CODED_AGE_FIELDS = ["startage", "endage"]


def _mmyyyy_of(c: str) -> Column:
    """'YYYY-MM-DD' text -> 'MMYYYY' (NULL stays NULL)."""
    return F.concat(F.substring(c, 6, 2), F.substring(c, 1, 4))


def infant_records(episodes: DataFrame) -> DataFrame:
    """All completed episodes of persons with any infant episode.

    A person qualifies when a completed episode has a neonatal age code at
    start or end, or when the month of birth equals the month of any of the
    four episode dates.  The qualifying ids (deduplicated) reduce the episodes
    by a left-semi join, so no episode is duplicated.
    """
    return semi_reduce(completed(episodes), infant_ids(episodes), "token_person_id")


def completed(episodes: DataFrame) -> DataFrame:
    return episodes.filter(F.col("epistat") == "3")


def infant_ids(episodes: DataFrame) -> DataFrame:
    """The persons of ``infant_records``, once each."""
    return completed(episodes).filter(_qualifies()).select("token_person_id").distinct()


def _qualifies() -> Column:
    dob = F.col("mydob")
    month_match = ~dob.isin(*DOB_SENTINELS) & any_of(
        [dob == _mmyyyy_of(c) for c in DATE_FIELDS]
    )
    return F.col("startage").isin(*C.NEONATAL_AGE_CODES) | F.col("endage").isin(*C.NEONATAL_AGE_CODES) | month_match


def infant_persons(episodes: DataFrame) -> DataFrame:
    """``infant_ids`` with ``PERSON_DATES`` of all their records, in one aggregate of
    fixed-width values, so that the timeline needs no aggregate and join of its own."""
    first = F.least(*[clean_date(c, DATE_SENTINELS, empty_is_null=False) for c in DATE_FIELDS])
    rows = completed(episodes).select("token_person_id", _qualifies().alias("_infant"), first.alias("episode_min_date"))
    persons = rows.groupBy("token_person_id").agg(F.max("_infant").alias("_infant"), *_person_dates())
    return persons.filter(F.col("token_person_id").isNotNull() & F.col("_infant")).drop("_infant")


PERSON_DATES = ["min_recorded_date", "any_missing_episode_min_date"]


def _person_dates() -> list[Column]:
    return [F.min("episode_min_date").alias("min_recorded_date"),
            F.max(flag(F.col("episode_min_date").isNull())).alias("any_missing_episode_min_date")]


def flagged_records(episodes: DataFrame, ids: DataFrame) -> DataFrame:
    """The flags of the infant records, ``SUMMARY_INPUT_COLUMNS``; with the persons of
    ``infant_persons``, not only their ids, also ``PERSON_DATES``.

    A row's flags need no other row, so they are made before the join, which
    then moves these few columns and not the 20 diagnosis fields."""
    flags = birth_record_flags(clean_infant_records(completed(episodes))).select(*SUMMARY_INPUT_COLUMNS)
    if set(PERSON_DATES) <= set(ids.columns):
        return flags.join(ids.select("token_person_id", *PERSON_DATES).hint("shuffle_hash"), "token_person_id")
    return semi_reduce(flags, ids, "token_person_id")


def clean_infant_records(records: DataFrame) -> DataFrame:
    """Typed, sentinel-free view of the infant records (dates, DOB, ages)."""
    cols = {c: clean_date(c, DATE_SENTINELS, empty_is_null=False) for c in DATE_FIELDS}
    cols["mydob"] = parse_mmyyyy("mydob")
    cols.update({c: F.substring(c, 1, 4) for c in DIAG_FIELDS})
    cols.update({c: clean_int(c, ("", "999")) for c in INT_AGE_FIELDS})
    cols.update({c: nullif_empty(c) for c in CODED_AGE_FIELDS})
    cols["epiorder"] = clean_int("epiorder", ("", "98", "99"))
    return records.withColumns(cols)


def _codes_any(codes: Column, values) -> Column:
    """Any element of the code array is one of ``values`` (never NULL)."""
    return F.coalesce(F.arrays_overlap(codes, F.array(*[F.lit(v) for v in values])), F.lit(False))


def birth_record_flags(clean: DataFrame) -> DataFrame:
    """Adds ``resgor_england`` (1/0/NULL), ``episode_min_date`` and five 0/1
    episode flags: birth, termination, stillbirth, singleton, multiple.

    The 20 diagnosis fields are tested as one array (``arrays_overlap`` with a
    hashed literal set) instead of 20 OR-ed predicates per code list.
    """
    ry = F.col("reporting_year_start")
    resgor, cr = F.col("resgor"), F.col("cr_residence")
    before, after = ry < C.RESIDENCE_SWITCH_YEAR, ry >= C.RESIDENCE_SWITCH_YEAR
    resgor_england = (
        F.when(before & resgor.isin(*C.ENGLAND_RESGOR), 1)
        .when(after & (F.length(cr) == 3) & (cr != "Q99"), 1)
        .when(before & resgor.isin(*C.NON_ENGLAND_RESGOR), 0)
        .when(after & cr.isin(*C.NON_ENGLAND_CR_RESIDENCE), 0)
    )
    d4 = F.array(*[F.substring(c, 1, 4) for c in DIAG_FIELDS])
    d3 = F.array(*[F.substring(c, 1, 3) for c in DIAG_FIELDS])
    h3 = F.array(*[F.substring(h, 1, 3) for h in HRG_FIELDS])
    h4 = F.array(*[F.substring(h, 1, 4) for h in HRG_FIELDS])
    birth = any_of(
        [
            _codes_any(d3, C.BIRTH_DIAG_3CHAR),
            _codes_any(h3, C.BIRTH_HRG_3CHAR),
            _codes_any(h4, C.BIRTH_HRG_4CHAR),
            F.col("epitype").isin(*C.BIRTH_EPITYPE),
            F.col("classpat").isin(*C.BIRTH_CLASSPAT),
            F.col("admimeth").isin(*C.BIRTH_ADMIMETH),
            F.col("neocare").isin(*C.BIRTH_NEOCARE),
        ]
    )
    termination = _codes_any(d4, C.TERMINATION_DIAG_4CHAR)
    stillbirth = any_of(
        [
            _codes_any(d3, C.STILLBIRTH_DIAG_3CHAR),
            _codes_any(d4, C.STILLBIRTH_DIAG_4CHAR),
            F.col("dismeth").isin(*C.STILLBIRTH_DISMETH),
            F.col("birstat").isin(*C.STILLBIRTH_BIRSTAT),
        ]
    )
    singleton = _codes_any(d4, C.SINGLETON_DIAG_4CHAR)
    multiple = any_of(
        [
            _codes_any(d4, C.MULTIPLE_DIAG_4CHAR),
            F.col("birordr").isin(*C.MULTIPLE_BIRORDR),
            F.col("numbaby").isin(*C.MULTIPLE_NUMBABY),
        ]
    )
    return clean.withColumns(
        {
            "resgor_england": resgor_england,
            "episode_min_date": F.least(*[F.col(c) for c in DATE_FIELDS]),
            "birth_record": flag(birth),
            "termination_record": flag(termination),
            "stillbirth_record": flag(stillbirth),
            "singleton_diag_birth_record": flag(singleton),
            "multiple_birth_record": flag(multiple),
        }
    )


# columns the timeline and person summary read from the flagged records
SUMMARY_INPUT_COLUMNS = [
    "token_person_id", "epikey", "reporting_year_start", "episode_min_date", "epistart", "epiend", "epiorder",
    "mydob", "startage", "endage", "sex", "sexbaby", "activage", "admiage", "resgor_england", "birth_record",
    "termination_record", "stillbirth_record", "singleton_diag_birth_record", "multiple_birth_record",
]

# person timeline order: earliest episode first, missing dates last, unique by epikey
TIMELINE_ORDER = ["episode_min_date", "epistart", "epiorder", "epikey"]


def timeline_anchor(flagged: DataFrame, with_record_order: bool = True) -> DataFrame:
    """Per episode: ``record_order`` on the person timeline, days since the
    person's first record, months after DOB (calendar-month boundaries), the
    person's first date and whether any of their episodes lacks all dates.

    The per-person aggregates come with the rows (``infant_persons``); if they do
    not, they are computed with a partial-aggregating ``groupBy`` and joined back
    (AQE splits a hot person on the join).
    ``record_order`` is a full ranking of each person's episodes; it uses the
    skew-safe ranking (a very large person is ranked in slices), and is
    skipped when the caller does not need it.
    """
    if not set(PERSON_DATES) <= set(flagged.columns):
        flagged = flagged.join(flagged.groupBy("token_person_id").agg(*_person_dates()), "token_person_id")
    out = flagged.withColumns(
        {
            "days_since_min_recorded_date": days_between("min_recorded_date", "episode_min_date"),
            "months_after_dob": months_diff("mydob", "episode_min_date"),
        }
    )
    if with_record_order:
        out = rank_skew_safe(out, ["token_person_id"], TIMELINE_ORDER, "record_order")
    return out


def _timeline_key() -> list[Column]:
    return [F.col(c) for c in TIMELINE_ORDER]


def person_summary(anchored: DataFrame) -> DataFrame:
    """One row per person: counts, any-flags near birth, earliest valid sex and
    baby sex, smallest coded neonatal age with its date, earliest residency.

    Everything is one ``groupBy`` with conditional aggregates; the "value at
    the earliest qualifying record" picks are ``min_by`` over a struct of the
    timeline order, so no self-joins are needed and the aggregation combines
    map-side even for a very large person group.
    """
    near = F.abs(F.col("months_after_dob")) < 2
    neonatal = C.NEONATAL_AGE_CODES
    start_ok = F.col("startage").isin(*neonatal) & F.col("epistart").isNotNull()
    end_ok = F.col("endage").isin(*neonatal) & F.col("epiend").isNotNull()
    # NOT IN keeps three-valued logic: a NULL start age yields a NULL age
    use_end = (~F.col("startage").isin(*neonatal) | F.col("epistart").isNull()) & end_ok
    epiage = F.when(start_ok, F.col("startage").cast("int")).when(use_end, F.col("endage").cast("int"))
    epidate = F.when(start_ok, F.col("epistart")).when(use_end, F.col("epiend"))
    age_pick = first_value_by(F.struct(epiage.alias("a"), epidate.alias("d")), [epiage, epidate, F.col("epikey")],
                              where=start_ok | end_ok)
    res_pick = first_value_by(
        F.struct(F.col("resgor_england").alias("r"), F.col("episode_min_date").alias("d")),
        _timeline_key(),
        where=F.col("resgor_england").isNotNull() & F.col("episode_min_date").isNotNull(),
    )
    valid_sex = F.col("sex").isin("1", "2")
    valid_sexbaby = F.col("sexbaby").isin("1", "2")

    def any_near(col: str) -> Column:
        return F.max(flag((F.col(col) == 1) & near))

    agg = anchored.groupBy("token_person_id").agg(
        F.max("any_missing_episode_min_date").alias("any_missing_episode_min_date"),
        # distinct counts over a two-value domain as flags: with several distinct
        # aggregates every row would be replicated through the shuffle
        (F.max(flag(F.col("sex") == "1")) + F.max(flag(F.col("sex") == "2"))).cast("long").alias("n_sex"),
        any_near("birth_record").alias("any_birth_record"),
        any_near("termination_record").alias("any_termination_record"),
        any_near("stillbirth_record").alias("any_stillbirth_record"),
        any_near("multiple_birth_record").alias("any_multiple_birth_record"),
        any_near("singleton_diag_birth_record").alias("any_singleton_diag_birth_record"),
        F.sum(flag(near)).alias("records_within_1_month_of_dob"),
        F.count(F.lit(1)).alias("records"),
        F.sum(flag(F.col("days_since_min_recorded_date") < 29)).alias("recs_28days"),
        F.sum(flag(F.col("days_since_min_recorded_date") <= 3 * 365)).alias("recs_3yrs"),
        F.min("reporting_year_start").alias("reporting_year_start"),
        F.max(flag(near & (F.col("startage").isin(*neonatal) | F.col("endage").isin(*neonatal)))).alias("any_baby"),
        F.min(F.when(near & F.col("startage").isin(*neonatal), F.col("startage").cast("int"))).alias("min_startage"),
        F.min(F.when(near & F.col("endage").isin(*neonatal), F.col("endage").cast("int"))).alias("min_endage"),
        F.min("months_after_dob").alias("min_months_after_dob"),
        F.min("episode_min_date").alias("first_admi"),
        F.max("episode_min_date").alias("last_admi"),
        F.min("mydob").alias("min_dob"),
        # the one distinct aggregate: bounded state whatever an id collects
        F.count_distinct(F.col("mydob")).alias("n_dob"),
        F.least(*[F.min(c) for c in INT_AGE_FIELDS]).alias("min_age"),
        F.greatest(*[F.max(c) for c in INT_AGE_FIELDS]).alias("max_age"),
        first_value_by(F.col("sex"), _timeline_key(), where=valid_sex).alias("sex_earliest"),
        first_value_by(F.col("sexbaby"), _timeline_key(), where=valid_sexbaby & near).alias("sexbaby_earliest"),
        F.count_if(near).alias("_n_near"),
        (F.max(flag(near & (F.col("sexbaby") == "1"))) + F.max(flag(near & (F.col("sexbaby") == "2"))))
        .cast("long").alias("_n_sexbaby"),
        age_pick.alias("_age"),
        res_pick.alias("_res"),
    )
    return agg.select(
        *[c for c in agg.columns if not c.startswith("_")],
        # no record near birth -> NULL (not 0), as the count comes from a filtered subquery
        F.when(F.col("_n_near") > 0, F.col("_n_sexbaby")).alias("n_sexbaby"),
        F.col("_age.a").alias("min_epiage"),
        F.col("_age.d").alias("min_epiage_epidate"),
        F.col("_res.r").alias("resgor_england"),
        months_diff("min_dob", F.col("_res.d")).alias("resgor_england_months_since_min_dob"),
    )


REGISTRATION_FIELDS = [
    "birth_records",
    "birth_registration_date",
    "birth_sex",
    "birth_stillbirth_records",
    "death_records",
    "death_date",
    "death_date_year_precision_only",
]
NOTIFICATION_FIELDS = [
    "notification_dob",
    "notification_ethnicity",
    "notification_sex",
    "notification_stillbirth",
    "notification_num_births",
]


def birth_cohort(summary: DataFrame, registrations: DataFrame, notifications: DataFrame, ids: DataFrame) -> DataFrame:
    """Person summary LEFT JOIN registrations, notifications and the id lookup.

    All four inputs are person grain; AQE broadcasts a side only when its
    measured size is under the threshold and otherwise sort-merge joins.
    """
    reg = registrations.select("token_person_id", *REGISTRATION_FIELDS)
    notif = notifications.select("token_person_id", *NOTIFICATION_FIELDS)
    out = summary.join(reg, "token_person_id", "left").join(notif, "token_person_id", "left")
    lk = ids.select(F.col("nhs_id").alias("token_person_id"), "dfe_id", "dfe_id_problematic")
    return out.join(lk, "token_person_id", "left")
