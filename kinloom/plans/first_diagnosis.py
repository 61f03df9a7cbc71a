"""First diagnosis per person and diagnosis group (cancer slots, congenital groups)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.dates import clean_date
from ..functions.values import any_of, flag
from ..operators.link import code_join
from ..operators.observe import Counted, stop_on
from ..operators.quality import count_where
from ..operators.reshape import pivot_slots
from ..operators.select import rank_within
from ..sources.casts import DATE_PLACEHOLDERS, bad_date

DATE_FIELDS = ["admidate", "epistart", "epiend", "disdate"]
CANCER_SLOTS = [1, 2, 3, 4]


def _with_dates(df: DataFrame) -> DataFrame:
    """Parsed dates, their earliest, and whether any text could not be parsed."""
    parsed = {c: clean_date(c, sentinels=DATE_PLACEHOLDERS) for c in DATE_FIELDS}
    out = df.withColumn("_bad_text", any_of([bad_date(c) for c in DATE_FIELDS])).withColumns(parsed)
    return out.withColumn("min_date", F.least(*[F.col(c) for c in DATE_FIELDS]))


def guards() -> dict[str, Column]:
    """What must not occur on coded rows: no date at all, or date text that cannot be parsed."""
    return {"all dates missing": F.col("min_date").isNull(), "unparseable date text": F.col("_bad_text")}


def _guarded(coded: DataFrame, on_missing: str) -> DataFrame:
    """For callers without a pipeline: ``fail`` counts the guards and raises,
    ``report``, an explicit choice, goes on without the undated rows."""
    if on_missing not in ("fail", "report"):
        raise ValueError(f"on_missing: {on_missing}")
    if on_missing == "fail":
        count = Counted()
        count(coded, "diagnoses", guards())
        stop_on(count.counts(), "first diagnosis")
    return coded


def cancer_diagnoses(diagnoses: DataFrame, codes: DataFrame) -> DataFrame:
    """Primary-position diagnoses in the cancer code list, with parsed dates."""
    return cancer_coded(diagnoses, codes).drop("_bad_text")


def cancer_coded(diagnoses: DataFrame, codes: DataFrame) -> DataFrame:
    """``cancer_diagnoses`` with ``_bad_text``: a date text could not be parsed."""
    primary = diagnoses.filter(F.col("diagnostic_position") == 1)
    joined = code_join(primary, codes, stems=C.stems(C.cancer_code_rows()))
    return _with_dates(
        joined.select("cancer_group", "token_person_id", "reporting_year_start", "epikey", "diagnostic_position",
                      *DATE_FIELDS)
    )


def first_cancer_slots(diagnoses: DataFrame, codes: DataFrame, on_missing: str = "fail") -> DataFrame:
    """``cancer_slots`` of the coded diagnoses, after the guards."""
    return cancer_slots(_guarded(cancer_coded(diagnoses, codes), on_missing))


def cancer_slots(coded: DataFrame) -> DataFrame:
    """Per person, up to four cancer groups ordered by first diagnosis date.

    ``coded``: from ``cancer_coded``; rows without any date are left out.

    Per person and group: earliest admission date; it is replaced by the
    earliest of any date when that is earlier; a person-group whose
    admission dates are all missing keeps a NULL ``earliest_diagnosis`` and is
    flagged problematic.  Ties on the first date are broken by group name.
    Columns ``cancer_group_<n>``, ``cancer_earliest_diagnosis_<n>``,
    ``cancer_earliest_diagnosis_problematic_<n>`` for n = 1..4.
    """
    dated = coded.filter(F.col("min_date").isNotNull())
    per_group = dated.groupBy("token_person_id", "cancer_group").agg(
        F.min("admidate").alias("earliest_admidate"),
        F.max(flag(F.col("admidate").isNull())).alias("admidate_missing"),
        F.min("min_date").alias("min_date"),
    )
    later = F.col("earliest_admidate") > F.col("min_date")
    slots = per_group.select(
        "token_person_id",
        "cancer_group",
        F.when(later, F.col("min_date")).otherwise(F.col("earliest_admidate")).alias("earliest_admission"),
        flag((F.col("admidate_missing") == 1) | later).alias("problematic"),
        rank_within(["token_person_id"], ["min_date", "cancer_group"]).alias("diagnosis_order"),
    )
    return pivot_slots(
        slots,
        ["token_person_id"],
        "diagnosis_order",
        CANCER_SLOTS,
        {
            "group": "cancer_group",
            "earliest_diagnosis": "earliest_admission",
            "earliest_diagnosis_problematic": "problematic",
        },
        name=lambda stem, n: f"cancer_{stem}_{n}",
        on_duplicate="unique",  # diagnosis_order numbers a person's groups, of which the list has as many as slots
    )


def congenital_diagnoses(diagnoses: DataFrame, codes: DataFrame) -> DataFrame:
    """Diagnoses at any position in the congenital inclusion list, with dates."""
    return congenital_coded(diagnoses, codes).drop("_bad_text")


def congenital_coded(diagnoses: DataFrame, codes: DataFrame) -> DataFrame:
    """``congenital_diagnoses`` with ``_bad_text``: a date text could not be parsed."""
    joined = code_join(diagnoses, codes, stems=C.stems(C.congenital_code_rows()))
    return _with_dates(joined.select("token_person_id", "ca_group", *DATE_FIELDS)).select(
        "token_person_id", "ca_group", "min_date", "_bad_text"
    )


def first_congenital(diagnoses: DataFrame, codes: DataFrame, on_missing: str = "fail") -> DataFrame:
    """``congenital_groups`` of the coded diagnoses, after the guards."""
    return congenital_groups(_guarded(congenital_coded(diagnoses, codes), on_missing))


def congenital_groups(coded: DataFrame) -> DataFrame:
    """Per person, first date of each congenital group (``ca_<group>``).

    ``coded``: from ``congenital_coded``; rows without any date are left out.

    ``other`` becomes the earliest of other / Down syndrome /
    neurofibromatosis / tuberous sclerosis; the gestation-dependent group is
    blanked when ``other`` is not later than it.
    """
    dated = coded.filter(F.col("min_date").isNotNull())
    wide = dated.groupBy("token_person_id").pivot("ca_group", C.CONGENITAL_GROUPS).agg(F.min("min_date"))
    other = F.least(*[F.col(g) for g in ("other", "down_syndrome", "neurofibromatosis", "tuberous_sclerosis")])
    wide = wide.withColumn("other", other)
    ga = F.col("ga_mte_37wks_only")
    wide = wide.withColumn("ga_mte_37wks_only", F.when(F.col("other") <= ga, F.lit(None)).otherwise(ga))
    return wide.withColumnsRenamed({g: f"ca_{g}" for g in C.CONGENITAL_GROUPS})


def undated(cancer: DataFrame, congenital: DataFrame) -> DataFrame:
    """Counts of coded rows that lack all four dates (one of the guards)."""
    parts = [count_where(df, F.col("min_date").isNull()).select(F.lit(name).alias("dataset"), F.col("n").alias("missing_all_dates"))
             for name, df in (("cancer", cancer), ("congenital", congenital))]
    return parts[0].unionByName(parts[1])


def missing_all_dates(diagnoses: DataFrame, cancer_codes: DataFrame, congenital_codes: DataFrame) -> DataFrame:
    """``undated`` of the diagnoses in the code lists."""
    return undated(cancer_diagnoses(diagnoses, cancer_codes), congenital_diagnoses(diagnoses, congenital_codes))


def unparseable_dates(diagnoses: DataFrame) -> DataFrame:
    """Per date field, how many diagnosis rows hold a text that is neither a
    date nor one of the stated placeholders (it would become NULL)."""
    one = diagnoses.agg(*[F.count_if(bad_date(c)).alias(c) for c in DATE_FIELDS])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("unparseable")) for c in DATE_FIELDS])
    return one.select(F.inline(pairs))
