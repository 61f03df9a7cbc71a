"""Which text of the raw extracts cannot be cast, by source and field.

Dates and numbers arrive as text.  A stated placeholder is missing; any other text
that is no date or number is bad: it would become NULL, so the stages that load a
source count it while they write (``operators.observe``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import (DOB_SENTINELS, academic_year_start, clean_date, parse_mmyyyy, parse_year_month,
                               parse_yyyymmdd_int)
from . import mappings as M

DATE_PLACEHOLDERS = ("", "1800-01-01", "1801-01-01")


def _bad(c: str, parsed: Column, placeholders: Iterable[str] = ()) -> Column:
    """A value that is neither missing, nor a placeholder, nor parsed."""
    stated = list(placeholders)
    there = F.col(c).isNotNull()
    return there & ~F.col(c).isin(*stated) & parsed.isNull() if stated else there & parsed.isNull()


def bad_date(c: str, placeholders: Iterable[str] = DATE_PLACEHOLDERS) -> Column:
    return _bad(c, clean_date(c, sentinels=placeholders), placeholders)


def bad_month(c: str, placeholders: Iterable[str] = ()) -> Column:
    return _bad(c, parse_mmyyyy(c, sentinels=()), placeholders)


def bad_number(c: str, placeholders: Iterable[str] = ()) -> Column:
    return _bad(c, F.col(c).try_cast("int"), placeholders)


def bad_academic_year(c: str) -> Column:
    return _bad(c, academic_year_start(c))


#: Source -> field -> the condition that its text is bad.  Columns are built on call: they need a session.
def episodes() -> dict[str, Column]:
    return {
        **{c: bad_date(c) for c in ("admidate", "epistart", "epiend", "disdate")},
        "mydob": bad_month("mydob", DOB_SENTINELS),
        "epiorder": bad_number("epiorder", ("", "98", "99")),
        **{c: bad_number(c, ("", "999")) for c in ("activage", "admiage")},
        "birweit": bad_number("birweit", ("9999",)),
        "matage": bad_number("matage", ("999",)),
        "gestat": bad_number("gestat", ("99",)),
    }


def civil_births() -> dict[str, Column]:
    return {"DOREG": bad_date("DOREG", ("",))}


def civil_deaths() -> dict[str, Column]:
    return {"REG_DATE_OF_DEATH": _bad("REG_DATE_OF_DEATH", parse_yyyymmdd_int("REG_DATE_OF_DEATH"))}


def birth_notifications() -> dict[str, Column]:
    return {"BABY_BIRTH_DATE": bad_month("BABY_BIRTH_DATE")}


def mother_baby_links() -> dict[str, Column]:
    return {
        **{c: bad_number(c, ("",)) for c in ("matage_clean", "gestat_clean", "birweit_clean")},
        "mdel_my": _bad("mdel_my", parse_year_month("mdel_my")),
    }


def _harmonised(mapping: dict, numbers: Iterable[str], year: str) -> dict[str, Column]:
    """By target name, so that the yearly tables' counts add up."""
    fields = {t: bad_number(mapping[t]) for t in sorted(numbers) if isinstance(mapping[t], str)}
    return fields | {year: bad_academic_year(mapping[year])}


def census(year: int) -> dict[str, Column]:
    return _harmonised(M.census_mapping(year), M.CENSUS_INT_TARGETS, "census_academic_year")


def absence(year: int) -> dict[str, Column]:
    mapping = M.absence_mapping(year)
    return _harmonised(mapping, set(mapping) - M.ABSENCE_TEXT_TARGETS, "abs_academic_year")


def key_stage(stage: str) -> dict[str, Column]:
    """``stage``: KS1, KS2, KS4 or KS5.  A mark of 'x' is a stated code."""
    marks = {c: bad_number(c, ("x",)) for c in ("KS2_READMRK", "KS2_MATMRK")} if stage == "KS2" else {}
    return {f"{stage}_ACADYR": bad_academic_year(f"{stage}_ACADYR"), **marks}
