"""Date parsing and calendar arithmetic as built-in Column expressions.

Raw extracts keep dates as text with sentinel values ('1800-01-01',
'1801-01-01', '') and partial forms (month of birth 'MMYYYY', delivery month
'YYYY?M').  Everything here returns a ``Column`` so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Sentinel texts that mean "date unknown" in the raw extracts.
DATE_SENTINELS = ("1800-01-01", "1801-01-01")
DOB_SENTINELS = ("011800", "011801")

_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def clean_date(c: str | Column, sentinels: Iterable[str] = DATE_SENTINELS, empty_is_null: bool = True) -> Column:
    """Text date -> DATE; sentinels, '' and unparseable text -> NULL.

    The regex guard keeps Spark from accepting partial forms ('2000',
    '2000-05') that a SQL ``TRY_CAST(... AS DATE)`` rejects.
    """
    c = as_col(c)
    bad = c.isin(*sentinels)
    if empty_is_null:
        bad = bad | (c == "")
    ok = c.rlike(_ISO_DATE)
    return F.when(bad, F.lit(None)).when(ok, c.try_cast("date"))


def parse_mmyyyy(c: str | Column, sentinels: Iterable[str] = DOB_SENTINELS) -> Column:
    """Month-precision 'MMYYYY' -> first day of that month (DATE)."""
    c = as_col(c)
    text = F.concat(F.substring(c, 3, 4), F.lit("-"), F.substring(c, 1, 2), F.lit("-01"))
    return F.when(c.isin(*sentinels), F.lit(None)).otherwise(clean_date(text, sentinels=()))


def parse_year_month(c: str | Column) -> Column:
    """Delivery month 'YYYY?M' or 'YYYY?MM' (any separator) -> first of month."""
    c = as_col(c)
    month = F.when(F.length(c) == 6, F.concat(F.lit("-0"), F.substring(c, 6, 2))).otherwise(
        F.concat(F.lit("-"), F.substring(c, 6, 2))
    )
    return clean_date(F.concat(F.substring(c, 1, 4), month, F.lit("-01")), sentinels=())


def parse_yyyymmdd_int(c: str | Column) -> Column:
    """Integer YYYYMMDD; a year-only value (MMDD = 0000) becomes 1 January; no date -> NULL."""
    c = as_col(c)
    year_only = (c % 10000) == 0
    text = F.when(year_only, F.concat((c / 10000).cast("int").cast("string"), F.lit("0101"))).otherwise(
        c.cast("string")
    )
    return F.try_to_date(text, "yyyyMMdd")


def months_diff(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    31 Jan -> 1 Feb is 1 (calendar-month difference), unlike
    ``months_between`` which measures elapsed fractional months.
    """
    s, e = as_col(start), as_col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(as_col(end), as_col(start))


def completed_years(start: str | Column, end: str | Column) -> Column:
    """Whole years elapsed (truncated toward zero, like a calendar period)."""
    return (F.months_between(as_col(end), as_col(start), roundOff=False) / 12).cast("int")


def school_start_year(dob: str | Column) -> Column:
    """Calendar year of school entry: children born Sept-Dec start a year later."""
    d = as_col(dob)
    return F.year(d) + F.when(F.month(d) < 9, F.lit(4)).otherwise(F.lit(5))


def nominal_school_year(event: str | Column, start_year: str | Column) -> Column:
    """School year group at an event date (academic year turns in July here)."""
    e = as_col(event)
    return F.year(e) - as_col(start_year) - F.when(F.month(e) < 7, F.lit(1)).otherwise(F.lit(0))


def academic_year_start(c: str | Column) -> Column:
    """'2004/2005' -> 2004."""
    return F.substring(as_col(c), 1, 4).try_cast("int")
