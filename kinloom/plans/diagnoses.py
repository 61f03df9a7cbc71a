"""Diagnoses in long form (one row per completed episode and coded position)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import unpivot_positions

DIAG_FIELDS = [f"diag_{k:02d}" for k in range(1, 21)] + ["cause"]
EPISODE_ID_FIELDS = ["token_person_id", "epikey", "admidate", "epistart", "epiend", "disdate", "epiorder", "startage"]

DIAGNOSES_SCHEMA = (
    ", ".join(f"{c} string" for c in EPISODE_ID_FIELDS)
    + ", diagnostic_position int, diagnosis string, diagnosis_3char string, reporting_year_start int"
)


def diagnoses_long(episodes: DataFrame, positions: list[int] | None = None,
                   stems: set[str] | None = None) -> DataFrame:
    """Completed episodes x 21 diagnosis positions with a non-empty code.

    One ``Expand`` over a single scan replaces a union of one query per
    position; the non-empty filter runs right after it, before any shuffle.
    Output: id fields, ``reporting_year_start``, ``diagnostic_position``
    (1..20 = diag_01..diag_20, 21 = cause), ``diagnosis`` (first 4
    characters), ``diagnosis_3char``.

    ``positions`` restricts the output to those positions; only their columns
    are unpivoted (a position filter cannot be pushed below the unpivot, so
    it is applied by construction).
    ``stems`` keeps only codes whose first three characters are in the set;
    the test is made before the generator, so codes that cannot match a code list
    never become rows; of a single position no generator is needed.
    """
    fields = DIAG_FIELDS if positions is None else [DIAG_FIELDS[p - 1] for p in positions]
    completed = episodes.filter(F.col("epistat") == "3").select(
        *EPISODE_ID_FIELDS, "reporting_year_start", *fields
    )
    if stems is not None:
        listed = {f: F.substring(f, 1, 3).isin(*sorted(stems)) for f in fields}
        if len(fields) == 1:
            rows = completed.filter(listed[fields[0]]).withColumns(
                {"p": F.lit(DIAG_FIELDS.index(fields[0]) + 1), "c": F.col(fields[0])})
        else:
            # a field's test needs no struct and no lambda; only the listed ones become structs
            cells = [F.when(listed[f], F.struct(F.lit(DIAG_FIELDS.index(f) + 1).alias("p"), F.col(f).alias("c"))) for f in fields]
            rows = completed.select(*EPISODE_ID_FIELDS, "reporting_year_start", F.inline(F.array_compact(F.array(*cells))))
        return rows.select(
            *EPISODE_ID_FIELDS,
            "reporting_year_start",
            F.col("p").alias("diagnostic_position"),
            F.substring("c", 1, 4).alias("diagnosis"),
            F.substring("c", 1, 3).alias("diagnosis_3char"),
        )
    long = unpivot_positions(
        completed, [*EPISODE_ID_FIELDS, "reporting_year_start"], fields, "_pos", "_code"
    )
    ordinal = F.array(*[F.lit(DIAG_FIELDS.index(f) + 1) for f in fields])
    long = long.withColumn("diagnostic_position", F.element_at(ordinal, F.col("_pos")))
    return long.filter(F.col("_code").isNotNull() & (F.col("_code") != "")).select(
        *EPISODE_ID_FIELDS,
        "reporting_year_start",
        "diagnostic_position",
        F.substring("_code", 1, 4).alias("diagnosis"),
        F.substring("_code", 1, 3).alias("diagnosis_3char"),
    )
