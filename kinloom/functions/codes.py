"""Clinical code lists and ordinal maps, and builders for their lookup tables.

Code lists are small, fixed constants; they are turned into tiny DataFrames
and joined by broadcast (their size is bounded by construction: a few hundred
rows at most, whatever the data volume).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def expand(spec: str) -> list[str]:
    """Expand 'C00-C74, D352-D354, Q90' into explicit codes (same width)."""
    out: list[str] = []
    for part in (p.strip() for p in spec.split(",")):
        if not part:
            continue
        m = re.fullmatch(r"([A-Z])(\d+)-(?:[A-Z])?(\d+)", part)
        if m:
            letter, lo, hi = m.group(1), m.group(2), m.group(3)
            width = len(lo)
            out += [f"{letter}{i:0{width}d}" for i in range(int(lo), int(hi) + 1)]
        else:
            out.append(part)
    return out


# ---------------------------------------------------------------------------
# Cancer code universe and groups (children's cancer incidence
# definition: all malignant tumours plus non-malignant brain/CNS tumours).
# ---------------------------------------------------------------------------
CANCER_3CHAR = "C00-C74, C76-C97, D32, D33, D42, D43"
CANCER_4CHAR = "C750-C759, D352-D354, D443-D445"
CANCER_GROUPS = {
    "Brain / CNS": "C70-C72, D32, D33, D42, D43, C751-C753, D352-D354, D443-D445",
    "Lymphoma": "C81-C86, C88, C96",
    "Leukaemia": "C90-C95",
}
CANCER_OTHER = "Other"

# ---------------------------------------------------------------------------
# Congenital anomaly inclusion/exclusion lists (EUROCAT guide).
# ---------------------------------------------------------------------------
CONGENITAL_INCLUDE_3CHAR = "Q00-Q99"
CONGENITAL_INCLUDE_4CHAR = "D215, D821, P350-P351, P354, P358, P371"
CONGENITAL_EXCLUDE_3CHAR = "Q53, Q95"
CONGENITAL_EXCLUDE_4CHAR = (
    "Q101-Q103, Q105, Q135, Q170-Q175, Q179, Q180-Q182, Q184-Q187, Q189, Q246, Q250, Q256, Q261, Q270, "
    "Q314-Q315, Q320, Q322, Q331, Q357, Q381-Q382, Q400-Q401, Q430, Q444, Q501-Q502, Q505, Q523, Q525, Q527, "
    "Q544, Q610, Q627, Q633, Q653-Q656, Q658-Q659, Q661-Q669, Q670-Q678, Q680, Q683-Q685, Q752-Q753, Q760, "
    "Q765, Q825, Q833, Q845-Q846, Q899, Q850-Q851"
)
# excluded codes that are re-admitted under a group of their own
CONGENITAL_READMITTED = {
    "Q250": "ga_mte_37wks_only",
    "Q256": "ga_mte_37wks_only",
    "Q850": "neurofibromatosis",
    "Q851": "tuberous_sclerosis",
}
CONGENITAL_DOWN_3CHAR = "Q90"
CONGENITAL_GROUPS = ["down_syndrome", "ga_mte_37wks_only", "neurofibromatosis", "other", "tuberous_sclerosis"]

# ---------------------------------------------------------------------------
# Birth-record classification (per episode).
# ---------------------------------------------------------------------------
BIRTH_DIAG_3CHAR = ["Z37", "Z38"]
BIRTH_HRG_3CHAR = ["N01", "N02", "N03", "N04", "N05"]
BIRTH_HRG_4CHAR = ["PB01", "PB02", "PB03", "PB04", "PB05", "PB06"]
BIRTH_EPITYPE = ["3", "6"]
BIRTH_CLASSPAT = ["5"]
BIRTH_ADMIMETH = ["82", "83", "2C"]
BIRTH_NEOCARE = ["0", "1", "2", "3", "4"]
TERMINATION_DIAG_4CHAR = ["P964"]
STILLBIRTH_DIAG_3CHAR = ["P95"]
STILLBIRTH_DIAG_4CHAR = ["Z371", "Z373", "Z376", "Z377"]
STILLBIRTH_DISMETH = ["5"]
STILLBIRTH_BIRSTAT = ["2", "3", "4"]
SINGLETON_DIAG_4CHAR = ["Z370", "Z371", "Z380", "Z381", "Z382"]
MULTIPLE_DIAG_4CHAR = ["Z372", "Z373", "Z374", "Z375", "Z376", "Z377", "Z383", "Z384", "Z385", "Z386", "Z387", "Z388"]
MULTIPLE_BIRORDR = ["2", "3", "4", "5", "6", "7"]
MULTIPLE_NUMBABY = ["2", "3", "4", "5", "6"]
NEONATAL_AGE_CODES = ["7001", "7002", "7003"]

# Residency coding (region of residence).
ENGLAND_RESGOR = ["A", "B", "C", "D", "E", "F", "G", "H", "J", "K"]
NON_ENGLAND_RESGOR = ["S", "W", "X", "Z"]
NON_ENGLAND_CR_RESIDENCE = ["Q99", "S", "X", "Z"]
RESIDENCE_SWITCH_YEAR = 2021

_CODE_SCHEMA = T.StructType(
    [
        T.StructField("diagnosis_3char", T.StringType()),
        T.StructField("diagnosis_4char", T.StringType()),
        T.StructField("group", T.StringType()),
    ]
)


def cancer_code_rows() -> list[tuple[str | None, str | None, str]]:
    def group_of(code: str) -> str:
        for name, spec in CANCER_GROUPS.items():
            if code in expand(spec):
                return name
        return CANCER_OTHER

    rows = [(c, None, group_of(c)) for c in expand(CANCER_3CHAR)]
    rows += [(None, c, group_of(c)) for c in expand(CANCER_4CHAR)]
    return rows


def congenital_code_rows() -> list[tuple[str | None, str | None, str]]:
    excl3 = set(expand(CONGENITAL_EXCLUDE_3CHAR))
    excl4 = expand(CONGENITAL_EXCLUDE_4CHAR)
    parents = {c[:3] for c in excl4}
    rows: list[tuple[str | None, str | None]] = []
    for c in expand(CONGENITAL_INCLUDE_3CHAR):
        if c in excl3:
            continue
        if c in parents:  # replaced by its ten 4-character children
            rows += [(None, f"{c}{i}") for i in range(10)]
        else:
            rows.append((c, None))
    rows += [(None, c) for c in expand(CONGENITAL_INCLUDE_4CHAR)]
    dropped = {c for c in excl4 if c not in CONGENITAL_READMITTED}
    out = []
    for c3, c4 in rows:
        if c4 is not None and c4 in dropped:
            continue
        if c4 in CONGENITAL_READMITTED:
            group = CONGENITAL_READMITTED[c4]
        elif c3 == CONGENITAL_DOWN_3CHAR:
            group = "down_syndrome"
        else:
            group = "other"
        out.append((c3, c4, group))
    return out


def stems(rows) -> set[str]:
    """3-character stems of a code list's rows (for early filtering)."""
    return {(c3 or c4)[:3] for c3, c4, _ in rows}


def code_list_df(spark: SparkSession, rows, group_col: str) -> DataFrame:
    return spark.createDataFrame(rows, _CODE_SCHEMA).withColumnRenamed("group", group_col)


def cancer_codes(spark: SparkSession) -> DataFrame:
    """(diagnosis_3char, diagnosis_4char, cancer_group): one of the two codes is set."""
    return code_list_df(spark, cancer_code_rows(), "cancer_group")


def congenital_codes(spark: SparkSession) -> DataFrame:
    """(diagnosis_3char, diagnosis_4char, ca_group)."""
    return code_list_df(spark, congenital_code_rows(), "ca_group")
