"""The cohort build as a stage graph over user-supplied source tables, and a
runner that writes every stage plus the final export (the reference's
orchestration script, as one Spark application)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions import codes as C
from ..operators.link import semi_reduce
from ..operators.observe import Watch
from ..session import limit_methods
from ..sources import casts
from ..sources.io import write_with_metadata
from ..sources.schemas import STAGES
from . import birth_cohort as BC
from . import cohort as CO
from . import education as ED
from . import first_diagnosis as FD
from .birth_details import birth_information, ethnicity_geo
from .diagnoses import diagnoses_long
from .episodes import episodes_harmonised
from .mothers import mothers_delivery_episode
from .pipeline import Pipeline, Stage
from .registrations import birth_notifications, id_lookup, registrations_summary

SENABS_FIELDS = [f"{v}_{ED.nominal_label(n)}" for n in ED.NOMINAL_YEARS for v in ED.SENABS_VARIABLES]

Loader = Callable[[], DataFrame]


@dataclass
class Sources:
    """Raw extracts, each a zero-argument loader returning a DataFrame (so a
    stage that is resumed from storage never touches its inputs).

    ``census`` is keyed by collection year and ``absence`` by table year; the
    column mappings in ``kinloom.sources.mappings`` select each table.
    ``episodes`` gives the raw hospital extracts by reporting year.
    """

    episodes: Callable[[], Mapping[int, DataFrame]]
    civil_births: Loader
    civil_deaths: Loader
    birth_notifications: Loader
    bridging: Loader
    mother_baby_links: Loader
    census: Mapping[int, Loader] = field(default_factory=dict)
    absence: Mapping[int, Loader] = field(default_factory=dict)
    ks1: Loader | None = None
    ks2: Loader | None = None
    ks4_a: Loader | None = None
    ks4_b: Loader | None = None
    ks5_a: Loader | None = None
    ks5_b: Loader | None = None


def cohort_stages(spark: SparkSession, src: Sources, on_bad: str = "fail") -> dict[str, Stage]:
    """Named stages in dependency order.  Stages read by several later stages
    (or large) are written; ``write=False`` stages are cheap or read once and
    are planned into their consumer instead of being stored.

    Extracts with dates or numbers as text are stored as loaded and counted on the
    way (``CAST_STAGES``); so are the diagnoses in the code lists (``cancer_coded``,
    ``congenital_coded``), whose guards are counted in the one run of their join.

    With ``on_bad="fail"`` a pipeline stops on text that cannot be cast, on coded
    diagnoses without any date, and on repeated persons or pupil-years.  With
    ``"report"`` it goes on: undated rows are left out (stage ``undated``) and one
    whole row of a repeated pupil-year is kept (stage ``repeated_pupil_years``)."""
    if on_bad not in ("fail", "report"):
        raise ValueError(f"on_bad: {on_bad}")

    def raw(loader: Loader) -> Stage:
        return Stage(loader, (), write=False)

    def counted(loader: Loader, source: str, rules: Callable, unique: tuple[str, ...] = ()) -> Stage:
        return Stage(lambda watch: watch(loader(), source, rules()), (), watched=True, unique=unique,
                     sources=lambda: [loader])

    def yearly(tables: Mapping[int, Loader], source: str, rules: Callable, collate: Callable) -> Stage:
        def load(watch: Watch) -> DataFrame:
            return collate({y: watch(f(), source, rules(y)) for y, f in tables.items()})

        return Stage(load, (), watched=True, sources=lambda: list(tables.values()))

    def key_stage(loader: Loader, name: str) -> Stage:
        return counted(loader, name.lower(), lambda: casts.key_stage(name))

    stages = {
        # extracts
        "episodes": Stage(lambda watch: watch(episodes_harmonised(src.episodes()), "episodes", casts.episodes()), (),
                          watched=True, sources=lambda: list(src.episodes().values())),
        "births": counted(src.civil_births, "civil_births", casts.civil_births),
        "deaths": counted(src.civil_deaths, "civil_deaths", casts.civil_deaths),
        "notifications_raw": counted(src.birth_notifications, "birth_notifications", casts.birth_notifications,
                                     unique=("TOKEN_PERSON_ID",)),
        "bridging": raw(src.bridging),
        "links": counted(src.mother_baby_links, "mother_baby_links", casts.mother_baby_links),
        # hospital side; the files of a year are ordered by code, so a reader of some codes skips most of them
        "diagnoses": Stage(diagnoses_long, ("episodes",), partition_by="reporting_year_start",
                           sort_by=("diagnosis_3char", "diagnostic_position")),
        # the persons are written, with their first date; each reader meets them with the columns that it needs
        "infant_ids": Stage(BC.infant_persons, ("episodes",)),
        "infants": Stage(lambda e, ids: semi_reduce(BC.completed(e), ids, "token_person_id"),
                         ("episodes", "infant_ids"), write=False),
        # written: the timeline reads it twice (slices + ranks), the summary once
        "flagged": Stage(BC.flagged_records, ("episodes", "infant_ids")),
        "anchored": Stage(lambda f: BC.timeline_anchor(f, with_record_order=False), ("flagged",), write=False),
        "timeline": Stage(BC.timeline_anchor, ("flagged",), write=False),
        "summary": Stage(BC.person_summary, ("anchored",), unique=("token_person_id",)),
        "registrations": Stage(registrations_summary, ("births", "deaths"), write=False),
        "ids": Stage(id_lookup, ("bridging",), write=False),
        "notifications": Stage(birth_notifications, ("notifications_raw",), write=False),
        "birth_cohort": Stage(BC.birth_cohort, ("summary", "registrations", "notifications", "ids")),
        "cancer_coded": Stage(
            lambda d, watch: watch(FD.cancer_coded(d, C.cancer_codes(spark)), "cancer", FD.guards()),
            ("diagnoses",), watched=True),
        "cancer": Stage(FD.cancer_slots, ("cancer_coded",)),
        "congenital_coded": Stage(
            lambda d, watch: watch(FD.congenital_coded(d, C.congenital_codes(spark)), "congenital", FD.guards()),
            ("diagnoses",), watched=True),
        "congenital": Stage(FD.congenital_groups, ("congenital_coded",)),
        # what the explicit choice to report, not to stop, leaves out
        "undated": Stage(FD.undated, ("cancer_coded", "congenital_coded")),
        "unparseable_dates": Stage(FD.unparseable_dates, ("diagnoses",)),
        "repeated_pupil_years": Stage(ED.repeated_pupil_years, ("sen_long",)),
        "mothers": Stage(mothers_delivery_episode, ("links", "episodes")),
        "birth_info": Stage(lambda e, links, ids: birth_information(BC.completed(e), links, ids),
                            ("episodes", "links", "infant_ids")),
        "eth_geo": Stage(lambda e, ids: ethnicity_geo(BC.completed(e), ids), ("episodes", "infant_ids")),
        # pupil side
        "census": yearly(src.census, "census", casts.census, ED.census_harmonised),
        "absence_collated": yearly(src.absence, "absence", casts.absence, ED.absence_collated),
        "absence": Stage(ED.absence_summary, ("absence_collated",), write=False),
        "ks1_raw": key_stage(src.ks1, "KS1"),
        "ks2_raw": key_stage(src.ks2, "KS2"),
        "ks4_a": key_stage(src.ks4_a, "KS4"),
        "ks4_b": key_stage(src.ks4_b, "KS4"),
        "ks5_a": key_stage(src.ks5_a, "KS5"),
        "ks5_b": key_stage(src.ks5_b, "KS5"),
        "ks1_census": Stage(ED.ks1_census_presence, ("census",), write=False),
        "ks1": Stage(ED.ks1_best, ("ks1_raw",), write=False),
        "ks2": Stage(ED.ks2_best, ("ks2_raw",), write=False),
        "ks4": Stage(ED.ks4_best, ("ks4_a", "ks4_b"), write=False),
        "ks5": Stage(ED.ks5_best, ("ks5_a", "ks5_b"), write=False),
        "pupils": Stage(ED.cohort_pupils, ("birth_cohort",), write=False),
        "education": Stage(ED.education_combined, ("pupils", "ks1_census", "ks1", "ks2", "ks4", "ks5")),
        "sen": Stage(ED.sen_best_record, ("census",), write=False),
        "sen_long": Stage(ED.sen_absence_long, ("pupils", "sen", "absence"),
                          unique=("dfe_id", "senabs_academic_year_start")),
        "sen_wide": Stage(lambda d: ED.sen_absence_wide(d, "first"), ("sen_long",)),
        "cohort": Stage(
            lambda *dfs: CO.with_eligibility(CO.derive(CO.assemble(*dfs, SENABS_FIELDS))),
            ("birth_cohort", "birth_info", "mothers", "eth_geo", "cancer", "congenital", "sen_wide", "education"),
        ),
    }
    for name, declared in STAGES.items():
        stages[name].schema = declared
    return stages


# Stages that count text of their source that cannot be cast.
CAST_STAGES = ["episodes", "births", "deaths", "notifications_raw", "links", "census", "absence_collated",
               "ks1_raw", "ks2_raw", "ks4_a", "ks4_b", "ks5_a", "ks5_b"]
# Outputs of a run; what they need is built with them.
OUTPUTS = ["cohort", "diagnoses", "undated", "unparseable_dates", "repeated_pupil_years"]


def run_cohort(spark: SparkSession, src: Sources, workdir: str, export_dir: str | None = None,
               resume: bool = False, on_bad: str = "fail", targets: list[str] | None = None) -> dict[str, DataFrame]:
    """Build the outputs under ``workdir``, then export the cohort as CSV with a
    metadata sidecar.  ``counts`` in the result holds what the stages counted.

    ``resume`` reads stages back that were written from the same sources,
    parameters and code.  ``on_bad``: see ``cohort_stages``."""
    limit_methods(spark)
    p = Pipeline(spark, cohort_stages(spark, src, on_bad), workdir=workdir, resume=resume, on_bad=on_bad)
    out = p.run(targets or OUTPUTS)
    out["counts"] = p.all_counts()
    if export_dir is not None:
        write_with_metadata(p.get("cohort"), export_dir)
    return out
