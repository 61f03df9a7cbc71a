"""Counts of rows that meet a condition, taken while a frame is written.

``Watch`` hangs the conditions on a frame with ``DataFrame.observe``: the counts
come with the write and cost no pass of their own.  Put it right below the write:
below a shuffle a repeated map stage would count twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Count(NamedTuple):
    """``n`` of the ``rows`` rows of ``source`` met the condition ``name``."""

    source: str
    name: str
    rows: int
    n: int


def observed(observation: Observation) -> dict[str, int]:
    """The metrics of a finished write; none if no row passed, as the plan of a
    frame that turns out empty is cut short."""
    if observation._jo.getRow().schema() is None:
        return {}
    return observation.get


def _metrics(conditions: Mapping[str, Column]) -> list[Column]:
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"n{i}") for i, c in enumerate(conditions.values())]
    return [F.count(F.lit(1)).alias("rows"), *counts]


@dataclass
class Watch:
    """Conditions on the frames of one write; several frames of a source add up."""

    _seen: list[tuple[str, tuple[str, ...], Observation]] = field(default_factory=list)

    def __call__(self, df: DataFrame, source: str, conditions: Mapping[str, Column]) -> DataFrame:
        observation = Observation(f"{source}-{uuid.uuid4().hex[:12]}")
        self._seen.append((source, tuple(conditions), observation))
        return df.observe(observation, *_metrics(conditions))

    def counts(self) -> list[Count]:
        """The counts; call it after the write has ended."""
        rows: dict[str, int] = {}
        found: dict[tuple[str, str], int] = {}
        for source, names, observation in self._seen:
            got = observed(observation)
            rows[source] = rows.get(source, 0) + (got.get("rows") or 0)
            for i, name in enumerate(names):
                found[source, name] = found.get((source, name), 0) + (got.get(f"n{i}") or 0)
        return [Count(source, name, rows[source], n) for (source, name), n in found.items()]


class Unwatched(Watch):
    """For plans that are not written: nothing is counted."""

    def __call__(self, df: DataFrame, source: str, conditions: Mapping[str, Column]) -> DataFrame:
        return df

    def counts(self) -> list[Count]:
        return []


@dataclass
class Counted(Watch):
    """For plans that are not written but must stop on bad rows: one aggregate a frame."""

    _found: list[Count] = field(default_factory=list)

    def __call__(self, df: DataFrame, source: str, conditions: Mapping[str, Column]) -> DataFrame:
        got = df.agg(*_metrics(conditions)).first()
        self._found += [Count(source, name, got["rows"], got[f"n{i}"]) for i, name in enumerate(conditions)]
        return df

    def counts(self) -> list[Count]:
        return self._found


def stop_on(counts: list[Count], where: str) -> None:
    """Raise if any condition was met."""
    bad = [c for c in counts if c.n]
    if bad:
        raise ValueError(f"{where}: " + "; ".join(f"{c.source}: {c.name} on {c.n} of {c.rows} rows" for c in bad))
