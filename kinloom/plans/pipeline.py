"""Pipeline orchestration: the cohort stages in dependency order.

Each stage is a DataFrame -> DataFrame function of earlier stages.  With a
``workdir`` every stage output is written once as Parquet and read back, so

* each stage is planned on its own (small plans instead of one giant tree),
* lineage is cut at stage boundaries: a lost executor recomputes from the
  last written stage, not from the raw extracts, and a stage's shuffle files go
  when it is written,
* what a stage counts (``watched``) is counted while it is written, and keys that
  must be unique are checked on the written files, so no check computes a stage
  a second time,
* with ``resume=True`` a stage that was written from the same code and inputs is
  read back (see ``manifest``).

A stage is complete when its manifest lies beside its files, which is after its
checks: a stage that fails, or stops the run, leaves none and is built again.

``workdir`` must be a folder every executor can reach: by default a run folder
under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.observe import Count, Counted, Unwatched, Watch, stop_on
from ..operators.quality import assert_unique
from ..session import ensure_checkpoint_dir, freed_shuffles
from ..sources.io import write_partitioned
from ..sources.schemas import missing
from . import manifest as M


@dataclass
class Stage:
    fn: Callable[..., DataFrame]
    deps: tuple[str, ...]
    write: bool = True
    partition_by: str | None = None  # hive-partition the written output
    sort_by: tuple[str, ...] = ()  # order within the written files, for their statistics
    by_task: bool = False  # partitioned by the tasks that make the rows, without a shuffle
    unique: tuple[str, ...] = ()  # keys that no two rows may share
    watched: bool = False  # fn takes ``watch=`` and counts with it
    schema: StructType | None = None  # declared columns; a stage that gives others stops the run
    #: What a stage without dependencies loads, if not simply ``fn()``.
    sources: Callable[[], Iterable[Callable[[], DataFrame] | DataFrame]] | None = None


@dataclass
class Pipeline:
    spark: SparkSession
    stages: dict[str, Stage]
    workdir: str | None = None
    resume: bool = False
    on_bad: str = "fail"  # "fail": stop on counts and on repeated keys; "report": go on
    params: tuple = ()  # whatever else the stages were built from
    counts: dict[str, list[Count]] = field(default_factory=dict)
    _done: dict[str, DataFrame] = field(default_factory=dict)
    _marks: dict[str, str | None] = field(default_factory=dict)
    _texts: dict[str, str] = field(default_factory=dict)

    def mark(self, name: str) -> str | None:
        """Of the stage's code, the parameters, and all that it reads; None if a
        source below it cannot be marked."""
        if name not in self._marks:
            stage = self.stages[name]
            parts = [name, repr(self.params), self.on_bad, repr((stage.partition_by, stage.sort_by, stage.by_task, stage.unique)), M.code_mark(stage.fn, self._texts)]
            parts += [self.mark(d) for d in stage.deps]
            if not stage.deps:
                parts += M.loader_marks(stage.sources() if stage.sources else [stage.fn])
            self._marks[name] = None if None in parts else hashlib.sha256("\n".join(parts).encode()).hexdigest()
        return self._marks[name]

    def _call(self, stage: Stage, watch: Watch) -> DataFrame:
        deps = [self.get(d) for d in stage.deps]
        out = stage.fn(*deps, watch=watch) if stage.watched else stage.fn(*deps)
        return out if stage.schema is None else conform(out, stage.schema)

    def _write(self, name: str, path: str) -> DataFrame:
        stage, watch = self.stages[name], Watch()
        M.remove_manifest(self.spark, path)
        df = self._call(stage, watch)
        with freed_shuffles(self.spark):
            if stage.partition_by:
                write_partitioned(df, path, stage.partition_by, sort_by=stage.sort_by, by_task=stage.by_task)
            else:
                df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.counts[name] = watch.counts()
        if self.on_bad == "fail":
            stop_on(self.counts[name], name)
            if stage.unique:
                assert_unique(out, stage.unique)
        M.write_manifest(self.spark, path, {
            "stage": name, "mark": self.mark(name), "schema": df.schema.jsonValue(), "counts": self.counts[name]})
        return out

    def _read(self, name: str, path: str) -> DataFrame | None:
        """A finished stage with the same mark."""
        facts = M.read_manifest(self.spark, path)
        if facts is None or facts["mark"] is None or facts["mark"] != self.mark(name):
            return None
        self.counts[name] = [Count(*c) for c in facts["counts"]]
        return self.spark.read.schema(StructType.fromJson(facts["schema"])).parquet(path)

    def get(self, name: str) -> DataFrame:
        if name in self._done:
            return self._done[name]
        stage = self.stages[name]
        if self.workdir is not None and stage.write:
            path = f"{self.workdir.rstrip('/')}/{name}"
            out = self._read(name, path) if self.resume else None
            out = self._write(name, path) if out is None else out
        else:
            watch = Counted() if self.on_bad == "fail" else Unwatched()
            out = self._call(stage, watch)
            stop_on(watch.counts(), name)
        self._done[name] = out
        return out

    def run(self, targets: list[str]) -> dict[str, DataFrame]:
        """Build the targets and whatever they need."""
        return {name: self.get(name) for name in targets}

    def all_counts(self) -> DataFrame:
        """``stage, source, field, rows, n`` of every watched stage that was built or read back."""
        rows = [(stage, *c) for stage, counts in self.counts.items() for c in counts]
        return self.spark.createDataFrame(rows, "stage string, source string, field string, rows long, n long")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of a frame; a missing one, or one of another type, is an error."""
    if wrong := missing(df.schema, schema):
        raise ValueError(f"not as declared: {', '.join(wrong)}")
    return df.select(*schema.names)


def run_folder(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder for one pipeline run under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/kinloom-{label}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a run folder that this application made."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
