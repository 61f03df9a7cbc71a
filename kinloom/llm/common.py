"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, freed_shuffles

#: A word, as the contracts state it: a run of characters outside space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Ids of 8 bytes up to which a list of them is broadcast.
BROADCAST_IDS = 1 << 20
#: A key that holds more than one row in so many is met by broadcast: there are fewer than this of them.
HOT = 1024
#: Bytes of text that a Python worker treats at once.
SLICE_BYTES = 16 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()
#: Folders made by this process and not removed yet.
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Nothing to do when the launcher put the repository on ``PYTHONPATH``;
    otherwise the package's sources are sent once per application.
    """
    if _ROOT in [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p]:
        return
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="kinloom-src-"), "kinloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(os.path.join(_ROOT, "kinloom")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), _ROOT))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


_kept: dict[str, object] = {}


def kept(name: str, make):
    """What ``make`` returns, kept by the worker for its next tasks of that name."""
    if name not in _kept:
        _kept.clear()
        release_memory()
        _kept[name] = make()
    return _kept[name]


def lean(run, name: str | None = None):
    """The same batch function; when a task has read its last batch, its memory is released.

    What the worker keeps under another ``name`` goes first: workers outlive an
    operator, and its encoders and caches would add to the next one's memory."""

    def batches_of(batches):
        if _kept and name not in _kept:
            _kept.clear()
            release_memory()
        yield from run(batches)
        release_memory()

    return batches_of


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kinloom-{label}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    atexit.register(_remove_at_end, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``run_dir`` named."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(hpath, True)
    _made.remove(path)


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Results are lazy and read their tables until the application ends."""
    if path in _made and spark.sparkContext._jsc is not None:
        remove(spark, path)


def written(df: DataFrame, label: str, make) -> DataFrame:
    """``make(df)`` stored as a table, the tables that were made on the way removed."""
    spark, before = df.sparkSession, set(_made)
    out = stored(make(df), label)
    for path in [p for p in _made if p not in before][:-1]:
        remove(spark, path)
    return out


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts the lineage)."""
    path = run_dir(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, ids: DataFrame, on: str, how: str) -> DataFrame:
    """Semi or anti join with a (stored) table of ids, which is broadcast if it is small enough.

    Otherwise the ids are hashed: the texts beside ``df``'s ids are moved, but not sorted."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash"), on, how)


def joined_by_id(df: DataFrame, facts: DataFrame) -> DataFrame:
    """``df`` joined to a (stored) table of facts with one row an id, as in ``only``."""
    return df.join(F.broadcast(facts) if facts.count() <= BROADCAST_IDS else facts.hint("shuffle_hash"), "id")


def meet(rows: DataFrame, facts: DataFrame, key: str, hot, how: str = "inner") -> DataFrame:
    """``rows.join(facts, key, how)`` in which no hot key's rows gather in one task.

    ``facts`` has one row a key.  Those for which ``hot`` holds are broadcast: the
    caller states it as more than one row in ``HOT``, so they are fewer than that.
    """
    more = [c for c in facts.columns if c != key]
    known = rows.join(F.broadcast(facts.filter(hot).select(key, F.struct(*more).alias("hot_facts"))), key, "left")
    few = known.filter("hot_facts is null").drop("hot_facts").join(facts, key, how)
    many = known.filter("hot_facts is not null").select(*rows.columns, *[F.col(f"hot_facts.{c}").alias(c) for c in more])
    return few.unionByName(many)


def slices(batch: pa.RecordBatch, column: int = 1, at_most: int = SLICE_BYTES):
    """The batch in runs of rows of about ``at_most`` bytes of text, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        stop = int(np.searchsorted(size, (size[first - 1] if first else 0) + at_most)) + 1
        yield batch.slice(first, stop - first)
        first = stop


def word_count(text):
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
