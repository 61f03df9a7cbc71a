"""What a stored stage was made from, so that a resumed run never reads a stale one.

A stage's mark covers the source text of the whole package its function comes
from (whatever the function calls, and the code lists), the values the function
holds, its parameters, and the marks of all that it reads.  A source made of files
is marked by their names, sizes and times of change.  Any other source needs a
``Snapshot``, whose token changes with its data; without one it has no mark, and
the stages above it are built again on every run.

The manifest lies beside the stage's files.  It is written under a temporary name
and renamed when the stage is complete and has passed its checks.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Name of a stage's manifest; Spark's readers skip names with an underscore.
MANIFEST = "_manifest.json"
#: The training-data operators, which no stage uses, and compiled files.
_LEFT_OUT = {"llm", "__pycache__"}


@dataclass(frozen=True)
class Snapshot:
    """A loader and a token that changes whenever the loaded data do, such as a
    table version, a change counter or the time of the last load."""

    load: Callable[[], DataFrame]
    token: Callable[[], str]

    def __call__(self) -> DataFrame:
        return self.load()


def text_hash(folder: str) -> str:
    """Of all Python sources of a package, or of a folder that is none, by relative name."""
    found = hashlib.sha256()
    package = os.path.exists(os.path.join(folder, "__init__.py"))
    for path, dirs, names in os.walk(folder):
        dirs[:] = sorted(d for d in dirs if package and d not in _LEFT_OUT)
        for name in sorted(n for n in names if n.endswith(".py")):
            with open(os.path.join(path, name), "rb") as f:
                body = f.read()
            found.update(f"{os.path.relpath(os.path.join(path, name), folder)}:{len(body)}\n".encode() + body)
    return found.hexdigest()


def _folder_of(file: str) -> str:
    """The outermost package around a file, or else its folder."""
    folder = os.path.dirname(os.path.abspath(file))
    while os.path.exists(os.path.join(folder, "__init__.py")) and os.path.exists(os.path.join(os.path.dirname(folder), "__init__.py")):
        folder = os.path.dirname(folder)
    return folder


def _plain(value) -> str:
    """Text of a value that says all about it; '' for others (frames, sessions, functions of the package)."""
    if isinstance(value, (str, int, float, bool, bytes, type(None))):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return f"[{','.join(map(_plain, value))}]"
    if isinstance(value, (set, frozenset)):
        return f"{{{','.join(sorted(map(_plain, value)))}}}"
    if isinstance(value, dict):
        return f"{{{','.join(sorted(f'{_plain(k)}:{_plain(v)}' for k, v in value.items()))}}}"
    return ""


def code_mark(fn: Callable, texts: dict[str, str]) -> str:
    """Of a function's package, its own place and the plain values it holds."""
    if isinstance(fn, Snapshot):
        return "snapshot"
    inner = getattr(fn, "func", fn)  # of a partial
    code = getattr(inner, "__code__", None)
    parts = [getattr(inner, "__qualname__", type(inner).__name__), _plain(list(getattr(fn, "args", ()))), _plain(dict(getattr(fn, "keywords", {}) or {}))]
    if code is not None:
        folder = _folder_of(code.co_filename)
        parts += [texts.setdefault(folder, text_hash(folder)), str(code.co_firstlineno), code.co_code.hex(), _plain(list(code.co_consts)), _plain(list(code.co_names))]
        parts += [_plain(cell.cell_contents) for cell in (inner.__closure__ or ())]
    return "\n".join(parts)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def source_mark(df: DataFrame) -> str | None:
    """Of the files a frame reads; None if it reads anything that is not a file."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation":
            kind = leaf.relation().getClass().getSimpleName()
        if kind not in ("HadoopFsRelation", "Range", "OneRowRelation"):
            return None
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString() if not leaves.isEmpty() else ""
    out = [",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields), plan]
    for path in sorted(df.inputFiles()):
        fs, hpath = _filesystem(df.sparkSession, path)
        status = fs.getFileStatus(hpath)
        out.append(f"{path}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def loader_marks(loaders: Iterable[Callable[[], DataFrame] | DataFrame]) -> list[str | None]:
    return [f"token:{x.token()}" if isinstance(x, Snapshot) else source_mark(x if isinstance(x, DataFrame) else x()) for x in loaders]


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the stage stored at ``path``, if it was finished."""
    fs, hpath = _filesystem(spark, f"{path}/{MANIFEST}")
    if not fs.exists(hpath):
        return None
    return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(fs.open(hpath), "UTF-8"))


def remove_manifest(spark: SparkSession, path: str) -> None:
    fs, hpath = _filesystem(spark, f"{path}/{MANIFEST}")
    fs.delete(hpath, False)


def write_manifest(spark: SparkSession, path: str, facts: dict) -> None:
    """Replace the manifest of the stage stored at ``path``."""
    fs, temporary = _filesystem(spark, f"{path}/{MANIFEST}.{uuid.uuid4().hex[:12]}")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(json.dumps(facts, indent=1).encode()))
    finally:
        out.close()
    remove_manifest(spark, path)
    if not fs.rename(temporary, _filesystem(spark, f"{path}/{MANIFEST}")[1]):
        raise OSError(f"cannot rename {temporary}")
