"""Guards in one pass, stages that leave no marker, resume that cannot be stale, yearly store."""

import importlib
import os
import shutil
import sys

import pytest
from pyspark.sql import functions as F

from kinloom.functions import codes as C
from kinloom.operators.observe import Counted, Unwatched, Watch, stop_on
from kinloom.plans import cohort_pipeline as CP
from kinloom.plans import manifest as M
from kinloom.plans.pipeline import Pipeline, Stage
from kinloom.plans.store import YearStore
from kinloom.sources.fixtures import fixture_sources

SF = "/root/testdata/sf0.001"


def counting(spark, df):
    """The same frame, and how many of its rows were computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema), lambda: seen.value


def codes_of(path, stage):
    return sorted(os.listdir(os.path.join(path, stage)))


# --------------------------------------------------------------------------- counts


def test_watch_counts_while_writing(spark, tmp_path):
    df, seen = counting(spark, spark.range(100))
    watch = Watch()
    both = watch(df, "a", {"odd": F.col("id") % 2 == 1, "null": F.lit(None).cast("boolean")})
    both.unionByName(watch(spark.range(10), "a", {"odd": F.col("id") % 2 == 1})).write.parquet(str(tmp_path / "x"))
    assert sorted(watch.counts()) == [("a", "null", 110, 0), ("a", "odd", 110, 55)]
    assert seen() == 100
    assert Unwatched()(df, "a", {"x": F.lit(True)}) is df
    with pytest.raises(ValueError, match="step: a: odd on 55 of 110 rows"):
        stop_on(watch.counts(), "step")


def test_counts_of_empty_frames(spark, tmp_path):
    watch = Watch()
    watch(spark.createDataFrame([], "id long"), "none", {"x": F.col("id") > 0}).write.parquet(str(tmp_path / "x"))
    assert watch.counts() == [("none", "x", 0, 0)]
    count = Counted()
    count(spark.range(0), "none", {"x": F.col("id") > 0})
    assert count.counts() == [("none", "x", 0, 0)]


# --------------------------------------------------------------------------- guards


def test_coded_join_runs_once_and_stops(spark, tmp_path):
    stages = CP.cohort_stages(spark, fixture_sources(spark, SF))
    rows = Pipeline(spark, CP.cohort_stages(spark, fixture_sources(spark, SF), "report"), on_bad="report").get("diagnoses")
    rows = spark.createDataFrame(rows.filter("diagnosis_3char < 'D'").limit(3000).collect(), rows.schema)
    good, seen = counting(spark, rows.withColumn("admidate", F.lit("2010-01-01")))
    stages["diagnoses"] = Stage(lambda: good, (), write=False)
    work = str(tmp_path / "good")
    assert Pipeline(spark, stages, workdir=work).get("cancer").count() > 0
    assert seen() == rows.count()
    bad, seen = counting(spark, rows.withColumns({c: F.lit("") for c in ("admidate", "epistart", "epiend", "disdate")}))
    stages["diagnoses"] = Stage(lambda: bad, (), write=False)
    work = str(tmp_path / "bad")
    with pytest.raises(ValueError, match="all dates missing"):
        Pipeline(spark, stages, workdir=work).get("cancer")
    assert seen() == rows.count()
    assert M.MANIFEST not in codes_of(work, "cancer_coded") and not os.path.exists(f"{work}/cancer")


def test_person_summary_runs_once(spark, tmp_path):
    stages = CP.cohort_stages(spark, fixture_sources(spark, SF))
    anchored = Pipeline(spark, CP.cohort_stages(spark, fixture_sources(spark, SF), "report"), on_bad="report").get("anchored")
    frame, seen = counting(spark, anchored)
    stages["anchored"] = Stage(lambda: frame, (), write=False)
    out = Pipeline(spark, stages, workdir=str(tmp_path / "w")).get("summary")
    assert out.count() > 0 and seen() == anchored.count()


def test_repeated_keys_stop_and_leave_no_marker(spark, tmp_path):
    stages = {"s": Stage(lambda: spark.range(4).selectExpr("id % 2 AS k", "id"), (), unique=("k",))}
    work = str(tmp_path / "w")
    with pytest.raises(AssertionError, match="2 duplicated keys"):
        Pipeline(spark, stages, workdir=work).get("s")
    assert M.MANIFEST not in codes_of(work, "s")
    assert Pipeline(spark, stages, workdir=work, on_bad="report").get("s").count() == 4
    assert M.MANIFEST in codes_of(work, "s")


def test_bad_text_of_every_source_stops(spark, tmp_path):
    src = fixture_sources(spark, SF)
    stages = CP.cohort_stages(spark, src)
    run = Pipeline(spark, stages, workdir=str(tmp_path / "w"))
    for name, field in (("births", "DOREG"), ("notifications_raw", "BABY_BIRTH_DATE"), ("links", "birweit_clean"),
                        ("episodes", "birweit")):
        with pytest.raises(ValueError, match=field):
            run.get(name)
    counts = Pipeline(spark, stages, workdir=str(tmp_path / "r"), on_bad="report")
    counts.run(["births", "links", "episodes"])
    got = {(r.source, r.field): r.n for r in counts.all_counts().collect()}
    for field in ("admidate", "mydob", "epiorder", "birweit", "gestat", "matage", "admiage", "activage"):
        assert got["episodes", field] > 0
    assert got["episodes", "epiend"] == 0


# --------------------------------------------------------------------------- resume


def steps(folder, body):
    os.makedirs(folder, exist_ok=True)
    open(os.path.join(folder, "__init__.py"), "w").close()
    with open(os.path.join(folder, "called.py"), "w") as f:
        f.write(body)
    with open(os.path.join(folder, "stage.py"), "w") as f:
        f.write("from . import called\n\n\ndef make(df):\n    return called.change(df)\n")


def fresh(name):
    for key in [k for k in sys.modules if k.split(".")[0] == name]:
        del sys.modules[key]
    importlib.invalidate_caches()
    return importlib.import_module(f"{name}.stage")


def build(spark, work, source, fn, **more):
    stages = {"raw": Stage(source, ()), "out": Stage(fn, ("raw",))}
    run = Pipeline(spark, stages, workdir=work, resume=True, **more)
    return run.get("out")


def stamp(work, stage="out"):
    return os.stat(os.path.join(work, stage, M.MANIFEST)).st_mtime_ns


def test_a_changed_called_function_rebuilds(spark, tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    monkeypatch.setattr(sys, "dont_write_bytecode", True)
    package, work = str(tmp_path / "steps_pkg"), str(tmp_path / "w")
    steps(package, "def change(df):\n    return df.selectExpr('id + 1 AS x')\n")
    source = lambda: spark.range(3)
    assert sorted(r.x for r in build(spark, work, source, fresh("steps_pkg").make).collect()) == [1, 2, 3]
    first = stamp(work), stamp(work, "raw")
    build(spark, work, source, fresh("steps_pkg").make)
    assert (stamp(work), stamp(work, "raw")) == first
    steps(package, "def change(df):\n    return df.selectExpr('id + 2 AS x')\n")
    assert sorted(r.x for r in build(spark, work, source, fresh("steps_pkg").make).collect()) == [2, 3, 4]
    assert stamp(work, "raw") == first[1]


def test_a_changed_code_list_changes_every_mark(tmp_path):
    here = os.path.dirname(os.path.dirname(os.path.abspath(C.__file__)))
    copy = str(tmp_path / "kinloom")
    shutil.copytree(here, copy, ignore=shutil.ignore_patterns("__pycache__"))
    assert M.text_hash(copy) == M.text_hash(here)
    path = os.path.join(copy, "functions", "codes.py")
    with open(path) as f:
        text = f.read()
    with open(path, "w") as f:
        f.write(text.replace("'C75'", "'C76'").replace('"C75"', '"C76"') + "\n")
    assert M.text_hash(copy) != M.text_hash(here)
    # every stage's mark holds the text of the package
    stage = CP.cohort_stages(None, CP.Sources(*[None] * 6))["cancer"]
    texts = {}
    M.code_mark(stage.fn, texts)
    assert texts == {here: M.text_hash(here)}


def test_held_values_are_marked(spark, tmp_path):
    def add(n):
        return lambda df: df.selectExpr(f"id + {n} AS x")

    work, source = str(tmp_path / "w"), lambda: spark.range(2)
    assert sorted(r.x for r in build(spark, work, source, add(1)).collect()) == [1, 2]
    first = stamp(work)
    build(spark, work, source, add(1))
    assert stamp(work) == first
    assert sorted(r.x for r in build(spark, work, source, add(5)).collect()) == [5, 6]


def test_sources_without_files(spark, tmp_path):
    table, version = [(1,)], ["v1"]

    def load():
        return spark.createDataFrame(table, "id long")

    keep = lambda df: df
    marked, unmarked = str(tmp_path / "m"), str(tmp_path / "u")
    snapshot = M.Snapshot(load, lambda: version[0])
    build(spark, marked, snapshot, keep)
    build(spark, unmarked, load, keep)
    first = stamp(marked), stamp(unmarked)
    build(spark, marked, snapshot, keep)
    build(spark, unmarked, load, keep)
    assert stamp(marked) == first[0] and stamp(unmarked) != first[1]  # without a token it is built again
    table.append((2,))
    version[0] = "v2"
    assert build(spark, marked, snapshot, keep).count() == 2
    assert build(spark, unmarked, load, keep).count() == 2


def test_changed_files_and_unfinished_stages_rebuild(spark, tmp_path):
    path, work = str(tmp_path / "src"), str(tmp_path / "w")
    spark.range(3).write.parquet(path)
    source, keep = (lambda: spark.read.parquet(path)), (lambda df: df)
    assert build(spark, work, source, keep).count() == 3
    first = stamp(work)
    spark.range(5).write.mode("overwrite").parquet(path)
    assert build(spark, work, source, keep).count() == 5 and stamp(work) != first
    first = stamp(work)
    M.remove_manifest(spark, f"{work}/out")
    build(spark, work, source, keep)
    assert stamp(work) != first

    def fails(df):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        build(spark, work, source, fails)
    assert M.MANIFEST not in codes_of(work, "out")


# --------------------------------------------------------------------------- yearly store


def files(path):
    return {(d, n): os.stat(os.path.join(path, d, n)).st_mtime_ns
            for d in os.listdir(path) if "=" in d for n in os.listdir(os.path.join(path, d)) if n.endswith(".parquet")}


def test_one_year_is_rewritten_and_others_left(spark, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "store")

    def extract(year, n):
        spark.range(n).selectExpr("id", f"{year} AS y").write.mode("overwrite").parquet(f"{raw}/{year}")

    def tables(*years):
        return {y: spark.read.parquet(f"{raw}/{y}") for y in years}

    def union(parts):
        out = None
        for df in parts.values():
            out = df if out is None else out.unionByName(df)
        return out

    store = YearStore(spark, path, "y", union, "id long, y int")
    for y in (2001, 2002, 2003):
        extract(y, y - 2000)
    assert store.refresh(tables(2001, 2002, 2003)) == [2001, 2002, 2003]
    before = files(path)
    assert store.refresh(tables(2001, 2002, 2003)) == [] and files(path) == before
    extract(2002, 20)
    assert store.refresh(tables(2001, 2002, 2003)) == [2002]
    after = files(path)
    assert {k: v for k, v in before.items() if "2002" not in k[0]} == {k: v for k, v in after.items() if "2002" not in k[0]}
    assert sorted((r.y, r.n) for r in store.read().groupBy("y").agg(F.count("*").alias("n")).collect()) == [(2001, 1), (2002, 20), (2003, 3)]
    extract(2002, 0)  # an extract without rows, and a year that is no longer there
    assert store.refresh(tables(2001, 2002)) == [2002]
    assert {r.y for r in store.read().collect()} == {2001}
    extract(2004, 4)
    assert store.refresh(tables(2001, 2002, 2004)) == [2004]
    assert store.read().filter("y = 2004").count() == 4


def test_an_interrupted_refresh_is_repeated(spark, tmp_path):
    path, ends = str(tmp_path / "store"), [True]

    def union(parts):
        if ends[0]:
            raise RuntimeError("no")
        return parts[2001].selectExpr("id", "2001 AS y")

    store = YearStore(spark, path, "y", union, "id long, y int")
    with pytest.raises(RuntimeError):
        store.refresh({2001: spark.range(3)})
    ends[0] = False
    assert store.refresh({2001: spark.range(3)}) == [2001] and store.read().count() == 3


# --------------------------------------------------------------------------- stored diagnoses


def test_first_diagnoses_read_the_store_by_code(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    run = Pipeline(spark, CP.cohort_stages(spark, fixture_sources(spark, SF), "report"), workdir=str(tmp_path / "w"), on_bad="report")
    run.get("diagnoses")
    for name in ("cancer_coded", "congenital_coded"):
        stage = run.stages[name]
        plan = stage.fn(run.get("diagnoses").filter("reporting_year_start >= 2005"), watch=Unwatched())
        text = plan._jdf.queryExecution().executedPlan().toString()
        pushed = text[text.index("PushedFilters"):text.index("ReadSchema")]
        assert "GreaterThanOrEqual(diagnosis_3char" in pushed and "LessThanOrEqual(diagnosis_3char" in pushed
        assert "reporting_year_start#" in text[text.index("PartitionFilters"):text.index("PushedFilters")]
        assert "diag_01" not in text  # not from the episodes
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the files of a year are ordered by code
    folder = next(p for p in (tmp_path / "w" / "diagnoses").iterdir() if p.name.startswith("reporting"))
    for f in folder.glob("*.parquet"):
        got = [r[0] for r in spark.read.parquet(str(f)).select("diagnosis_3char").toLocalIterator()]
        assert got == sorted(got)
