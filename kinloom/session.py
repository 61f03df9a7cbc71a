"""Spark session helpers.

On a cluster the session comes from the launcher and already carries its own
settings; ``ensure_checkpoint_dir`` only fills in a checkpoint folder when the
cluster did not name one (tests, local runs).
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not JIT-compile methods above 8000 bytecodes; a whole-stage
    # codegen method larger than that runs interpreted and is slower than the
    # non-fused operators, so fall back for such (wide) stages only.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def limit_methods(spark: SparkSession) -> None:
    """Set the recommended method limit in a session that still has Spark's default.

    The wide stages depend on it: with the default their generated methods are not
    compiled and take several times as long.  A limit that the user chose stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, RECOMMENDED_CONF[name])


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes within it remove their shuffle files when they have ended.

    A session otherwise keeps them until the driver's JVM collects the plan, which a
    driver with memory to spare does late: a run of many stages holds the shuffles of all."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "kinloom") -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a scratch one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always respected.  A machine-local temporary folder is used only by a
    local master that has none (tests); on a cluster the executors would not
    see each other's files, so an unset folder is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors (master {master})")
    path = tempfile.mkdtemp(prefix="kinloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
