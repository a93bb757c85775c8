"""Session construction and shared-storage helpers.

On a cluster the session comes from the platform with ``spark.checkpoint.dir``
pointing at shared storage; ``scratch_dir`` only creates a local folder when
that setting is absent and the master is local (tests, local benchmarks).
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Planner settings the operators rely on for skew safety.  With
# requireAllClusterKeysForDistribution an aggregate or window keyed by
# (a, b, c) is shuffled on all of (a, b, c) even when the input is already
# hash-partitioned on a subset (say ``customer_id`` after a join): a hot
# subset key can then not pin a whole group of keys to one task, and the
# map-side partial aggregate / window-group limit stays in the plan.
PLANNER_CONF = {
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}

# Settings that matter at scale.  ``shuffle.partitions`` is only the upper bound
# AQE coalesces from; advisory size keeps reducers near 128 MB each.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with the frames that use them
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    **PLANNER_CONF,
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "salesforge", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``PLANNER_CONF`` to a session the caller built, keeping any value it set itself, at start or later."""
    chosen = spark.conf.getAll
    for k, v in PLANNER_CONF.items():
        if k not in chosen:
            spark.conf.set(k, v)
    return spark


@contextmanager
def part_of_key_suffices(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block take rows that lie together by a part of their key as they lie.

    For a key whose part has few rows by its nature, such as an order, so that no task gets much of one value.
    """
    name = "spark.sql.requireAllClusterKeysForDistribution"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block, and streams started in it, give their shuffle files back when they end.

    Otherwise the files of finished jobs stay until the driver happens to collect its garbage, beside those of the next.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_state(spark: SparkSession) -> Iterator[None]:
    """Streams started in this block compress the files of their state well (a checkpoint keeps its codec)."""
    name = "spark.sql.streaming.stateStore.compression.codec"
    before = spark.conf.get(name)
    spark.conf.set(name, "zstd")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block, and streams started in it, run no generated method that the JVM leaves uncompiled.

    HotSpot interprets a method of more than 8000 bytes of code for good.  A wide row whose every field is parsed makes
    such a method if its stage is fused; beyond this limit Spark runs the stage's operators by themselves, in short methods.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory, which executors and driver share.

    A machine-local folder is made only where the setting is absent and the
    whole application runs on one machine (``local[...]``).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name shared storage on master {sc.master}")
        configured = tempfile.mkdtemp(prefix="salesforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """The folder ``name`` for written tables under the shared checkpoint directory.

    The name is fixed in an application: writing again overwrites the earlier table instead of leaving it behind.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """As ``scratch_dir``, emptied first."""
    path = scratch_dir(spark, name)
    delete_path(spark, path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own scratch space, through the file system of its path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def replace_path(spark: SparkSession, aside: str, path: str) -> None:
    """Put the folder written at ``aside`` in the place of ``path``; what was there goes only afterwards.

    The old folder is renamed away and back again if the new one cannot take its place.
    """
    jvm = spark._jvm
    new, place, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path, f"{aside}-old"))
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"cannot put {aside} in the place of {path}")
    if had:
        fs.delete(old, True)
