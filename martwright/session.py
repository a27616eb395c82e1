"""Spark session and shared scratch locations.

The library never picks its own shuffle width or checkpoint location when the
cluster already names one: those come from the session. ``width_for`` only
raises the width, for as long as a job over large tables runs. Local defaults are only
filled in where a setting is absent (tests, bench, laptops).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import warnings
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on for correct answers (not tuning knobs).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: coalesce small shuffles, split skewed join partitions,
# turn a join into a broadcast only after the build side has been measured.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app_name: str = "martwright",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **ADAPTIVE_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    it is used as is. Only when nothing is configured (local tests) is a local
    scratch folder created.
    """
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - absent key
            configured = None
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(checkpoints and scratch tables must survive the loss of a machine)")
        configured = tempfile.mkdtemp(prefix="martwright-ckpt-")  # local mode only (tests)
    elif configured.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        warnings.warn(f"spark.checkpoint.dir is {configured}: it must be a mount that all machines share", stacklevel=2)
    spark.sparkContext.setCheckpointDir(configured)
    return jsc.getCheckpointDir().get()


class _Scopes(threading.local):
    """The open scopes of a thread, the innermost last."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_SCOPES = _Scopes()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/martwright-scratch/{label}-{uuid.uuid4().hex}"
    if _SCOPES.open:
        _SCOPES.open[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders that this thread made inside once everything
    read from them has been written."""
    made: list[str] = []
    _SCOPES.open.append(made)
    try:
        yield
    finally:
        _SCOPES.open.remove(made)
        for path in made:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Codec of written tables: a third to a half smaller than Spark's default on these.
COMPRESSION = "zstd"

#: Spark's own switch (4.1): a query's shuffle files go when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, each query removes its shuffle files as it ends. Otherwise they stay until the driver happens to collect its
    garbage, so that a job of many written steps holds the shuffles of all of them. Every query here plans its own shuffles,
    so nothing asks for removed files again (Spark would run the lost stage once more)."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Bytes of a source's files that one shuffle partition stands for (some ten times as much once decoded).
SHUFFLE_BYTES = 16 * 1024 * 1024
MAX_SHUFFLE_WIDTH = 10_000
#: From here on a size is the planner's word for "not known" (rows that come from no file), which says nothing of a width.
UNKNOWN_BYTES = 1 << 50


@contextmanager
def width_for(spark: SparkSession, tables: Iterable[DataFrame]) -> Iterator[int]:
    """At least the session's shuffle width, and more where ``tables`` are larger, so that what a task sorts or
    hashes does not grow with the input. Adaptive execution merges partitions that turn out small."""
    sizes = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables]
    before = shuffle_width(spark)
    width = max(before, min(MAX_SHUFFLE_WIDTH, -(-sum(n for n in sizes if n < UNKNOWN_BYTES) // SHUFFLE_BYTES)))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        yield width
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def default_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
