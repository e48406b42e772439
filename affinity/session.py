"""Session and shared-storage helpers.

Operators never build sessions or set configuration (but for the removal of
shuffle files while a table is written); these helpers are for
tests, the bench and command-line use. On a cluster the session comes from the
launcher and ``spark.checkpoint.dir`` names a shared folder.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyspark.sql import SparkSession

#: Before the name of a catalog table among them.
_TABLE = "table "
#: Folders and catalog tables written within the outermost scope; None outside of one.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)
#: Whether Spark removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scope(job: Callable) -> Callable:
    """Remove the intermediate tables that ``job(spark, ...)`` wrote once it has ended, with or without an error.

    For jobs whose results are elsewhere (files, or rows already collected). A
    job called within another one's scope leaves its tables to the outer one.
    """
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        if _OWNED.get() is not None:
            return job(spark, *args, **kwargs)
        owned: list[str] = []
        token = _OWNED.set(owned)
        try:
            return job(spark, *args, **kwargs)
        finally:
            _OWNED.reset(token)
            for path in owned:
                if path.startswith(_TABLE):
                    spark.sql(f"DROP TABLE IF EXISTS {path.removeprefix(_TABLE)}")
                else:
                    remove(spark, path)
    return run


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a table of the shared folder, whatever store it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "affinity") -> SparkSession:
    """A local session tuned like the production one (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("AFFINITY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that value
    wins. Only a local session (tests, the bench) without one falls back to a
    local folder; a cluster session without one is an error, because a
    machine-local folder is not shared by the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    one_process = sc.master == "local" or sc.master.startswith("local[")
    if not configured and not fallback and not one_process:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: written "
                           "intermediates must be readable by every executor")
    if configured and not one_process and not urlparse(configured).scheme and _local_by_default(spark):
        raise RuntimeError(f"spark.checkpoint.dir {configured} names no file system and the default one is local: "
                           "say file:// for a mounted folder that every machine shares, or give its scheme")
    target = configured or fallback or os.path.join("/tmp", f"affinity-ckpt-{os.getpid()}")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def _local_by_default(spark: SparkSession) -> bool:
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return default.startswith("file:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    if _OWNED.get() is not None:
        _OWNED.get().append(path)
    return path


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Queries that run within leave no shuffle files: what they wrote is read from its table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    For intermediates read by several later steps: computed once (an RDD
    checkpoint would compute its input twice), they survive the loss of
    executors (the files live in shared storage, not in executor memory),
    later plans start from the written table, and the file sizes let the
    planner choose broadcasts by real size. The shuffles that made it are
    removed with the end of the writing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_let_go(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bucketed(df, name: str, keys: list[str], buckets: int, distinct: bool = True):
    """The rows of ``df``, equal ones once if ``distinct``, as a table cut by the hash of ``keys`` into ``buckets`` sorted files.

    One shuffle, at the time of writing, which also brings equal rows together;
    no later join on the keys shuffles the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    if _OWNED.get() is not None:
        _OWNED.get().append(_TABLE + table)
    # Dealt as the buckets are, so that every task writes one file.
    dealt = df.repartition(buckets, *keys)
    with shuffles_let_go(spark):
        ((dealt.distinct() if distinct else dealt).write.bucketBy(buckets, *keys).sortBy(*keys)
         .option("path", path).format("parquet").saveAsTable(table))
    return spark.table(table)
