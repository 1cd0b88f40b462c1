"""Session construction and the shared folder for checkpoints / scratch tables."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

# Settings that matter for every plan in the package.  AQE re-plans joins at
# runtime (broadcast only after measuring the real size, split skewed shuffle
# partitions, coalesce small ones); the rest pin semantics for comparisons.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # let AQE pick a shuffled hash join (no sort) when every post-shuffle
    # partition of the build side is small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tastegraph", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    tests use ``local[*]`` with a handful of shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for reliable checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or a checkpoint dir already set on the
    context).  Only when neither is set *and* the master is local (tests) do we
    make our own temporary folder; on a cluster a machine-local folder would
    not survive executor loss, so we refuse instead, also a ``file:`` one
    unless the setting :data:`MOUNTED` says that all machines mount it.
    """
    sc = spark.sparkContext
    local = sc.master.startswith("local")
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="tastegraph-ckpt-")
    if not local and spark.conf.get(MOUNTED, "false") != "true" and _scheme(spark, folder) == "file":
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, on a file system of each machine; choose a shared one, or set {MOUNTED}=true if "
                           "the same folder is mounted on all of them")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


#: Says that a ``file:`` checkpoint folder is one that all machines mount.
MOUNTED = "spark.tastegraph.fileFolderIsShared"


def _scheme(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()


@contextmanager
def scratch_tables(spark: SparkSession):
    """Scope of a program: the tables that :func:`materialize` writes within
    it are deleted when it ends, so consume lazy results before."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in _SCOPES.pop():
            where = hadoop.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Open scopes of scratch tables, innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written intermediate table."""
    base = shared_dir(spark)
    path = os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def materialize(df, name: str):
    """Write an intermediate that several branches of a plan reuse to a
    parquet table in the shared folder and read it back.  Later stages scan
    it with column pruning and predicate pushdown, the lineage is cut (a lost
    executor re-reads the table instead of recomputing the joins), and each
    branch no longer re-runs the upstream scans and shuffles.  The shuffle files
    of the write go with its end: nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Scope in which a finished query leaves no shuffle files; else they stay
    until the driver's JVM happens to collect its garbage."""
    before = spark.conf.get(_DROP)
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP, before)


def release(*tables) -> None:
    """Delete materialized tables that no later step reads, and let Spark's
    cleaner drop what finished steps left: it acts on what the driver's JVM
    has collected as garbage."""
    for t in tables:
        for path in {f.rpartition("/")[0] for f in t.inputFiles()[:1]}:
            where = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
    if tables:
        collect_garbage(tables[0].sparkSession)


def collect_garbage(spark: SparkSession) -> None:
    """Spark's cleaner drops the shuffle files and blocks of what neither the
    program nor the driver's JVM refers to any more.  What the last call handed
    to Python is let go by the next one, so it takes two."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return the memory that this process has freed to the system: Arrow's
    pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow or mapInPandas, whose worker process ends the
    task without memory that it has freed.  Spark keeps several idle workers
    an executor, which would hold it while others work."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
