"""Session helpers: local session builder and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from threading import Lock
from typing import ContextManager, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def local_session(cores: int | str = "*", app: str = "hireflow", **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="hireflow-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{shared_dir(spark)}/hireflow/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


#: Folders a task writes to at a time, each with a buffer; with more it sorts the rest of its rows.
WRITERS = 8

#: What a query has shuffled is deleted when it ends, not when the driver collects its garbage.
_DELETED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Settings of the session while a table is written.
_WHILE_WRITING = {"spark.sql.maxConcurrentOutputFileWriters": str(WRITERS), **_DELETED_SHUFFLES}
_set: dict[tuple[int, str], list] = {}  # by session and setting: how many use it, and its value before them
_set_lock = Lock()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    session = id(spark._jsparkSession)
    with _set_lock:
        for name, value in values.items():
            _set.setdefault((session, name), [0, spark.conf.get(name, None)])[0] += 1
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _set_lock:
            for name in values:
                using = _set[session, name]
                using[0] -= 1
                if not using[0]:
                    del _set[session, name]
                    if using[1] is None:
                        spark.conf.unset(name)
                    else:
                        spark.conf.set(name, using[1])


def deleted_shuffles(spark: SparkSession) -> ContextManager[None]:
    """Queries started meanwhile delete their shuffles when they end; for those that run once."""
    return _settings(spark, _DELETED_SHUFFLES)


def unsorted_writes(spark: SparkSession) -> ContextManager[None]:
    """Writes by ``partitionBy`` open a file per folder instead of sorting a task's rows by folder first.

    A task that sorts holds or spills all rows it has, however big the file it reads. What a write has
    shuffled is deleted when it ends.
    """
    return _settings(spark, _WHILE_WRITING)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that nothing refers to any more."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str, having: str) -> list[str]:
    """Names of the folders below a path that hold a file whose name starts with ``having``."""
    if not path_exists(spark, path):
        return []
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(fs_path(fs_path(path), f"*/{having}*"))
    return sorted({status.getPath().getParent().getName() for status in found})


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few bookkeeping rows as one partition, built from literals without Python workers."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
