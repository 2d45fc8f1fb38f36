"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where driver and tasks are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="epochloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/epochloom/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and scan the result, which cuts lineage and survives lost executors.

    Columnar storage lets each consumer read only the columns it needs. The table lives as long as
    the application; the shuffles behind it go once it is written.
    """
    path = shared_path(df.sparkSession, label)
    _registered(df.sparkSession, path)
    with shuffles_released(df.sparkSession):
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it ends, rather than when the driver's collector comes by."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


_scopes = threading.local()


def _registered(spark: SparkSession, path: str) -> None:
    """Note a path that goes when the innermost ``scratch`` ends, or else when the application does."""
    open_scopes = getattr(_scopes, "open", [])
    if open_scopes:
        open_scopes[-1].append(path)
    _remove_at_exit(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Remove what ``materialise`` writes inside, but for what the yielded function stores.

    That function works like ``materialise``; its tables belong to the scope around this one. Frames that
    read other tables of the scope must be stored or collected before it ends.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    made: list[str] = []
    _scopes.open.append(made)

    def keep(df: DataFrame, label: str) -> DataFrame:
        _scopes.open.pop()
        try:
            return materialise(df, label)
        finally:
            _scopes.open.append(made)

    try:
        yield keep
    finally:
        _scopes.open.pop()
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    system, where = _file_system(spark, path)
    system.delete(where, True)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Let the driver's file system client remove ``path`` when the application ends."""
    system, where = _file_system(spark, path)
    system.deleteOnExit(where)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as the session's default file system completes it."""
    system, where = _file_system(spark, path)
    return system.makeQualified(where).toString()


def touch(spark: SparkSession, path: str) -> None:
    """An empty file on the shared file system."""
    system, where = _file_system(spark, path)
    system.create(where, True).close()


def path_exists(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return system.exists(where)


def read_if_landed(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The Parquet table at ``path``, or None while the folder is missing or empty."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
