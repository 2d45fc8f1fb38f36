"""Byte access from inside tasks, on whatever file system Spark's paths name."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epochloom.shared import materialise, qualified

#: Folders that one task lists.
FOLDERS_PER_TASK = 1_000

#: Schemes of Spark's object stores and what the Arrow library calls them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "abfs": "abfs", "abfss": "abfss"}


def open_filesystem(path: str):
    """Arrow file system and inner path of a Spark path; a bare path is local, ``dbfs:`` is its mount."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme in ("file", "dbfs"):
        inner = "/" + rest.lstrip("/")
        return fs.LocalFileSystem(), inner if scheme == "file" else f"/dbfs{inner}"
    return fs.FileSystem.from_uri(quote(f"{SCHEMES.get(scheme, scheme)}:{rest}", safe=":/@?=&%+,;"))


@contextmanager
def open_ranges(path: str) -> Iterator[Callable[[int, int], bytes]]:
    """A function that reads ``length`` bytes from ``start`` of the file, or what there is of them."""
    system, inner = open_filesystem(path)
    with system.open_input_file(inner) as file:
        size = file.size()
        yield lambda start, length: file.read_at(min(length, max(size - start, 0)), start)


def read_range(path: str, start: int, length: int) -> bytes:
    with open_ranges(path) as read:
        return read(start, length)


def write_bytes(path: str, data: bytes) -> None:
    system, inner = open_filesystem(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner) as file:
        file.write(data)


def spread(
    df: DataFrame, *keys: str, rows_per_task: int, rows: int | None = None, size: Column | None = None,
    size_per_task: int = 1,
) -> DataFrame:
    """Spread rows that are small but stand for much work; a fixed count is not merged back.

    A task gets about ``rows_per_task`` rows, or fewer if their ``size`` comes to ``size_per_task`` before.
    """
    if rows is None or size is not None:
        rows, total = df.agg(F.count(F.lit(1)), F.sum(F.lit(0) if size is None else size)).first()
    parallel = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(rows, 2 * parallel), -(-rows // rows_per_task), 1)
    if size is not None:
        tasks = max(tasks, min(rows, -(-(total or 0) // size_per_task)))
    return df.repartition(tasks, *keys)


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for folder in batch["path"].to_pylist():
            system, inner = open_filesystem(folder)
            seen = [e for e in system.get_file_info(fs.FileSelector(inner)) if not _hidden(e.base_name)]
            yield pa.record_batch({
                "path": pa.array([f"{folder}/{e.base_name}" for e in seen], pa.string()),
                "length": pa.array([e.size for e in seen], pa.int64()),
                "folder": pa.array([e.type == fs.FileType.Directory for e in seen], pa.bool_()),
            })


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """``path, length`` of the files below a folder whose names end with ``suffix``.

    The folders of a level are listed in tasks and what they hold is stored, so the driver keeps no entry.
    """
    files, level = None, spark.range(1).select(F.lit(qualified(spark, root).rstrip("/")).alias("path"))
    while True:
        entries = materialise(level.mapInArrow(_listed, "path string, length long, folder boolean"), "listing")
        found = entries.where(~F.col("folder") & F.col("path").endswith(suffix)).select("path", "length")
        files = found if files is None else files.unionAll(found)
        folders = entries.where("folder").select("path")
        if not (count := folders.count()):
            return files
        level = spread(folders, "path", rows_per_task=FOLDERS_PER_TASK, rows=count)
