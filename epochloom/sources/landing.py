"""Parquet and JSON landing zones."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from epochloom.functions.columns import column
from epochloom.shared import materialise, qualified, remove, scratch, touch
from epochloom.sources.files import list_files, open_filesystem, spread

RECORDING = ("subject_id", "run_id")
ROWS_PER_FILE = 5_000_000
#: Partitions that rows are dealt to by key; Spark merges those with few bytes.
DEALT = 2048
#: Rows of a key that a task holds before they go to its file.
GROUP_ROWS = 65_536
#: Files that one task moves or reads.
FILES_PER_TASK = 1_000

LOCAL = "file:"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: What Spark escapes in names of folders.
UNSAFE = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""
ROW_METADATA = "org.apache.spark.sql.parquet.row.metadata"


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str] = RECORDING, mode: str = "overwrite",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """One folder per key. REBALANCE groups rows by key and splits a key that owns most of them.

    Rows are dealt over so many partitions that only a hot key fills one beyond the size at which Spark splits it.
    Where folders are local, tasks write the files themselves (see ``_land``); elsewhere Spark does.
    """
    spark = df.sparkSession
    path, dealt = qualified(spark, path), df.hint("rebalance", DEALT, *map(column, keys))
    if not path.startswith(LOCAL):
        dealt.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path)
        return
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "overwrite":
        remove(spark, path)
    _land(dealt, path, keys, rows_per_file)


def _land(dealt: DataFrame, path: str, keys: Sequence[str], rows_per_file: int) -> None:
    """Files of every key, written aside in tasks and moved to their folders once all are written.

    Hadoop's local client starts several processes for each file it makes, which takes far longer than a small
    file; and the driver would move them all. Only what successful attempts state is moved, so a failed write
    shows nothing and a retry no duplicates.
    """
    spark, names = dealt.sparkSession, [n for n in dealt.columns if n not in keys]
    fields, write_id = dealt.select(*map(column, names)).schema, uuid.uuid4().hex
    aside = f"{path}/_landing-{write_id}"
    rows = dealt.select(
        *[column(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
        *[column(n).alias(f"c{i}") for i, n in enumerate(names)],
    ).sortWithinPartitions(*[f"k{i}" for i in range(len(keys))])
    footer = {ROW_METADATA: fields.json()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, inner = open_filesystem(f"{aside}/{task.partitionId()}-{task.taskAttemptId()}")
        system.create_dir(inner, recursive=True)
        count, made = itertools.count(), []
        for key, pieces in itertools.groupby(_pieces(batches, len(keys)), key=lambda p: p[0]):
            folder = "/".join(map(_folder, keys, key))
            for table in _files((piece for _, piece in pieces), rows_per_file):
                name = f"part-{task.partitionId():05d}-{write_id}.c{next(count):06d}.snappy.parquet"
                with system.open_output_stream(f"{inner}/{name}") as out:
                    first = next(table)
                    schema = pa.schema([f.with_name(n) for f, n in zip(first.schema, names)], footer)
                    with pq.ParquetWriter(out, schema, store_schema=False) as file:
                        for part in itertools.chain([first], table):
                            file.write_table(pa.Table.from_arrays(part.columns, schema=schema))
                made.append({"source": f"{inner}/{name}", "folder": folder, "name": name})
        yield pa.RecordBatch.from_pylist(made, schema=written_type)

    ddl = "source string, folder string, name string"
    written_type = to_arrow_schema(T._parse_datatype_string(ddl))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = open_filesystem(path)
        for batch in batches:
            for file in batch.to_pylist():
                folder = f"{inner}/{file['folder']}"
                system.create_dir(folder, recursive=True)
                try:
                    system.move(file["source"], f"{folder}/{file['name']}")
                except FileNotFoundError:
                    if not system.get_file_info(f"{folder}/{file['name']}").is_file:  # moved by an earlier attempt
                        raise
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    with scratch(spark):
        try:
            made = materialise(rows.mapInArrow(write, ddl), "written")
            moved = spread(made, "folder", rows_per_task=FILES_PER_TASK).mapInArrow(move, "n long")
            moved.agg(F.sum("n")).collect()
        finally:
            remove(spark, aside)
    touch(spark, f"{path}/_SUCCESS")


def _pieces(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys, the first columns of batches that are sorted by them, without these columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        codes = [c.dictionary_encode(null_encoding="encode").indices.to_numpy() for c in batch.columns[:keys]]
        ends = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in codes])) + 1
        rest = table.select(range(keys, table.num_columns))
        for start, end in itertools.pairwise([0, *ends.tolist(), batch.num_rows]):
            yield tuple(batch[i][start].as_py() for i in range(keys)), rest.slice(start, end - start)


def _files(pieces: Iterator[pa.Table], rows_per_file: int) -> Iterator[Iterator[pa.Table]]:
    """The rows of a key as files of at most ``rows_per_file``, each as tables of a row group."""
    pieces, kept = iter(pieces), []

    def groups() -> Iterator[pa.Table]:
        room, held = rows_per_file, 0
        taken: list[pa.Table] = []
        while room:
            piece = kept.pop() if kept else next(pieces, None)
            if piece is None:
                break
            if piece.num_rows > room:
                kept.append(piece.slice(room))
                piece = piece.slice(0, room)
            taken.append(piece)
            room, held = room - piece.num_rows, held + piece.num_rows
            if held >= GROUP_ROWS:
                yield pa.concat_tables(taken).combine_chunks()
                taken, held = [], 0
        if taken:
            yield pa.concat_tables(taken).combine_chunks()

    while kept or (piece := next(pieces, None)) is not None:
        if not kept:
            kept.append(piece)
        yield groups()


def _folder(key: str, value: str | None) -> str:
    """The folder of a key's value, escaped as Spark escapes it."""
    escaped = [re.sub(UNSAFE, lambda c: f"%{ord(c[0]):02X}", text or "") for text in (key, value)]
    return f"{escaped[0]}={escaped[1] or NO_VALUE}"


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = RECORDING
) -> DataFrame:
    """All rows of a landing zone with the columns of ``schema``; ``keys`` are strings, from the folders' names.

    Local folders are listed and read in tasks, so the driver holds no entry for each file. A column that a file
    lacks is NULL. To read a few folders only, leave it to Spark's reader, which prunes them.
    """
    names = [*keys, *[f.name for f in schema if f.name not in keys]]
    typed = T.StructType([T.StructField(n, T.StringType() if n in keys else schema[n].dataType) for n in names])
    if not qualified(spark, path).startswith(LOCAL):
        return spark.read.schema(typed).parquet(path)
    arrow = to_arrow_schema(typed)
    rest = pa.schema([arrow.field(n) for n in names[len(keys):]])
    marks = [re.compile(f"/{re.escape(_folder(k, None).removesuffix(NO_VALUE))}([^/]*)/") for k in keys]

    def values(file: str) -> list[str | None]:
        found = [mark.search(file)[1] for mark in marks]
        return [None if v == NO_VALUE else unquote(v) for v in found]

    def tables(file: str) -> Iterator[pa.Table]:
        system, inner = open_filesystem(file)
        with system.open_input_file(inner) as opened:
            parquet = pq.ParquetFile(opened)
            held = set(parquet.schema_arrow.names)
            own = [pa.scalar(v, pa.string()) for v in values(file)]
            for batch in parquet.iter_batches(GROUP_ROWS, columns=[n for n in rest.names if n in held], use_threads=False):
                columns = [
                    batch.column(f.name).cast(f.type) if f.name in held else pa.nulls(batch.num_rows, f.type) for f in rest
                ]
                yield pa.Table.from_arrays([*[pa.repeat(v, batch.num_rows) for v in own], *columns], schema=arrow)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for table in (t for batch in batches for file in batch["path"].to_pylist() for t in tables(file)):
            waiting.append(table)
            rows += table.num_rows
            if rows >= GROUP_ROWS:
                yield from pa.concat_tables(waiting).combine_chunks().to_batches()
                waiting, rows = [], 0
        if waiting:
            yield from pa.concat_tables(waiting).combine_chunks().to_batches()

    files = list_files(spark, path, ".parquet").select("path")
    return spread(files, "path", rows_per_task=FILES_PER_TASK).mapInArrow(read, typed)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Scan with merged schemas: a channel missing from a file reads as NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A one-row metrics document as a single JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def signal_sample(
    df: DataFrame, subject, run, columns: Sequence[str], order: Sequence[str] = ("time",),
    count: int = 3200, subject_column: str = "subject_id", run_column: str = "run_id",
) -> DataFrame:
    """First ``count`` samples of one recording. Both filters prune partitions."""
    return (
        df.where((F.col(subject_column) == subject) & (F.col(run_column) == run))
        .orderBy(*order)
        .select(*columns)
        .limit(count)
    )


def landed_files(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """``path, length, written`` of the Parquet files below a folder, and the partition values ``keys`` as strings.

    Spark lists the folders, many of them in tasks; no file is opened.
    """
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
        .select("path", "length", F.col("modificationTime").alias("written"))
    )
    values = [
        F.try_url_decode(F.replace(F.regexp_extract("path", f"/{re.escape(key)}=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))).alias(key)
        for key in keys
    ]
    return listed.select("path", "length", "written", *values)


def latest_batches(spark: SparkSession, path: str, count: int, batch: str = "batch_id") -> DataFrame:
    """Rows of the newest ``count`` batches of a sink laid out as ``batch_id=<n>`` folders.

    The batches come from the names of folders; the scan is pruned to them.
    """
    table = spark.read.parquet(path)
    number = F.col(batch).cast(table.schema[batch].dataType)
    newest = landed_files(spark, path, batch).select(number.alias("n")).distinct().orderBy(F.desc("n")).limit(count)
    return table.where(F.col(batch).isin([r.n for r in newest.collect()]))  # at most ``count`` numbers


def latest_files(spark: SparkSession, path: str, count: int) -> DataFrame:
    """Rows of the ``count`` most recently written files of a folder, from a listing of it."""
    newest = landed_files(spark, path).orderBy(F.desc("written"), F.desc("path")).limit(count).collect()
    if not newest:
        return spark.read.parquet(path).limit(0)
    schema = spark.read.parquet(path).schema
    return spark.read.schema(schema).option("basePath", path).parquet(*[r.path for r in newest])


def union_batches(*frames: DataFrame) -> DataFrame:
    """All rows of frames whose columns may differ; missing ones become NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
