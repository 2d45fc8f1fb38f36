"""EDF and EDF+ recordings as Spark rows.

A file's header is read once and planned as ranges of data records, so one large recording spreads over the
cluster. A first pass reads the annotation blocks alone and settles, for every file, its outcome and its
disjoint label pieces. The ranges carry these along, and each is then read and decoded by one task that
labels its samples by binary search: samples are read once and never exchanged. Layout (Kemp 1992; Kemp and Olivan 2003): a
256-byte header, 256 bytes per signal, then fixed-size records of little-endian 16-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from epochloom.constants import REST_CLASS
from epochloom.operators.intervals import disjoint_pieces
from epochloom.shared import materialise
from epochloom.sources.files import open_ranges, spread

ANNOTATIONS = "EDF Annotations"
RECORDS_BYTES = 8 << 20
#: A task gets 16 whole ranges, or up to a thousand of short recordings.
BYTES_PER_TASK = 16 * RECORDS_BYTES
FILES_PER_TASK = 1_000
# Header values are scaled to volts.
UNIT_SCALE = {"uV": 1e-6, "µV": 1e-6, "mV": 1e-3}

#: Annotation blocks closer together than this are read in one go.
GAP_BYTES = 4096

PLAN_COLUMNS = {
    "path": "string", "subject_id": "string", "run_id": "string", "status": "string",
    "error": "string", "channels": "array<string>", "signals": "array<string>", "samples": "array<int>",
    "gain": "array<double>", "offset": "array<double>", "header_bytes": "long", "record_bytes": "long",
    "rate": "double", "first_record": "long", "n_records": "long",
}
_NOTE = "struct<rank: bigint, onset: double, finish: double, label: string>"


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


class Truncated(ValueError):
    """A file that ends before the records its header states."""


@dataclass(frozen=True)
class Header:
    signals: list[str]
    samples: np.ndarray
    gain: np.ndarray
    offset: np.ndarray
    header_bytes: int
    record_bytes: int
    records: int
    record_seconds: float

    @property
    def channels(self) -> list[str]:
        return [name for name in self.signals if name != ANNOTATIONS]

    @property
    def rate(self) -> float:
        used = {int(n) for n, name in zip(self.samples, self.signals) if name != ANNOTATIONS}
        if len(used) != 1:
            raise ValueError("channels differ in sampling rate")
        return used.pop() / self.record_seconds


def parse_header(raw: bytes, file_bytes: int) -> Header:
    if len(raw) < 256:
        raise ValueError("file ends inside the header")
    count = int(raw[252:256])
    if count < 1 or len(raw) < 256 * (count + 1):
        raise ValueError("file ends inside the signal headers")
    fields, at = [], 256
    for width in (16, 80, 8, 8, 8, 8, 8, 80, 8):
        block = raw[at:at + width * count]
        fields.append([block[i * width:(i + 1) * width].decode("latin-1").strip() for i in range(count)])
        at += width * count
    low, high, dlow, dhigh = (np.array(fields[i], dtype=float) for i in (3, 4, 5, 6))
    scale = np.array([UNIT_SCALE.get(unit, 1.0) for unit in fields[2]])
    gain = (high - low) / (dhigh - dlow)
    samples = np.array(fields[8], dtype=int)
    header_bytes, record_bytes = int(raw[184:192]), int(samples.sum()) * 2
    present = (file_bytes - header_bytes) // record_bytes
    stated = int(raw[236:244])
    # A recording still being written states -1 records: what is there counts.
    if stated > present:
        raise Truncated(f"file holds {present} of {stated} records")
    records = present if stated < 0 else stated
    return Header(fields[0], samples, gain * scale, (low - gain * dlow) * scale, header_bytes,
                  record_bytes, records, float(raw[244:252]))


def read_header(path: str, file_bytes: int) -> Header:
    with open_ranges(path) as read:
        fixed = read(0, 256)
        signals = int(fixed[252:256]) if len(fixed) == 256 else 0
        return parse_header(fixed + read(256, 256 * signals), file_bytes)


def annotations_of(block: bytes) -> Iterator[tuple[float, float, str]]:
    """Onset, duration and text of each entry of one record's annotation signal."""
    for entry in block.split(b"\x00"):
        if not entry:
            continue
        stamp, *texts = entry.split(b"\x14")
        onset, _, duration = stamp.partition(b"\x15")
        for text in texts:
            if text:  # the first, empty text of a record only keeps time
                yield float(onset), float(duration or 0), text.decode("utf-8")


def plan_records(files: DataFrame, range_bytes: int = RECORDS_BYTES) -> DataFrame:
    """Record ranges of every readable file; an unreadable file yields one row with its error.

    A range carries what its header says, so nothing of the header is read again.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.to_pylist():
                row = dict.fromkeys(PLAN_COLUMNS) | {k: file[k] for k in ("path", "subject_id", "run_id")}
                try:
                    header = read_header(file["path"], file["length"])
                    row |= {
                        "status": "converted", "channels": header.channels, "signals": header.signals,
                        "samples": header.samples.tolist(), "gain": header.gain.tolist(), "offset": header.offset.tolist(),
                        "header_bytes": header.header_bytes, "record_bytes": header.record_bytes, "rate": header.rate,
                    }
                except Exception as error:  # one bad file must not fail the job
                    status = "truncated" if isinstance(error, Truncated) else "errors"
                    rows.append(row | {"status": status, "error": f"{type(error).__name__}: {error}", "first_record": 0, "n_records": 0})
                    continue
                step = max(range_bytes // header.record_bytes, 1)
                rows += [
                    row | {"first_record": first, "n_records": min(step, header.records - first)}
                    for first in range(0, max(header.records, 1), step)
                ]
            yield pa.RecordBatch.from_pylist(rows, schema=plan_type)

    listed = files.select("path", "length", "subject_id", "run_id")
    ddl = _ddl(PLAN_COLUMNS)
    plan_type = to_arrow_schema(T._parse_datatype_string(ddl))
    return spread(listed, "path", rows_per_task=FILES_PER_TASK).mapInArrow(plan, ddl)


def _spread_ranges(ranges: DataFrame) -> DataFrame:
    size = F.col("n_records") * F.col("record_bytes")
    return spread(ranges, "path", "first_record", rows_per_task=FILES_PER_TASK, size=size, size_per_task=BYTES_PER_TASK)


def _edges(row: dict) -> list[int]:
    """Where each signal begins in a record, in samples."""
    return [0, *np.cumsum(row["samples"]).tolist()]


def _annotation_blocks(row: dict) -> Iterator[tuple[int, list[bytes]]]:
    """(record, annotation blocks) of a range; other signals between far blocks are not read."""
    edges = _edges(row)
    spans = [(2 * edges[i], 2 * edges[i + 1]) for i, name in enumerate(row["signals"]) if name == ANNOTATIONS]
    if not spans or row["n_records"] < 1:
        return
    begin = row["header_bytes"] + row["first_record"] * row["record_bytes"]
    low, high, size = spans[0][0], spans[-1][1], row["record_bytes"]
    with open_ranges(row["path"]) as read:
        if size - (high - low) < GAP_BYTES:
            raw = read(begin, row["n_records"] * size)
            records = (raw[r * size : (r + 1) * size] for r in range(row["n_records"]))
        else:
            records = (bytes(low) + read(begin + r * size + low, high - low) for r in range(row["n_records"]))
        for r, record in enumerate(records):
            if len(record) < high:
                raise ValueError(f"record {row['first_record'] + r} ends early")
            yield row["first_record"] + r, [record[a:b] for a, b in spans]


def read_annotations(ranges: DataFrame) -> DataFrame:
    """Per range: ``path``, and either its ``notes`` (rank, onset, finish, label) or its ``error``.

    Ranks order the notes as they stand in the file.
    """

    def notes_of(row: dict) -> list[dict]:
        return [
            {"rank": record * 65536 + n, "onset": onset, "finish": onset + duration, "label": text}
            for record, blocks in _annotation_blocks(row)
            for n, (onset, duration, text) in enumerate(e for block in blocks for e in annotations_of(block))
        ]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                try:
                    rows.append({"path": row["path"], "notes": notes_of(row), "error": None})
                except Exception as error:  # one bad file must not fail the job
                    rows.append({"path": row["path"], "notes": [], "error": f"{type(error).__name__}: {error}"})
            yield pa.RecordBatch.from_pylist(rows, schema=note_type)

    ddl = f"path string, notes array<{_NOTE}>, error string"
    note_type = to_arrow_schema(T._parse_datatype_string(ddl))
    return _spread_ranges(ranges.drop("channels", "gain", "offset", "status", "error")).mapInArrow(read, ddl)


def decode_samples(ranges: DataFrame, channels: Sequence[str], default: str = REST_CLASS) -> DataFrame:
    """Sample rows ``subject_id, run_id, time, <channel...>, task_label`` of ranges with label ``pieces``.

    A channel that a file lacks is NULL. A sample between pieces, or of a range without any, has ``default``.
    """
    names = ["subject_id", "run_id", "time", *channels, "task_label"]
    fields = [(n, T.StringType() if n in ("subject_id", "run_id", "task_label") else T.DoubleType()) for n in names]
    schema = T.StructType([T.StructField(n, kind) for n, kind in fields])

    def decoded(row: dict) -> pa.RecordBatch:
        size, edges, records = row["record_bytes"], _edges(row), row["n_records"]
        with open_ranges(row["path"]) as read:
            raw = read(row["header_bytes"] + row["first_record"] * size, records * size)
        words = np.frombuffer(raw, dtype="<i2").reshape(records, -1)
        used = [i for i, name in enumerate(row["signals"]) if name != ANNOTATIONS]
        per_record = row["samples"][used[0]]
        total = records * per_record
        time = (np.arange(total) + row["first_record"] * per_record) / row["rate"]
        columns = {name: pa.nulls(total, pa.float64()) for name in channels}
        for i in used:
            if row["signals"][i] in columns:
                digital = words[:, edges[i]:edges[i + 1]].reshape(-1).astype(float)
                columns[row["signals"][i]] = pa.array(digital * row["gain"][i] + row["offset"][i])
        pieces = row["pieces"] or []
        labels = pa.array([default, *(default if p["label"] is None else p["label"] for p in pieces)], pa.string())
        place = np.searchsorted(np.array([p["start"] for p in pieces], dtype=float), time, side="right")
        constant = [pa.array([row[k]], pa.string()).take(pa.array(np.zeros(total, np.int32))) for k in ("subject_id", "run_id")]
        return pa.RecordBatch.from_arrays([*constant, pa.array(time), *columns.values(), labels.take(pa.array(place))], names=names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(decoded, batch.to_pylist())

    return _spread_ranges(ranges).mapInArrow(decode, schema)


def decode_recordings(
    files: DataFrame, channels: Sequence[str] | None = None, range_bytes: int = RECORDS_BYTES,
    default: str = REST_CLASS,
) -> tuple[DataFrame, DataFrame]:
    """Labelled sample rows of all readable files, and the outcome of every file.

    A file with a range whose annotations cannot be decoded counts as an error and lands no samples; so the
    outcomes are known before any sample is read. The channel set is the union over the files unless given.
    Labels follow the recordings' own annotations; samples outside of them carry ``default``.
    """
    plan = materialise(plan_records(files, range_bytes), "edf-plan")
    merged = read_annotations(plan.where("n_records > 0")).groupBy("path").agg(
        F.flatten(F.collect_list("notes")).alias("notes"), F.min("error").alias("damage")
    )
    lasting = F.filter("notes", lambda n: n["onset"] < n["finish"])
    labels = materialise(merged.select("path", "damage", disjoint_pieces(lasting).alias("pieces")), "edf-labels")
    planned = plan.where("first_record = 0").select("path", "subject_id", "run_id", "status", "error")
    status = planned.join(labels.select("path", "damage"), "path", "left").select(
        "path", "subject_id", "run_id", F.when(F.col("damage").isNull(), F.col("status")).otherwise("errors").alias("status"),
        F.coalesce("error", "damage").alias("error"),
    )
    ranges = plan.where("n_records > 0").join(labels.where("damage IS NULL").drop("damage"), "path")
    if channels is None:
        found = plan.select(F.explode("channels").alias("c")).distinct()
        channels = sorted(row.c for row in found.collect())  # a file names at most 9999 signals
    return decode_samples(ranges.drop("status", "error", "channels"), channels, default), status
