"""Live epochs: file source, scoring with two sinks, event-time assembly and de-duplication."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from epochloom.constants import (
    BANDS, CLASSES, EPOCH_SECONDS, LIVE_META, MOTOR_CHANNELS, SAMPLES_PER_EPOCH, SAMPLING_HZ,
)
from epochloom.functions.columns import as_double, column, lateralization
from epochloom.operators.epochs import (
    EPOCH, SLICE_SAMPLES, RECORDING, epochs_by_count, event_times, loop_replay, majority_label,
)
from epochloom.operators.features import epoch_features
from epochloom.operators.model import score
from epochloom.shared import materialise, shuffles_released

TRIGGER = "1 seconds"


def live_epochs(
    samples: DataFrame, channels: Sequence[str], start: Column, order: Sequence[str] = ("time",),
    size: int = SAMPLES_PER_EPOCH, seconds: float = EPOCH_SECONDS, rate: float | None = None,
    duration: float | None = None, clock_hz: float | None = None,
) -> DataFrame:
    """Stored samples in the layout of a live input: whole epochs, each with label and event time.

    Where stored times repeat, ``clock_hz`` replaces them by the place in the recording.
    With ``rate`` (epochs per second) and ``duration`` each recording is looped until
    ``int(duration * rate)`` epochs have played; ``epoch_id`` then counts the played epochs.
    """
    cut = epochs_by_count(samples, order, RECORDING, size)
    if clock_hz:
        cut = cut.withColumn("time", (F.col("epoch_id") * size + F.col("sample_no")) / clock_hz)
    # Read twice, by the labels and by the rows; numbering twice would hold all rows on disk twice.
    cut = materialise(cut.select(*EPOCH, "time", "task_label", *map(column, channels)), "cut")
    epochs = cut.groupBy(*EPOCH).agg(majority_label("task_label").alias("epoch_label"))
    if rate and duration:
        epochs = loop_replay(epochs, ["epoch_id"], RECORDING, rate, duration)
    else:
        epochs = epochs.withColumn("replay_no", F.col("epoch_id"))
    timed = event_times(epochs, start, "replay_no", seconds).withColumn(
        "event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    rows = cut.join(timed, list(EPOCH)).withColumn("epoch_id", F.col("replay_no"))
    rows = rows.withColumns({
        "run_seq": F.lit(None).cast("long"), "subject_id": F.col("subject_id").cast("string"),
    })
    return as_double(rows, ["time", *channels]).select(*LIVE_META, *map(column, channels))


def replay(samples: DataFrame, channels: Sequence[str], path: str, keys: Sequence[str] = EPOCH,
           files: int | None = None) -> None:
    """Land epochs for a stream; a file holds whole epochs, so no epoch spans two triggers.

    Channels and time become doubles. Pacing is left to the reader's ``maxFilesPerTrigger``.
    """
    rows = as_double(samples, ["time", *channels])
    spread = rows.repartition(*keys) if files is None else rows.repartition(files, *keys)
    with shuffles_released(samples.sparkSession):
        spread.write.mode("append").parquet(path)


def land_in_order(
    df: DataFrame, time: str, path: str, steps: int = 4, files: int | None = None
) -> None:
    """Append ``df`` in ``steps`` slices of rising time, so file age follows event time.

    Rows without a time come with the first slice. Within a slice the files have no order: a reader with a watermark takes at least a slice per
    trigger, or allows for a slice's span as delay. ``files`` limits the files per slice.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    cuts = df.agg(
        F.percentile_approx(at, [i / steps for i in range(1, steps)], 10_000).alias("c")
    ).first().c or []
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in zip(bounds, bounds[1:]):
        part = df
        if low is not None:
            part = part.where(at > low)
        if high is not None:
            inside = at <= high
            part = part.where(inside | at.isNull() if low is None else inside)
        (part.coalesce(files) if files else part).write.mode("append").parquet(path)


def land_closing_row(df: DataFrame, time: str, path: str, seconds: int) -> None:
    """Append a row with nothing but a time, ``seconds`` after the newest of ``df``.

    If ``seconds`` is more than an epoch and the reader's delay, the watermark passes the end of every epoch
    of ``df`` and stays before the end of the closing row's own epoch, which is never emitted.
    """
    newest = df.agg(F.max(F.col(time).cast("timestamp")).alias("_newest"))
    later = F.timestamp_micros(F.unix_micros("_newest") + seconds * 1_000_000)
    newest.select(*[
        (later if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema
    ]).write.mode("append").parquet(path)


def sample_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet file source with an explicit schema."""
    reader = spark.readStream.format("parquet").schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def scored_epochs(
    samples: DataFrame,
    model,
    channels: Sequence[str],
    motor: Sequence[str] = MOTOR_CHANNELS,
    bands: Mapping[str, tuple[float, float]] = BANDS,
    fs: float = SAMPLING_HZ,
    order: Sequence[str] = ("time",),
    classes: Sequence[str] = CLASSES,
    map_band: str = "alpha",
    max_samples: int | None = SLICE_SAMPLES,
    scorer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per epoch with ``prediction`` (struct) and ``topomaps`` (array of structs).

    All channels are collected and transformed once; the motor channels feed the model and every
    channel feeds the map. ``scorer`` replaces the model: it adds ``pred_label``,
    ``proba_<class>`` and ``correct`` to a feature frame.
    """
    described = {
        "true_label": F.min("epoch_label"), "event_time": F.min("event_time"), "run_seq": F.min("run_seq"),
    }
    wide = epoch_features(
        samples, channels, bands, fs, order, min_samples=4, max_samples=max_samples, extra=described
    )
    wide = lateralization(wide, bands, motor[0], motor[-1])
    scored = scorer(wide) if scorer else score(model, wide, "true_label", classes)
    shared = ["event_time", "epoch_id", "true_label", "pred_label"]
    prediction = F.struct(
        "event_time", "epoch_id", "subject_id", "run_id", "run_seq", "true_label", "pred_label",
        *[f"proba_{name}" for name in classes], "correct",
    )
    entry = [
        F.struct(*shared, F.lit(name).alias("channel"), F.col(f"{name}_{map_band}").alias("alpha_power"),
                 "subject_id", "run_id")
        for name in channels
    ]
    return scored.select(prediction.alias("prediction"), F.array(*entry).alias("topomaps"))


def predictions_of(scored: DataFrame) -> DataFrame:
    return scored.select("prediction.*")


def topomap_of(scored: DataFrame) -> DataFrame:
    # A plain explode adds a filter on the array's size, which would score twice.
    return scored.select(F.explode_outer("topomaps").alias("t")).select("t.*")


def batch_sink(
    stream: DataFrame, process: Callable[[DataFrame], DataFrame],
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str,
) -> DataStreamWriter:
    """Write several outputs of each micro-batch, each to ``<path>/<name>/query_id=<id>/batch_id=<n>``.

    The query's identifier lives in its checkpoint: a repeated batch overwrites its own folders, so a
    retry leaves no duplicates, and a query with a new checkpoint adds to what earlier ones wrote. A record of
    the batch under ``<path>/commits`` follows when all outputs are written: read them with ``committed``,
    which shows all of a batch or nothing. The batch and its result are kept while the outputs are written.
    Empty batches are skipped. Processed rows are counted while they are kept, for ``run_statistics``.
    """
    counted = {"epochs": 0}

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place, seen = f"query_id={query_id}/batch_id={batch_id}", Observation()
        rows = batch.persist()
        done = process(rows).observe(seen, F.count(F.lit(1)).alias("epochs")).persist()
        try:
            if not rows.count():  # fills the cache, so the source is read once
                return
            for name, project in outputs.items():
                project(done).write.mode("overwrite").parquet(f"{path}/{name}/{place}")
            counted["epochs"] += seen.get["epochs"]
            record = batch.sparkSession.range(1).select(F.lit(seen.get["epochs"]).alias("epochs"), F.current_timestamp().alias("written"))
            record.write.mode("overwrite").parquet(f"{path}/commits/{place}")
        finally:
            done.unpersist()
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.counted = counted
    return writer


def committed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One output of a ``batch_sink``: the rows of batches of which every output is written."""
    batch = ["query_id", "batch_id"]
    done = spark.read.parquet(f"{path}/commits").select(*batch)
    return spark.read.parquet(f"{path}/{name}").join(done, batch, "left_semi")


def table_sink(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Exactly-once Parquet sink in append mode."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


ROWS = "rows_seen"


def observed(stream: DataFrame) -> DataFrame:
    """``stream`` with its rows counted in every progress event."""
    return stream.observe(ROWS, F.count(F.lit(1)).alias("rows"))


class Tally(StreamingQueryListener):
    """Counts of one query over all its triggers; the query itself remembers the last hundred only."""

    def __init__(self) -> None:
        self.batches, self.rows_read, self.milliseconds, self.rows = 0, 0, 0, None
        self.ended, self._last = threading.Event(), None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.batchId != self._last and progress.numInputRows:
            self.batches += 1
            self.milliseconds += progress.batchDuration
            self.rows_read += progress.numInputRows
            seen = progress.observedMetrics.get(ROWS)
            if seen is not None:
                self.rows = (self.rows or 0) + seen.rows
        self._last = progress.batchId

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def _tallied(writer: DataStreamWriter, wait: Callable[[StreamingQuery], None]) -> StreamingQuery:
    spark, tally = SparkSession.getActiveSession(), Tally()
    spark.streams.addListener(tally)
    try:
        query = writer.start()
        try:
            wait(query)
        finally:
            query.stop()
        tally.ended.wait(30)  # its last progress comes before
    finally:
        spark.streams.removeListener(tally)
    query.tally, query.counted = tally, getattr(writer, "counted", {})
    return query


def run_live(
    writer: DataStreamWriter, timeout: float, name: str, interval: str = TRIGGER, until: int | None = None,
) -> dict:
    """Trigger every ``interval`` until ``timeout`` seconds have passed, then stop this query.

    With ``until`` it stops earlier, once that many batches are done.
    """
    def wait(started: StreamingQuery) -> None:
        deadline = time.monotonic() + timeout
        while time.monotonic() < deadline:
            if started.awaitTermination(min(1.0, max(deadline - time.monotonic(), 0.01))):
                return
            last = started.lastProgress
            if until is not None and last and last.batchId + 1 >= until and not started.status["isTriggerActive"]:
                return

    query = _tallied(writer.queryName(name).trigger(processingTime=interval), wait)
    return run_statistics(query) | {"timeout_seconds": timeout}


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that has landed, then end."""
    return _tallied(writer.trigger(availableNow=True), lambda started: started.awaitTermination())


def run_statistics(query: StreamingQuery) -> dict:
    """What a finished query did over its whole run.

    Batches with rows, rows read, rows observed (where the stream is ``observed``), milliseconds in triggers
    and per trigger; for a ``batch_sink`` also the epochs it wrote and milliseconds per epoch.
    """
    tally = query.tally
    stats = {"batches": tally.batches, "rows_read": tally.rows_read, "milliseconds": tally.milliseconds}
    if tally.rows is not None:
        stats["rows"] = tally.rows
    if tally.batches:
        stats["milliseconds_per_trigger"] = tally.milliseconds / tally.batches
    if "epochs" in query.counted:
        stats["epochs"] = query.counted["epochs"]
        if stats["epochs"]:
            stats["milliseconds_per_epoch"] = tally.milliseconds / stats["epochs"]
    return stats


def window_epochs(
    stream: DataFrame, time: str, keys: Sequence[str], seconds: int, delay: str,
    aggregates: Sequence[Column],
) -> DataFrame:
    """Event-time epochs that may span files, emitted once the watermark has passed their end.

    The state of an epoch is a fixed set of aggregates, and rows are combined before the shuffle.
    """
    window = F.window(time, f"{seconds} seconds")
    return (
        stream.withWatermark(time, delay)
        .groupBy(*keys, window.alias("_w"))
        .agg(*aggregates)
        .withColumn("epoch_id", F.floor(F.unix_micros("_w.start") / (seconds * 1_000_000)))
        .drop("_w")
    )


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First row per key; a key is remembered until the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
