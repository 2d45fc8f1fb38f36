"""The jobs behind the command line: each reads tables, runs operators and writes tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epochloom.constants import (
    CLASSES, EPOCH_SECONDS, MOTOR_CHANNELS, REST_WEIGHT, SAMPLES_PER_EPOCH, SEED, TRAIN_RATIO,
)
from epochloom.functions.columns import feature_columns, landed_channels, lateralization, live_schema, without_dots
from epochloom.operators.epochs import RECORDING, epochs_by_count
from epochloom.operators.features import epoch_features
from epochloom.operators.metrics import with_importance_tier
from epochloom.operators.model import feature_importances, fit_live, load_or_fit
from epochloom.operators.split import split_counts
from epochloom.plans import batch
from epochloom.shared import materialise, path_exists
from epochloom.sources import landing
from epochloom.sources.manifests import CONVERTED, FAILED, SKIPPED, TRUNCATED
from epochloom.sources.runs import append_runs, run_record
from epochloom.streaming import live

#: Recordings that the live model learns from unless told otherwise.
LIVE_TRAINING_RECORDINGS = 60


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a job of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def ingest(spark: SparkSession, recordings: str, landed: str, metrics: str | None = None) -> DataFrame:
    known = landing.landed_files(spark, landed, *RECORDING) if path_exists(spark, landed) else None
    tally = materialise(batch.ingest(spark, recordings, landed, known), "tally")
    if metrics:
        wide = tally.agg(*[
            F.max(F.when(F.col("status") == s, F.col("n"))).alias(s) for s in (CONVERTED, SKIPPED, FAILED, TRUNCATED)
        ])
        landing.write_metrics(wide, metrics)
    return tally


def features(spark: SparkSession, landed: str, out: str, weight: float = REST_WEIGHT) -> dict:
    """Write normalised features; returns the volumes read from the write itself."""
    table, seen = _counted(batch.build_features(landing.read_merged(spark, landed), weight), "features")
    landing.write_table(table, out)
    return {"epochs": seen.get["rows"], "features": len(feature_columns(table))}


def train(
    spark: SparkSession, features_path: str, model_path: str, metrics: str, runs: str | None = None,
    importances: str | None = None, trees: Sequence[int] = (50, 100), depths: Sequence[int] = (5, 10),
    folds: int = 3, ratio: float = TRAIN_RATIO, seed: int = SEED,
) -> DataFrame:
    table = landing.read_merged(spark, features_path)
    names = feature_columns(table)
    model, scores = batch.train(table, model_path, trees, depths, folds, ratio, seed)
    scores = materialise(scores, "test-metrics")
    landing.write_metrics(scores, metrics)
    if importances:
        landing.write_table(with_importance_tier(feature_importances(spark, model, names)), importances)
    if runs:
        sides = split_counts(table, ratio=ratio)
        subjects = sides.agg(*[
            F.max(F.when(F.col("is_train") == side, F.col("n_subjects"))).alias(name)
            for side, name in ((True, "train_subjects"), (False, "test_subjects"))
        ])
        params = {
            "num_trees_grid": F.lit(json.dumps(list(trees))), "max_depth_grid": F.lit(json.dumps(list(depths))),
            "cv_folds": F.lit(folds), "n_features": F.lit(len(names)), "rows_left_out": F.lit(model.left_out),
            "train_subjects": subjects.select("train_subjects").scalar(),
            "test_subjects": subjects.select("test_subjects").scalar(),
        }
        append_runs(run_record(scores, F.uuid(), F.current_timestamp(), params), runs)
    return scores


def evaluate(
    spark: SparkSession, features_path: str, model_path: str, predictions: str, metrics: str,
    ratio: float = TRAIN_RATIO,
) -> DataFrame:
    rows, scores = batch.evaluate_stored(landing.read_merged(spark, features_path), model_path, ratio)
    landing.write_table(rows, predictions)
    landing.write_metrics(scores, metrics)
    return scores


def export(
    spark: SparkSession, landed: str, features_path: str, predictions: str, out: str,
    subject: str = "S001", run: str = "R03",
) -> None:
    samples = without_dots(landing.read_merged(spark, landed))
    batch.export({
        "signal_sample": landing.signal_sample(samples, subject, run, ["time", "Cz", "task_label"]),
        "features": spark.read.parquet(features_path),
        "predictions": spark.read.parquet(predictions),
    }, out)


def replay(
    spark: SparkSession, landed: str, out: str, subject: str, run: str, start: str | None = None,
    rate: float = 0.5, duration: float = 300, loop: bool = False, files: int | None = None,
) -> None:
    """Land one recording as live epochs; ``loop`` repeats it until ``duration * rate`` epochs."""
    samples = without_dots(landing.read_merged(spark, landed))
    one = samples.where((F.col("subject_id") == subject) & (F.col("run_id") == run))
    channels = [c for c in one.columns if c not in (*RECORDING, "time", "task_label")]
    begin = F.lit(start).cast("timestamp") if start else F.current_timestamp()
    pace = {"rate": rate, "duration": duration} if loop else {}
    epochs = live.live_epochs(one, channels, begin, **pace)
    live.replay(epochs.where(F.col("epoch_id") < int(duration * rate)), channels, out, files=files)


def first_recordings(samples: DataFrame, count: int) -> DataFrame:
    """Samples of the first ``count`` recordings by subject and run."""
    chosen = samples.select(*RECORDING).distinct().orderBy(*RECORDING).limit(count)
    return samples.join(F.broadcast(chosen), list(RECORDING), "left_semi")  # ``count`` rows


def live_training(samples: DataFrame, recordings: int = LIVE_TRAINING_RECORDINGS) -> DataFrame:
    """Features of the live model: counted epochs, majority label, no per-subject scaling.

    ``recordings`` bounds the training set: the first so many by subject and run.
    """
    chosen = first_recordings(samples.select(*RECORDING, "time", "task_label", *MOTOR_CHANNELS), recordings)
    cut = epochs_by_count(chosen, ["time"], RECORDING, SAMPLES_PER_EPOCH)
    raw = epoch_features(
        cut, order=("sample_no",), label_rule="majority", min_samples=4, max_samples=None
    )
    return materialise(lateralization(raw), "live-training")


def stream(
    spark: SparkSession, source: str, out: str, checkpoint: str, landed: str, model_path: str,
    timeout: float = 3600, files_per_trigger: int = 1, once: bool = False, trees: int = 300, depth: int = 18,
    training_recordings: int = LIVE_TRAINING_RECORDINGS,
) -> dict:
    """Score live epochs into ``predictions`` and ``topomap`` tables until ``timeout`` seconds pass.

    ``once`` ends when everything that has landed is scored. Where no model is stored yet, one is fitted to the
    first ``training_recordings`` landed recordings.
    """
    def fit():
        training = live_training(without_dots(landing.read_merged(spark, landed)), training_recordings)
        return fit_live(training, feature_columns(training), trees=trees, depth=depth)

    model = load_or_fit(spark, model_path, fit)
    channels = landed_channels(spark, source)
    samples = live.sample_stream(spark, source, live_schema(channels), files_per_trigger)
    writer = live.batch_sink(
        samples, lambda rows: live.scored_epochs(rows, model, channels, classes=CLASSES),
        {"predictions": live.predictions_of, "topomap": live.topomap_of}, out, checkpoint,
    )
    if once:
        stats = live.run_statistics(live.run_available(writer))
    else:
        stats = live.run_live(writer, timeout, "live-epochs")
    return {"timeout_seconds": timeout, "channels": len(channels), "epoch_seconds": EPOCH_SECONDS, **stats}
