"""The batch jobs: ingest, features, training, evaluation, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochloom.constants import (
    BANDS, CLASSES, MOTOR_CHANNELS, MOTOR_RUNS, REST_CLASS, REST_WEIGHT, SAMPLING_HZ, SEED, TRAIN_RATIO,
)
from epochloom.functions.columns import feature_columns, lateralization, without_dots
from epochloom.operators.epochs import SLICE_SAMPLES, epochs_by_time
from epochloom.operators.features import epoch_features, with_rest_weight, zscore_by_subject
from epochloom.operators.model import evaluate, forest_pipeline, tune_forest
from epochloom.operators.split import train_test
from epochloom.shared import materialise
from epochloom.sources.edf import decode_recordings
from epochloom.sources.landing import write_partitioned, write_table
from epochloom.sources.manifests import SKIPPED, outcomes, pending, recording_files


def ingest(
    spark: SparkSession, recordings: str, landing: str, landed: DataFrame | None = None,
    runs: Sequence[str] | None = MOTOR_RUNS,
) -> DataFrame:
    """Convert the recordings that have not landed yet; returns the tally of outcomes.

    ``landed`` holds a row for each landed recording or more, such as the files of the landing zone, if there
    are any yet. What counts is committed data, so a recording that
    failed before is tried again.
    """
    listed = recording_files(spark, recordings)
    if runs is not None:
        listed = listed.where(F.col("run_id").isin(*runs))
    listed = materialise(listed, "manifest")
    if landed is not None:
        # Stored, because the landing zone grows before the tally is read.
        landed = materialise(landed.select("subject_id", "run_id").distinct(), "landed")
    todo = listed if landed is None else pending(listed, landed, runs=None)
    samples, status = decode_recordings(todo)
    write_partitioned(samples, landing, mode="append")
    skipped = (
        listed.limit(0) if landed is None
        else listed.join(landed, ["subject_id", "run_id"], "left_semi")
    )
    return outcomes(status.select("status").unionAll(skipped.select(F.lit(SKIPPED).alias("status"))))


def normalised_features(
    epochs: DataFrame,
    channels: Sequence[str] = MOTOR_CHANNELS,
    bands: Mapping[str, tuple[float, float]] = BANDS,
    fs: float = SAMPLING_HZ,
    order: Sequence[str] = ("time",),
    rest=REST_CLASS,
    weight: float = REST_WEIGHT,
    label_rule: str = "first",
    max_samples: int | None = SLICE_SAMPLES,
) -> DataFrame:
    """Epoch rows to z-scored band features with a class weight.

    The features are stored once: the statistics and the rows both read them back instead of
    transforming every signal twice.
    """
    raw = epoch_features(
        epochs, channels, bands, fs, order, label_rule=label_rule, max_samples=max_samples
    )
    raw = materialise(lateralization(raw, bands, channels[0], channels[-1]), "features")
    return with_rest_weight(zscore_by_subject(raw, feature_columns(raw)), rest=rest, weight=weight)


def build_features(samples: DataFrame, weight: float = REST_WEIGHT) -> DataFrame:
    """Landed samples to normalised features, with time-based epochs.

    Only the motor channels and the metadata are read from the landing zone.
    """
    clean = without_dots(samples)
    needed = clean.select("subject_id", "run_id", "time", "task_label", *MOTOR_CHANNELS)
    return normalised_features(epochs_by_time(needed), weight=weight)


def train(
    features: DataFrame, model_path: str, trees: Sequence[int] = (50, 100),
    depths: Sequence[int] = (5, 10), folds: int = 3, ratio: float = TRAIN_RATIO, seed: int = SEED,
    classes: Sequence[str] = CLASSES,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Split by subject, tune, store the model; returns it with its test metrics."""
    training, test = train_test(features, ratio=ratio)
    names = feature_columns(features)
    model = tune_forest(forest_pipeline(names, seed=seed), training, trees, depths, folds, seed)
    model.write().overwrite().save(model_path)
    return model, evaluate(model, test, classes=classes)[1]


def evaluate_stored(
    features: DataFrame, model_path: str, ratio: float = TRAIN_RATIO, classes: Sequence[str] = CLASSES
) -> tuple[DataFrame, DataFrame]:
    """Predictions ``subject_id, task_label, prediction`` and metrics of a stored model."""
    _, test = train_test(features, ratio=ratio)
    predictions, metrics = evaluate(CrossValidatorModel.load(model_path), test, classes=classes)
    return predictions.select("subject_id", "task_label", "prediction"), metrics


def export(tables: Mapping[str, DataFrame], root: str) -> None:
    """Overwrite one Parquet table per name."""
    for name, table in tables.items():
        write_table(table, f"{root}/{name}")
