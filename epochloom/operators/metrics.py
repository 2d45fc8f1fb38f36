"""Classification metrics from one confusion count.

Every metric starts from ``groupBy(truth, predicted).count()``, whose result has at most
classes x classes rows, so the fact table is read once and shuffles only partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epochloom.constants import CHANCE_LEVEL, CLASSES
from epochloom.functions.columns import agrees, feature_columns, tier
from epochloom.operators.ordering import number_rows, rolling_mean

SUBJECT_TIERS = ((0.50, "high"), (0.40, "medium"), (0.33, "low"))
IMPORTANCE_TIERS = ((0.75, "top"), (0.5, "strong"), (0.3, "fair"), (0.15, "weak"))


def confusion_counts(df: DataFrame, truth: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _class_grid(counts: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Counts for every (truth, predicted) pair of the fixed class list, 0 where none occurred."""
    listed = F.array(*map(F.lit, classes))
    grid = (
        counts.sparkSession.range(1)
        .select(F.explode(listed).alias("truth"))
        .select("truth", F.explode(listed).alias("predicted"))
    )
    return grid.join(counts, ["truth", "predicted"], "left").select(
        "truth", "predicted", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


def confusion_matrix(
    df: DataFrame, truth: str, predicted: str, classes: Sequence[str] = CLASSES
) -> DataFrame:
    """All class pairs with their count and its share of the true class in percent, one decimal."""
    grid = _class_grid(confusion_counts(df, truth, predicted), classes)
    row_total = F.sum("n").over(Window.partitionBy("truth"))
    return grid.withColumn("pct", F.bround(F.try_divide(F.col("n") * 100.0, row_total), 1))


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision, recall = _rate(tp, tp + fp), _rate(tp, tp + fn)
    return precision, recall, _rate(2.0 * precision * recall, precision + recall)


def class_counts(
    df: DataFrame, truth: str, predicted: str, classes: Sequence[str] | None = CLASSES,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per class: true positives, false positives, false negatives.

    Without ``classes`` every label found in truth or prediction is a class.
    """
    counts = confusion_counts(df, truth, predicted, keys)
    found = F.array_compact(F.array_distinct(F.array("truth", "predicted")))
    listed = found if classes is None else F.array(*map(F.lit, classes))
    per_class = counts.withColumn("label", F.explode(listed))
    is_truth = F.coalesce(F.col("truth") == F.col("label"), F.lit(False))
    is_predicted = F.coalesce(F.col("predicted") == F.col("label"), F.lit(False))

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return per_class.groupBy(*keys, "label").agg(
        total(is_truth & is_predicted).alias("tp"),
        total(~is_truth & is_predicted).alias("fp"),
        total(is_truth & ~is_predicted).alias("fn"),
    )


def class_scores(
    df: DataFrame, truth: str, predicted: str, classes: Sequence[str] = CLASSES
) -> DataFrame:
    """Per class counts with precision, recall and F1; 0.0 where a denominator is 0."""
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return class_counts(df, truth, predicted, classes).withColumns(
        {"precision": precision, "recall": recall, "f1": f1}
    )


def class_scores_long(
    df: DataFrame, truth: str, predicted: str, classes: Sequence[str] = CLASSES
) -> DataFrame:
    """Long form ``(label, metric, value)`` of recall, precision and F1."""
    return class_scores(df, truth, predicted, classes).unpivot(
        "label", ["recall", "precision", "f1"], "metric", "value"
    )


def macro_f1(
    df: DataFrame, truth: str, predicted: str, classes: Sequence[str] = CLASSES
) -> DataFrame:
    """Mean of the class F1 scores and the class with the lowest, the first listed on a tie."""
    scores = class_scores(df, truth, predicted, classes)
    place = F.array_position(F.array(*map(F.lit, classes)), F.col("label"))
    return scores.agg(
        F.avg("f1").alias("macro_f1"),
        F.min_by("label", F.struct("f1", place.alias("place"))).alias("worst_class"),
    )


def weighted_metrics(
    df: DataFrame, truth: str, predicted: str, classes: Sequence[str] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Accuracy with support-weighted F1, precision and recall, all from one pass.

    Every row with a true label counts, whatever the label; ``classes`` limits them to a list.
    """
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    support = F.col("tp") + F.col("fn")
    scores = class_counts(df, truth, predicted, classes, keys).select(
        *keys, "tp", support.alias("support"),
        (support * precision).alias("p"), (support * recall).alias("r"), (support * f1).alias("f"),
    )
    return scores.groupBy(*keys).agg(
        _rate(F.sum("tp"), F.sum("support")).alias("accuracy"),
        _rate(F.sum("f"), F.sum("support")).alias("f1"),
        _rate(F.sum("p"), F.sum("support")).alias("precision_weighted"),
        _rate(F.sum("r"), F.sum("support")).alias("recall_weighted"),
    )


def subject_accuracy(df: DataFrame, truth: str, predicted: str, subject: str = "subject_id") -> DataFrame:
    """Share of correct rows per subject, best first."""
    return (
        df.groupBy(subject)
        .agg(F.avg(agrees(F.col(predicted), F.col(truth)).cast("double")).alias("accuracy"))
        .orderBy(F.col("accuracy").desc(), subject)
    )


def with_subject_tier(accuracies: DataFrame) -> DataFrame:
    return accuracies.withColumn("tier", tier(F.col("accuracy"), SUBJECT_TIERS, "poor"))


def with_importance_tier(importances: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.col("importance"), importances.agg(F.max("importance")).scalar())
    return importances.withColumn("tier", tier(ratio, IMPORTANCE_TIERS, "minor", strict=True))


def kpi_summary(
    predictions: DataFrame, features: DataFrame, truth: str, predicted: str, subject: str = "subject_id",
    chance: float = CHANCE_LEVEL,
) -> DataFrame:
    """Accuracy of the predictions with its gain over chance in percentage points, and their subjects;
    epochs and feature columns of the feature table."""
    scored = predictions.agg(
        F.avg(agrees(F.col(predicted), F.col(truth)).cast("double")).alias("accuracy"), F.countDistinct(subject).alias("n_subjects")
    )
    n_rows = features.agg(F.count(F.lit(1))).scalar()
    n_features = len(feature_columns(features))
    return scored.select(
        "accuracy", ((F.col("accuracy") - chance) * 100.0).alias("gain_points"), n_rows.alias("n_rows"), "n_subjects",
        F.lit(n_features).cast("long").alias("n_features"),
    )


def live_kpis(
    predictions: DataFrame, correct: str = "correct", truth: str = "true_label",
    time: str = "event_time", epoch: str = "epoch_id",
) -> DataFrame:
    """Rows, correct rows, accuracy, true classes seen and the newest epoch id."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.coalesce(F.sum(correct), F.lit(0)).cast("long").alias("n_correct"),
        F.coalesce(F.avg(F.col(correct).cast("double")), F.lit(0.0)).alias("accuracy"),
        F.countDistinct(truth).alias("n_classes"),
        F.max_by(epoch, F.struct(time, epoch)).alias("last_epoch_id"),
    )


def rolling_accuracy(
    predictions: DataFrame, order: Sequence[str], keys: Sequence[str] = (), size: int = 10,
    correct: str = "correct",
) -> DataFrame:
    """Running index and mean of ``correct`` over the last ``size`` epochs of each recording."""
    return rolling_mean(predictions, correct, order, keys, size, "rolling_acc", "epoch_idx")


def prediction_timeline(
    predictions: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
    truth: str = "true_label", predicted: str = "pred_label",
) -> DataFrame:
    """Running index and marker kind of each prediction."""
    marker = F.when(agrees(F.col(predicted), F.col(truth)) == 1, F.lit("correct")).otherwise(F.lit("wrong"))
    return number_rows(predictions, order, keys, "epoch_idx").withColumn("marker", marker)
