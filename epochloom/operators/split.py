"""Subject-wise train and test sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochloom.constants import TRAIN_RATIO
from epochloom.operators.ordering import number_rows


def subject_split(df: DataFrame, subject: str = "subject_id", ratio: float = TRAIN_RATIO) -> DataFrame:
    """One row per known subject with ``is_train``: the first ``int(n * ratio)`` in sorted order."""
    subjects = df.select(subject).where(F.col(subject).isNotNull()).distinct()
    placed = number_rows(subjects, [subject], (), "_no", total="_n")
    return placed.select(subject, (F.col("_no") < F.floor(F.col("_n") * F.lit(ratio))).alias("is_train"))


def rows_of(df: DataFrame, split: DataFrame, train: bool, subject: str = "subject_id") -> DataFrame:
    """Rows whose subject is on one side of the split."""
    wanted = split.where(F.col("is_train") == train).select(subject)
    return df.join(wanted, subject, "left_semi")


def train_test(df: DataFrame, subject: str = "subject_id", ratio: float = TRAIN_RATIO):
    split = subject_split(df, subject, ratio)
    return rows_of(df, split, True, subject), rows_of(df, split, False, subject)


def split_counts(df: DataFrame, subject: str = "subject_id", ratio: float = TRAIN_RATIO) -> DataFrame:
    """Rows and subjects on each side of the split; rows are counted per subject before the join."""
    per_subject = df.groupBy(subject).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        per_subject.join(subject_split(per_subject, subject, ratio), subject)
        .groupBy("is_train")
        .agg(F.sum("_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_subjects"))
    )
