"""Cutting samples into epochs and assembling each epoch's signal and label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochloom.constants import EPOCH_SECONDS, SAMPLES_PER_EPOCH
from epochloom.operators.ordering import number_rows

RECORDING = ("subject_id", "run_id")
EPOCH = (*RECORDING, "epoch_id")
#: Rows of an epoch that are held together.
SLICE_SAMPLES = 65_536


def seconds_of(timestamp: Column) -> Column:
    """Seconds since 1970 as a double, to the microsecond."""
    return F.unix_micros(timestamp.cast("timestamp")) / F.lit(1_000_000)


def epochs_by_time(
    df: DataFrame, time: str | Column = "time", seconds: float = EPOCH_SECONDS
) -> DataFrame:
    """``epoch_id = floor(time / seconds)``; a partial last epoch stays."""
    moment = F.col(time) if isinstance(time, str) else time
    return df.withColumn("epoch_id", F.floor(moment / F.lit(seconds)).cast("long"))


def epochs_by_count(
    df: DataFrame,
    order: Sequence,
    keys: Sequence[str] = RECORDING,
    samples: int = SAMPLES_PER_EPOCH,
) -> DataFrame:
    """Consecutive chunks of ``samples`` rows per recording; an incomplete last chunk is not an epoch.

    ``sample_no`` is the row's place in its epoch, from 0.
    """
    numbered = number_rows(df, order, keys, "_no", total="_rows")
    return (
        numbered.withColumn("epoch_id", F.floor(F.col("_no") / samples))
        .where(F.col("epoch_id") < F.floor(F.col("_rows") / samples))
        .withColumn("sample_no", (F.col("_no") % samples).cast("int"))
        .drop("_no", "_rows")
    )


def collect_samples(channels: Sequence[str], order: Sequence[str]) -> Column:
    """Aggregate: samples in time order as one array of structs, shared by all channels."""
    sample = F.struct(F.struct(*order).alias("at"), F.struct(*channels).alias("v"))
    return F.sort_array(F.collect_list(sample)).getField("v")


def epoch_signals(
    df: DataFrame,
    channels: Sequence[str],
    order: Sequence[str] = ("time",),
    keys: Sequence[str] = EPOCH,
    max_samples: int = SLICE_SAMPLES,
) -> DataFrame:
    """Ordered samples of each (epoch, ``segment``) as an array. NULL samples stay in place.

    A segment holds ``max_samples`` rows, and the last one of an epoch what is left, so that no row grows
    without bound; an epoch of up to that many rows is segment 0.
    """
    numbered = number_rows(df, order, keys, "_no")
    segment = F.floor(F.col("_no") / max_samples).alias("segment")
    return numbered.groupBy(*keys, segment).agg(
        collect_samples(channels, order).alias("samples"), F.count(F.lit(1)).alias("n_samples")
    )


def first_label(label: str, order: Sequence[str]) -> Column:
    """Aggregate: label of the earliest row that has one."""
    return F.min_by(label, F.when(F.col(label).isNotNull(), F.struct(*order)))


def majority_label(label: str) -> Column:
    """Aggregate: most frequent label, the smallest on a tie, ignoring NULL."""
    return F.mode(label, True)


def event_times(df: DataFrame, start: Column, index: str = "epoch_id",
                seconds: float = EPOCH_SECONDS, name: str = "event_time") -> DataFrame:
    """Timestamp at which each epoch starts: ``start + index * seconds``."""
    micros = F.unix_micros(start.cast("timestamp")) + F.round(
        F.col(index) * F.lit(seconds * 1_000_000)
    ).cast("long")
    return df.withColumn(name, F.timestamp_micros(micros))


def loop_replay(
    epochs: DataFrame, order: Sequence[str], keys: Sequence[str], rate: float, duration: float
) -> DataFrame:
    """Repeat each recording's epochs end to end until ``int(duration * rate)`` are played.

    ``replay_no`` counts the played epochs from 0; every copy's number follows from the epoch's
    own position, so the copies need no second sort.
    """
    played = int(duration * rate)
    numbered = number_rows(epochs, order, keys, "_no", total="_len")
    rounds = F.floor((F.lit(played - 1) - F.col("_no")) / F.col("_len"))
    return (
        numbered.where(F.col("_no") < played)
        .withColumn("_round", F.explode(F.sequence(F.lit(0).cast("long"), rounds)))
        .withColumn("replay_no", F.col("_round") * F.col("_len") + F.col("_no"))
        .drop("_no", "_len", "_round")
    )
