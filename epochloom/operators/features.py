"""Epoch features: band powers, per-subject z-scores and class summaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epochloom.constants import (
    BANDS, FEATURE_META, MOTOR_CHANNELS, REST_CLASS, REST_WEIGHT, SAMPLING_HZ,
)
from epochloom.functions.columns import feature_columns, rest_weight
from epochloom.functions.spectrum import band_powers, channel_arrays, channel_powers, slice_entries
from epochloom.operators.epochs import EPOCH, SLICE_SAMPLES, collect_samples, first_label, majority_label
from epochloom.operators.ordering import Ranges


def _label(how: str, label: str, order: Sequence[str]) -> Column:
    return first_label(label, order) if how == "first" else majority_label(label)


def _bad_samples(channels: Sequence[str]) -> Column:
    missing = [F.col(name).isNull() | F.isnan(F.col(name).cast("double")) for name in channels]
    bad = missing[0]
    for more in missing[1:]:
        bad = bad | more
    return F.count_if(bad)


def epoch_features(
    df: DataFrame,
    channels: Sequence[str] = MOTOR_CHANNELS,
    bands: Mapping[str, tuple[float, float]] = BANDS,
    fs: float = SAMPLING_HZ,
    order: Sequence[str] = ("time",),
    keys: Sequence[str] = EPOCH,
    label: str = "task_label",
    label_rule: str = "first",
    min_samples: int = 2,
    max_samples: int | None = SLICE_SAMPLES,
    quality: bool = False,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per epoch: label, then ``<channel>_<band>`` for every channel and band.

    One shuffle collects all channels once; one Arrow function returns all powers. An epoch is held in slices
    of about ``max_samples`` rows, however many rows it has; pass None where epochs are bounded by
    construction, which saves the count. ``quality``
    adds ``n_bad``, the number of instants with a NULL or NaN sample. ``extra`` holds further
    aggregates by name.
    """
    details = {label: _label(label_rule, label, order), **(extra or {})}
    if quality:
        details["n_bad"] = _bad_samples(channels)
    described = [value.alias(name) for name, value in details.items()]
    names = [f"{channel}_{band}" for channel in channels for band in bands]
    slices = _slices(df, order, max_samples)
    if slices.count > 1:
        return _joined(
            df.groupBy(*keys).agg(*described),
            sliced_band_powers(df, slices, channels, order, keys, fs, bands, min_samples), keys,
        ).select(*keys, *details, *names)
    signals = df.groupBy(*keys).agg(*described, collect_samples(channels, order).alias("_samples"))
    powers = band_powers(channel_arrays(channels, F.col("_samples")), fs, bands, min_samples)
    return signals.withColumn("_powers", powers).select(
        *keys, *details, *[F.col("_powers")[name].alias(name) for name in names]
    )


def _slices(df: DataFrame, order: Sequence[str], max_samples: int | None) -> Ranges:
    """Ranges of the order that hold about ``max_samples`` rows each; one range where epochs are bounded anyway."""
    rows = df.count() if max_samples else 0
    return Ranges(df, order, max(1, -(-rows // max_samples)) if max_samples else 1, rows)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of equal keys, NULL included; ``right`` brings its other columns."""
    renamed = right.withColumnsRenamed({key: f"_j{i}" for i, key in enumerate(keys)})
    match = [F.col(key).eqNullSafe(F.col(f"_j{i}")) for i, key in enumerate(keys)]
    return left.join(renamed, match).drop(*[f"_j{i}" for i in range(len(keys))])


def sliced_band_powers(
    df: DataFrame, slices: Ranges, channels: Sequence[str], order: Sequence[str], keys: Sequence[str],
    fs: float, bands: Mapping[str, tuple[float, float]], min_samples: int = 2,
) -> DataFrame:
    """``keys`` plus ``<channel>_<band>`` of epochs of any length, from slices of their signals.

    Only rows of one epoch and one range of the order are held together. A slice that is a whole epoch gives
    its powers; other slices give what they add to each bin of the epoch's transform, and these sums add up
    like any aggregate. The samples are exchanged once.
    """
    rows = df.select(
        F.struct(*keys).alias("key"), slices.place().alias("part"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(channels)],
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
    )
    values, places = [f"v{i}" for i in range(len(channels))], [f"o{i}" for i in range(len(order))]
    of_key = Window.partitionBy("key")
    earlier = of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(of_key).alias("total")
    )
    held = rows.groupBy("key", "part").agg(collect_samples(values, places).alias("samples")).join(sizes, ["key", "part"])
    entry = slice_entries([F.col("samples")[v] for v in values], F.col("before"), F.col("total"), fs, bands, min_samples)
    sums = held.select("key", "total", F.explode_outer(entry).alias("e")).groupBy(
        "key", "total", "e.channel", "e.whole", "e.bin"
    ).agg(F.sum("e.re").alias("re"), F.sum("e.im").alias("im"))
    value = F.when(F.col("whole"), F.col("re")).otherwise(F.col("re") ** 2 + F.col("im") ** 2)
    frequency = F.col("bin") * (F.lit(1.0) / (F.col("total") * F.lit(1.0 / fs)))
    powers = []
    for c, channel in enumerate(channels):
        for b, (band, (low, high)) in enumerate(bands.items()):
            inside = F.when(F.col("whole"), F.col("bin") == b).otherwise((frequency >= float(low)) & (frequency < float(high)))
            mean = F.avg(F.when((F.col("channel") == c) & inside, value))
            powers.append(F.coalesce(mean, F.lit(0.0)).alias(f"{channel}_{band}"))
    return sums.groupBy("key").agg(*powers).select("key.*", *[f"{c}_{b}" for c in channels for b in bands])


def alpha_by_channel(
    df: DataFrame,
    channels: Sequence[str],
    fs: float = SAMPLING_HZ,
    band: tuple[float, float] = BANDS["alpha"],
    order: Sequence[str] = ("time",),
    keys: Sequence[str] = EPOCH,
    min_samples: int = 4,
    max_samples: int | None = SLICE_SAMPLES,
) -> DataFrame:
    """Long form ``(keys, channel, alpha_power)`` for every channel of every epoch."""
    slices = _slices(df, order, max_samples)
    if slices.count > 1:
        wide = sliced_band_powers(df, slices, channels, order, keys, fs, {"power": band}, min_samples)
        powers = wide.select(*keys, F.array(*[
            F.struct(F.lit(name).alias("channel"), F.col(f"{name}_power").alias("power")) for name in channels
        ]).alias("_powers"))
    else:
        signals = df.groupBy(*keys).agg(collect_samples(channels, order).alias("_samples"))
        arrays = channel_arrays(channels, F.col("_samples"))
        powers = signals.select(*keys, channel_powers(arrays, fs, band, min_samples).alias("_powers"))
    return explode_channels(powers, keys)


def explode_channels(df: DataFrame, keys: Sequence[str], powers: str = "_powers") -> DataFrame:
    """One row per element of an array of ``(channel, power)`` structs."""
    # A plain explode adds a filter on the array's size, which would compute the powers twice.
    return df.select(*keys, F.explode_outer(powers).alias("_p")).select(
        *keys, F.col("_p.channel").alias("channel"), F.col("_p.power").alias("alpha_power")
    )


def _usable(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def subject_stats(
    df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("subject_id",)
) -> DataFrame:
    """Mean and sample standard deviation of each feature per subject; NaN values are left out."""
    stats = []
    for name in features:
        stats += [F.avg(_usable(name)).alias(f"{name}_mean"),
                  F.stddev_samp(_usable(name)).alias(f"{name}_std")]
    return df.groupBy(*keys).agg(*stats)


def zscore_by_subject(
    df: DataFrame,
    features: Sequence[str] | None = None,
    keys: Sequence[str] = ("subject_id",),
    meta: Iterable[str] = FEATURE_META,
) -> DataFrame:
    """Each feature minus its subject's mean, divided by its subject's standard deviation.

    A subject with one row, or a constant feature, scores 0.0. The statistics are one row per
    subject, and Spark broadcasts them when their measured size allows; beyond that the join
    shuffles and adaptive execution splits a subject that owns most rows.
    """
    features = list(features) if features is not None else feature_columns(df, meta)
    stats = subject_stats(df, features, keys)
    stats = stats.withColumnsRenamed({key: f"_s{i}" for i, key in enumerate(keys)})
    match = [F.col(key).eqNullSafe(F.col(f"_s{i}")) for i, key in enumerate(keys)]
    scored = {}
    for name in features:
        spread = F.coalesce(F.col(f"{name}_std"), F.lit(1.0))
        score = F.try_divide(F.col(name) - F.col(f"{name}_mean"), spread)
        scored[name] = F.when(spread == 0.0, F.when(F.col(name).isNotNull(), F.lit(0.0))).otherwise(score)
    joined = df.join(stats, match, "left")
    return joined.select(*[
        scored[name].alias(name) if name in scored else F.col(f"`{name}`") for name in df.columns
    ])


def with_rest_weight(
    df: DataFrame, label: str = "task_label", rest=REST_CLASS, weight: float = REST_WEIGHT
) -> DataFrame:
    return df.withColumn("weight", rest_weight(F.col(label), rest, weight))


def balanced_weights(df: DataFrame, label: str = "task_label") -> DataFrame:
    """Weight ``rows / (classes * rows of the class)``, so every class weighs the same in total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).where(F.col(label).isNotNull())
    whole = counts.agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_classes"))
    weights = counts.select(
        F.col(label).alias("_label"),
        (whole.select("_rows").scalar() / (whole.select("_classes").scalar() * F.col("_n"))).alias("weight"),
    )
    return df.join(weights, F.col(label) == F.col("_label"), "left").drop("_label")


def class_means(
    df: DataFrame, columns: Sequence[str], label: str = "task_label"
) -> DataFrame:
    """Mean of each column per class; NaN values and rows without a class are left out."""
    known = df.where(F.col(label).isNotNull())
    return known.groupBy(label).agg(*[F.avg(_usable(name)).alias(name) for name in columns])


def class_band_means(
    df: DataFrame, channels: Sequence[str], band: str, label: str = "task_label"
) -> DataFrame:
    """Long form ``(label, channel, power)`` of one band's class means."""
    names = [f"{channel}_{band}" for channel in channels]
    means = class_means(df, names, label).unpivot(label, names, "channel", "power")
    return means.withColumn("channel", F.regexp_replace("channel", f"_{band}$", ""))


def class_lateralization(
    df: DataFrame, bands: Sequence[str], label: str = "task_label"
) -> DataFrame:
    """Long form ``(label, band, difference)`` of the class means of ``diff_<band>``."""
    names = [f"diff_{band}" for band in bands]
    means = class_means(df, names, label).unpivot(label, names, "band", "difference")
    return means.withColumn("band", F.initcap(F.regexp_replace("band", "^diff_", "")))


def class_difference(
    df: DataFrame, columns: Sequence[str], minuend, subtrahend, label: str = "task_label"
) -> DataFrame:
    """Long form ``(name, difference)``: mean of one class minus mean of the other."""
    def mean_of(name, value):
        return F.avg(F.when(F.col(label) == value, _usable(name)))

    row = df.agg(*[(mean_of(n, minuend) - mean_of(n, subtrahend)).alias(n) for n in columns])
    return row.unpivot([], list(columns), "name", "difference")


def band_ranges(
    df: DataFrame, channels: Sequence[str], bands: Sequence[str], label: str = "task_label"
) -> DataFrame:
    """Padded value range ``(band, vmin, vmax)`` of each band's class means.

    The padding is 20 % of the span, or 10 % of the level plus 1e-9 where the span is zero.
    """
    names = [f"{channel}_{band}" for channel in channels for band in bands]
    means = class_means(df, names, label)
    return padded_ranges(
        means.unpivot(label, names, "name", "value").withColumn(
            "band", F.regexp_extract("name", "_([^_]+)$", 1)
        ),
        "value", ["band"],
    )


def padded_ranges(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    low, high = F.min(value).alias("_low"), F.max(value).alias("_high")
    pad = F.when(F.col("_high") > F.col("_low"), (F.col("_high") - F.col("_low")) * 0.20).otherwise(
        F.abs("_high") * 0.10 + 1e-9
    )
    return df.groupBy(*keys).agg(low, high).select(
        *keys, (F.col("_low") - pad).alias("vmin"), (F.col("_high") + pad).alias("vmax")
    )


def symmetric_range(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Range centred on zero for difference maps: 110 % of the largest magnitude, at least 1e-9."""
    reach = F.greatest(F.coalesce(F.max(F.abs(_usable(value))), F.lit(1e-9)) * 1.10, F.lit(1e-9))
    return df.groupBy(*keys).agg(reach.alias("vmax")).select(*keys, (-F.col("vmax")).alias("vmin"), "vmax")


def live_range(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Plain range of a live map, widened by 0.1 on both sides where it is flat, [0, 1] if empty."""
    plain = df.groupBy(*keys).agg(
        F.coalesce(F.min(_usable(value)), F.lit(0.0)).alias("_low"),
        F.coalesce(F.max(_usable(value)), F.lit(1.0)).alias("_high"),
    )
    widen = F.when(F.col("_high") - F.col("_low") < 1e-9, F.lit(0.1)).otherwise(F.lit(0.0))
    return plain.select(*keys, (F.col("_low") - widen).alias("vmin"), (F.col("_high") + widen).alias("vmax"))
