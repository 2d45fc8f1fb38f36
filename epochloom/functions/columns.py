"""Schema introspection and scalar expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.constants import (
    BANDS, DEFAULT_LIVE_CHANNELS, FEATURE_META, LEFT_CHANNEL, LIVE_META, LOG_FLOOR, REST_CLASS,
    REST_WEIGHT, RIGHT_CHANNEL,
)
from epochloom.shared import read_if_landed


def column(name: str) -> Column:
    """Reference a column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def without_dots(df: DataFrame) -> DataFrame:
    """Drop every dot from the column names; two names that become equal are an error."""
    cleaned = [name.replace(".", "") for name in df.columns]
    clashes = sorted({name for name in cleaned if cleaned.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide once dots are removed: {clashes}")
    return df.toDF(*cleaned)


def other_columns(df: DataFrame, known: Iterable[str]) -> list[str]:
    known = set(known)
    return [name for name in df.columns if name not in known]


def feature_columns(df: DataFrame, meta: Iterable[str] = FEATURE_META) -> list[str]:
    """Every column that is not metadata is a feature."""
    return other_columns(df, meta)


def channel_columns(df: DataFrame, meta: Iterable[str] = LIVE_META) -> list[str]:
    """Every column that is not metadata is a channel."""
    return other_columns(df, meta)


def landed_channels(
    spark: SparkSession, path: str, default: Sequence[str] = DEFAULT_LIVE_CHANNELS
) -> list[str]:
    """Channels of a landed Parquet folder, from footers only; ``default`` while it is empty."""
    landed = read_if_landed(spark, path)
    return list(default) if landed is None else channel_columns(landed)


def live_schema(channels: Sequence[str]) -> T.StructType:
    """Explicit schema of a live sample file: metadata fields, then one double per channel."""
    types = {"time": T.DoubleType(), "epoch_id": T.LongType(), "run_seq": T.LongType()}
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in LIVE_META]
    return T.StructType(fields + [T.StructField(name, T.DoubleType()) for name in channels])


def as_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: column(name).cast("double") for name in columns})


def lateralization(
    df: DataFrame,
    bands: Iterable[str] = tuple(BANDS),
    left: str = LEFT_CHANNEL,
    right: str = RIGHT_CHANNEL,
) -> DataFrame:
    """``diff_<band>``: left channel's power minus right channel's power."""
    return df.withColumns(
        {f"diff_{band}": F.col(f"{left}_{band}") - F.col(f"{right}_{band}") for band in bands}
    )


def log_compressed(value: Column, floor: float = LOG_FLOOR) -> Column:
    """log10 with values below ``floor`` lifted to it; NaN stays NaN and NULL stays NULL."""
    return F.when(value.isNotNull(), F.log10(F.greatest(value, F.lit(floor))))


def rest_weight(label: Column, rest=REST_CLASS, weight: float = REST_WEIGHT) -> Column:
    """``weight`` for the resting class, 1.0 for every other label and for none."""
    return F.when(label == F.lit(rest), F.lit(float(weight))).otherwise(F.lit(1.0))


def agrees(predicted: Column, truth: Column) -> Column:
    """1 where the prediction equals the truth, else 0."""
    return F.coalesce((predicted == truth).cast("long"), F.lit(0).cast("long"))


def tier(value: Column, bounds: Sequence[tuple[float, str]], rest: str, strict: bool = False) -> Column:
    """Name of the first bound that ``value`` reaches (or exceeds, if ``strict``)."""
    result = F.lit(rest)
    for bound, name in reversed(list(bounds)):
        result = F.when(value > bound if strict else value >= bound, F.lit(name)).otherwise(result)
    return result


def decoded(index: Column, labels: Sequence[str]) -> Column:
    """Label at a zero-based model index; NULL outside the list."""
    return F.try_element_at(F.array(*map(F.lit, labels)), index.cast("int") + 1)


def scoring_defaults(
    run_id: Column, run_seq: Column, predicted: Column, probabilities: Mapping[str, Column]
) -> dict[str, Column]:
    """Values a scored row carries when its source leaves them out."""
    filled = {
        "run_id": F.coalesce(run_id, F.lit("?")),
        "run_seq": F.coalesce(run_seq.cast("long"), F.lit(-1).cast("long")),
        "pred_label": F.coalesce(predicted, F.lit("?")),
    }
    for label, probability in probabilities.items():
        filled[f"proba_{label}"] = F.coalesce(probability.cast("double"), F.lit(0.0))
    return filled
