"""Scalp maps: electrode lookup, projection and Gaussian interpolation.

Electrodes are dimension data of any number. Measurements are aggregated per channel first, and
only then weighted, so the work on the measurements is one aggregation whatever the map size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.constants import GRID_SIGMA, GRID_SIZE, HEAD_FRACTION, SCALP_ELECTRODES, SCALP_SIGMA
from epochloom.functions.columns import column

#: Maps that are multiplied at a time, and weights that a task holds.
MAPS_TOGETHER, WEIGHT_CELLS = 16, 1 << 21


def scalp_sites(montage: DataFrame, names: Sequence[str] = SCALP_ELECTRODES) -> DataFrame:
    """The montage's rows for the listed electrodes, matched without case and named in upper case."""
    wanted = [name.lower() for name in names]
    return montage.where(F.lower("name").isin(wanted)).withColumn("name", F.upper("name"))


def electrode_lookup(
    channels: DataFrame, electrodes: DataFrame, channel: str = "channel", name: str = "name"
) -> DataFrame:
    """Electrode coordinates of each channel, matched without case; unknown channels drop out.

    The result carries the channel name in upper case.
    """
    known = electrodes.select(F.lower(name).alias("_key"), "x", "y", "z")
    return (
        channels.withColumn("_key", F.lower(channel))
        .join(known, "_key")
        .drop("_key")
        .withColumn(channel, F.upper(channel))
    )


def electrode_powers(
    electrodes: DataFrame, powers: DataFrame, value: str, name: str = "name", channel: str = "channel"
) -> DataFrame:
    """Every electrode with its measured value, NULL where the channel was not recorded."""
    measured = powers.select(F.lower(channel).alias("_key"), F.col(value))
    return electrodes.withColumn("_key", F.lower(name)).join(measured, "_key", "left").drop("_key")


def projected(electrodes: DataFrame) -> DataFrame:
    """Planar coordinates ``px, py`` of positions on the head."""
    radius = F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2)
    theta = F.acos(F.col("z") / F.greatest(radius, F.lit(1e-9)))
    phi = F.atan2("y", "x")
    rho = F.sin(theta) / (1.0 + F.cos(theta) + 1e-9)
    return electrodes.withColumns({"px": rho * F.cos(phi), "py": rho * F.sin(phi)})


def map_radius(flat: DataFrame) -> Column:
    """Half-width of the map: 5 % beyond the outermost electrode, at least 0.6."""
    outermost = flat.agg(F.max(F.sqrt(F.col("px") ** 2 + F.col("py") ** 2))).scalar()
    return F.greatest(outermost * 1.05, F.lit(0.6))


def _as_array(rows: DataFrame, columns: Sequence[str]) -> Column:
    """A dimension table as one array value, in a fixed order."""
    return rows.agg(F.array_sort(F.collect_list(F.struct(*columns)))).scalar()


def scalp_interpolate(
    electrodes: DataFrame,
    anchors: DataFrame,
    values: DataFrame,
    keys: Sequence[str] = (),
    value: str = "value",
    sigma: float = SCALP_SIGMA,
) -> DataFrame:
    """Value at every electrode from a few anchor electrodes, per key: ``(keys, name, value)``.

    Weights are ``exp(-d**2 / (2 sigma**2))`` of the distance in space; where all vanish the plain
    mean of the anchors stands in. ``electrodes`` and ``anchors`` hold ``name, x, y, z``;
    ``values`` holds one row per (keys, anchor name). The weights depend on the montage alone.
    """
    d2 = sum((F.col(f"_a.{axis}") - F.col(axis)) ** 2 for axis in ("x", "y", "z"))
    weights = electrodes.withColumn("_a", F.explode(_as_array(anchors, ["name", "x", "y", "z"]))).select(
        F.col("name").alias("_site"), F.col("_a.name").alias("name"), F.exp(-d2 / (2.0 * sigma * sigma)).alias("_w")
    )
    known = values.where(F.col(value).isNotNull())
    sums = known.join(weights, "name").groupBy(*keys, "_site").agg(
        F.sum(F.col("_w") * F.col(value)).alias("_mass"), F.sum("_w").alias("_total"), F.avg(value).alias("_mean")
    )
    return sums.select(
        *keys, F.col("_site").alias("name"),
        F.when(F.col("_total") < 1e-9, F.col("_mean")).otherwise(F.col("_mass") / F.col("_total")).alias(value),
    )


def grid_weights(
    px: np.ndarray, py: np.ndarray, cells: np.ndarray, radius: float, size: int = GRID_SIZE, sigma: float = GRID_SIGMA,
) -> np.ndarray:
    """Weight of every electrode (column) in the cells given by number (row); 0.0 outside the head.

    The square grid has ``size`` times ``size`` cells, ``gy * size + gx``, and covers all electrodes.
    """
    step = 2.0 * radius / (size - 1)
    cx, cy = cells % size * step - radius, cells // size * step - radius
    d2 = (cx[:, None] - px) ** 2 + (cy[:, None] - py) ** 2
    return np.exp(-d2 / (2.0 * sigma * sigma)) * (cx**2 + cy**2 <= (radius * HEAD_FRACTION) ** 2)[:, None]


def _painted(own: Sequence[str], size: int, sigma: float) -> Callable:
    """Grids of maps that come with their electrodes; maps of one montage are one matrix product."""

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, float, np.ndarray]]:
        """(first row, next row, positions, radius, sums and counts) of neighbours with one montage."""
        sites, radius = batch.column("sites"), batch.column("radius").to_numpy()
        edges, flat = sites.offsets.to_numpy(), sites.values
        x, y, s, n = (flat.field(f).to_numpy(zero_copy_only=False).astype(float) for f in ("px", "py", "s", "n"))
        at = 0
        while at < batch.num_rows:
            low, high, to = edges[at], edges[at + 1], at + 1
            width = high - low
            while to < min(batch.num_rows, at + MAPS_TOGETHER) and edges[to + 1] - edges[to] == width and (
                np.array_equal(x[low:high], x[edges[to] : edges[to + 1]]) and np.array_equal(y[low:high], y[edges[to] : edges[to + 1]])
            ):
                to += 1
            span = slice(low, edges[to])
            yield at, to, np.array([x[low:high], y[low:high]]), radius[at], np.stack([s[span], n[span]]).reshape(2, to - at, width)
            at = to

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        montage, weights = None, None
        for batch in batches:
            for low, high, places, radius, known in blocks(batch):
                step = max(1, WEIGHT_CELLS // max(1, places.shape[1]))
                for first in range(0, size * size, step):
                    cells = np.arange(first, min(first + step, size * size))
                    name = (places.tobytes(), radius, first)
                    if name != montage:
                        montage, weights = name, grid_weights(*places, cells, radius, size, sigma)
                    mass, total = (weights @ part.T for part in known)
                    empty = total <= 1e-9
                    mean = np.divide(mass, total, out=np.zeros_like(mass), where=~empty).T.ravel()
                    row = pa.array(np.repeat(np.arange(low, high), len(cells)))
                    cell = np.tile(cells, high - low)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).take(row) for k in own), pa.array(cell % size), pa.array(cell // size),
                         pa.array(mean, mask=empty.T.ravel())],
                        names=[*own, "gx", "gy", "value"],
                    )

    return paint


def topomap_grid(
    flat: DataFrame,
    values: DataFrame,
    keys: Sequence[str] = (),
    value: str = "value",
    size: int = GRID_SIZE,
    sigma: float = GRID_SIGMA,
) -> DataFrame:
    """Interpolated value of every grid cell, per key: ``(keys, gx, gy, value)``.

    ``values`` holds one row per (keys, name). A NULL or NaN channel is skipped; cells outside the
    head, or too far from every electrode, are NULL. The montage is joined as a dimension and the values move
    once, by key; a map travels as one row with its electrodes, and the static weights (cells by electrodes)
    times a block of maps give their cells where they are.
    """
    own = [f"k{i}" for i in range(len(keys))]
    usable = F.col("v").isNotNull() & ~F.isnan("v")
    known = values.select(
        *[column(k).alias(o) for k, o in zip(keys, own)], F.col("name").alias("site"), column(value).cast("double").alias("v")
    )
    # Small rows stand for whole grids here: a fixed number of partitions is not merged back.
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = known.repartition(tasks, *own) if keys else known
    heard = placed.join(flat.select(F.col("name").alias("site"), "px", "py"), "site").groupBy(*own, "site", "px", "py").agg(
        F.coalesce(F.sum(F.when(usable, F.col("v"))), F.lit(0.0)).alias("s"), F.count_if(usable).alias("n")
    )
    maps = heard.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("site", "px", "py", "s", "n"))).alias("sites"))
    painted = maps.withColumn("radius", map_radius(flat)).mapInArrow(
        _painted(own, size, sigma),
        T.StructType([*maps.schema.fields[: len(own)], *T.StructType.fromDDL("gx long, gy long, value double").fields]),
    )
    return painted.toDF(*keys, "gx", "gy", value)
