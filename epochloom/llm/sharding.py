"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows each source sends to each shard is drawn first, exactly as a uniform permutation of all
rows would have it: one row of the matrix per source, drawn without replacement from what the shards
still take. A source is a partition of the input, or several where there are more than ``SOURCES``, so the
matrix has at most ``MATRIX_CELLS`` cells at any size of the input. Every source then permutes its rows and
deals them out by its matrix row, the shards exchange, and each shard is permuted again. Only row counts of
sources reach the driver. A permutation is numbered in ``SLICES`` slices of its hash, so neither a source nor
a shard is ever held by one task.

Behaviour: shards differ by one row at most. All rows count alike, repeated rows and NULL identifiers
included. Placement depends on the seed and on how the rows lie in their partitions. All columns stay;
``shard`` and ``slot`` of the input are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.shared import materialise

#: numpy draws from populations below this size.
_LIBRARY_LIMIT = 10**9
SOURCES = 1024
MATRIX_CELLS = 1 << 20
SLICES = 256


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Good ones among ``sample`` draws without replacement, for populations of any size."""
    if good + bad < _LIBRARY_LIMIT:
        return int(rng.hypergeometric(good, bad, sample))
    low, high = max(0, sample - bad), min(good, sample)
    mode = min(max((sample + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, sample - mode) - log_choose(good + bad, sample))
    left, up, down, p_up, p_down = rng.random() - at_mode, mode, mode, at_mode, at_mode
    while left > 0 and (up < high or down > low):  # outward from the mode, as the ratios of neighbours say
        if up < high:
            p_up *= (good - up) * (sample - up) / ((up + 1) * (bad - sample + up + 1))
            up, left = up + 1, left - p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - sample + down) / ((good - down + 1) * (sample - down + 1))
            down, left = down - 1, left - p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard; columns differ by one at most."""
    rng, total = np.random.default_rng(seed), sum(rows)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = np.zeros((len(rows), shards), dtype=np.int64)
    for p, n in enumerate(rows):
        rest = sum(room)
        for s in range(shards):
            rest -= room[s]
            matrix[p, s] = hypergeometric(rng, room[s], rest, n) if n else 0
            n -= int(matrix[p, s])
            room[s] -= int(matrix[p, s])
    return matrix


def _placed(rows: DataFrame, key: str, salt: int, spread: int, name: str) -> DataFrame:
    """Zero-based place of each row of ``key`` in the order of a hash of ``row``.

    The hash cuts a key into ``spread`` even parts, which are numbered apart; their counts add up.
    """
    mixed = rows.withColumn("mix", F.xxhash64(F.lit(salt), "row")).withColumn("slice", F.pmod("mix", F.lit(spread)))
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = mixed.groupBy(key, "slice").agg(F.count(F.lit(1)).alias("n")).select(
        key, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy(key, "slice").orderBy("mix", "row"))
    numbered = mixed.withColumn("no", inside.cast("long")).join(sizes, [key, "slice"])
    return numbered.withColumn(name, F.col("no") - 1 + F.col("before")).drop("mix", "slice", "no", "before")


def shuffled_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard)."""
    spark, names = df.sparkSession, [c for c in df.columns if c not in ("shard", "slot")]
    sources = max(1, min(SOURCES, MATRIX_CELLS // shards))
    cells = F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(names)])
    stored = materialise(
        df.select(cells.alias("cells"), F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part")),
        "to-shard",
    ).withColumn("source", F.pmod("part", F.lit(sources))).drop("part")
    counts = {r.source: r.n for r in stored.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed = sorted(counts)
    ends = communication_matrix([counts[s] for s in listed], shards, seed).cumsum(axis=1)
    dealt = spark.createDataFrame([(s, row.tolist()) for s, row in zip(listed, ends)], "source int, ends array<long>")
    mixed = _placed(stored, "source", seed, SLICES, "place").join(F.broadcast(dealt), "source")  # MATRIX_CELLS at most
    shard = F.size(F.filter("ends", lambda e: e <= F.col("place")))
    placed = _placed(mixed.select("cells", "row", shard.alias("shard")), "shard", seed + 1, SLICES, "slot")
    return placed.select(*[F.col(f"cells.c{i}").alias(c) for i, c in enumerate(names)], "shard", "slot")
