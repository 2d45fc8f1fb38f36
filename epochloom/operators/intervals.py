"""Labelling samples by the annotation interval that covers them.

The time line is cut into bins that hold a bounded number of interval ends each: ranges of (keys, time), so a
recording of a few intervals lies in one bin and a key with very many has bins of its own. An interval stands
in the bins of its two ends; of the intervals that cover a whole bin only the one with the greatest rank
matters, found over dyadic runs of bins. Inside a (key, bin) a heap sweep turns overlapping intervals into
disjoint pieces, and a sample finds its piece by its (key, bin) and a binary search.
"""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.constants import REST_CLASS
from epochloom.functions.columns import column
from epochloom.operators.ordering import Ranges

#: Intervals that a bin is planned for.
BIN_INTERVALS = 1_000
_INFINITY = float("inf")
PIECES = T.ArrayType(T.StructType([T.StructField("start", T.DoubleType()), T.StructField("at", T.IntegerType())]))


def sweep(onsets: Sequence[float], ends: Sequence[float]) -> tuple[list[float], list[int]]:
    """Disjoint pieces of intervals given in ascending rank: where each begins, and which interval it shows.

    A piece lasts until the next begins; -1 shows that none covers it.
    """
    by_onset = sorted(range(len(onsets)), key=onsets.__getitem__)
    starts, shown, active, at = [], [], [], 0
    for moment in sorted({*onsets, *ends}):
        while at < len(by_onset) and onsets[by_onset[at]] <= moment:
            heappush(active, -by_onset[at])
            at += 1
        while active and ends[-active[0]] <= moment:
            heappop(active)
        best = -active[0] if active else -1
        if not shown or shown[-1] != best:
            starts.append(moment)
            shown.append(best)
    return starts, shown


@F.arrow_udf(PIECES)
def _swept(onsets: pa.Array, ends: pa.Array) -> pa.Array:
    pieces = [sweep(a, b) for a, b in zip(onsets.to_pylist(), ends.to_pylist())]
    flat = pa.StructArray.from_arrays(
        [pa.array([x for s, _ in pieces for x in s], pa.float64()), pa.array([x for _, w in pieces for x in w], pa.int32())],
        names=["start", "at"],
    )
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s) for s, _ in pieces)]), pa.int32()), flat)


def disjoint_pieces(items: Column) -> Column:
    """Ascending (start, label) of an array of (rank, onset, finish, label); the label is NULL where none covers."""
    ranked = F.sort_array(items)
    swept = _swept(F.transform(ranked, lambda i: i["onset"]), F.transform(ranked, lambda i: i["finish"]))
    return F.transform(
        swept, lambda p: F.struct(p["start"].alias("start"), F.get(ranked, p["at"])["label"].alias("label"))
    )


def piece_at(pieces: Column, time: Column) -> Column:
    """Label of the piece that began last at or before ``time``."""
    steps = F.sequence(F.floor(F.log2(F.greatest(F.size(pieces), F.lit(1)))).cast("int"), F.lit(0), F.lit(-1))
    reached = F.aggregate(
        steps, F.lit(0),
        lambda at, k: F.when(
            F.get(pieces, at + F.call_function("shiftleft", F.lit(1), k) - 1)["start"] <= time,
            at + F.call_function("shiftleft", F.lit(1), k),
        ).otherwise(at),
    )
    return F.get(pieces, reached - 1)["label"]


def _covered_bins(spans: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """The greatest interval that covers each whole bin: keys, ``bin``, ``item``.

    Bins strictly between an interval's ends are a union of few aligned dyadic runs. Only the greatest rank
    is kept for each run before anything is spread over its bins.
    """
    levels = max(1, (bins - 1).bit_length())
    size = F.call_function("shiftleft", F.lit(1), F.col("level"))
    inner = spans.where(F.col("last") - F.col("first") > 1).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    low, high = F.ceil((F.col("first") + 1) / size).cast("int"), F.floor(F.col("last") / size).cast("int")
    left, right = F.when(low % 2 == 1, low), F.when(high % 2 == 1, high - 1)
    runs = inner.where(low < high).select(*keys, "level", "item", F.explode(F.array_compact(F.array(left, right))).alias("run"))
    best = runs.groupBy(*keys, "level", "run").agg(F.max_by("item", "item.rank").alias("item"))
    run = F.sequence(F.col("run") * size, (F.col("run") + 1) * size - 1)
    whole = F.col("item").withField("onset", F.lit(-_INFINITY)).withField("finish", F.lit(_INFINITY))
    return best.select(*keys, F.explode(run).alias("bin"), whole.alias("item"))


def label_by_interval(
    samples: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str] = ("subject_id", "run_id"),
    time: str = "time",
    onset: str = "onset",
    end: Column | None = None,
    rank: str = "ann_idx",
    label: str = "description",
    name: str = "task_label",
    default: str = REST_CLASS,
    bin_intervals: int = BIN_INTERVALS,
) -> DataFrame:
    """Label of the interval ``onset <= time < end`` of the same recording.

    Where intervals overlap the one with the greatest ``rank`` wins; a sample that none covers
    gets ``default``. ``end`` defaults to ``onset + duration``; (keys, rank) must be unique. Times are
    compared as doubles. The intervals are read for their count and the bounds of the bins.
    """
    finish = (F.col(onset) + F.col("duration")) if end is None else end
    own = [f"k{i}" for i in range(len(keys))]
    known = intervals.select(
        *[column(key).alias(k) for key, k in zip(keys, own)],
        F.struct(
            F.col(rank).alias("rank"), F.col(onset).cast("double").alias("onset"),
            finish.cast("double").alias("finish"), F.col(label).alias("label"),
        ).alias("item"),
    ).where("item.onset < item.finish").dropna(subset=own)
    rows = known.count()
    ends = known.select(*own, F.explode(F.array("item.onset", "item.finish")).alias("t"))
    bins = Ranges(ends, [*own, "t"], -(-rows // bin_intervals), 2 * rows)
    place = lambda moment: bins.place([*map(F.col, own), moment])
    spans = known.withColumns({"first": place(F.col("item.onset")), "last": place(F.col("item.finish"))})
    standing = spans.select(*own, F.explode(F.array_distinct(F.array("first", "last"))).alias("bin"), "item")
    if bins.count > 2:
        standing = standing.unionByName(_covered_bins(spans, own, bins.count))
    pieces = standing.groupBy(*own, "bin").agg(F.collect_list("item").alias("items")).select(
        *own, "bin", disjoint_pieces(F.col("items")).alias("pieces")
    )
    tag = "i"
    while any(c.lower().startswith(tag) for c in samples.columns):
        tag += "_"
    moment = column(time).cast("double")
    at = bins.place([*map(column, keys), moment])
    found = samples.select(
        *map(column, samples.columns), *[column(key).alias(tag + k) for key, k in zip(keys, own)], at.alias(tag + "bin")
    ).join(pieces.toDF(*[tag + c for c in pieces.columns]), [tag + c for c in (*own, "bin")], "left")
    kept = [column(other) for other in samples.columns if other != name]
    return found.select(*kept, F.coalesce(piece_at(F.col(tag + "pieces"), moment), F.lit(default)).alias(name))
