"""Best-fit packing of token sequences, planned on the histogram of piece lengths.

Documents are encoded and cut into pieces of at most ``CAPACITY`` tokens. The driver gets only how many
pieces have each length (at most ``CAPACITY`` numbers) and runs best-fit decreasing over these counts: a
move puts many equal pieces into a range of alike sequences at once. Pieces then take the planned slots by
their rank within their length. A rank is a piece's place in its partition plus the pieces of that length
in earlier partitions, so no length, however common, is gathered in one task.

Behaviour: NULL text counts as empty; an empty document is its end token alone. Repeated rows are packed
each. Columns other than the identifier and the text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Mapping
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.functions.columns import column
from epochloom.llm.stages import bounded_batches
from epochloom.llm.word_tokens import encoder, slices
from epochloom.shared import materialise

CAPACITY = 4096
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 1 << 20


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Plan for ``counts`` pieces of each length, and the number of sequences it fills.

    Rows: length, first rank, first sequence, pieces per sequence, offset. Pieces of that length from the
    first rank on fill the sequences from the first on, so many in each from the offset on. Of the open
    sequences, those with the least room that suffices come first.
    """
    moves, used = [], 0
    rooms: list[int] = []
    open_at: dict[int, list[tuple[int, int]]] = {}

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_at:
                open_at[room] = []
                insort(rooms, room)
            open_at[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room], rooms[at]
            else:
                room, first, n = capacity, used, -(-left // (capacity // length))
                used += n
            each = room // length
            full = min(n, left // each)
            if full:
                moves.append((length, rank, first, each, capacity - room))
                leave(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                moves.append((length, rank, first + full, left, capacity - room))
                leave(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(room, first + full, n - full)
    return np.array(moves, dtype=np.int64).reshape(-1, 5), used


def _pieces(vocabulary: str, end_id: int | None, capacity: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for piece in slices(batch, "_text", SLICE_BYTES):
                ids, counts = encoder(vocabulary).encode(piece.column("_text"), end_id)
                parts = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), parts)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = number * capacity
                length = np.minimum(counts[owner] - start, capacity)
                at = (np.cumsum(counts) - counts)[owner] + start
                raw = ids.astype("<u4")
                blobs = [raw[a : a + n].tobytes() for a, n in zip(at.tolist(), length.tolist())]
                rank = np.empty(len(length), dtype=np.int64)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                rank[order] = np.arange(len(order)) - np.searchsorted(ordered, ordered)
                rank += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("_id").take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start),
                        pa.array(length), pa.array(blobs, pa.binary()),
                        pa.array([crc32(b) for b in blobs], pa.int64()), pa.array([part] * len(owner), pa.int32()),
                        pa.array(rank),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "_part", "_rank"],
                )

    return cut


def packed_pieces(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = 1,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (little-endian 32-bit), ids_crc32, sequence_id, offset."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(column(doc_id).alias("_id"), column(text).alias("_text"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("_part", T.IntegerType()), T.StructField("_rank", T.LongType()),
    ])
    pieces = materialise(rows.mapInArrow(_pieces(vocabulary, end_id, capacity), schema), "pieces")
    per_part = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    moves, _ = best_fit({r.length: r.n for r in histogram}, capacity)
    # at most a few moves for each possible length
    plan = docs.sparkSession.sparkContext.broadcast(moves[np.lexsort((moves[:, 1], moves[:, 0]))])
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = plan.value
        wanted = length.to_numpy().astype(np.int64) << 46 | rank.to_numpy()
        move = table[np.searchsorted(table[:, 0] << 46 | table[:, 1], wanted, side="right") - 1]
        ahead = rank.to_numpy() - move[:, 1]
        return pd.DataFrame({
            "sequence_id": move[:, 2] + ahead // move[:, 3],
            "offset": move[:, 4] + ahead % move[:, 3] * move[:, 0],
        })

    placed = pieces.join(bases, ["_part", "length"]).withColumn("_slot", slot("length", F.col("_rank") + F.col("_before")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "_slot.sequence_id", "_slot.offset")
