"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers. A block of the index keeps, for every dimension and every bit of the
shifted component, one bitmap over the block's rows. The scores of all rows of a block against one query are
added bitmap by bitmap: bit j of a query component adds the dimension's slices j places higher, complemented
where the component is negative, and full adders reduce the bitmaps of one place three to two, carrying into
the next. The best rows are then selected from the most significant slice of the sum downward; rows that are
still equal after the last slice are the boundary, and the smallest identifiers of them are taken.

Queries are met in blocks of their own: every block of the index meets every block of queries once, in tasks
of their own, and leaves ``k`` rows a query. Nothing is broadcast or collected but four counts.

Behaviour: a vector that is NULL, or holds a NULL or non-finite component or one of ``LIMIT`` or more after
scaling, takes no part, nor does a row without identifier. Vectors meet those of their own width only; with
width zero every score is 0. Rows that share an identifier with the query are its own and no candidates;
repeated query rows get their answers each. Ties go to the smaller identifier. Columns other than identifier
and vector are not read. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.stages import bounded_batches
from epochloom.shared import materialise

#: Quantised components stay below this size, so that a sum fits a long integer for widths up to 2^14.
LIMIT = 1 << 24
#: Components (rows times width) of one block of the index, and of one block of queries.
BLOCK_CELLS = 1 << 21
QUERY_CELLS = 1 << 13
#: Most tasks that the meetings of blocks are dealt to; beyond it several meetings share a task.
MEETING_TASKS = 20_000
_BLOCK = "part int, width int, rows int, low long, bits int, ids binary, slices binary"
_QUERIES = "chunk int, width int, first int, query_ids binary, weights binary"


def quantised(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` of every component as long integers; NULL for vectors that take no part."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float(LIMIT)))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def quantised_vectors(df: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """The rows that take part: ``_id`` and the integer components ``_v``."""
    rows = df.select(column(vec_id).cast("long").alias("_id"), quantised(column(vector), scale).alias("_v"))
    return rows.where(F.col("_id").isNotNull() & F.col("_v").isNotNull())


def _gathered(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, identifiers in ascending order, components) of up to ``cells`` components or one batch more."""
    held: dict[int, list] = defaultdict(list)
    size: dict[int, int] = defaultdict(int)

    def flushed(width: int):
        parts = held.pop(width)
        ids = np.concatenate([p[0] for p in parts])
        order = np.argsort(ids, kind="stable")
        return width, ids[order], np.concatenate([p[1] for p in parts])[order]

    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            piece = batch.slice(low, 1024)
            ids = piece.column("_id").to_numpy()
            lists = piece.column("_v")
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
            widths = np.diff(offsets)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                if size[width] and size[width] + len(rows) * max(1, width) > cells:
                    yield flushed(width)
                    size[width] = 0
                held[width].append((ids[rows], values[offsets[rows][:, None] + np.arange(width)]))
                size[width] += len(rows) * max(1, width)
    for width in list(held):
        yield flushed(width)


def sliced(values: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(least value, bits, bitmaps): slice [d, b] holds bit b of ``value - least`` for dimension d, row by row."""
    n, width = values.shape
    low = int(values.min()) if values.size else 0
    shifted = (values - low).T
    bits = int(shifted.max()).bit_length() if values.size else 0
    words = -(-n // 64)
    bitmaps = np.zeros((width, bits, words * 8), dtype=np.uint8)
    for b in range(bits):
        packed = np.packbits((shifted >> b & 1).astype(np.uint8), axis=1, bitorder="little")
        bitmaps[:, b, : packed.shape[1]] = packed
    return low, bits, bitmaps.view(np.uint64)


def added(bitmaps: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of ``sum of |weight| * component``, the components of negative weights complemented."""
    places: dict[int, list[np.ndarray]] = defaultdict(list)
    size = np.abs(weights)
    flips = np.where(weights < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    for j in range(int(size.max(initial=0)).bit_length()):
        dims = np.flatnonzero(size >> j & 1)
        if len(dims):
            part = bitmaps[dims] ^ flips[dims][:, None, None]
            for b in range(part.shape[1]):
                places[j + b].append(part[:, b])
    sums, place = [], 0
    empty = np.zeros((0, bitmaps.shape[2]), dtype=np.uint64)
    while place <= max(places, default=-1):
        stack = np.concatenate(places.pop(place, [empty]))
        while len(stack) > 1:
            m = max(1, len(stack) // 3)
            a, b = stack[:m], stack[m : 2 * m]
            half, carry = a ^ b, a & b
            if len(stack) > 2:
                c = stack[2 * m : 3 * m]
                carry |= half & c
                half ^= c
            places[place + 1].append(carry)
            stack = np.concatenate([half, stack[3 * m :]]) if len(stack) > 3 * m else half
        sums.append(stack[0] if len(stack) else np.zeros(bitmaps.shape[2], dtype=np.uint64))
        place += 1
    return sums


def _places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_rows(sums: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Rows of ``alive`` with the ``k`` greatest sums; of rows equal at the boundary, the first ones."""
    chosen, equal, left = np.zeros_like(alive), alive, k
    for bits in reversed(sums):
        ones = equal & bits
        n = int(np.bitwise_count(ones).sum())
        if n >= left:
            equal = ones
        else:
            chosen, equal, left = chosen | ones, equal & ~bits, left - n
    return np.concatenate([_places(chosen), _places(equal)[:left]])


def block_search(
    ids: np.ndarray, low: int, bits: int, bitmaps: np.ndarray, query_id: int, weights: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers and scores of a block's ``k`` best rows but those that share the query's identifier."""
    alive = np.zeros(bitmaps.shape[2] * 8, dtype=np.uint8)
    packed = np.packbits(ids != query_id, bitorder="little")
    alive[: len(packed)] = packed
    sums = added(bitmaps, weights)
    rows = best_rows(sums, alive.view(np.uint64), k)
    score = np.full(len(rows), low * int(weights.sum()) + ((1 << bits) - 1) * int(weights[weights < 0].sum()))
    for place, bitmap in enumerate(sums):
        score += ((bitmap[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << place
    return ids[rows], score


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for width, ids, values in _gathered(batches, 2 * BLOCK_CELLS):
        low, bits, bitmaps = sliced(values)
        row = [part, width, len(ids), low, bits, ids.tobytes(), bitmaps.tobytes()]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        names = ["part", "width", "rows", "low", "bits", "ids", "slices"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, first = TaskContext.get().partitionId(), 0
    for width, ids, values in _gathered(batches, 2 * QUERY_CELLS):
        row = [part, width, first, ids.tobytes(), values.tobytes()]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        names = ["chunk", "width", "first", "query_ids", "weights"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)
        first += len(ids)


def bit_sliced_index(vectors: DataFrame) -> DataFrame:
    """Stored blocks of the rows of ``quantised_vectors``, each of about ``BLOCK_CELLS`` components."""
    return _stored_blocks(vectors, BLOCK_CELLS, _index, _BLOCK, "bit-slices")


def _stored_blocks(vectors: DataFrame, cells: int, build: Callable, schema: str, label: str) -> DataFrame:
    total = vectors.agg(F.sum(F.greatest(F.size("_v"), F.lit(1))).alias("n")).first().n or 0
    return materialise(vectors.repartition(max(1, -(-total // cells))).mapInArrow(build, schema), label)


def _search(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                ids = np.frombuffer(pair["ids"], dtype=np.int64)
                words = -(-pair["rows"] // 64)
                bitmaps = np.frombuffer(pair["slices"], dtype=np.uint64).reshape(pair["width"], pair["bits"], words)
                queries = np.frombuffer(pair["query_ids"], dtype=np.int64)
                weights = np.frombuffer(pair["weights"], dtype=np.int64).reshape(len(queries), pair["width"])
                found = [
                    block_search(ids, pair["low"], pair["bits"], bitmaps, int(q), w, k) for q, w in zip(queries, weights)
                ]
                sizes = [len(f[0]) for f in found]
                row = (pair["chunk"] << 32) + pair["first"] + np.arange(len(queries))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(row, sizes)), pa.array(np.repeat(queries, sizes)),
                        pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    names=["query_row", "query_id", "vec_id", "score"],
                )

    return run


def top_rows(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Per row of ``queries`` (as ``quantised_vectors``): query_id, rank (from 1), vec_id, score."""
    bounded_batches(index.sparkSession)
    chunks = _stored_blocks(queries, QUERY_CELLS, _chunks, _QUERIES, "query-blocks")
    parts, groups = (t.agg(F.coalesce(F.max(c), F.lit(-1)).alias("n")).first().n + 1 for t, c in ((index, "part"), (chunks, "chunk")))
    tasks, meet = min(max(1, parts * groups), MEETING_TASKS), ["part", "chunk", "width"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("chunk", every(groups)) if groups else index.withColumn("chunk", F.lit(0))
    right = chunks.withColumn("part", every(parts)) if parts else chunks.withColumn("part", F.lit(0))
    pairs = left.repartition(tasks, *meet).join(right.repartition(tasks, *meet).hint("shuffle_hash"), meet)
    found = pairs.select(
        "width", "rows", "low", "bits", "ids", "slices", "chunk", "first", "query_ids", "weights"
    ).mapInArrow(_search(k), "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_matches(
    df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256,
) -> DataFrame:
    """The ``k`` best other rows for every row for which ``is_query``, a column over the identifier ``_id``, holds."""
    rows = quantised_vectors(df, vec_id, vector, scale)
    return top_rows(bit_sliced_index(rows), rows.where(is_query), k)
