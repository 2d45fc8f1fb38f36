"""Token files of 64-bit words, each a 4-bit selector and as many ids of equal width as fit.

Ids are coded in blocks of ``BLOCK`` ids, and a segment lists at which word every block begins, so blocks
are coded and decoded side by side in numpy. Selector ``s`` below 14 stands for ``COUNTS[s]`` values of
``60 // COUNTS[s]`` bits; ``ESCAPE`` announces one plain 64-bit word for a value of more than 60 bits.

Files: the rows of one Spark partition, in order of the key, become segments of whole documents; a segment
is a Parquet row with the document keys, their lengths, the block offsets and the words. Spark's own
writer commits the files, so a retried task leaves none twice.

Behaviour: NULL text counts as empty; a document without ids has length 0 and keeps its place. NULL keys
come first; rows that share a key are ordered by a hash of their text, rows alike in both have no defined
order. Other columns are not read. An empty table gives files without segments and an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.functions.columns import column
from epochloom.llm.stages import bounded_batches
from epochloom.llm.word_tokens import encoder, slices

BLOCK = 512
#: How many ids each selector packs.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 15


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    high = (values >> np.uint64(32)).astype(np.float64)
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    if not high.any():
        return low.astype(np.uint8)
    return np.where(high > 0, np.frexp(high)[1] + 32, low).astype(np.uint8)


def _selectors(widths: np.ndarray) -> np.ndarray:
    """For every place of a (blocks, ids) matrix of bit widths, the selector that packs most from there."""
    spans = {1: widths}

    def widest(n: int) -> np.ndarray:
        if n not in spans:
            half = widest(max(k for k in spans if k < n))
            size = max(k for k in spans if k < n)
            shifted = np.zeros_like(half)
            shift = min(n - size, half.shape[1])
            shifted[:, : half.shape[1] - shift] = half[:, shift:]
            spans[n] = np.maximum(half, shifted)
        return spans[n]

    for n in (2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60):
        widest(n)
    fitting = sum((spans[int(n)] <= bits).astype(np.uint8) for n, bits in zip(COUNTS, WIDTHS))
    return np.where(fitting, len(COUNTS) - fitting, ESCAPE).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``values`` (unsigned 64 bits) and the word at which each block begins."""
    values = values.astype(np.uint64)
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros(blocks * BLOCK + int(COUNTS[0]), dtype=np.uint64)
    padded[: len(values)] = values
    chosen = _selectors(_bit_lengths(padded[: blocks * BLOCK]).reshape(blocks, BLOCK))
    taken = np.append(COUNTS, [1, 1])[chosen]
    size = np.full(blocks, BLOCK)
    if blocks:
        size[-1] = len(values) - (blocks - 1) * BLOCK
    begins = np.zeros((blocks, BLOCK), dtype=bool)
    at, active = np.zeros(blocks, dtype=np.int64), np.arange(blocks)
    while len(active):
        here = at[active]
        begins[active, here] = True
        here += taken[active, here]
        at[active] = here
        active = active[here < size[active]]
    source = np.flatnonzero(begins)
    block, place = source // BLOCK, source % BLOCK
    selector = chosen.ravel()[source]
    words_of = 1 + (selector == ESCAPE).astype(np.int64)
    position = np.cumsum(words_of) - words_of
    words = np.zeros(int(words_of.sum()), dtype=np.uint64)
    left = size[block] - place
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[position[rows]] = np.uint64(ESCAPE) << np.uint64(60)
            words[position[rows] + 1] = padded[source[rows]]
            continue
        word = np.full(len(rows), np.uint64(s) << np.uint64(60))
        for k in range(int(COUNTS[s])):
            value = np.where(k < left[rows], padded[source[rows] + k], np.uint64(0))
            word |= value << np.uint64(k * int(WIDTHS[s]))
        words[position[rows]] = word
    offsets = position[np.searchsorted(block, np.arange(blocks))] if blocks else np.zeros(0, np.int64)
    return words, offsets.astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` values behind ``encode``; all blocks advance together."""
    blocks = len(offsets)
    at, done = offsets.astype(np.int64), np.zeros(blocks, dtype=np.int64)
    size = np.full(blocks, BLOCK)
    if blocks:
        size[-1] = count - (blocks - 1) * BLOCK
    out = np.zeros(blocks * BLOCK + int(COUNTS[0]), dtype=np.uint64)
    active, steps = np.arange(blocks), []
    while len(active):
        word = words[at[active]]
        selector = (word >> np.uint64(60)).astype(np.int64)
        steps.append((active * BLOCK + done[active], at[active], selector))
        escaped = selector == ESCAPE
        at[active] += 1 + escaped
        done[active] += np.append(COUNTS, [1, 1])[selector]
        active = active[done[active] < size[active]]
    if steps:
        target, source, selector = (np.concatenate(x) for x in zip(*steps))
        order = np.argsort(target)  # padding behind a block's end is overwritten by the next block
        target, source, selector = target[order], source[order], selector[order]
        room = np.minimum(np.append(COUNTS, [1, 1])[selector], BLOCK - target % BLOCK)
        for s in np.unique(selector):
            rows = np.flatnonzero(selector == s)
            if s == ESCAPE:
                out[target[rows]] = words[source[rows] + 1]
                continue
            mask = (np.uint64(1) << np.uint64(WIDTHS[s])) - np.uint64(1)
            for k in range(int(COUNTS[s])):
                some = rows[room[rows] > k]
                out[target[some] + k] = (words[source[some]] >> np.uint64(k * int(WIDTHS[s]))) & mask
    return out[:count]


def _segments(path: str, end_id: int | None) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "_text"):
                ids, counts = encoder(path).encode(piece.column("_text"), end_id)
                words, offsets = encode(ids)
                keys = piece.column("_key")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int64()), pa.array([first], pa.int64()),
                        pa.ListArray.from_arrays([0, len(keys)], keys),
                        pa.ListArray.from_arrays([0, len(counts)], pa.array(counts, pa.int64())),
                        pa.array([len(ids)], pa.int64()), pa.array([offsets.tobytes()], pa.binary()),
                        pa.array([words.tobytes()], pa.binary()),
                    ],
                    names=["part", "first", "keys", "lengths", "n_ids", "offsets", "words"],
                )
                first += len(ids)

    return write


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int | None = 1
) -> None:
    """Encode every text and write the ids below ``path`` in ascending order of ``key``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(column(key).alias("_key"), column(text).alias("_text"))
    order = [F.col("_key"), F.xxhash64("_text")]
    kind = rows.schema["_key"].dataType
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("keys", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("n_ids", T.LongType()), T.StructField("offsets", T.BinaryType()),
        T.StructField("words", T.BinaryType()),
    ])
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_segments(vocabulary, end_id), schema).write.parquet(path)


def _documents(kind: pa.DataType, visit: Callable | None) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cells = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
                words = np.frombuffer(cells["words"].as_py(), dtype=np.uint64)
                offsets = np.frombuffer(cells["offsets"].as_py(), dtype=np.uint32)
                ids = decode(words, offsets, cells["n_ids"].as_py())
                lengths = cells["lengths"].values.to_numpy().astype(np.int64)
                before = np.cumsum(lengths) - lengths
                starts = before + cells["first"].as_py() + cells["base"].as_py()
                small = ids.astype("<u4")
                last = pa.array(
                    [visit(small[a : a + n]) for a, n in zip(before.tolist(), lengths.tolist())], pa.int64()
                ) if visit else pa.LargeListArray.from_arrays(
                    np.append(before, len(ids)), pa.array(ids.view(np.int64))
                ).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [cells["keys"].values.cast(kind), pa.array(starts), pa.array(lengths), last],
                    names=["key", "start", "n_tokens", "ids_crc32" if visit else "ids"],
                )

    return read


def _crc(ids: np.ndarray) -> int:
    return crc32(ids.tobytes())


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id", checksum: bool = False) -> DataFrame:
    """Documents of the files: key, start (ids before it in the whole set), n_tokens, ids.

    With ``checksum`` the ids stay in the task and ``ids_crc32`` comes instead.
    """
    files = spark.read.parquet(path)
    kind = files.schema["keys"].dataType.elementType
    # one row per written partition
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    last = T.StructField("ids_crc32", T.LongType()) if checksum else T.StructField("ids", T.ArrayType(T.LongType()))
    schema = T.StructType([
        T.StructField("key", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), last,
    ])
    from pyspark.sql.pandas.types import to_arrow_type

    read = _documents(to_arrow_type(kind), _crc if checksum else None)
    return files.join(F.broadcast(bases), "part").mapInArrow(read, schema).withColumnRenamed("key", key)
