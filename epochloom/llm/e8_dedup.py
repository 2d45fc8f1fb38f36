"""Near-duplicate vectors by lattice hashing: projections decoded to E8 points, neighbouring cells probed.

Each of ``TABLES`` tables projects unit vectors on ``BLOCKS`` times eight random orthonormal directions,
scales them and decodes every eight coordinates to the nearest point of the E8 lattice. A vector enters the
cells of the ``PROBES`` nearest combinations of lattice points. Vectors that meet in a cell are compared by
cosine in double precision. At cosine 0.95 a table brings a pair together with probability 0.68, so nine
tables miss one of 30 000 such pairs, and far fewer above. More blocks make more and finer cells.

Equal vectors are one class from the start and are never compared or paired. A cell of more than
``CELL_ROWS`` classes is cut into parts by a hash, and every two parts meet in a task of their own, so no
task holds a whole cell. A pair that meets in several cells is counted in the one with its smallest common
code; cells put out sums and a forest, no pairs.

Behaviour: vectors that are NULL, zero or hold NULL or non-finite components link with nothing and are
their own component. Rows without an identifier link with nothing either and have none. Repeated rows are
vectors of their own. Vectors of different lengths do not meet. Other columns, labels included, are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.components import components
from epochloom.llm.grouped import runs
from epochloom.shared import materialise

TABLES, BLOCKS, PROBES = 9, 2, 3
#: Scale of the projections of vectors of SCALE_WIDTH components; it grows with the root of the width, so that
#: pairs of one cosine lie equally far apart on the lattice at every width.
SCALE, SCALE_WIDTH = 3.5, 64
#: The least cosine for which the stated miss probability holds.
LEAST_COSINE = 0.95
CELL_ROWS = 2048
SEED = 11


@lru_cache
def lattice_steps() -> np.ndarray:
    """The origin and the 240 shortest vectors of E8."""
    pairs = [
        [s if k == i else t if k == j else 0.0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2) for s in (1.0, -1.0) for t in (1.0, -1.0)
    ]
    halves = [h for h in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in h) % 2 == 0]
    return np.array([[0.0] * 8, *pairs, *halves])


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    gap = (x - near)[odd]
    worst = np.abs(gap).argmax(axis=1)
    near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_points(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: of the even integer points, or of those moved by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _probed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest lattice points around each row, with their distances less that of the origin."""
    centre, steps = nearest_points(x), lattice_steps()
    gain = (steps**2).sum(axis=1) - 2 * ((x - centre) @ steps.T)
    order = np.argpartition(gain, PROBES, axis=1)[:, :PROBES]
    return centre[:, None, :] + steps[order], np.take_along_axis(gain, order, axis=1)


@lru_cache
def _directions(dims: int) -> list[np.ndarray]:
    rng = np.random.default_rng([SEED, dims])
    return [np.linalg.qr(rng.normal(size=(max(dims, 8 * BLOCKS), 8 * BLOCKS)))[0][:dims] for _ in range(TABLES)]


def cell_codes(unit: np.ndarray) -> np.ndarray:
    """Codes (rows, TABLES, PROBES) of the cells that unit vectors enter."""
    rng = np.random.default_rng([SEED, unit.shape[1], 1])
    out = np.empty((len(unit), TABLES, PROBES), dtype=np.int64)
    rows = np.arange(len(unit))[:, None]
    for t, directions in enumerate(_directions(unit.shape[1])):
        y = unit @ directions * (SCALE * np.sqrt(unit.shape[1] / SCALE_WIDTH))
        code, cost = np.zeros((len(unit), 1), dtype=np.int64), np.zeros((len(unit), 1))
        for b in range(BLOCKS):
            points, gain = _probed(y[:, 8 * b : 8 * b + 8])
            mixed = ((2 * points).astype(np.int64) * (rng.integers(1, 1 << 62, 8) | 1)).sum(axis=2)
            both = (cost[:, :, None] + gain[:, None, :]).reshape(len(unit), -1)
            best = np.argsort(both, axis=1, kind="stable")[:, :PROBES]
            code = code[rows, best // PROBES] * 1_000_003 + mixed[rows, best % PROBES]
            cost = both[rows, best]
        out[:, t] = code * 31 + t
    return out


def _units(raw: pa.Array, dtype: str) -> np.ndarray:
    x = np.stack([np.frombuffer(v, dtype=dtype) for v in raw.to_pylist()]).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(dtype: str) -> Callable:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: list[bytes | None] = []
            for cell in batch.column("_vector"):
                values = None if not cell.is_valid else cell.values
                good = values is not None and len(values) and not values.null_count
                x = np.asarray(values, dtype=dtype) if good else None
                with np.errstate(over="ignore"):
                    size = np.linalg.norm(x.astype(np.float64)) if good else 0.0
                raw.append(x.tobytes() if size > 0 and np.isfinite(size) else None)
            codes: list = [None] * len(raw)
            for size in {len(r) for r in raw if r}:
                at = [i for i, r in enumerate(raw) if r and len(r) == size]
                found = cell_codes(_units(pa.array([raw[i] for i in at], pa.binary()), dtype))
                for i, c in zip(at, found.reshape(len(at), -1).tolist()):
                    codes[i] = c
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array([r and blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                    pa.array(raw, pa.binary()), pa.array(codes, pa.list_(pa.int64())),
                ],
                names=["_id", "_class", "_raw", "_codes"],
            )

    return code


def _compared(dtype: str, threshold: float) -> Callable:
    """Sums of links and a forest for every (cell, part, part)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ("cell", "low", "high")):
            if len(group) < 2:
                continue
            raw = group.column("_raw").combine_chunks()
            raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
            sizes = pc.binary_length(raw).to_numpy()
            cell, low, high = (group.column(c)[0].as_py() for c in ("cell", "low", "high"))
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                x = _units(raw.take(pa.array(same)), dtype)
                part = group.column("part").to_numpy()[same]
                weight = group.column("size").to_numpy()[same]
                name = group.column("rep").to_numpy()[same]
                if low == high:
                    left, right = np.nonzero(np.triu(x @ x.T >= threshold, 1))
                else:
                    mine, theirs = np.flatnonzero(part == low), np.flatnonzero(part == high)
                    left, right = np.nonzero(x[mine] @ x[theirs].T >= threshold)
                    left, right = mine[left], theirs[right]
                if not len(left):
                    continue
                links = np.zeros(len(x), dtype=np.int64)
                for at in range(0, len(left), 1 << 16):
                    a, b = left[at : at + (1 << 16)], right[at : at + (1 << 16)]
                    involved, where = np.unique(np.concatenate([a, b]), return_inverse=True)
                    codes = cell_codes(x[involved])
                    ca, cb = codes[where[: len(a)]], codes[where[len(a) :]]
                    shared = (ca[:, :, :, None] == cb[:, :, None, :]).any(axis=3)
                    first = np.where(shared, ca, np.iinfo(np.int64).max).min(axis=(1, 2)) == cell
                    np.add.at(links, a[first], weight[b[first]])
                    np.add.at(links, b[first], weight[a[first]])
                order = np.argsort(name, kind="stable")
                place = np.empty(len(x), dtype=np.int64)
                place[order] = np.arange(len(x))
                best, before = place.copy(), None
                while before is None or (best != before).any():
                    before = best.copy()
                    np.minimum.at(best, left, best[right])
                    np.minimum.at(best, right, best[left])
                    best = np.minimum(best, best[order[best]])
                root = order[best]
                some = np.unique(np.concatenate([left, right]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[some]), pa.array(links[some]), pa.array(name[root[some]])], names=["rep", "links", "root"]
                )

    return compare


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept. Identifiers are integers.

    Thresholds below ``LEAST_COSINE`` are refused: the tables would miss more pairs than stated.
    """
    if threshold < LEAST_COSINE:
        raise ValueError(f"thresholds below {LEAST_COSINE} need more tables")
    rows = vectors.select(column(vec_id).cast("long").alias("_id"), column(vector).alias("_vector"))
    dtype = "float32" if rows.schema["_vector"].dataType.elementType.simpleString() == "float" else "float64"
    coded = materialise(
        rows.mapInArrow(_coded(dtype), "_id long, _class binary, _raw binary, _codes array<long>"), "coded-vectors"
    )
    usable = coded.where("_id IS NOT NULL AND _class IS NOT NULL")
    classes = materialise(
        usable.groupBy("_class").agg(
            F.min("_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first(F.struct("_raw", "_codes")).alias("_v")
        ).select("_class", "rep", "size", "_v._raw", "_v._codes"),
        "vector-classes",
    )
    entered = classes.select("rep", F.explode("_codes").alias("cell"))
    crowded = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    meetings = entered.join(crowded.select("cell", parts.alias("parts")), "cell").withColumn("part", part).select(
        "rep", F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda p: F.struct(F.col("cell"), F.least("part", p).alias("low"), F.greatest("part", p).alias("high"), F.col("part")),
        ).alias("meetings"),
    )
    by_class = meetings.groupBy("rep").agg(F.flatten(F.collect_list("meetings")).alias("meetings"))
    together = classes.select("rep", "size", "_raw").join(by_class, "rep").select(
        "rep", "size", "_raw", F.explode("meetings").alias("at")
    ).select("rep", "size", "_raw", "at.*")
    keys = ("cell", "low", "high")
    found = materialise(
        together.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_compared(dtype, threshold), "rep long, links long, root long"),
        "vector-links",
    )
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "root")
    answer = classes.select("_class", "rep", "size").join(sums, "rep", "left").join(
        joined, F.col("rep") == F.col("node"), "left"
    ).select(
        "_class", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = usable.select("_id", "_class").join(answer, "_class").select("_id", "n_links", "component_id")
    alone = coded.where("_id IS NULL OR _class IS NULL").select(
        "_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("_id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
