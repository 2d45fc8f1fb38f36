import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.llm import bit_sliced as BS

SCHEMA = "vec_id long, embedding array<float>, part string, ids string"


def brute(rows, k, scale=256):
    """Inner products of floored components, one pair at a time."""
    kept = []
    for vec_id, vector, *_ in rows:
        if vec_id is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, np.floor(scale * np.array(vector, dtype=np.float32).astype(float))))
    out = []
    for q, a in kept:
        if q % 5 == 0:
            scores = sorted((-int(a @ b), c) for c, b in kept if c != q and len(a) == len(b))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def found(frame, k):
    got = BS.top_matches(frame, F.col("_id") % 5 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, width))
    data[::7] = data[0]  # many equal vectors: ties at every boundary
    return [(i, data[i].tolist(), "x", "y") for i in range(n)]


@pytest.mark.parametrize("n, width, k", [(300, 64, 5), (150, 3, 7), (3, 2, 5), (40, 1, 50)])
def test_equals_brute_force(spark, n, width, k):
    rows = vectors(n, width, n)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7), k) == brute(rows, k)


def test_many_blocks(spark, monkeypatch):
    """Rows over many blocks; workers that are forked anew read the small sizes from the closure of the plan."""
    monkeypatch.setattr(BS, "BLOCK_CELLS", 320)
    monkeypatch.setattr(BS, "QUERY_CELLS", 64)
    rows = vectors(200, 16, 3)
    frame = BS.quantised_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 256)
    index = BS.bit_sliced_index(frame)
    assert index.select("part").distinct().count() == 10
    got = BS.top_rows(index, frame.where("_id % 5 = 0"), 4).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4)


def test_rows_that_take_no_part(spark):
    good = vectors(30, 4, 1)
    nan, inf = float("nan"), float("inf")
    bad = [
        (100, None), (105, [1.0, None, 0.0, 0.0]), (110, [nan, 0.0, 0.0, 0.0]), (115, [0.0, inf, 0.0, 0.0]),
        (None, [9.0, 9.0, 9.0, 9.0]), (120, [1e30, 0.0, 0.0, 0.0]),
    ]
    rows = good + [(i, v, None, None) for i, v in bad]
    assert found(spark.createDataFrame(rows, SCHEMA), 3) == brute(good, 3)


def test_widths_repeated_rows_and_zeros(spark):
    rows = [(i, [0.5 * i, 1.0], "x", "y") for i in range(12)] + [(i, [1.0, 0.0, float(i)], "x", "y") for i in range(20, 32)]
    rows += [(40, [], "x", "y"), (41, [], "x", "y"), (45, [0.0, 0.0], "x", "y"), (5, [2.5, 1.0], "x", "y")]
    got = found(spark.createDataFrame(rows, SCHEMA), 3)
    assert got == brute(rows, 3)
    assert [r for r in got if r[0] == 40] == [(40, 1, 41, 0)]
    assert len([r for r in got if r[0] == 5]) == 6  # the query stands twice, and is no candidate of itself


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA), 5) == []
    assert found(spark.createDataFrame([(1, [1.0], "x", "y")], SCHEMA), 5) == []
