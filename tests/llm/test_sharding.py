from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.llm import sharding
from epochloom.llm.queries import op6_shards
from epochloom.llm.sharding import communication_matrix, hypergeometric, shuffled_shards

SCHEMA = "doc_id long, text string, shard int, _row string"


@pytest.mark.parametrize("rows, shards", [(0, 3), (1, 3), (100, 7), (103, 7)])
def test_shards_are_whole_and_even(spark, rows, shards):
    data = [(i if i % 9 else None, "same" if i % 3 else None, 99, "x") for i in range(rows)]
    got = shuffled_shards(spark.createDataFrame(data, SCHEMA).repartition(4), shards, seed=3).collect()
    assert sorted(map(str, ((r.doc_id, r.text, r._row) for r in got))) == sorted(map(str, ((d[0], d[1], d[3]) for d in data)))
    sizes = [0] * shards
    for r in got:
        sizes[r.shard] += 1
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_matrix_keeps_both_margins():
    rows = [0, 5, 1000, 17, 1]
    matrix = communication_matrix(rows, 6, 1)
    assert matrix.sum(axis=1).tolist() == rows and np.ptp(matrix.sum(axis=0)) <= 1


def test_placement_is_uniform(spark):
    """Rows of one partition spread over all shards and slots."""
    got = shuffled_shards(spark.range(40_000).repartition(4), 8).toPandas()
    first = got[got.id < 10_000]
    spread = first.shard.value_counts()
    assert spread.min() > 1100 and spread.max() < 1400
    assert abs(first.slot.mean() - 2499.5) < 60


def test_large_populations():
    rng = np.random.default_rng(0)
    draws = [hypergeometric(rng, 2 * 10**9, 6 * 10**9, 1000) for _ in range(300)]
    assert abs(np.mean(draws) - 250) < 4 and 10 < np.std(draws) < 18


@pytest.mark.parametrize("sources, slices", [(2, 1), (1, 3), (1024, 256)])
def test_names_and_parts_do_not_matter(spark, monkeypatch, sources, slices):
    """Columns named like the internal ones come back unchanged, however rows are grouped."""
    monkeypatch.setattr(sharding, "SOURCES", sources)
    monkeypatch.setattr(sharding, "SLICES", slices)
    names = "row part source place mix slice before no n cells ends shard slot _row _part _first _place _ends c0".split()
    df = spark.range(500).select(*[(F.col("id") * 100 + i).alias(n) for i, n in enumerate(names)]).repartition(5)
    got = shuffled_shards(df, 7).collect()
    kept = [n for n in names if n not in ("shard", "slot")]
    assert sorted(tuple(r[n] for n in kept) for r in got) == sorted(tuple(r[n] for n in kept) for r in df.collect())
    assert sorted((r.shard, r.slot) for r in got) == sorted((s, i) for s in range(7) for i in range(500 // 7 + (s < 500 % 7)))


def test_query_columns_equal_brute_force(spark, tmp_path):
    texts = [None, "", "é日", "same", "same", "x" * 100_000, "a\nb"] * 9
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op6_shards(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        raw = (t or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(raw) + 16, crc32(raw), "rows", None)
    assert sorted((r.shard, r.slot) for r in got.values()) == sorted((i % 40, i // 40) for i in range(len(rows)))
