import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from epochloom.llm import gram_table as GT
from epochloom.llm.resampling import bucket_counts, resampled

SCHEMA = "doc_id long, text string, n_words string, score int, place string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ODD = [
    None, "", " \t\n", "One", "İstanbul Élan's été—fin 日本 語", "a b a b a b " * 9, "x" * 5000 + " " + "y" * 700 + " z", "A.B,C;9_8`7{",
    "é" * 200 + " é", "end of one", "Start of next",
]


def grams(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def counts(texts):
    return Counter(crc32(g.encode()) % 10_000 for t in texts for g in grams(t)[1])


def brute(rows, target, percent=5, least=20):
    s, t = counts(r[1] for r in rows), counts(target)
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))

    out = []
    for doc_id, text, *_ in rows:
        n_words, found = grams(text)
        weight = sum(gain(crc32(g.encode()) % 10_000) for g in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, n_words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "of", "É", "日本"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(n)]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    return rows + [(n + i, t, "x", 1, "y") for i, t in enumerate(ODD)] + [(None, texts[0], "x", 1, "y"), (3, texts[3], "x", 1, "y")]


@pytest.mark.parametrize("percent", [5, 50, 100])
def test_equals_brute_force(spark, percent):
    rows, target = corpus(300), ["w1 w2 w3 The of", None, "", "日本 É w5 w6 " * 30]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = resampled(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent)
    found = sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert found == brute(rows, target, percent)


def test_counts_are_whole(spark):
    rows = corpus(100, 2)
    got = bucket_counts(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert dict(enumerate(got.tolist())) == {b: counts(r[1] for r in rows)[b] for b in range(10_000)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert resampled(empty, empty).count() == 0
    rows = corpus(4)
    got = resampled(spark.createDataFrame(rows, SCHEMA), empty, percent=0).collect()
    assert [r.rank for r in got] == [None] * len(rows)


def test_xxh64_is_the_library():
    data = np.random.default_rng(0).integers(0, 256, 3000, dtype=np.uint8)
    at = np.array([0, 5, 777, 2001])
    for length in [*range(0, 80), 200, 256]:
        want = [xxhash.xxh64_intdigest(data[a : a + length].tobytes()) for a in at]
        assert GT.xxh64(GT._Lanes(data), at, length).tolist() == want


def test_equal_keys_of_different_grams_stay_apart(monkeypatch):
    """With one key for all grams only the bytes tell them apart."""
    monkeypatch.setattr(GT, "xxh64", lambda lanes, at, length: np.full(len(at), 7, dtype=np.uint64))
    texts = ["a b c a b", "b c d " + "long" * 20, "a", "é a"]
    table = GT.GramTable(GT.words_of(pa.array(texts)), (1, 2, 3), 10_000)
    want = Counter(g for t in texts for g in grams(t)[1])
    assert sorted(table.count[table.count > 0].tolist()) == sorted(want.values())
    assert Counter(np.repeat(table.bucket, table.count).tolist()) == counts(texts)
