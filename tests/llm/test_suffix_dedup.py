import hashlib
import random

import pytest

from epochloom.llm import suffix_dedup
from epochloom.llm.suffix_dedup import front_coded, merged, repeats_removed, shared_prefix, without_repeats

SCHEMA = "doc_id long, text string, digest string, _k int"


def brute(rows, window=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = {}
    for d, raw in enumerate(raws):
        for i in range(len(raw) - window + 1):
            seen.setdefault(raw[i : i + window], []).append((d, i))
    gone = [bytearray(len(r)) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + window] = b"\x01" * window
    out = []
    for (doc, _), raw, mask in zip(rows, raws, gone):
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        n_spans = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        out.append((doc, len(raw), sum(mask), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdé fgh ij\n") for _ in range(n))

    passages = [noise(n) for n in (150, 190, 197, 200, 205, 260, 700)]
    texts = [noise(rng.randint(0, 300)) + rng.choice(passages) + noise(rng.randint(0, 300)) for _ in range(60)]
    texts += [passages[6][:k] + noise(40) + passages[6][k:] for k in (100, 250, 420)]
    twice = noise(230)
    texts += [twice + "," + twice, "x" * 199, "x" * 200, "x" * 201, "y" * 3000, "ab" * 400, noise(50) + "ab" * 300]
    texts += [texts[0]] * 3 + [None, "", noise(199), "short", "short", "é" * 150, noise(30) + "é" * 120, noise(20_000)]
    texts.append(texts[-1][9000:12_000])
    texts += [passages[6] + noise(30) for _ in range(25)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, hot, run, size", [(0, 50_000, 1 << 16, 50_000), (1, 3, 1 << 16, 50_000), (2, 50_000, 40, 100)])
def test_removed_bytes_match_brute_force(spark, many_partitions, monkeypatch, seed, hot, run, size):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(suffix_dedup, "RUN_ROWS", run)
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", size)
    rows = corpus(seed)
    frame = spark.createDataFrame([(*r, "d", 0) for r in rows], SCHEMA).repartition(5)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats_removed(frame).collect())
    assert got == brute(rows)


def test_repeated_rows_and_missing_identifiers(spark):
    text = "".join(random.Random(3).choice("abcdef") for _ in range(300))
    rows = [(1, text), (1, text), (None, text + "!"), (None, None), (2, "z")]
    got = sorted(
        ((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats_removed(
            spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)).collect())
    )
    assert got == sorted((d or 0, *rest) for d, *rest in brute(rows))


def test_texts_without_repeats(spark):
    rng = random.Random(8)
    passage, own = ["".join(rng.choice("abcdef") for _ in range(n)) for n in (250, 100)]
    rows = [(1, own + passage, "d", 1), (2, passage, "d", 2), (3, None, None, 3), (4, "kept", "d", 4), (5, passage, "d", 5)]
    got = {r.doc_id: tuple(r) for r in without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (1, own, "d", 1), 2: (2, "", "d", 2), 3: (3, None, None, 3), 4: (4, "kept", "d", 4), 5: (5, "", "d", 5)}


def test_nothing_is_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    docs = spark.createDataFrame([(i, "abc " * 100 + str(i), "d", 1) for i in range(5)], SCHEMA)
    got = repeats_removed(docs)
    assert {t.name for t in spark.catalog.listTables()} == before and got.count() == 5


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repeats_removed(empty).count() == 0 and without_repeats(empty).count() == 0


@pytest.mark.parametrize("n_runs", [0, 1, 2, 3, 7])
def test_loser_tree_sorts_and_knows_prefixes(n_runs):
    rng = random.Random(n_runs)
    strings = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30))) for _ in range(n_runs)]
    coded = [(s.tolist(), r) for s, r in map(front_coded, strings)]
    order, prefixes = merged(coded) if coded else ([], [])
    got = [strings[run][at] for run, at in order]
    assert got == sorted(x for run in strings for x in run)
    assert prefixes[1:] == [shared_prefix(a, b, 0) for a, b in zip(got, got[1:])]
