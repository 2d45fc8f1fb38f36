import math
import os
import random
import urllib.parse
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from epochloom.llm import gru_lm
from epochloom.llm.gru_lm import CLASSES, HIDDEN, Streams, Vocabulary, document_scores, fresh_weights, gradients, log10_likelihoods

SCHEMA = "doc_id long, text string, score string, held int"


def corpus(n=300):
    rng = random.Random(2)
    tongues = [["the", "of", "and", "water", "Stone"], ["der", "die", "und", "wasser", "stein"]]
    texts = [" ".join(rng.choice(tongues[i % 2]) + (str(rng.randint(0, 400)) if rng.random() < 0.1 else "") for _ in range(rng.randint(1, 90))) for i in range(n)]
    texts += ["", None, " \t\n", "the" * 20_000, "the " * 30_000]
    return list(enumerate(texts)) + [(None, "the der"), (7, texts[7])]


def words(text):
    return [*(text or "").encode().lower().split(), None]


@pytest.fixture(scope="module")
def scored(spark):
    frame = spark.createDataFrame([(d, t, "s", 0) for d, t in corpus()], SCHEMA).repartition(5)
    return document_scores(frame, held_out=F.pmod(F.col("doc_id"), F.lit(5)) == 1).toPandas()


def test_counts_and_base_scores_match_brute_force(scored):
    counts = Counter(w for d, t in corpus() if d is None or d % 5 != 1 for w in words(t))
    n, v = sum(counts.values()), len(counts)
    texts = dict(corpus())
    assert len(scored) == len(corpus())
    for r in scored.itertuples():
        own = words(texts[None if math.isnan(r.doc_id) else r.doc_id])
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    assert (scored[scored.doc_id == 7].score.round(4).nunique()) == 1


def test_model_beats_single_words_on_held_out_text(scored):
    held = scored[scored.held_out]
    assert (held.score <= 0).all() and held.score.sum() > held.base_score.sum()


def test_state_carries_over_windows_and_stops_at_documents():
    rng = np.random.default_rng(0)
    w = {k: (v * 3 if k != "bias" else rng.normal(size=CLASSES).astype(np.float32)) for k, v in fresh_weights(3).items()}
    docs = [rng.integers(0, CLASSES, n) for n in (1, 5, 40, 100, 3)]
    lengths = np.array([len(d) for d in docs])
    got = log10_likelihoods(w, Streams(np.concatenate(docs), np.cumsum(lengths) - lengths, lengths), len(docs))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for d, score in zip(docs, got):
        h, given, total = np.zeros(HIDDEN), CLASSES, 0.0
        for c in d:
            x, u = w["input"][given], h @ w["state"]
            z, r = sigmoid(x[:HIDDEN] + u[:HIDDEN]), sigmoid((x + u)[HIDDEN : 2 * HIDDEN])
            fresh = np.tanh(x[2 * HIDDEN :] + r * u[2 * HIDDEN :])
            h = (1 - z) * fresh + z * h
            logits = h @ w["output"] + w["bias"]
            total += (logits[c] - np.log(np.exp(logits).sum())) / np.log(10)
            given = c
        assert math.isclose(score, total, rel_tol=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in fresh_weights(2).items()}
    given = rng.integers(0, CLASSES + 1, (6, 4))
    target, real = rng.integers(0, CLASSES, (6, 4)), rng.random((6, 4)) < 0.8
    state = rng.normal(size=(4, HIDDEN))
    g, _, _ = gradients(w, given, target, real, state)
    for k, v in w.items():
        for place in [tuple(rng.integers(0, s) for s in v.shape) for _ in range(12)] + [tuple(np.unravel_index(np.abs(g[k]).argmax(), v.shape))]:
            old, losses = v[place], []
            for step in (1e-3, -1e-3):
                v[place] = old + step
                losses.append(gradients(w, given, target, real, state)[2] / real.sum())
            v[place] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - g[k][place]) < 2e-4


def test_words_of_a_class_share_probability_one():
    tokens = np.zeros(gru_lm.BANDS, dtype=np.int64)
    counts = np.array([1, 1, 1, 2, 3, 5, 6, 900])
    hashes = np.arange(1, 9, dtype=np.uint64)
    for c in counts[:-1]:
        tokens[gru_lm._band(np.array([c]))[0]] += c
    vocabulary = Vocabulary(919, 8, hashes[-1:], counts[-1:], tokens, 0.4)
    kind, inner = vocabulary.classes(np.append(hashes, np.uint64(99)), np.append(counts, 0))
    for k in np.unique(kind):
        assert math.isclose((10.0 ** inner[kind == k]).sum(), 1.0)
    assert kind[7] == gru_lm.BANDS and kind[8] == 0


@pytest.mark.parametrize("rows", [[], [(1, "all held out", "", 0)]])
def test_without_training_documents(spark, rows):
    got = document_scores(spark.createDataFrame(rows, SCHEMA), held_out=F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * len(rows)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)


def _word_trees():
    """Trees over words of two buckets with two frequent ones left out, and what each word needs."""
    counts = np.array([1] * 5 + [2, 3, 3, 5, 6, 7, 7, 900, 20, 21, 22, 30] + [1] * 3 + [17, 16, 950])
    bucket, top = np.arange(len(counts)) % 2, counts > 100
    part, rank = gru_lm._part(counts), np.zeros(len(counts), dtype=np.int64)
    held = np.zeros((2, gru_lm.BANDS * gru_lm.PARTS), dtype=np.int64)
    for b in range(2):
        rank[bucket == b] = gru_lm._ranks(part[bucket == b])
        held[b] = np.bincount(part[bucket == b], minlength=held.shape[1])
    before = np.cumsum(held, axis=0) - held
    gone = np.sort((part << 40 | (before[bucket, part] + rank))[top])
    words, tokens = (np.bincount(part[~top], weights=v, minlength=held.shape[1]).astype(np.int64) for v in (None, counts[~top]))
    trees = gru_lm.Trees(tokens, words, before, gone, 0.4)
    return trees, counts[~top], part[~top], trees.places(bucket[~top], part[~top], rank[~top])


def test_words_of_a_class_share_probability_one_in_every_state():
    trees, counts, part, place = _word_trees()
    n = len(counts)
    assert len({*zip(part, place)}) == n
    seen, part, place = np.append(np.ones(n, bool), False), np.append(part, 0), np.append(place, 0)
    decisions = trees.decisions(np.zeros(n + 1, bool), seen, part, place)
    rng, shares = np.random.default_rng(4), []
    w = fresh_weights() | {"nodes": rng.normal(size=(gru_lm.NODE_ROWS, HIDDEN + 1)).astype(np.float32)}
    for state in (np.zeros(HIDDEN), rng.normal(size=HIDDEN), rng.normal(size=HIDDEN)):
        found = decisions.of(np.arange(n + 1), np.ones(n + 1, bool))
        odds = gru_lm.branches(w, np.tile(state, (n + 1, 1)), found)[0]
        shares.append(np.exp(-np.bincount(found[0], weights=np.logaddexp(0, np.where(found[2], -odds, odds)), minlength=n + 1)))
        for band in np.unique(part // gru_lm.PARTS):
            assert math.isclose(shares[-1][part // gru_lm.PARTS == band].sum(), 1.0, rel_tol=1e-5)
    assert abs(shares[1] - shares[2]).max() > 0.05


def test_gradients_of_words_match_differences():
    rng = np.random.default_rng(1)
    trees, counts, part, place = _word_trees()
    n = len(counts)
    decisions = trees.decisions(np.zeros(n, bool), np.ones(n, bool), part, place)
    w = {k: v.astype(np.float64) for k, v in fresh_weights(2).items()}
    w["nodes"] = rng.normal(size=w["nodes"].shape)
    real, rows = rng.random((6, 4)) < 0.8, rng.integers(0, gru_lm.WORD_ROWS, (6, 4, 2))
    args = (rng.integers(0, CLASSES + 1, (6, 4)), rng.integers(0, CLASSES, (6, 4)), real, rng.normal(size=(4, HIDDEN)),
            rows, decisions.of(rng.integers(0, n, 24), real.ravel()))
    g = gradients(w, *args)[0]
    for k in w:
        for flat in np.argsort(-np.abs(g[k]).ravel())[:8]:
            place = np.unravel_index(flat, g[k].shape)
            old, losses = w[k][place], []
            for step in (1e-3, -1e-3):
                w[k][place] = old + step
                losses.append(gradients(w, *args)[2] / real.sum())
            w[k][place] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - g[k][place]) < 2e-4


def test_learning_tells_words_of_a_class_apart():
    """Pairs of equally frequent words of one class: the second of a pair becomes likely after the first."""
    rng = np.random.default_rng(3)
    n, part = 16, np.full(16, 3 * gru_lm.PARTS)
    words = np.zeros(gru_lm.BANDS * gru_lm.PARTS, dtype=np.int64)
    words[part[0]] = n
    trees = gru_lm.Trees(words * 8, words, np.zeros((1, len(words)), dtype=np.int64), np.zeros(0, dtype=np.int64), 0.0)
    decisions = trees.decisions(np.zeros(n, bool), np.ones(n, bool), part, np.arange(n))
    rows = gru_lm._rows_of_words(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.ones(n, bool))

    def streams(pairs):
        docs = [np.array([w for p in rng.permutation(8) for w in pairs[p]]) for _ in range(2000)]
        lengths, flat = np.full(len(docs), 16), np.concatenate(docs)
        return Streams(np.full(len(flat), 3), np.cumsum(lengths) - lengths, lengths, flat, rows, decisions)

    whole, dealt = [(p, 8 + p) for p in range(8)], [(p, 8 + (p + 1) % 8) for p in range(8)]
    w = fresh_weights()
    for _ in range(8):
        w = gru_lm.learn(w, streams(whole))
    good, bad = (log10_likelihoods(w, streams(p), 2000).mean() for p in (whole, dealt))
    assert good > bad + 1


def test_scores_depend_on_which_words_of_a_class_follow(spark):
    """Words of one count and a class that they share, whole pairs against pairs dealt anew."""
    rng = random.Random(5)
    texts = [" ".join(f"{a}{k}" for k in rng.sample(range(8), 8) for a in ("left", "right")) for _ in range(300)]
    left, right = texts[0].split()[::2], texts[0].split()[1::2]
    bad = " ".join(f"{a} {b}" for a, b in zip(left, right[1:] + right[:1]))
    # 64 more words take the classes of their own, so that the pairs share one class
    often = [" ".join(f"often{k}" for k in range(64)) for _ in range(400)]
    rows = [(i, t, "", 0) for i, t in enumerate([texts[0], bad, *texts, *often])]
    got = {r.doc_id: r.score for r in document_scores(
        spark.createDataFrame(rows, SCHEMA).coalesce(2), held_out=F.col("doc_id") < 2).collect()}
    assert abs(got[0] - got[1]) > 1e-3


def test_chunks_are_read_where_they_lie(spark):
    """Scoring moves no chunk again: what is stored once is what the rounds and the scores read."""
    got = document_scores(spark.createDataFrame([(d, t, "", 0) for d, t in corpus(40)], SCHEMA).repartition(3))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_stored_in_less_than_their_text(spark):
    rng = random.Random(6)
    texts = [" ".join(f"word{int(rng.paretovariate(1))}" for _ in range(2000)) for _ in range(30)]
    got = document_scores(spark.createDataFrame([(d, t, "", 0) for d, t in enumerate(texts)], SCHEMA).coalesce(1))
    stored = sum(os.path.getsize(urllib.parse.urlparse(f).path) for f in got.inputFiles())
    assert got.count() == 30 and stored < sum(map(len, texts)) / 2


def test_streams_hold_each_token_once():
    lengths = np.array([50_000, 1, 7, 30, 2, 2])
    streams = Streams(np.arange(lengths.sum()) % CLASSES, np.cumsum(lengths) - lengths, lengths)
    assert streams.target.size == lengths.sum()
    seen = np.concatenate([doc[real] for _, _, doc, real, *_ in streams.windows(16)])
    assert np.bincount(seen).tolist() == lengths.tolist()


def test_scores_do_not_depend_on_the_number_of_streams():
    rng = np.random.default_rng(7)
    lengths = rng.integers(1, 60, 40)
    classes, starts, w = rng.integers(0, CLASSES, lengths.sum()), np.cumsum(lengths) - lengths, fresh_weights(5)
    one, many = (log10_likelihoods(w, Streams(classes, starts, lengths, streams=n), 40) for n in (1, 40))
    assert np.allclose(one, many, rtol=1e-5)


def test_word_hashes_are_those_of_their_bytes():
    words = ["", "a", "Wörter", "the" * 9000, "b"]
    for some in (pa.array(words), pa.array(["x", *words, "y"]).slice(1, 5), pa.array(words, pa.large_string()), pa.array([], pa.string())):
        want = [xxhash.xxh64_intdigest(w) for w in words[: len(some)]]
        assert gru_lm._word_hashes(some).tolist() == want


def test_neighbouring_batches_share_a_chunk(monkeypatch):
    """Documents stay whole and in order; batches make one chunk while they fit its bytes."""
    monkeypatch.setattr(gru_lm, "CHUNK_BYTES", 10_000)
    texts = ["w " * n for n in (1, 900, 20, 1500, 2000, 300, 9000, 40, 0)]
    batches = [pa.RecordBatch.from_pydict({"_text": [t]}) for t in texts]
    joined = list(gru_lm._joined(iter(batches)))
    assert [t for b in joined for t in b.column("_text").to_pylist()] == texts
    assert [b.num_rows for b in joined] == [6, 1, 2]
    assert list(gru_lm._joined(iter([]))) == []


def test_windows_hold_few_branches_beyond_those_of_their_words():
    rng = np.random.default_rng(8)
    size = np.minimum(rng.integers(1, 25, 5000), rng.integers(1, 25, 5000)).astype(np.int8)
    size[:500] = 0
    wide = np.arange(24) < size[:, None]
    decisions = gru_lm.Decisions(size, np.where(wide, 2 * rng.integers(0, gru_lm.NODE_ROWS, wide.shape), 1).astype(np.int16),
                                 np.where(wide, 0, gru_lm.CERTAIN).astype(np.float32))
    words, real = rng.integers(0, 5000, 4096), rng.random(4096) < 0.9
    token, row, right, prior, *_ = decisions.of(words, real)
    own = prior < gru_lm.CERTAIN
    assert np.bincount(token[own], minlength=4096).tolist() == np.where(real, size[words], 0).tolist()
    assert right[~own].all() and len(token) < 1.5 * own.sum()


def test_scoring_takes_few_windows_for_a_long_document():
    lengths = np.array([60_000, *[5] * 2000])
    streams = Streams(np.zeros(lengths.sum(), np.int64), np.cumsum(lengths) - lengths, lengths, streams=gru_lm.SCORED_STREAMS)
    windows = list(streams.windows(1, gru_lm.SCORED_TOKENS))
    assert len(windows) < 20 and max(real.size for _, _, _, real, *_ in windows) <= gru_lm.SCORED_TOKENS
    assert np.bincount(np.concatenate([doc[real] for _, _, doc, real, *_ in windows])).tolist() == lengths.tolist()
