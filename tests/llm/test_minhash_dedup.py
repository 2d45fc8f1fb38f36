import random
import re

import numpy as np
import pyarrow as pa
import pytest

from epochloom.llm import minhash_dedup
from epochloom.llm.minhash_dedup import SLOTS, near_documents, shingle_sets, superminhash

SCHEMA = "doc_id long, text string, rep int, _set string"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k=4, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    label = [i for i, _ in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {r[0]: (len(s), c) for r, s, c in zip(rows, sets, label)}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size in (3, 4, 8, 20, 60, 200):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for changes in [0, 0, 1, 1, 2, 3, 4, 5, 6, 8] * 3:
            words = list(base)
            for _ in range(changes):
                words[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append(" ".join(words).title() if changes == 3 else "\t".join(words))
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts += [" ".join(passage + [rng.choice(vocabulary) for _ in range(25)]) for _ in range(40)]
    texts += ["", None, " \n", "one", "One", "x" * 100_000, "word " * 30_000, "a\x1cb c d e", "Ä b c d", "ä b c d"]
    rng.shuffle(texts)
    return list(zip(rng.sample(range(10_000), len(texts)), texts))


@pytest.mark.parametrize("seed, rows_each", [(0, 2048), (1, 8)])
def test_components_match_brute_force(spark, monkeypatch, seed, rows_each):
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", rows_each)
    monkeypatch.setattr(minhash_dedup, "CLUSTER_ROWS", rows_each)
    monkeypatch.setattr(minhash_dedup, "PIVOT_ROWS", rows_each)
    rows = corpus(seed)
    got = near_documents(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA).repartition(6), words_each=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_repeated_and_missing_identifiers(spark):
    rows = [(1, "a b c d e f", 0, ""), (1, "a b c d e f", 0, ""), (None, "a b c d e f", 0, ""), (2, "A b c d e f", 0, ""), (2, "other words", 0, "")]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_documents(spark.createDataFrame(rows, SCHEMA), words_each=4).collect())
    assert got == sorted([(0, 3, None), (1, 3, 1), (1, 3, 1), (2, 3, 1), (2, 1, 2)], key=lambda r: r[:2])


def test_empty_table(spark):
    assert near_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_superminhash(elements, slots):
    """One element and one slot at a time, with the whole permutation."""
    out = [None] * slots
    for e in elements:
        order = list(range(slots))
        for step in range(slots):
            draw = int(minhash_dedup._mixed(np.array([(e + (step + 1) * 0x9E3779B97F4A7C15) % 2**64], dtype=np.uint64))[0])
            jump = step + ((draw & 0xFFFF) * (slots - step) >> 16)
            order[step], order[jump] = order[jump], order[step]
            rank = step << 48 | draw >> 16
            slot = order[step]
            out[slot] = rank if out[slot] is None else min(out[slot], rank)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 40, 300])
def test_signatures_follow_the_definition(n):
    elements = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    got = superminhash(np.concatenate([elements, elements[:1]]), np.array([n, 0, 1]), 50)
    assert got[0].tolist() == plain_superminhash(elements.tolist(), 50)
    assert (got[1] == minhash_dedup._UNSET).all() and got[2].tolist() == plain_superminhash(elements[:1].tolist(), 50)


def test_estimates_are_close():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(40):
        x = rng.integers(0, 2**64, 300, dtype=np.uint64)
        a, b = x[:240], x[60:]  # similarity 0.6
        s = superminhash(np.concatenate([a, b]), np.array([240, 240]))
        errors.append((s[0] == s[1]).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < np.sqrt(0.24 / SLOTS) * 1.1


def test_sets_of_sliced_arrays():
    found, counts = shingle_sets(pa.array(["x", "a b c", None, " a  B c d "]).slice(1), 3)
    assert counts.tolist() == [1, 0, 2] and found[0] in found[1:].tolist()


def test_lower_similarities_are_refused(spark):
    with pytest.raises(ValueError, match="more bands"):
        near_documents(spark.createDataFrame([], "doc_id long, text string"), percent=60)
