import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.llm.quality import STATISTICS, fit_quality, isotonic, quality_scores, statistics

SCHEMA = "doc_id long, text string, score string, _y int"


def corpus(n=400):
    rng = random.Random(1)
    words = ["the", "of", "reading", "river", "and", "stone,", "light", "moves.", "was", "evening"]
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = " ".join(rng.choice(words) if good else rng.choice(["###", "A1!!", "zz%%"]) for _ in range(rng.randint(5, 60)))
        rows.append((i, text, "x", 0))
        labels.append((i, int(good), None))
    return rows, labels


def test_held_out_labels_are_predicted(spark):
    rows, labels = corpus()
    rows += [(1000, None, "x", 0), (1001, "", "x", 0), (1002, "w" * 300_000, "x", 0), (None, "the of", "x", 0), (5, "again", "x", 0)]
    labels += [(1000, None, None), (9999, 1, None), (3, 0, None)]
    held = F.pmod(F.col("doc_id"), F.lit(4)) == 1
    got = quality_scores(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, text string"), held_out=held
    ).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    truth = {d: q for d, q, _ in labels[:400]}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]) > 0.97


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus(120)
    docs = spark.createDataFrame(rows, SCHEMA)
    learn = F.col("doc_id") % 3 != 1
    flipped = [(d, 1 - q if d % 3 == 1 else q, x) for d, q, x in labels]
    a, b = (fit_quality(docs, spark.createDataFrame(x, "doc_id long, quality int, text string"), learn=learn) for x in (labels, flipped))
    assert np.allclose(a.weights, b.weights) and np.allclose(a.levels, b.levels)


@pytest.mark.parametrize("labels", [[], [(1, None)]])
def test_without_labels_every_score_is_a_half(spark, labels):
    docs = spark.createDataFrame([(1, "a", "x", 0)], SCHEMA)
    got = quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert [r.score for r in got] == [0.5]


def test_empty_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_scores(empty, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_one_class_of_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x", 0) for i in range(30)], SCHEMA)
    got = quality_scores(docs, spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")).collect()
    assert all(r.predicted == 1 for r in got)


def test_statistics_have_names():
    assert len(statistics("Some text, here.\nSome text, here.")) == len(STATISTICS) == len(statistics(None))


def test_isotonic_matches_brute_force():
    rng = np.random.default_rng(2)
    n, ones = np.ones(30), rng.integers(0, 2, 30).astype(float)
    _, levels = isotonic(np.arange(30.0), n, ones)
    want = {max(min(ones[a : b + 1].mean() for b in range(i, 30)) for a in range(i + 1)) for i in range(30)}
    assert np.allclose(sorted(want), levels)
