import random

from pyspark.sql import functions as F
import pytest

from epochloom.operators import epochs as EP
from epochloom.operators.intervals import label_by_interval


def test_time_epochs_keep_a_partial_tail(spark):
    df = spark.createDataFrame([(0.0,), (1.99,), (2.0,), (3.5,), (4.0,)], "time double")
    assert [r.epoch_id for r in EP.epochs_by_time(df).orderBy("time").collect()] == [0, 0, 1, 1, 2]


def test_count_epochs_drop_an_incomplete_tail(spark, many_partitions):
    rows = [(s, "R1", float(i), s * 1000 + i) for s, n in ((1, 2000), (2, 7), (3, 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "subject_id int, run_id string, time double, id int").repartition(8)
    got = EP.epochs_by_count(df, ["time", "id"], samples=10).collect()
    assert len(got) == 2020
    assert all(r.epoch_id == int(r.time) // 10 for r in got)
    assert {r.subject_id for r in got} == {1, 3}


def test_labels(spark):
    rows = [("e", float(i), label) for i, label in enumerate([None, "T2", "T1", "T1", "T2", None, None, None])]
    df = spark.createDataFrame(rows, "k string, time double, task_label string").repartition(4)
    row = df.groupBy("k").agg(
        EP.first_label("task_label", ["time"]).alias("first"), EP.majority_label("task_label").alias("most")
    ).first()
    assert (row["first"], row["most"]) == ("T2", "T1")


def test_long_epochs_come_in_ordered_segments(spark, many_partitions):
    rows = [("S1", "R1", 0, float(i), float(i)) for i in range(95)] + [("S1", "R1", 1, 0.5, None), ("S1", "R1", 1, 0.1, 7.0)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "subject_id string, run_id string, epoch_id int, time double, C3 double").repartition(8)
    got = EP.epoch_signals(df, ["C3"], max_samples=20).orderBy("epoch_id", "segment").collect()
    assert [r.n_samples for r in got] == [20, 20, 20, 20, 15, 2]
    assert [s["C3"] for r in got[:5] for s in r.samples] == [float(i) for i in range(95)]
    assert [s["C3"] for s in got[5].samples] == [7.0, None]


def test_event_times_and_loop_replay(spark):
    df = spark.range(4).select(F.lit("S1").alias("subject_id"), F.col("id").alias("epoch_id"))
    timed = EP.event_times(df, F.lit("2026-01-01 00:00:00").cast("timestamp")).orderBy("epoch_id").collect()
    assert str(timed[3].event_time) == "2026-01-01 00:00:06"
    played = EP.loop_replay(df, ["epoch_id"], ["subject_id"], rate=0.5, duration=20).orderBy("replay_no").collect()
    assert [(r.replay_no, r.epoch_id) for r in played] == [(i, i % 4) for i in range(10)]
    short = EP.loop_replay(df, ["epoch_id"], ["subject_id"], rate=0.5, duration=4).collect()
    assert sorted(r.epoch_id for r in short) == [0, 1]


SAMPLES = "subject_id string, run_id string, time double"
NOTES = "subject_id string, run_id string, onset double, duration double, description string, ann_idx long"


def test_overlapping_annotations(spark):
    samples = spark.createDataFrame([("S1", "R1", float(t)) for t in range(10)] + [("S2", "R1", 1.0)], SAMPLES)
    notes = spark.createDataFrame(
        [("S1", "R1", 0.0, 4.0, "T1", 0), ("S1", "R1", 2.0, 4.0, "T2", 1), ("S1", "R1", 8.0, 1.0, "T1", 2),
         ("S1", "R1", 3.0, 0.0, "empty", 9)], NOTES,
    )
    got = {(r.subject_id, r.time): r.task_label for r in label_by_interval(samples, notes).collect()}
    want = ["T1", "T1", "T2", "T2", "T2", "T2", "T0", "T0", "T1", "T0"]
    assert [got[("S1", float(t))] for t in range(10)] == want
    assert got[("S2", 1.0)] == "T0"


def test_no_annotations_at_all(spark):
    samples = spark.createDataFrame([("S1", "R1", 1.0)], SAMPLES)
    assert label_by_interval(samples, spark.createDataFrame([], NOTES)).first().task_label == "T0"


@pytest.mark.parametrize("seed, bin_intervals", [(1, 1), (2, 3), (2, 1000), (3, 10)])
def test_intervals_match_brute_force(spark, many_partitions, seed, bin_intervals):
    """From one bin to about one for each interval, with one key that owns most samples and intervals."""
    rng = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b"]
    notes = [
        (rng.choice(keys), "R1", float(rng.randint(0, 60)), float(rng.choice([0, 1, 2, 5, 30])), f"L{i}", i)
        for i in range(80)
    ]
    samples = [(rng.choice(keys), "R1", rng.randint(0, 200) / 2, i) for i in range(1500)]
    # Ranks need not follow the onsets.
    ranks = list(range(80))
    rng.shuffle(ranks)
    notes = [(*n[:5], rank) for n, rank in zip(notes, ranks)]
    got = label_by_interval(
        spark.createDataFrame(samples, SAMPLES + ", id int").repartition(8),
        spark.createDataFrame(notes, NOTES).repartition(8), bin_intervals=bin_intervals,
    ).collect()
    assert len(got) == len(samples)
    labels = {r.id: r.task_label for r in got}
    for key, run, time, i in samples:
        covering = [n for n in notes if n[0] == key and n[2] <= time < n[2] + n[3]]
        assert labels[i] == (max(covering, key=lambda n: n[5])[4] if covering else "T0")


def test_interval_labels_keep_names_and_missing_values(spark):
    """Columns named like the internal ones, NULL keys and times, and labels that are replaced."""
    samples = spark.createDataFrame(
        [("S1", "R1", 1.0, "x", 7, 8), (None, "R1", 1.0, "x", 7, 8), ("S1", "R1", None, "x", 7, 8)],
        SAMPLES + ", task_label string, ibin int, k0 int",
    )
    notes = spark.createDataFrame([("S1", "R1", 0.0, 2.0, "T1", 0), (None, "R1", 0.0, 2.0, "T2", 1)], NOTES)
    got = label_by_interval(samples, notes)
    assert got.columns == ["subject_id", "run_id", "time", "ibin", "k0", "task_label"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        ("S1", "R1", 1.0, 7, 8, "T1"), (None, "R1", 1.0, 7, 8, "T0"), ("S1", "R1", None, 7, 8, "T0"),
    ]))
