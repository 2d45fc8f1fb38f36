"""The whole way: recordings, landing, features, training, evaluation, export, live scoring."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.__main__ import parser
from epochloom.plans import jobs
from epochloom.sources.edf_write import encode_recording

RATE, SECONDS = 160, 24
CHANNELS = ("C3..", "Cz..", "C4..", "Oz..")


def recording(seed):
    """T1 shows as 10 Hz on the left, T2 on the right, T0 as noise."""
    rng = np.random.default_rng(seed)
    time = np.arange(RATE * SECONDS) / RATE
    signals = {name: rng.normal(0, 5, time.size) for name in CHANNELS}
    notes = [(at, 4, ("T0", "T1", "T2")[(at // 4) % 3]) for at in range(0, SECONDS, 4)]
    for onset, length, label in notes:
        part = slice(onset * RATE, (onset + length) * RATE)
        side = {"T1": "C3..", "T2": "C4.."}.get(label)
        if side:
            signals[side][part] += 40 * np.sin(2 * np.pi * 10 * time[part])
    return encode_recording(signals, RATE, {n: (-200, 200) for n in signals}, notes, unit="uV")


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    path = tmp_path_factory.mktemp("job")
    for s in range(1, 6):
        folder = path / "edf" / f"S{s:03d}"
        folder.mkdir(parents=True)
        for r in (3, 4):
            (folder / f"S{s:03d}R{r:02d}.edf").write_bytes(recording(s * 100 + r))
    return path


def test_the_whole_way(spark, root):
    at = {n: str(root / n) for n in (
        "edf", "landed", "features", "model", "metrics", "runs", "importances", "predictions", "eval", "export",
        "live", "out", "check", "live-model")}
    tally = {r.status: r.n for r in jobs.ingest(spark, at["edf"], at["landed"], at["metrics"]).collect()}
    assert tally == {"converted": 10, "skipped": 0, "errors": 0, "truncated": 0}
    tally = {r.status: r.n for r in jobs.ingest(spark, at["edf"], at["landed"]).collect()}
    assert tally == {"converted": 0, "skipped": 10, "errors": 0, "truncated": 0}

    assert jobs.features(spark, at["landed"], at["features"]) == {"epochs": 120, "features": 16}
    scores = jobs.train(spark, at["features"], at["model"], at["metrics"], at["runs"], at["importances"],
                        trees=[5], depths=[3, 4]).first()
    assert scores.accuracy > 0.9
    line = json.loads(next((root / "metrics").glob("*.json")).read_text())
    assert line["accuracy"] == pytest.approx(scores.accuracy)
    run = spark.read.parquet(at["runs"]).first()
    assert run.params["train_subjects"] == "3" and run.params["n_features"] == "16"
    assert run.metrics["test_accuracy"] == pytest.approx(scores.accuracy)
    assert spark.read.parquet(at["importances"]).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)

    again = jobs.evaluate(spark, at["features"], at["model"], at["predictions"], at["eval"]).first()
    assert again.accuracy == pytest.approx(scores.accuracy)
    predictions = spark.read.parquet(at["predictions"])
    assert predictions.columns == ["subject_id", "task_label", "prediction"] and predictions.count() == 48

    jobs.export(spark, at["landed"], at["features"], at["predictions"], at["export"])
    sample = spark.read.parquet(f"{at['export']}/signal_sample")
    assert sample.columns == ["time", "Cz", "task_label"] and sample.count() == 3200

    jobs.replay(spark, at["landed"], at["live"], "S002", "R04", "2026-01-01 00:00:00", rate=1, duration=15,
                loop=True, files=3)
    stats = jobs.stream(spark, at["live"], at["out"], at["check"], at["landed"], at["live-model"], once=True,
                        trees=10, depth=5)
    assert stats["channels"] == 4 and stats["batches"] >= 1
    scored = spark.read.parquet(f"{at['out']}/predictions").orderBy("epoch_id").collect()
    assert [r.epoch_id for r in scored] == list(range(15))
    assert [r.event_time[17:19] for r in scored] == [f"{2 * i:02d}" for i in range(15)]
    assert sum(r.correct for r in scored) >= 13 and all(r.run_seq == -1 for r in scored)
    assert spark.read.parquet(f"{at['out']}/topomap").count() == 60


def test_command_line():
    options = parser().parse_args(["train", "--features", "f", "--model", "m", "--metrics", "j", "--trees", "5,10"])
    assert options.trees == [5, 10] and options.folds == 3
    assert parser().parse_args(["stream", "--source", "a", "--out", "b", "--checkpoint", "c", "--landed", "d",
                                "--model", "e", "--once"]).once
