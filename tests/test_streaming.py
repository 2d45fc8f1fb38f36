import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.functions.columns import agrees, landed_channels, live_schema
from epochloom.shared import shared_path
from epochloom.streaming import live

CHANNELS = ["C3", "Cz", "C4"]


@pytest.fixture(scope="module")
def landed(spark):
    """Two recordings share epoch ids; 3 epochs of 32 samples each."""
    rng = np.random.default_rng(0)
    rows = [
        (s, "R1", i / 16, "T1", e, "T1" if e else "T2", f"2026-01-01T00:00:0{e}", e, *map(float, rng.standard_normal(3)))
        for s in ("S1", "S2") for e in range(3) for i in range(e * 32, e * 32 + 32)
    ]
    path = shared_path(spark, "in")
    live.replay(spark.createDataFrame(rows, live_schema(CHANNELS)), CHANNELS, path, files=3)
    return path


def scorer(wide):
    guess = F.when(F.col("diff_alpha") > 0, "T1").otherwise("T2")
    chances = {f"proba_{c}": F.lit(0.0) for c in ("T0", "T1", "T2")}
    return wide.withColumns({"pred_label": guess, **chances, "correct": agrees(guess, F.col("true_label"))})


def process(samples):
    return live.scored_epochs(samples, None, CHANNELS, fs=16 * 10, scorer=scorer)


OUTPUTS = {"predictions": live.predictions_of, "topomap": live.topomap_of}


def test_dual_sink(spark, landed):
    assert landed_channels(spark, landed) == CHANNELS
    out, check = shared_path(spark, "out"), shared_path(spark, "check")
    def start():
        stream = live.sample_stream(spark, landed, live_schema(CHANNELS), 1)
        return live.run_available(live.batch_sink(stream, process, OUTPUTS, out, check))
    query = start()
    stats = live.run_statistics(query)
    assert (stats["batches"], stats["rows_read"]) == (3, 192) and stats["milliseconds"] > 0
    predictions = spark.read.parquet(f"{out}/predictions")
    assert predictions.columns == [
        "event_time", "epoch_id", "subject_id", "run_id", "run_seq", "true_label", "pred_label",
        "proba_T0", "proba_T1", "proba_T2", "correct", "query_id", "batch_id"]
    assert predictions.count() == 6 and predictions.select("subject_id", "epoch_id").distinct().count() == 6
    topomap = spark.read.parquet(f"{out}/topomap")
    assert topomap.count() == 18 and topomap.where("alpha_power < 0").isEmpty()
    start()  # nothing new has landed
    assert spark.read.parquet(f"{out}/predictions").count() == 6


def test_a_repeated_batch_leaves_no_duplicates(spark, landed, tmp_path):
    """A batch whose commit was lost runs again under the same query."""
    out, check = shared_path(spark, "out"), str(tmp_path / "check")
    for _ in range(2):
        stream = live.sample_stream(spark, landed, live_schema(CHANNELS), 1)
        live.run_available(live.batch_sink(stream, process, OUTPUTS, out, check))
        for commit in (tmp_path / "check" / "commits").glob("*2*"):
            commit.unlink()
    assert spark.read.parquet(f"{out}/predictions").count() == 6


def test_a_batch_is_read_whole_or_not_at_all(spark, landed):
    """The sink dies between its two writes: the reader shows nothing of that batch until it has run again."""
    out, check = shared_path(spark, "out"), shared_path(spark, "check")
    calls = {"topomap": 0}

    def failing(scored):
        calls["topomap"] += 1
        if calls["topomap"] == 2:
            raise OSError("the sink dies")
        return live.topomap_of(scored)

    def start(outputs):
        stream = live.sample_stream(spark, landed, live_schema(CHANNELS), 1)
        return live.run_available(live.batch_sink(stream, process, outputs, out, check))

    with pytest.raises(Exception, match="the sink dies"):
        start(OUTPUTS | {"topomap": failing})
    assert spark.read.parquet(f"{out}/predictions").select("batch_id").distinct().count() == 2
    assert [r.batch_id for r in live.committed(spark, out, "predictions").select("batch_id").distinct().collect()] == [0]
    assert {r.batch_id for r in live.committed(spark, out, "topomap").select("batch_id").collect()} == {0}
    start(OUTPUTS)
    assert live.committed(spark, out, "predictions").count() == 6 and live.committed(spark, out, "topomap").count() == 18


def test_statistics_of_a_bounded_run(spark, landed):
    """Rows observed in the stream, epochs written, and time per trigger and epoch, with a processing-time trigger."""
    out, check = shared_path(spark, "out"), shared_path(spark, "check")
    stream = live.observed(live.sample_stream(spark, landed, live_schema(CHANNELS), 1))
    stats = live.run_live(live.batch_sink(stream, process, OUTPUTS, out, check), 120, "counted", "100 milliseconds", until=3)
    assert (stats["batches"], stats["rows"], stats["rows_read"], stats["epochs"]) == (3, 192, 192, 6)
    assert stats["milliseconds_per_epoch"] == pytest.approx(stats["milliseconds"] / 6)
    assert stats["milliseconds_per_trigger"] == pytest.approx(stats["milliseconds"] / 3)


def test_a_new_checkpoint_adds_to_earlier_output(spark, landed):
    out = shared_path(spark, "out")
    for _ in range(2):
        stream = live.sample_stream(spark, landed, live_schema(CHANNELS), 1)
        live.run_available(live.batch_sink(stream, process, OUTPUTS, out, shared_path(spark, "check")))
    predictions = spark.read.parquet(f"{out}/predictions")
    assert predictions.count() == 12 and predictions.select("query_id").distinct().count() == 2


def test_landing_keeps_rows_without_a_time(spark):
    path = shared_path(spark, "timed")
    df = spark.range(100).select("id", F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.col("id"))).alias("ts"))
    live.land_in_order(df, "ts", path)
    assert spark.read.parquet(path).count() == 100
    live.land_in_order(df.where("ts IS NULL"), "ts", path)
    assert spark.read.parquet(path).count() == 120


def test_bounded_run(spark, landed):
    out, check = shared_path(spark, "out"), shared_path(spark, "check")
    stream = live.sample_stream(spark, landed, live_schema(CHANNELS))
    stats = live.run_live(live.table_sink(stream, out, check), 8, "bounded")
    assert stats["timeout_seconds"] == 8 and spark.read.parquet(out).count() == 192
    assert not spark.streams.active


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(600).select(
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("ts"), (F.col("id") % 3).alias("user_id"),
        "id", F.lit(1.0).alias("value"),
    )


def test_windows_wait_for_the_watermark(spark, events):
    path, out, check = (shared_path(spark, n) for n in ("ev", "out", "check"))
    live.land_in_order(events, "ts", path, 5, files=1)
    stream = live.window_epochs(
        live.sample_stream(spark, path, events.schema, 1), "ts", ["user_id"], 3600, "30 minutes",
        [F.count(F.lit(1)).alias("n")],
    )
    live.run_available(live.table_sink(stream, out, check))
    got = {(r.user_id, r.epoch_id): r.n for r in spark.read.parquet(out).collect()}
    last = events.agg(F.max(F.unix_micros("ts"))).first()[0] - 1_800_000_000
    whole = events.groupBy("user_id", F.floor(F.unix_micros("ts") / 3_600_000_000).alias("e")).count().collect()
    assert got == {(r.user_id, r.e): r["count"] for r in whole if (r.e + 1) * 3_600_000_000 <= last}


def test_deduplication(spark, events):
    path, out, check = (shared_path(spark, n) for n in ("ev", "out", "check"))
    live.land_in_order(events.union(events), "ts", path, 3, files=1)
    stream = live.deduplicated(live.sample_stream(spark, path, events.schema, 1), ["id"], "ts", "1 hour")
    live.run_available(live.table_sink(stream, out, check))
    assert spark.read.parquet(out).count() == 600


def test_live_epochs_number_their_samples_once(spark):
    """Labels and rows both read the cut, which is stored; numbering it twice would hold all rows on disk twice."""
    df = spark.range(700).select(
        F.lit("S1").alias("subject_id"), F.lit("R1").alias("run_id"), (F.col("id") / 160).alias("time"),
        F.when(F.col("id") < 500, "T1").otherwise("T2").alias("task_label"), F.col("id").cast("double").alias("C3"),
    )
    epochs = live.live_epochs(df, ["C3"], F.lit("2026-01-01 00:00:00").cast("timestamp"))
    assert "Window" not in epochs._jdf.queryExecution().executedPlan().toString()
    got = epochs.groupBy("epoch_id", "epoch_label", "event_time").agg(F.count(F.lit(1)).alias("n"), F.sum("C3").alias("s")).orderBy("epoch_id").collect()
    assert [tuple(r) for r in got] == [
        (0, "T1", "2026-01-01T00:00:00.000000", 320, 51040.0), (1, "T1", "2026-01-01T00:00:02.000000", 320, 153440.0)]
