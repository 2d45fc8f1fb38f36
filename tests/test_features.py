import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.functions import columns as C
from epochloom.operators import features as FE
from epochloom.operators import metrics as ME
from epochloom.operators import spatial as SP
from epochloom.operators import split as SL


def test_dotted_names(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`C3..` double, `Cz.` double")
    assert C.without_dots(df).first().asDict() == {"C3": 1.0, "Cz": 2.0}
    with pytest.raises(ValueError, match="C3"):
        C.without_dots(spark.createDataFrame([(1, 2)], "`C3..` int, C3 int"))


def test_log_compression(spark):
    df = spark.createDataFrame([(100.0,), (-5.0,), (0.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(C.log_compressed(F.col("x"))).collect()]
    assert got[:3] == [2.0, -12.0, -12.0] and math.isnan(got[3]) and got[4] is None


def test_rest_weight_and_defaults(spark):
    df = spark.createDataFrame([("T0",), ("T1",), (None,)], "l string")
    assert [r[0] for r in df.select(C.rest_weight(F.col("l"))).collect()] == [0.5, 1.0, 1.0]
    none = F.lit(None)
    row = spark.range(1).select(*[v.alias(n) for n, v in C.scoring_defaults(none, none, none, {"T0": none}).items()])
    assert tuple(row.first()) == ("?", -1, "?", 0.0)


def test_live_schema(spark, tmp_path):
    assert C.landed_channels(spark, str(tmp_path / "none"))[:3] == ["AF3", "AF4", "AF7"]
    schema = C.live_schema(["C3", "Cz"])
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "some"))
    assert C.landed_channels(spark, str(tmp_path / "some")) == ["C3", "Cz"]
    assert schema["epoch_id"].dataType.simpleString() == "bigint"


FEATURES = "subject_id string, epoch_id int, task_label string, x double, y double, z double"


def test_zscore_edges(spark):
    nan = float("nan")
    rows = [("A", 0, "T0", 1.0, 5.0, 1.0), ("A", 1, "T1", 3.0, 5.0, nan), ("A", 2, "T1", 5.0, 5.0, 3.0),
            ("B", 0, "T1", 9.0, 2.0, None), (None, 0, "T1", 1.0, 1.0, 1.0), (None, 1, "T1", 3.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, FEATURES)
    got = {(r.subject_id, r.epoch_id): r for r in FE.zscore_by_subject(df).collect()}
    assert len(got) == len(rows)
    assert [got[("A", i)].x for i in range(3)] == [-1.0, 0.0, 1.0]
    assert [got[("A", i)].y for i in range(3)] == [0.0, 0.0, 0.0]  # constant feature
    assert tuple(got[("B", 0)])[3:] == (0.0, 0.0, None)  # single row
    assert math.isnan(got[("A", 1)].z) and got[("A", 0)].z == pytest.approx(-1 / math.sqrt(2))
    assert got[(None, 1)].x == pytest.approx(1 / math.sqrt(2))


def test_dirty_epochs_are_counted(spark):
    rows = [(0, 0.0, 1.0), (0, 0.1, None), (0, 0.2, float("nan")), (1, 0.0, 1.0), (1, 0.1, 2.0)]
    df = spark.createDataFrame(rows, "epoch_id int, time double, C3 double").withColumn("task_label", F.lit("T1"))
    got = FE.epoch_features(df, ["C3"], keys=["epoch_id"], quality=True).orderBy("epoch_id").collect()
    assert [r.n_bad for r in got] == [2, 0] and math.isnan(got[0].C3_gamma)


def test_balanced_weights_sum_alike(spark):
    df = spark.createDataFrame([("A",)] * 6 + [("B",)] * 3 + [("C",)] * 1, "task_label string")
    sums = {r.task_label: r.w for r in
            FE.balanced_weights(df).groupBy("task_label").agg(F.sum("weight").alias("w")).collect()}
    assert all(value == pytest.approx(10 / 3) for value in sums.values())


def test_class_summaries(spark):
    rows = [("T0", 1.0, 1.0, 0.0), ("T1", 2.0, 4.0, 1.0), ("T1", 4.0, 4.0, 3.0), ("T2", 8.0, 8.0, 5.0), (None, 99.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "task_label string, C3_alpha double, C4_alpha double, diff_alpha double")
    means = {(r.task_label, r.channel): r.power for r in FE.class_band_means(df, ["C3", "C4"], "alpha").collect()}
    assert means[("T1", "C3")] == 3.0 and len(means) == 6
    sides = {r.task_label: (r.band, r.difference) for r in FE.class_lateralization(df, ["alpha"]).collect()}
    assert sides["T1"] == ("Alpha", 2.0)
    difference = {r.name: r.difference for r in FE.class_difference(df, ["C3_alpha"], "T2", "T1").collect()}
    assert difference == {"C3_alpha": 5.0}
    limits = FE.band_ranges(df, ["C3", "C4"], ["alpha"]).first()
    assert (limits.vmin, limits.vmax) == (pytest.approx(1 - 1.4), pytest.approx(8 + 1.4))


def test_value_ranges(spark):
    flat = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", -3.0), ("b", 1.0)], "k string, v double")
    def collect(df):
        return {r.k: (round(r.vmin, 9), round(r.vmax, 9)) for r in df.collect()}
    assert collect(FE.padded_ranges(flat, "v", ["k"]))["a"] == (round(1.8 - 1e-9, 9), round(2.2 + 1e-9, 9))
    assert collect(FE.symmetric_range(flat, "v", ["k"]))["b"] == (-3.3, 3.3)
    assert collect(FE.live_range(flat, "v", ["k"])) == {"a": (1.9, 2.1), "b": (-3.0, 1.0)}


# -- metrics --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def predictions(spark):
    """No T2 is ever predicted, and one prediction is unknown."""
    rows = [("S1", "T0", "T0")] * 5 + [("S1", "T1", "T0")] * 2 + [("S2", "T1", "T1")] * 3 + \
        [("S2", "T2", "T1")] * 2 + [("S3", "T2", "?")]
    return spark.createDataFrame(rows, "subject_id string, task_label string, pred_label string")


def test_confusion_is_complete(predictions):
    cells = {(r.truth, r.predicted): (r.n, r.pct) for r in
             ME.confusion_matrix(predictions, "task_label", "pred_label").collect()}
    assert len(cells) == 9
    assert cells[("T0", "T0")] == (5, 100.0) and cells[("T2", "T2")] == (0, 0.0)
    assert cells[("T1", "T0")] == (2, 40.0)


def test_scores_with_an_absent_class(predictions):
    scores = {r.label: r for r in ME.class_scores(predictions, "task_label", "pred_label").collect()}
    assert (scores["T2"].tp, scores["T2"].fp, scores["T2"].fn) == (0, 0, 3)
    assert (scores["T2"].precision, scores["T2"].recall, scores["T2"].f1) == (0.0, 0.0, 0.0)
    assert scores["T0"].precision == pytest.approx(5 / 7)
    worst = ME.macro_f1(predictions, "task_label", "pred_label").first()
    assert worst.worst_class == "T2" and worst.macro_f1 == pytest.approx(sum(s.f1 for s in scores.values()) / 3)
    weighted = ME.weighted_metrics(predictions, "task_label", "pred_label").first()
    assert weighted.accuracy == pytest.approx(8 / 13) and weighted.recall_weighted == pytest.approx(8 / 13)


def test_subject_tiers(predictions):
    ranked = ME.with_subject_tier(ME.subject_accuracy(predictions, "task_label", "pred_label")).collect()
    assert [(r.subject_id, r.tier) for r in ranked] == [("S1", "high"), ("S2", "high"), ("S3", "poor")]


def test_live_kpis_of_nothing(spark):
    empty = spark.createDataFrame([], "correct long, true_label string, event_time string, epoch_id long")
    row = ME.live_kpis(empty).first()
    assert (row.n_epochs, row.n_correct, row.accuracy, row.last_epoch_id) == (0, 0, 0.0, None)


def test_importance_tiers(spark):
    df = spark.createDataFrame([("a", 0.4), ("b", 0.3), ("c", 0.2), ("d", 0.1), ("e", 0.0)], "feature string, importance double")
    assert [r.tier for r in ME.with_importance_tier(df).orderBy("feature").collect()] == [
        "top", "strong", "fair", "weak", "minor"]


def test_weighted_metrics_count_every_label(spark):
    rows = [("T0", "T0"), ("T1", "T1"), ("T3", "T0"), ("T3", "T1"), (None, "T0")]
    df = spark.createDataFrame(rows, "truth string, predicted string")
    got = ME.weighted_metrics(df, "truth", "predicted").first()
    assert got.accuracy == 0.5 and got.recall_weighted == 0.5 and got.precision_weighted == pytest.approx((1 / 3 + 1 / 2) / 4)
    assert ME.weighted_metrics(df, "truth", "predicted", ("T0", "T1")).first().accuracy == 1.0


# -- split and maps -------------------------------------------------------------------------

def test_split_of_66_subjects(spark, many_partitions):
    df = spark.range(6600).select(F.format_string("S%03d", F.col("id") % 66).alias("subject_id"), "id")
    df = df.union(spark.createDataFrame([(None, -1)], "subject_id string, id long"))
    train, test = SL.train_test(df)
    assert (train.count(), test.count()) == (5100, 1500)
    assert train.agg(F.max("subject_id")).first()[0] == "S050" and test.agg(F.min("subject_id")).first()[0] == "S051"
    counts = {r.is_train: (r.n_rows, r.n_subjects) for r in SL.split_counts(df).collect()}
    assert counts == {True: (5100, 51), False: (1500, 15)}


@pytest.fixture(scope="module")
def sphere(spark):
    rows = []
    for i in range(64):
        z = 1 - (2 * i + 1) / 64
        rows.append((f"E{i}", 0.09 * math.sqrt(1 - z * z) * math.cos(2.4 * i), 0.09 * math.sqrt(1 - z * z) * math.sin(2.4 * i), 0.09 * z))
    return spark.createDataFrame(rows, "name string, x double, y double, z double")


def test_lookup_ignores_case(spark, sphere):
    df = spark.createDataFrame([("e3", 1.0), ("E4", 2.0), ("nowhere", 3.0)], "channel string, v double")
    assert {r.channel for r in SP.electrode_lookup(df, sphere).collect()} == {"E3", "E4"}
    powers = SP.electrode_powers(sphere, df, "v").collect()
    assert len(powers) == 64 and {r.name: r.v for r in powers}["E4"] == 2.0
    assert sum(r.v is None for r in powers) == 62


def test_listed_sites(spark):
    montage = spark.createDataFrame([("fcz", 1.0), ("CZ", 2.0), ("Nz", 3.0)], "name string, x double")
    assert {r.name for r in SP.scalp_sites(montage).collect()} == {"FCZ", "CZ"}


def test_map_without_usable_channels_is_empty(spark, sphere):
    flat = SP.projected(sphere)
    nothing = sphere.select(F.lit("k").alias("k"), "name", F.lit(None).cast("double").alias("value"))
    some = sphere.select(F.lit("l").alias("k"), "name", F.lit(1.0).alias("value"))
    cells = SP.topomap_grid(flat, nothing.union(some), ["k"], size=9).collect()
    assert len(cells) == 162 and all(c.value is None for c in cells if c.k == "k")
    assert any(c.value == pytest.approx(1.0) for c in cells if c.k == "l")


def test_interpolation_and_fallback(spark, sphere):
    anchors = sphere.where("name in ('E1', 'E20', 'E40')")
    given = anchors.select("name", F.expr("cast(substring(name, 2) as double)").alias("value"))
    values = {r.name: r.value for r in SP.scalp_interpolate(sphere, anchors, given).collect()}
    assert len(values) == 64 and all(1.0 <= v <= 40.0 for v in values.values())
    far = {r.name: r.value for r in SP.scalp_interpolate(sphere, anchors, given, sigma=1e-4).collect()}
    assert far["E20"] == pytest.approx(20.0) and far["E63"] == pytest.approx(61 / 3)


def test_grid(spark, sphere):
    flat = SP.projected(sphere)
    values = sphere.select("name", F.when(F.col("name") == "E5", float("nan")).otherwise(2.5).alias("value"))
    cells = SP.topomap_grid(flat, values, size=21).collect()
    assert len(cells) == 441
    inside = [c.value for c in cells if c.value is not None]
    assert inside and all(v == pytest.approx(2.5) for v in inside)
    assert {(c.gx, c.gy): c.value for c in cells}[(0, 0)] is None


def brute_map(flat, values, size, sigma=0.25, head=0.92):
    """Every cell of one map by the definition."""
    radius = max(1.05 * max(math.hypot(x, y) for x, y in flat.values()), 0.6)
    out = {}
    for gx in range(size):
        for gy in range(size):
            cx, cy = (2 * radius * g / (size - 1) - radius for g in (gx, gy))
            known = [(math.exp(-((cx - flat[n][0]) ** 2 + (cy - flat[n][1]) ** 2) / (2 * sigma**2)), v) for n, v in values if n in flat and v is not None]
            total = sum(w for w, _ in known)
            inside = cx**2 + cy**2 <= (head * radius) ** 2
            out[gx, gy] = sum(w * v for w, v in known) / total if inside and total > 1e-9 else None
    return out


@pytest.mark.parametrize("electrodes, weights", [(500, 1 << 21), (30, 100)])
def test_maps_of_any_number_of_electrodes_equal_brute_force(spark, monkeypatch, electrodes, weights):
    """Many electrodes, maps with different channels missing, repeated rows, and grids in several blocks."""
    monkeypatch.setattr(SP, "WEIGHT_CELLS", weights)
    rng = np.random.default_rng(electrodes)
    flat = {f"E{i}": tuple(map(float, rng.uniform(-0.8, 0.8, 2))) for i in range(electrodes)}
    maps = {k: [(n, None if rng.random() < 0.2 else float(rng.normal())) for n in flat if k % 3 or rng.random() < 0.5] for k in range(7)}
    maps[1].append(maps[1][0])
    maps[2].append(("unknown", 5.0))
    sites = spark.createDataFrame([(n, x, y) for n, (x, y) in flat.items()], "name string, px double, py double")
    rows = spark.createDataFrame([(k, n, v) for k, vs in maps.items() for n, v in vs], "k int, name string, value double")
    got = SP.topomap_grid(sites, rows, ["k"], size=11).collect()
    assert len(got) == 7 * 121
    for r in got:
        want = brute_map(flat, maps[r.k], 11)[r.gx, r.gy] if (r.gx, r.gy) in {(0, 0), (5, 5), (3, 7), (8, 2), (5, 1)} else r.value
        assert (r.value is None) == (want is None) and (want is None or r.value == pytest.approx(want, rel=1e-9))
