import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.functions.columns import feature_columns
from epochloom.operators import model as MO
from epochloom.operators.features import with_rest_weight
from epochloom.shared import shared_path


@pytest.fixture(scope="module")
def features(spark):
    """T0 is the rarest class, so a frequency-ordered index would not start with it."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        label = "T0" if i % 8 == 0 else ("T1" if i % 2 else "T2")
        level = {"T0": 0.0, "T1": 4.0, "T2": 8.0}[label]
        rows.append((f"S{i % 12:02d}", "R1", i, label, float(level + rng.normal()), float(abs(rng.normal()))))
    df = spark.createDataFrame(rows, "subject_id string, run_id string, epoch_id int, task_label string, good double, noise double")
    return with_rest_weight(df).persist()


@pytest.fixture(scope="module")
def tuned(features):
    return MO.tune_forest(MO.forest_pipeline(["good", "noise"]), features, [5], [2, 4], folds=3)


def test_labels_do_not_depend_on_frequency(tuned, features):
    assert MO.model_labels(tuned) == ["T0", "T1", "T2"]
    predictions, metrics = MO.evaluate(tuned, features)
    assert metrics.first().accuracy > 0.8
    rows = predictions.collect()
    assert len(rows) == 240
    for r in rows:
        assert r.proba_T0 + r.proba_T1 + r.proba_T2 == pytest.approx(1.0)
        best = max((r.proba_T0, "T0"), (r.proba_T1, "T1"), (r.proba_T2, "T2"))[0]
        assert best == pytest.approx(r[f"proba_{r.pred_label}"])
        assert r.correct == int(r.pred_label == r.task_label)


def test_grid_and_importances(spark, tuned):
    assert MO.grid_scores(spark, tuned).count() == 2
    ranked = MO.feature_importances(spark, tuned, ["good", "noise"]).collect()
    assert ranked[0].feature == "good" and sum(r.importance for r in ranked) == pytest.approx(1.0)


@pytest.mark.parametrize("subjects", [3, 4])
def test_every_fold_has_subjects(features, subjects):
    few = features.where(F.col("subject_id").isin(*[f"S{i:02d}" for i in range(subjects)]))
    model = MO.tune_forest(MO.forest_pipeline(["good", "noise"]), few, [2], [2], folds=3)
    assert len(model.avgMetrics) == 1


def test_live_features_that_are_missing_are_not_scored(spark, features):
    model = MO.fit_live(features.drop("weight"), ["good", "noise"], trees=3, depth=2)
    df = spark.createDataFrame([(1, "T1", None, 1.0), (2, "T1", 4.0, 1.0)], "epoch_id int, task_label string, good double, noise double")
    rows = {r.epoch_id: r for r in MO.score(model, df).collect()}
    assert (rows[1].pred_label, rows[1].proba_T1) == ("?", 0.0) and rows[2].pred_label != "?"


def test_unscorable_and_unknown_rows(spark, tuned):
    df = spark.createDataFrame(
        [("S1", "R1", 1, "T1", float("nan"), 1.0), ("S1", "R1", 2, "T9", 4.0, 1.0)],
        "subject_id string, run_id string, epoch_id int, task_label string, good double, noise double",
    )
    rows = {r.epoch_id: r for r in MO.score(tuned, df.withColumn("weight", F.lit(1.0))).collect()}
    assert (rows[1].pred_label, rows[1].proba_T0, rows[1].correct) == ("?", 0.0, 0)
    assert rows[2].pred_label in ("T0", "T1", "T2") and rows[2].correct == 0


def test_live_model_roundtrip(spark, features):
    path = shared_path(spark, "model")
    fits = []

    def fit():
        fits.append(1)
        return MO.fit_live(features.drop("weight"), ["good", "noise"], trees=5, depth=4)

    first, second = MO.load_or_fit(spark, path, fit), MO.load_or_fit(spark, path, fit)
    assert len(fits) == 1
    a = MO.score(first, features.drop("weight")).select("epoch_id", "pred_label").orderBy("epoch_id").collect()
    b = MO.score(second, features.drop("weight")).select("epoch_id", "pred_label").orderBy("epoch_id").collect()
    assert a == b
    assert feature_columns(features) == ["good", "noise"]


def test_rows_that_cannot_be_learned_from_are_counted(spark, features, tmp_path):
    broken = features.withColumn("good", F.when(F.col("epoch_id") == 7, float("nan")).when(F.col("epoch_id") != 9, F.col("good")))
    broken = broken.withColumn("task_label", F.when(F.col("epoch_id") != 11, F.col("task_label")))
    model = MO.tune_forest(MO.forest_pipeline(["good", "noise"]), broken, [3], [2, 3], folds=3)
    assert model.left_out == 3 and MO.fit_live(broken.drop("weight"), ["good", "noise"], trees=3, depth=2).left_out == 3
    model.write().overwrite().save(str(tmp_path / "model"))
    again = MO.CrossValidatorModel.load(str(tmp_path / "model"))
    assert again.avgMetrics == model.avgMetrics and MO.model_labels(again) == ["T0", "T1", "T2"]
    same = [m.transform(features).select("epoch_id", "prediction").collect() for m in (model, again)]
    assert sorted(same[0]) == sorted(same[1])
