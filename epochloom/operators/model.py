"""Random-forest training, tuning, scoring and importances with MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.constants import CLASSES, LOG_FLOOR, SEED
from epochloom.functions.columns import agrees, decoded, scoring_defaults
from epochloom.operators.features import balanced_weights
from epochloom.operators.metrics import weighted_metrics
from epochloom.operators.ordering import number_rows
from epochloom.shared import materialise, path_exists

FOLD = "_fold"


def _indexer(label: str) -> StringIndexer:
    # Alphabetical order makes the index independent of class frequencies.
    return StringIndexer(
        inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"
    )


def forest_pipeline(
    features: Sequence[str], label: str = "task_label", seed: int = SEED,
    trees: int = 20, depth: int = 5,
) -> Pipeline:
    """Label index, feature vector and weighted random forest."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", seed=seed,
        minInstancesPerNode=2, numTrees=trees, maxDepth=depth,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[_indexer(label), assembler, forest])


def _complete(df: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Rows that can be learned from, and a count of the ``rows`` seen and those ``left_out`` when they are read."""
    seen, whole = Observation(), F.lit(True)
    for field in (df.schema[name] for name in needed):
        whole = whole & F.col(f"`{field.name}`").isNotNull()
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            whole = whole & ~F.isnan(F.col(f"`{field.name}`"))
    counted = df.withColumn("_whole", whole).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_whole")).alias("left_out")
    )
    return counted.where("_whole").drop("_whole"), seen


def tune_forest(
    pipeline: Pipeline, train: DataFrame, trees: Sequence[int] = (50, 100),
    depths: Sequence[int] = (5, 10), folds: int = 3, seed: int = SEED,
    subject: str = "subject_id", parallelism: int = 4,
) -> CrossValidatorModel:
    """Grid search on accuracy; a subject's epochs stay in one fold. The best model is refitted.

    Label index and feature vector are fitted and stored once, with the fold as a column; the ``folds * grid``
    fits are of the forest alone. The best model is the whole pipeline again. Rows with a NULL or NaN feature or
    without a label are not learned from; ``left_out`` of the result says how many.
    """
    *prepare, forest = pipeline.getStages()
    usable, seen = _complete(train, [*prepare[1].getInputCols(), prepare[0].getInputCol()])
    # subjects in a fixed random order take the folds in turn, so no fold is empty
    numbered = number_rows(
        usable.select(F.col(subject).alias("_subject")).distinct().withColumn("_turn", F.xxhash64("_subject")),
        ["_turn", "_subject"], (), "_no",
    ).select("_subject", (F.col("_no") % folds).cast("int").alias(FOLD))
    fitted = Pipeline(stages=prepare).fit(usable)
    folded = usable.join(numbered, usable[subject].eqNullSafe(F.col("_subject")))
    vectors = materialise(fitted.transform(folded).select("label", "features", forest.getWeightCol(), FOLD), "training-vectors")
    grid = ParamGridBuilder().addGrid(forest.numTrees, list(trees)).addGrid(forest.maxDepth, list(depths))
    search = CrossValidator(
        estimator=forest, estimatorParamMaps=grid.build(), numFolds=folds, foldCol=FOLD, seed=seed,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        parallelism=parallelism, collectSubModels=False,
    )
    model = search.fit(vectors)
    model.bestModel = PipelineModel([*fitted.stages, model.bestModel])
    model.left_out = seen.get["left_out"]
    return model


def grid_scores(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """Mean cross-validated accuracy of each grid point; one row per point of the small grid."""
    rows = [
        (*[next(v for p, v in point.items() if p.name == name) for name in ("numTrees", "maxDepth")], float(score))
        for point, score in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]
    return spark.createDataFrame(rows, "num_trees int, max_depth int, avg_accuracy double")


def live_pipeline(
    features: Sequence[str], label: str = "task_label", trees: int = 300, depth: int = 18,
    seed: int = SEED,
) -> Pipeline:
    """log10 with a floor, standard scaling and a forest on class-balanced weights."""
    # A NULL stays NULL, as in ``functions.columns.log_compressed``: greatest() alone would skip it.
    logs = ", ".join(
        f"CASE WHEN `{name}` IS NOT NULL THEN log10(greatest(`{name}`, {LOG_FLOOR!r}D)) END AS `log_{name}`"
        for name in features
    )
    stages = [
        _indexer(label),
        SQLTransformer(statement=f"SELECT *, {logs} FROM __THIS__"),
        VectorAssembler(inputCols=[f"log_{name}" for name in features], outputCol="raw",
                        handleInvalid="keep"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees,
            maxDepth=depth, seed=seed,
        ),
    ]
    return Pipeline(stages=stages)


def fit_live(
    train: DataFrame, features: Sequence[str], label: str = "task_label", **forest
) -> PipelineModel:
    """Rows with a NULL or NaN feature or without a label cannot be learned from; ``left_out`` says how many."""
    usable, seen = _complete(train, [label, *features])
    model = live_pipeline(features, label, **forest).fit(balanced_weights(usable, label))
    model.left_out = seen.get["left_out"]
    return model


def load_or_fit(spark: SparkSession, path: str, fit) -> PipelineModel:
    """The stored model at ``path``; fitted and stored first where there is none."""
    if not path_exists(spark, f"{path}/metadata"):
        fit().write().overwrite().save(path)
    return PipelineModel.load(path)


def model_labels(model) -> list[str]:
    """Class labels in index order."""
    fitted = model.bestModel if isinstance(model, CrossValidatorModel) else model
    return list(fitted.stages[0].labels)


def score(
    model, df: DataFrame, label: str = "task_label", classes: Sequence[str] = CLASSES
) -> DataFrame:
    """Predicted label, one probability per class and the 0/1 agreement with ``label``.

    ``df`` may be a stream. Classes the model never saw have probability 0.0. A row with a NULL
    or NaN feature cannot be scored: its label is "?" and its probabilities are 0.0.
    """
    labels = model_labels(model)
    scored = model.transform(df)
    scorable = ~F.exists(vector_to_array("features"), F.isnan)
    chance = F.when(scorable, vector_to_array("probability"))
    probabilities = {
        name: chance[labels.index(name)] if name in labels else F.lit(0.0) for name in classes
    }
    run_id = F.col("run_id") if "run_id" in df.columns else F.lit(None).cast("string")
    run_seq = F.col("run_seq") if "run_seq" in df.columns else F.lit(None).cast("long")
    predicted = F.when(scorable, decoded(F.col("prediction"), labels))
    filled = scoring_defaults(run_id, run_seq, predicted, probabilities)
    kept = [name for name in df.columns if name not in filled]
    out = scored.select(*[F.col(f"`{n}`") for n in kept], "prediction",
                        *[value.alias(name) for name, value in filled.items()])
    return out.withColumn("correct", agrees(F.col("pred_label"), F.col(label)))


def evaluate(
    model, test: DataFrame, label: str = "task_label", classes: Sequence[str] = CLASSES
) -> tuple[DataFrame, DataFrame]:
    """Predictions and their accuracy, F1, precision and recall (one confusion count)."""
    predictions = score(model, test, label, classes)
    return predictions, weighted_metrics(predictions, label, "pred_label")


def feature_importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """``(feature, importance)``, most important first; one row per model input."""
    fitted = model.bestModel if isinstance(model, CrossValidatorModel) else model
    values = fitted.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )
