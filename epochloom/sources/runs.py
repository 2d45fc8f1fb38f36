"""Experiment runs: an append-only table of parameters and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochloom.operators.ordering import number_rows

RUN_METRICS = ("test_accuracy", "test_f1", "test_precision_weighted", "test_recall_weighted")


def run_record(
    metrics: DataFrame, run_id: Column, start_time: Column, params: dict[str, Column],
    parent_run_id: Column | None = None, prefix: str = "test_",
) -> DataFrame:
    """Run rows from metric columns; every column of ``metrics`` that is a double is a metric."""
    values = [name for name, kind in metrics.dtypes if kind == "double"]
    pairs = [item for name in values for item in (F.lit(prefix + name), F.col(name))]
    settings = [item for name, value in params.items() for item in (F.lit(name), value.cast("string"))]
    parent = F.lit(None) if parent_run_id is None else parent_run_id
    return metrics.select(
        run_id.cast("string").alias("run_id"), parent.cast("string").alias("parent_run_id"),
        start_time.cast("timestamp").alias("start_time"),
        F.create_map(*settings).alias("params"), F.create_map(*pairs).alias("metrics"),
    )


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def compare_runs(runs: DataFrame, metrics: Sequence[str] = RUN_METRICS) -> DataFrame:
    """``(step, run_id, metric, value)`` of top-level runs that have every metric, oldest first."""
    complete = F.col("parent_run_id").isNull()
    for name in metrics:
        complete = complete & F.col("metrics")[name].isNotNull()
    kept = runs.where(complete).select(
        "run_id", "start_time", *[F.col("metrics")[name].alias(name) for name in metrics]
    )
    steps = number_rows(kept, ["start_time", "run_id"], (), "step")
    return steps.unpivot(["step", "run_id"], list(metrics), "metric", "value")
