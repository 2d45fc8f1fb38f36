"""Physical plans: what is read, what moves, and what is computed once."""

import os
import re

import pytest
from pyspark.sql import functions as F

from epochloom.operators import features as FE
from epochloom.operators.epochs import epochs_by_time
from epochloom.operators.intervals import label_by_interval
from epochloom.plans import catalog
from epochloom.functions.columns import without_dots
from epochloom.shared import shared_path
from epochloom.sources import landing

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


def plan(df, mode="formatted"):
    explain = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain)


def tree(df):
    """The operator tree without the details below it."""
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def wide(spark):
    path = shared_path(spark, "wide")
    df = spark.range(640).select(
        F.concat(F.lit("S"), F.col("id") % 2).alias("subject_id"), F.lit("R03").alias("run_id"),
        (F.col("id") / 160).alias("time"), F.lit("T1").alias("task_label"),
        *[F.rand(i).alias(f"{name}..") for i, name in enumerate(("C3", "Cz", "C4", "Oz", "Fz"))],
    )
    landing.write_partitioned(df, path)
    return landing.read_merged(spark, path)


def test_features_read_only_the_motor_channels(wide):
    df = FE.epoch_features(epochs_by_time(without_dots(wide)))
    text = plan(df)
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "C3.." in schema and "Oz" not in schema and "Fz" not in schema
    assert tree(df).count("ArrowEvalPython") == 1
    assert tree(df).count("Exchange") == 1
    assert len(re.findall(r"Functions \[\d+\]: \[.*partial_collect_list", text)) == 1


def test_channel_maps_compute_powers_once(wide):
    df = FE.alpha_by_channel(epochs_by_time(without_dots(wide)), ["C3", "Oz"])
    assert tree(df).count("ArrowEvalPython") == 1


def test_filters_reach_the_partitions(wide):
    text = plan(wide.where("subject_id = 'S1'"))
    assert re.search(r"PartitionFilters: \[.*subject_id.*S1", text)


def test_interval_labels_need_three_exchanges(spark, wide):
    """One path at any size: runs of bins, the bins, and the samples; no broadcast of its own, no pairing."""
    notes = spark.range(5000).select(
        F.lit("S0").alias("subject_id"), F.lit("R03").alias("run_id"), F.col("id").cast("double").alias("onset"),
        F.lit(9.0).alias("duration"), F.lit("T2").alias("description"), F.col("id").alias("ann_idx"),
    )
    text = tree(label_by_interval(wide, notes))
    assert text.count("Exchange hashpartitioning") + len(re.findall(r"\bExchange \(", text)) <= 3
    assert "NestedLoop" not in text and "Cartesian" not in text and "Window" not in text


@needs_tables
@pytest.mark.parametrize("name", [
    "band_power", "class_weight", "decode_labels", "score_flags", "epochs_by_time", "union_batches",
    "clean_columns", "prediction_columns", "lateralization", "log_features",
])
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in tree(catalog.QUERIES[name](spark, SF))


@needs_tables
@pytest.mark.parametrize("name", [
    "confusion_matrix", "class_prf", "weighted_metrics", "kpi_summary", "subject_stats", "epoch_features",
    "topomap_grid", "scalp_interpolate", "interval_label", "zscore_by_subject", "split_train", "ingest_pending",
    "rolling_accuracy", "compare_runs", "loop_replay",
])
def test_no_pairing_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_tables
def test_maps_move_their_values_once(spark):
    df = catalog.QUERIES["topomap_grid"](spark, SF)
    assert len(re.findall(r"Exchange \(\d+\)", tree(df).split("BroadcastExchange")[0])) == 1


@needs_tables
def test_metrics_count_before_they_shuffle(spark):
    text = plan(catalog.QUERIES["weighted_metrics"](spark, SF))
    scan, rest = text.index("Scan parquet"), text.index("Exchange")
    assert "partial_count" in text and scan > 0 and rest > 0
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert set(re.findall(r"(l_\w+):", schema)) == {"l_discount", "l_returnflag"}
