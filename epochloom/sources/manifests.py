"""What still has to be ingested, and how ingestion went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochloom.constants import MOTOR_RUNS
from epochloom.sources.files import list_files

CONVERTED, SKIPPED, FAILED, TRUNCATED = "converted", "skipped", "errors", "truncated"


def recording_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, subject_id, run_id`` of ``<root>/<subject>/<subject><run>.edf`` files.

    Folders are listed in tasks; no file is opened. Files whose name does not repeat their folder are left out.
    """
    files = list_files(spark, root, ".edf")
    parts = F.split("path", "/")
    named = files.select(
        "path", "length",
        F.try_element_at(parts, F.lit(-2)).alias("subject_id"),
        F.regexp_replace(F.element_at(parts, -1), r"\.edf$", "").alias("_stem"),
    )
    return named.where(F.col("_stem").startswith(F.col("subject_id"))).select(
        "path", "length", "subject_id",
        F.expr("substring(_stem, length(subject_id) + 1)").alias("run_id"),
    )


def pending(
    manifest: DataFrame, landed: DataFrame, keys: Sequence[str] = ("subject_id", "run_id"),
    runs: Sequence | None = MOTOR_RUNS, run: str = "run_id",
) -> DataFrame:
    """Listed recordings of the wanted runs that have no landed rows yet."""
    wanted = manifest if runs is None else manifest.where(F.col(run).isin(*runs))
    return wanted.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def missing(remote: DataFrame, landed: DataFrame, key: str = "path", size: str = "length") -> DataFrame:
    """Remote records without a landed file of more than zero bytes."""
    return remote.join(landed.where(F.col(size) > 0).select(key), key, "left_anti")


def outcomes(statuses: DataFrame, status: str = "status") -> DataFrame:
    """Recordings per outcome, with a row for each of the four outcomes.

    A truncated recording lands nothing, so the next ingest takes it up again.
    """
    counts = statuses.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    listed = statuses.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, (CONVERTED, SKIPPED, FAILED, TRUNCATED)))).alias("status")
    )
    return listed.join(counts, "status", "left").select(
        "status", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )
