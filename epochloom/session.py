"""Session settings that the operators are planned for."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """Session on ``SPARK_MASTER`` if that is set, else where ``spark-submit`` says.

    Memory, executors, shuffle partitions and ``spark.checkpoint.dir`` belong to the deployment.
    """
    builder = SparkSession.builder.appName(app_name)
    if os.environ.get("SPARK_MASTER"):
        builder = builder.master(os.environ["SPARK_MASTER"])
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
