import os
import time

import pytest
from pyspark.sql import functions as F

from epochloom.shared import RELEASE, materialise, scratch


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scratch_removes_all_but_what_is_kept(spark):
    outside = materialise(spark.range(3), "outside")
    with scratch(spark) as keep:
        inner = materialise(spark.range(5), "inner")
        gone = folder(inner)
        with scratch(spark) as keep_inside:
            deep = materialise(spark.range(2), "deep")
            for_inner = keep_inside(deep.withColumn("x", F.lit(1)), "for-inner")
            deep_folder = folder(deep)
        assert not os.path.exists(deep_folder) and for_inner.count() == 2
        kept = keep(inner.join(for_inner, "id"), "kept")
        held = folder(for_inner)
    assert not os.path.exists(gone) and not os.path.exists(held)
    assert sorted(r.id for r in kept.collect()) == [0, 1] and outside.count() == 3


def test_scratch_removes_after_an_error(spark):
    with pytest.raises(ValueError):
        with scratch(spark):
            made = folder(materialise(spark.range(5), "inner"))
            raise ValueError
    assert not os.path.exists(made)


def test_shuffles_go_when_a_table_is_written(spark):
    """Without that they stay on disk until the driver happens to collect what refers to them."""
    local = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f for d in local for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    released, before = spark.conf.get(RELEASE), shuffles()
    stored = materialise(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.2)
    assert not left and stored.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(RELEASE) == released
