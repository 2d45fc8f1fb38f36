"""Steps that several stages of a pipeline share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epochloom.functions.columns import column


def row_key(doc_id: Column, text: Column) -> Column:
    """Name of a row by its content, the same at every scan; NULL text counts as empty."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def kept_documents(docs: DataFrame, decisions: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose decision (row_key, kept) says so.

    Rows alike in identifier and text share a key; as many of them stay as have been kept. One shuffle of
    the texts serves the join and the numbering.
    """
    kept = decisions.where("kept").groupBy(F.col("row_key").alias("_key")).agg(F.count(F.lit(1)).alias("_times"))
    joined = docs.withColumn("_key", row_key(column(doc_id), column(text))).join(kept, "_key")
    place = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return joined.withColumn("_place", place).where("_place <= _times").select(*[column(c) for c in docs.columns])


#: Bytes that Spark hands to a Python task at a time.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Limit what a Python task holds of its input, however long the texts are, for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def discard(stored: DataFrame) -> None:
    """Remove the files of a table made by ``materialise`` that nothing reads any more."""
    spark = stored.sparkSession
    files = stored.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
