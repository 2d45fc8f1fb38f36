"""A corpus made ready for training: five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and is written as Parquet
and read again by the next. All but the last return the columns of ``documents``. What a stage stores besides
its decisions is removed before it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochloom.llm.exact_dedup import exact_groups
from epochloom.llm.minhash_dedup import near_documents
from epochloom.llm.packing import packed_pieces
from epochloom.llm.quality import fit_quality, scored
from epochloom.llm.queries import WORD_BPE
from epochloom.llm.stages import kept_documents
from epochloom.llm.suffix_dedup import without_repeats
from epochloom.shared import materialise, scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by all labels, does not reject."""
    with scratch(spark):
        model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs if model is None else docs.where(scored(model, F.col("text")) >= 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    with scratch(spark) as keep:
        decisions = keep(exact_groups(docs).select("row_key", "kept"), "decisions")
    return kept_documents(docs, decisions)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    with scratch(spark) as keep:
        decisions = keep(near_documents(docs, words_each=5, percent=80).select("row_key", "kept"), "decisions")
    return kept_documents(docs, decisions)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the stretches of 200 bytes or more that occur again; ``n_chars`` follows.

    A document of which nothing but white space is left goes. One that was blank before stays as it is.
    """
    blank = F.length(F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", ""))) == 0
    marked = docs.withColumn("_blank", blank)
    cut = without_repeats(marked).where(~blank | F.col("_blank")).drop("_blank")
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens, with their token ids."""
    return packed_pieces(docs, WORD_BPE)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("minhash dedup", minhash_dedup),
    ("suffix dedup", suffix_dedup),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, from the documents table; without the token ids."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = materialise(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir).drop("ids")


#: A fitted classifier has no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None
