"""Resampling of documents towards a target distribution, by importance over hashed word n-grams.

Two passes over the texts. The first interns the n-grams of each batch in an open-addressed table
(``gram_table``) and adds the counts of its slots to a fixed number of buckets; a task leaves one row per
bucket, and the driver gets the sums: as many numbers as there are buckets, at any size of the corpus. The
second pass looks up each slot's gain and gathers the gains of all occurrences of a document. Documents are
then drawn without replacement by the greatest score, weight plus Gumbel noise from a hash of the identifier
(Gumbel top-k), ranked over range partitions, so no task holds all of them.

Behaviour: NULL texts have no words; documents without words have weight 0. A NULL identifier counts as empty
in the hash, and comes first among equal scores. Repeated rows are scored, counted and drawn each. Columns
other than identifier and text are not read. An empty corpus gives an empty result; an empty target has T = 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.gram_table import GramTable, words_of
from epochloom.llm.stages import bounded_batches
from epochloom.llm.word_tokens import slices
from epochloom.operators.ordering import number_rows
from epochloom.shared import materialise

BUCKETS = 10_000
ORDERS = (1, 2, 3)
#: Bytes of text whose grams share a table; a longer single text has one of its own.
TABLE_BYTES = 1 << 20


def _tables(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[pa.RecordBatch, GramTable]]:
    for batch in batches:
        for piece in slices(batch, "_text", TABLE_BYTES):
            yield piece, GramTable(words_of(piece.column("_text")), ORDERS, buckets)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of all n-grams in each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, table in _tables(batches, buckets):
            total += table.bucket_counts(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = texts.select(column(text).alias("_text")).mapInArrow(counted, "bucket long, n long")
    result = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        result[r.bucket] = r.n
    return result


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` for each of the B buckets."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def _weighed(gains: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, table in _tables(batches, len(gains)):
            features, weight = table.gathered(gains)
            n_words = np.bincount(table.words.text, minlength=piece.num_rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), pa.array(n_words), pa.array(features), pa.array(weight)],
                names=["_id", "n_words", "n_features", "weight"],
            )

    return run


def resampled(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 5,
    least_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank.

    Of the N documents with ``least_words`` words, the ``floor(percent * N / 100)`` with the greatest scores
    are drawn and ranked from 1; ``rank`` is NULL for the others.
    """
    bounded_batches(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, text, buckets))
    rows = docs.select(column(doc_id).alias("_id"), column(text).alias("_text"))
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    weighed = rows.mapInArrow(_weighed(gains), schema).withColumn("score", F.col("weight") + noise)
    stored = materialise(weighed.withColumn("eligible", F.col("n_words") >= least_words), "weighed")
    drawn = stored.where("eligible").count() * percent // 100
    place = [F.desc("eligible"), F.desc("score"), "_id"]
    ranked = number_rows(stored, place, name="place")
    rank = F.when(F.col("eligible") & (F.col("place") < drawn), F.col("place") + 1)
    return ranked.select(F.col("_id").alias("doc_id"), "n_words", "n_features", "weight", "score", rank.alias("rank"))
