"""Exact de-duplication by a tree of sorted digest runs.

Each input partition is one run of digests. Runs meet in binomial rounds: in round ``k`` the runs whose
numbers agree above digit ``k`` (base ``FAN_IN``) are exchanged by (digest, common number) and merged, and
each merge keeps the best row of a digest. No key gathers more than ``FAN_IN`` rows at any level but the
first, where a key holds one run's own copies. The answers go down the same tree, so a text that a third
of the rows carry never meets in one task either. All of it is DataFrame operations.

Behaviour: NULL text counts as empty, and all empty texts are one group. NULL identifiers rank after all
others; repeated rows are separate members of their group, of which one is kept. Columns other than the
identifier and the text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.stages import row_key
from epochloom.shared import materialise

FAN_IN = 8
#: The characters that do not count: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
_KEY = ("_sha", "_bytes", "_check")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digest_runs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One short row per document, sorted by digest within its run.

    Texts are one when SHA-256, length and an independent 64-bit hash agree, which verifies a digest
    without moving the text again.
    """
    plain = docs.select(
        column(doc_id).alias("_id"), F.coalesce(column(text), F.lit("")).alias("_text"),
        normalised(column(text)).alias("_plain"),
    )
    return materialise(
        plain.select(
            "_id", F.unhex(F.sha2("_plain", 256)).alias("_sha"), F.octet_length("_plain").alias("_bytes"),
            F.xxhash64("_plain").alias("_check"), F.char_length("_text").alias("_points"),
            row_key(F.col("_id"), F.col("_text")).alias("row_key"), F.spark_partition_id().alias("_run"), F.monotonically_increasing_id().alias("_row"),
        ).sortWithinPartitions("_sha"),
        "digest-runs",
    )


def _merged(rows: DataFrame, run: Column) -> DataFrame:
    return rows.groupBy(*_KEY, run.alias("_run")).agg(
        F.min("_best").alias("_best"), F.sum("_rows").alias("_rows")
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256, row_key.

    The row with the most code points, then the smallest identifier, is the one kept.
    """
    runs = digest_runs(docs, doc_id, text)
    rounds, left = 0, (runs.agg(F.max("_run")).first()[0] or 0) + 1
    while left > 1:
        rounds, left = rounds + 1, -(-left // FAN_IN)
    rank = F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), F.col("_id").alias("id"),
                    F.col("_row").alias("r"))
    members = runs.select(*_KEY, "_run", rank.alias("_best"), F.lit(1).cast("long").alias("_rows"))
    levels = [_merged(members, F.col("_run"))]
    for _ in range(rounds):
        levels.append(materialise(_merged(levels[-1], F.floor(F.col("_run") / FAN_IN).cast("int")), "digest-merge"))
    answer = levels.pop()
    while levels:
        above = F.floor(F.col("_run") / FAN_IN).cast("int")
        below = levels.pop().select(*_KEY, F.col("_run").alias("_own"), above.alias("_run"))
        answer = below.join(answer, [*_KEY, "_run"]).select(*_KEY, F.col("_own").alias("_run"), "_best", "_rows")
    return runs.join(answer, [*_KEY, "_run"]).select(
        F.col("_id").alias("doc_id"), F.col("_best.id").alias("keep_id"), F.col("_rows").alias("group_size"),
        (F.col("_row") == F.col("_best.r")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"),
        "row_key",
    )
