"""Quality classifier: kernel ridge regression on document statistics, then isotonic calibration.

Each text becomes a few dozen statistics of its bytes, words and lines. Random Fourier features of the
standardised statistics approximate a Gaussian kernel; every partition sums its part of the normal
equations, and the driver solves the sum, whose size depends on ``FEATURES`` alone. A part of the labelled
rows is kept out of the fit and calibrates the scores: pooled adjacent violators over ``BINS`` score bins.
Scoring is one pass over the texts, without a shuffle.

Behaviour: NULL text counts as empty, and empty texts get a score like any other. Labels that are NULL or
belong to no document are not used; repeated labels count each. Without usable labels every score is 0.5.
A row for which ``held_out`` is NULL, as for a NULL identifier, is not held out; it belongs to no label.
Only identifier and text of a document are read; labels, language, source and identifier are no inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.stages import bounded_batches
from epochloom.shared import materialise

FEATURES = 256
RIDGE = 1e-4
BINS = 500
#: Tasks that sum the normal equations; each sends one (FEATURES + 1) squared matrix to the driver.
SUMMING_TASKS = 32

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LOWER = (_CODES >= 97) & (_CODES <= 122)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_BLANK = (_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13))
_WIDE = _CODES >= 128
_PROSE = np.isin(_CODES, list(b".,;:!?'\"-()"))
_OTHER = ~(_UPPER | _LOWER | _DIGIT | _BLANK | _WIDE | _PROSE)
_LETTERS = bytes(c for c in range(256) if _UPPER[c] or _LOWER[c] or _WIDE[c])
_CAPITALS = frozenset(range(65, 91))


def statistics(text: str | None) -> list[float]:
    """Fixed-length description of a whole text; all zero for an empty one."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = byte / len(raw)
    positive = share[share > 0]
    n, lengths, tally = len(words), list(map(len, words)), Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    common = [count for _, count in tally.most_common(10)]
    letters = byte[_UPPER].sum() + byte[_LOWER].sum()
    return [
        np.log1p(len(raw)), np.log1p(n), len(raw) / n, share[_UPPER | _LOWER].sum(),
        byte[_UPPER].sum() / max(1, letters), share[_DIGIT].sum(), share[_BLANK].sum(), share[_PROSE].sum(),
        share[_OTHER].sum(), share[_OTHER | _PROSE].max(), share[_WIDE].sum(), float(-(positive * np.log(positive)).sum()),
        np.log1p(len(tally)) / np.log1p(n), sum(map(eq, words, words[1:])) / n, common[0] / n, sum(common) / n,
        len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)), sum(x <= 3 for x in lengths) / n,
        sum(not w.strip(b".,;:!?'\"-()").isalpha() for w in words if w.isascii()) / n,
        sum(w[0] in _CAPITALS for w in words) / n,
    ]


#: Names of what ``statistics`` returns.
STATISTICS = (
    "log_bytes", "log_words", "bytes_per_word", "letters", "capitals", "digits", "blanks", "prose_marks",
    "other_marks", "commonest_mark", "wide_bytes", "byte_entropy", "distinct_words", "doubled_words", "commonest_word",
    "ten_commonest_words", "distinct_lines", "line_length", "short_words", "words_with_marks", "capitalised_words",
)


@dataclass(frozen=True)
class QualityModel:
    """Everything a task needs to score a text; a few hundred kilobytes."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        stats = np.array([statistics(t) for t in texts])
        return pd.Series(np.interp(self.raw(stats), self.knots, self.levels))


def scored(model: QualityModel, text: Column) -> Column:
    """Score of each text: 0 to 1, higher where label 1 is likelier."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return model.score(texts)

    return score(text)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = np.array([statistics(t.as_py()) for t in batch.column("_text")]).reshape(batch.num_rows, len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), *[pa.array(stats[:, i]) for i in range(len(STATISTICS))]], names=["_id", *STATISTICS]
        )


def isotonic(score: np.ndarray, rows: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the non-decreasing fit; bins come in ascending order of score."""
    blocks: list[list[float]] = []  # sum of score times rows, rows, ones
    for s, n, y in zip(score, rows, ones):
        blocks.append([s * n, n, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 1], table[:, 2] / table[:, 1]


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    learn: Column | None = None, seed: int = 7,
) -> QualityModel | None:
    """Model of ``label`` from the labelled documents for which ``learn``, a column over ``doc_id``, holds."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(column(doc_id).alias("_id"), column(text).alias("_text"))
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in STATISTICS)
    known = labels.where(column(label).isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.select(column(doc_id).alias("_id"), column(label).cast("double").alias("_y"))
    table = materialise(
        rows.mapInArrow(_described, schema).join(known, "_id")
        .withColumn("_calibrate", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(4)) == 0),
        "labelled-statistics",
    )
    fitted = table.where(~F.col("_calibrate"))
    moments = fitted.agg(
        F.count(F.lit(1)), *[F.avg(n) for n in STATISTICS], *[F.stddev_pop(n) for n in STATISTICS]
    ).first()
    d = len(STATISTICS)
    if not moments[0]:
        return None
    rng = np.random.default_rng(seed)
    spread = np.array(moments[d + 1 :], dtype=float)
    model = QualityModel(
        np.array(moments[1 : d + 1], dtype=float), np.where(spread > 1e-9, spread, 1.0),
        rng.normal(size=(d, FEATURES)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1),
        np.zeros(1), np.zeros(1),
    )

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for frame in frames:
            x = model.features(frame[list(STATISTICS)].to_numpy())
            total += x.T @ np.hstack([x, frame[["_y"]].to_numpy()])
        yield pd.DataFrame({"part": [total.tobytes()]})

    parts = fitted.select(*STATISTICS, "_y").repartition(SUMMING_TASKS).mapInPandas(summed, "part binary").collect()
    total = sum(np.frombuffer(p.part).reshape(FEATURES + 1, FEATURES + 2) for p in parts)
    ridge = RIDGE * moments[0] * np.eye(FEATURES + 1)
    ridge[-1, -1] = 1e-9
    weights = np.linalg.solve(total[:, :-1] + ridge, total[:, -1])
    model = QualityModel(model.mean, model.scale, model.directions, model.phases, weights, model.knots, model.levels)

    @F.pandas_udf("double")
    def raw(*stats: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.column_stack(stats)))

    bins = table.where("_calibrate").select(raw(*STATISTICS).alias("_raw"), "_y").groupBy(
        F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), "_raw")) * (BINS / 2)).alias("_bin")
    ).agg(F.avg("_raw").alias("s"), F.count(F.lit(1)).alias("n"), F.sum("_y").alias("ones")).orderBy("_bin").collect()
    if not bins:  # too few labels to keep some aside
        bins = [pd.Series({"s": x, "n": 1, "ones": x}) for x in (0.0, 1.0)]
    knots, levels = isotonic(*(np.array([float(b[k]) for b in bins]) for k in ("s", "n", "ones")))
    return QualityModel(model.mean, model.scale, model.directions, model.phases, weights, knots, levels)


def quality_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    held_out: Column | None = None, threshold: float = 0.5,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; rows with ``held_out`` teach nothing."""
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    model = fit_quality(docs, labels, doc_id, text, label, ~held)
    score = F.lit(0.5) if model is None else scored(model, column(text))
    return docs.select(column(doc_id).alias("doc_id"), held.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
