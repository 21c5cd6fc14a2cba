"""Text quality from document statistics: random Fourier features and ridge regression.

Random cosines of the standardised statistics approximate a Gaussian kernel. Every
task sums the normal equations of its rows; the sums are added by row of the matrix, so
what reaches the driver is one matrix, whatever the number of documents. The ridge
scores are calibrated by isotonic regression on rows that the fit has not seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calibration import isotonic_points
from .shared import in_fold, stage, text_of

# Common words of English, German, French and Spanish.
COMMON_WORDS = frozenset(
    "a about after all also an and any are as at be been but by can could do each for from had "
    "has have he her his how i if in into is it its more my no not of on one or other our out "
    "she so some than that the their them then there these they this to up was we were what "
    "when which who will with would you your "
    "auf aus bei das dass dem den der des die ein eine einem einen einer eines er es für hat "
    "ich im ist mit nach nicht noch nur oder sich sie sind so über um und von vor war wie wird zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il ils je la le les leur mais ne nous "
    "ont ou par pas plus pour que qui sa se ses son sont sur un une vous "
    "al como con del el ella ellos esta este ha hay las lo los más muy para pero por se ser si "
    "sin sobre su sus también tiene y ya".split()
)

STATISTICS = [
    "log_chars",
    "log_words",
    "word_length",
    "distinct_words",
    "common_words",
    "upper",
    "digits",
    "marks",
    "symbols",
    "shouts",
    "bars",
    "non_ascii",
    "spaces",
    "line_words",
    "repeated_lines",
    "closed_lines",
    "top_word",
    "sentence_ends",
]

_CLASS = np.zeros(256, dtype=np.int64)
for _i, _chars in enumerate(
    [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"#$%&*@^~<>{}[]\\/+=_`", b"!", b"|", b" \t\n\r\x0b\x0c"],
    start=1,
):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 8


def statistics(text: str) -> list[float]:
    """The document's statistics, in the order of ``STATISTICS``."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(len(raw), 1)
    held = np.bincount(_CLASS[raw], minlength=9) / n
    words = text.split()
    n_words = max(len(words), 1)
    low = list(map(str.lower, words))
    counted = Counter(low)
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(len(lines), 1)
    top = max(counted.values(), default=0) / n_words
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        min(len(text) / n_words, 100.0),
        len(counted) / n_words,
        sum(map(COMMON_WORDS.__contains__, low)) / n_words,
        *held[1:7],
        held[8],
        held[7],
        min(n_words / n_lines, 500.0),
        1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(line.rstrip()[-1] in ".!?\"'" for line in lines) / n_lines,
        top,
        sum(map(text.count, (". ", "? ", "! ", ".\n"))) / n_words,
    ]


def statistics_of(texts: Column) -> Column:
    @F.pandas_udf("array<double>")
    def each(batch: pd.Series) -> pd.Series:
        return batch.map(statistics)

    return each(texts)


@dataclass
class QualityModel:
    """Everything a task needs to score a text; its size is fixed."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: list[float]
    share: list[float]

    def cosines(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6) @ self.directions + self.phases
        return np.hstack([np.cos(z) * math.sqrt(2 / len(self.phases)), np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.cosines(rows) @ self.weights if len(rows) else np.empty(0)

    def calibrated(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(np.clip(self.raw(rows), 0, 1), self.at, self.share)

    def scores(self, texts: Column) -> Column:
        """The probability of label 1 for whole texts, as a column."""

        @F.pandas_udf("double")
        def score(batch: pd.Series) -> pd.Series:
            return pd.Series(self.calibrated(_rows(batch.map(statistics))))

        return score(texts)

    def scores_of_statistics(self, column: Column) -> Column:
        @F.pandas_udf("double")
        def score(batch: pd.Series) -> pd.Series:
            return pd.Series(self.calibrated(_rows(batch)))

        return score(column)


def _rows(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(-1, len(STATISTICS))


def fit(
    labelled: DataFrame, features: int = 384, width: float = 0.35, ridge: float = 1e-4, seed: int = 11
) -> QualityModel:
    """Fits on all rows of ``labelled`` (``statistics array<double>, label double``).

    A fifth of the rows, by a hash of their statistics, is kept for the calibration. With no
    rows every score is 0.5; with one label only, every score is that label.
    """
    p = len(STATISTICS)
    rng = np.random.default_rng(seed)
    model = QualityModel(
        np.zeros(p),
        np.ones(p),
        rng.normal(size=(p, features)) * width,
        rng.uniform(0, 2 * math.pi, features),
        np.zeros(features + 1),
        [0.0, 1.0],
        [0.5, 0.5],
    )
    moments = (
        labelled.select("label", F.posexplode("statistics").alias("i", "x"))
        .groupBy("i")
        .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale"), F.avg("label").alias("y"))
        .collect()
    )
    if not moments:
        return model
    share = moments[0]["y"]
    if share in (0.0, 1.0):
        model.share = [share, share]
        return model
    for r in moments:
        model.mean[r["i"]] = r["mean"]
        model.scale[r["i"]] = max(r["scale"], 1e-6)
    kept = F.pmod(F.xxhash64("statistics"), F.lit(5)) == 0
    equations = normal_equations(labelled.filter(~kept), model)
    gram, right, n = equations
    gram[np.diag_indices(features)] += ridge * max(n, 1)
    gram[features, features] += 1e-9
    model.weights = np.linalg.solve(gram, right)

    @F.pandas_udf("double")
    def raw(batch: pd.Series) -> pd.Series:
        return pd.Series(model.raw(_rows(batch)))

    held = labelled.filter(kept).select(raw("statistics").alias("score"), "label")
    model.at, model.share = isotonic_points(held)
    return model


def normal_equations(labelled: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of outer products of the cosines, of label times cosines, and the number of rows.

    A task returns its sum as rows ``(i, row i of the matrix and of the right side)``.
    """
    size = len(model.phases) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            flat = np.asarray(batch.column("statistics").flatten(), dtype=np.float64)
            z = model.cosines(flat.reshape(-1, len(model.mean)))
            y = np.asarray(batch.column("label"), dtype=np.float64)[:, None]
            total += z.T @ np.hstack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
            ["i", "part"],
        )

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size + 1)
        for part in parts["part"]:
            total += np.frombuffer(part)
        return pd.DataFrame({"i": [key[0]], "part": [total.tobytes()]})

    parts = labelled.select("statistics", "label").mapInArrow(partial, "i int, part binary")
    rows = parts.groupBy("i").applyInPandas(add, "i int, part binary").collect()
    table = np.zeros((size, size + 1))
    for r in rows:
        table[r["i"]] = np.frombuffer(r["part"])
    return table[:, :size].copy(), table[:, size].copy(), int(round(table[size - 1, size - 1]))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2
) -> tuple[QualityModel, DataFrame]:
    """The model, and the stored statistics of all documents (``doc_id, statistics``).

    Learns from labelled rows outside the held-out fold of ``doc_id``. Null labels and
    labels without a document are left out; a document with several labels counts once
    for each. Only slim rows (number and statistics) are shuffled to meet the labels.
    """
    stored = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            statistics_of(text_of()).alias("statistics"),
        ),
        "statistics",
    )
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")
    ).filter(F.col("label").isNotNull() & ~in_fold(F.col("doc_id"), folds, held_out))
    return fit(stored.join(known, "doc_id").select("statistics", "label")), stored


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    folds: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    ``docs`` has ``doc_id`` and ``text`` and ``labels`` has ``doc_id`` and ``quality``; other
    columns are not read. A null text scores like an empty one, a very long one is scored whole;
    a null ``doc_id`` is in no fold. Labels that clash count one by one in the fit. Repeated rows
    stay repeated. No rows give no rows.
    """
    model, stored = train(docs, labels, folds=folds, held_out=held_out)
    return stored.select(
        "doc_id",
        in_fold(F.col("doc_id"), folds, held_out).alias("held_out"),
        model.scores_of_statistics(F.col("statistics")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` at least, with all their columns.

    Null and empty texts score like any text without words, very long ones are scored whole, and
    a null ``doc_id`` is no reason to drop a row. Equal texts have equal scores, so repeated rows
    stay or go together. Columns of any name are kept. No rows give no rows.
    """
    model, _ = train(docs, labels)
    # In a struct no name of the table can clash with a name of this step.
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("whole"))
    scored = rows.select("row", model.scores(F.col("whole")).alias("score"))
    return scored.filter(F.col("score") >= threshold).select("row.*")
