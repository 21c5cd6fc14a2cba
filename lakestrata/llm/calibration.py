"""Isotonic calibration from counts by score, so that its input stays small."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 2000


def isotonic_points(scored: DataFrame) -> tuple[list[float], list[float]]:
    """The steps of the calibration: scores, ascending, and the share of label 1 there.

    ``scored`` has ``score`` and ``label``. Scores are counted in at most
    ``BINS`` + 1 bins of equal width between 0 and 1 (outer ones fall into the last).
    No rows give the identity.
    """
    held = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    bins = scored.groupBy((F.round(held * BINS) / BINS).alias("at")).agg(
        F.avg("label").alias("label"), F.count("*").cast("double").alias("weight")
    )
    rows = bins.collect()
    if not rows:
        return [0.0, 1.0], [0.0, 1.0]
    small = scored.sparkSession.createDataFrame(
        [(r["at"], r["label"], r["weight"]) for r in rows], "at double, label double, weight double"
    ).coalesce(1)
    model = IsotonicRegression(featuresCol="at", labelCol="label", weightCol="weight").fit(small)
    return [float(x) for x in model.boundaries], [float(x) for x in model.predictions]
