"""Small documents with the difficult cases, and exact forms of what operators compute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


def rows_of(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
