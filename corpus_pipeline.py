"""The corpus pipeline: documents in, packed sequences out, one stage after the other.

Each stage takes the stored result of the one before, and its decisions take effect:
documents of low quality go, repeated chunks of lines are taken out, one document of
each near-duplicate group stays, documents with benchmark items go, and the rest is
packed. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import packing, quality
from lakestrata.llm.decontaminate import drop_leaks
from lakestrata.llm.line_dedup import dedup_lines, drop_passages
from lakestrata.llm.near_dedup import NearDuplicates
from lakestrata.llm.queries import table, vocabulary
from lakestrata.session import stage

# The workers that pack share an executor with all that the stages before have left in its JVM,
# so they remember a third of the words that the operator alone does.
MEMO = 200_000


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages and chunks leave the text; a document of which nothing is left goes."""
    # Lines are read several times; without a stored copy each would cut the passages out again.
    without = stage(drop_passages(docs), "without_passages")
    out = dedup_lines(without, drop_emptied=True, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest number of each near-duplicate group."""
    return NearDuplicates().keep_one(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all remaining documents."""
    return packing.pack(docs, vocabulary(), memo=MEMO)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", remove_repeated_lines),
    ("near-dedup", keep_one_of_each_group),
    ("decontamination", drop_benchmark_items),
    ("best-fit packing", pack_documents),
]

# The classifier and the tokenizer have no SQL form; tests/llm checks run() stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages in turn, each to the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, "pipeline")
    return docs
