"""The queries of this folder over the given tables."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import tune

from . import html_text, merkle, packing, quality, token_files, toxicity, warc
from .decontaminate import find_leaks
from .fingerprints import fingerprints
from .hard_negatives import hard_negatives
from .license_scan import scan_licenses
from .line_dedup import dedup_lines
from .near_dedup import NearDuplicates
from .oracle import ORACLE
from .shared import in_fold, work_dir

__all__ = ["ORACLE", "QUERIES"]

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    """The place of the public vocabulary; every machine has the same package."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = warc.write_archives(pages, work_dir(spark, "warc"))
    return warc.read_archives(index).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), 4096, end_id=1)


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(shingle=3, share=(85, 100)).groups(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    listed = token_files.write_ids(docs, token_files.new_folder(spark), vocabulary(), end_id=2)
    return token_files.read_ids(listed)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    return hard_negatives(
        table(spark, sf_dir, "embeddings"),
        is_anchor=F.col("vec_id") % 100 == 0,
        label=F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return merkle.manifest(docs, in_fold(F.col("doc_id"), 5, 0), lowered)


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_license_scan": op5_license_scan,
    "op6_decontamination": op6_decontamination,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_spot_signatures": op8_spot_signatures,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_token_files": op10_token_files,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_html_text": op13_html_text,
}
