"""The unified movies table built one operator after the other.

This is the plain form: lists are collected per batch, joined, un-nested and
cleaned of duplicates step by step. The refined plan must give the same rows;
tests compare the two, and ``bench.py`` times this form as the baseline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakestrata import operators as op
from lakestrata.schemas import REFINED_UNUSED

ORIGIN = "company_origin_country"


def _add_values(rows: DataFrame, batches: Sequence[DataFrame], value: str) -> DataFrame:
    lists = op.union_batches([op.collect_distinct(b, "imdb_id", value, "found") for b in batches])
    joined = op.distinct_rows(op.attach(rows, lists, "imdb_id", "found"))
    return op.distinct_rows(op.explode_list(joined, "found", value))


def unified_movies_stepwise(local: DataFrame, batches: Sequence[DataFrame]) -> DataFrame:
    """Same rows as ``unified_movies_rows(.., origin_per_batch=True)``."""
    rows = _add_values(op.drop_fields(local, REFINED_UNUSED), batches, "company_name")
    for number, batch in enumerate(batches, start=1):
        origins = op.rename_fields(batch, {ORIGIN: f"{ORIGIN}_{number}"})
        rows = op.distinct_rows(op.attach(rows, origins, "company_name", f"{ORIGIN}_{number}"))
    return op.to_int_columns(_add_values(rows, batches, "production_country_name"), "runtime")
