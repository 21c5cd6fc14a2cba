"""The jobs of the lake. ``*_rows`` functions build a DataFrame; ``run_*`` functions
read, build and write."""

from lakestrata.plans.raw import enriched_rows, run_enrichment, run_landing
from lakestrata.plans.refined import (
    run_series,
    run_unified_movies,
    series_rows,
    unified_movies_from_documents,
    unified_movies_rows,
)
from lakestrata.plans.trusted import (
    run_documents,
    run_local,
    trusted_document_rows,
    trusted_local_rows,
)
from lakestrata.plans.upkeep import UnifiedMovies

__all__ = [
    "UnifiedMovies",
    "enriched_rows",
    "run_documents",
    "run_enrichment",
    "run_landing",
    "run_local",
    "run_series",
    "run_unified_movies",
    "series_rows",
    "trusted_document_rows",
    "trusted_local_rows",
    "unified_movies_from_documents",
    "unified_movies_rows",
]
