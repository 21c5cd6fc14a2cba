from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def schema_key(payload: Column | str) -> Column:
    """Sorted top-level keys of a JSON object, as JSON text: ``["id","name"]``.

    JSON rather than a separator keeps ``{"a,b":..}`` and ``{"a":..,"b":..}``
    apart. Null for text that is not an object.
    """
    return F.to_json(F.array_sort(F.array_distinct(F.json_object_keys(payload))))


def has_fields(payload: Column | str) -> Column:
    """True for a JSON object with at least one key; false for all else, null included."""
    return F.coalesce(F.size(F.json_object_keys(payload)) > 0, F.lit(False))
