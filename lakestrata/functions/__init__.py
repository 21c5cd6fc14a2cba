"""Column expressions. All of them are built-in functions and run in the JVM."""

from lakestrata.functions.dates import date_parts, path_date_parts
from lakestrata.functions.documents import has_fields, schema_key
from lakestrata.functions.values import canonical, to_int

__all__ = ["canonical", "date_parts", "has_fields", "path_date_parts", "schema_key", "to_int"]
