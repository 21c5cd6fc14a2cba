"""Steps from DataFrame to DataFrame. None starts a Spark job, except
``number_within`` and what builds on it, which write their ordered input,
``enrich_counted``, which writes the counted keys, and ``distinct_of_few``, which writes hashes."""

from lakestrata.operators.grouping import (
    chunk_copies,
    chunk_within,
    encode_chunks,
    number_within,
    ordered_chunks,
    repeat_copies,
    schema_groups,
    split_copies,
    with_schema_key,
)
from lakestrata.operators.lookup import count_keys, enrich, enrich_counted, enrich_filtered, failed, found, unknown_keys
from lakestrata.operators.merge import (
    attach,
    collect_distinct,
    collect_segments,
    distinct_of_few,
    distinct_rows,
    known_pairs,
    union_batches,
    values_by_batch,
    values_of_batches,
)
from lakestrata.operators.shape import (
    canonicalise,
    canonicalise_from,
    drop_fields,
    keep_equal,
    project_key,
    rename_fields,
    to_int_columns,
)
from lakestrata.operators.unnest import explode_list, explode_structs, explode_text, unnest_lists

__all__ = [
    "attach",
    "canonicalise",
    "canonicalise_from",
    "chunk_copies",
    "chunk_within",
    "collect_distinct",
    "collect_segments",
    "count_keys",
    "distinct_of_few",
    "distinct_rows",
    "drop_fields",
    "encode_chunks",
    "enrich",
    "enrich_counted",
    "enrich_filtered",
    "explode_list",
    "explode_structs",
    "explode_text",
    "failed",
    "found",
    "keep_equal",
    "known_pairs",
    "number_within",
    "ordered_chunks",
    "project_key",
    "rename_fields",
    "repeat_copies",
    "schema_groups",
    "split_copies",
    "to_int_columns",
    "union_batches",
    "unknown_keys",
    "unnest_lists",
    "values_by_batch",
    "values_of_batches",
    "values_of_batches",
    "with_schema_key",
]
