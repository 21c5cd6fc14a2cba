from __future__ import annotations

import hashlib
import json
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import date_parts
from lakestrata.functions.document_types import TEXT, merged_types, types_by_key
from lakestrata.layout import DELIMITED, KEPT, SCHEMAS, day_path
from lakestrata.operators.grouping import deal_by_files, ordered_chunks, repeat_copies, split_copies
from lakestrata.schemas import CHUNK_SIZE
from lakestrata.session import many_files, replaced_folder, staged, tune


def _one_line_each(df: DataFrame) -> DataFrame:
    """The same rows; a text with a line break ends the job with an error that names its column."""
    checked = {}
    for field in df.schema.fields:
        if field.dataType.typeName() == "string":
            value = F.col(f"`{field.name}`")
            broken = value.contains("\n") | value.contains("\r")
            error = F.raise_error(F.lit(f"line break in {field.name}: land it with multi_line"))
            checked[field.name] = F.when(broken, error.cast("string")).otherwise(value)
    return df.withColumns(checked) if checked else df


def land_by_date(
    df: DataFrame,
    path: str,
    when: date | Column,
    file_format: str = "csv",
    sep: str = "|",
    multi_line: bool = False,
) -> None:
    """Write under ``year=/month=/day=``, replacing the days written and no others.

    With a run date all rows go to that day, without a shuffle. With a column
    each row goes to its own day; rows are brought together by day first, which
    keeps the files few, and adaptive execution cuts a day that is too large.
    A run that fails leaves the days as they were.

    Delimited values come back as they are. Values with line breaks need ``multi_line``
    here and in the reader, which then cannot split files; without it they are
    refused. So is a null in the only column of a frame.
    """
    spark = tune(df.sparkSession)
    options = {}
    if file_format == "csv":
        options = {**DELIMITED, "sep": sep}
        if len(df.columns) == 1:
            # A blank line would be no row, and a lone null has no other form.
            options["quoteAll"] = "true"
            (name,) = df.columns
            alone = F.raise_error(F.lit(f"a null in {name}, the only column, would be lost"))
            value = F.col(f"`{name}`")
            df = df.select(F.when(value.isNotNull(), value).otherwise(alone).alias(name))
        if not multi_line:
            df = _one_line_each(df)
    if isinstance(when, date):
        with replaced_folder(spark, day_path(path, when)) as folder:
            df.write.format(file_format).options(**options).save(folder)
        return
    parts = date_parts(when)
    (
        df.withColumns(parts)
        .hint("rebalance", *parts)
        .write.format(file_format)
        .options(**options, partitionOverwriteMode="dynamic")
        .mode("overwrite")
        .partitionBy(*parts)
        .save(path)
    )


def land_chunks(
    df: DataFrame,
    path: str,
    payload: str = "payload",
    group: str = "schema_key",
    size: int = CHUNK_SIZE,
    order_by: str | list[str] | None = None,
    copies: str | None = None,
    compression: str | None = None,
) -> None:
    """Write JSON documents, at most ``size`` per file, one folder per set of keys.

    The folder is ``schema_id=<md5 of the set of keys>``, so groups never share
    a file name. ``path`` is replaced as a whole. ``copies`` names a column with
    the number of times a document is to be written. ``compression`` is that of the files, such as
    ``gzip``; readers know it by their names, and the files, being small, are not split anyway.

    Without ``order_by`` a file holds one document per line. Spark ends a file
    after ``size`` documents, so nothing is numbered or sorted. The documents are written once
    and counted, and a set of keys is dealt to as many tasks as its files ask for, as a
    file of a hundred documents costs much more than its bytes. Copies are made in
    the writing task, after the shuffle.

    With ``order_by`` chunks are numbered from 1 in that order, and each is a
    JSON array in a folder ``chunk=<number>``. Documents are written once; their keys are numbered
    first, without the documents, which are then shuffled once. It costs one folder per chunk, so it is
    for a moderate number of documents. A run that fails leaves the documents as they were.

    The fields of the documents and their types are merged for each set of keys by the tasks
    that land them, and kept in the folder ``_schemas``, so that readers need not look for them.
    """
    spark = tune(df.sparkSession)
    seen = Observation()
    plain = df.withColumn("schema_id", F.md5(F.coalesce(group, F.lit(""))))
    keyed = plain.observe(seen, merged_types(payload, group).alias("types"))
    repeats = [F.col(copies).alias("_copies")] if copies else []
    times = "_copies" if copies else None
    if order_by is None:
        # Outside of strings a line break means nothing in JSON, inside it is escaped.
        broken = F.contains(payload, F.lit("\n")) | F.contains(payload, F.lit("\r"))
        line = F.when(broken, F.regexp_replace(payload, r"[\r\n]+", " ")).otherwise(F.col(payload))
        rows = keyed.select("schema_id", line.alias(payload), *repeats)
        if copies:
            rows = split_copies(rows, times, size)
    else:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        names = [f"_order{i}" for i in range(len(keys))]
        ordered = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
        rows = keyed.select("schema_id", F.col(payload).alias(payload), *ordered, *repeats)
    # Once, as they are read for their number and again to be written.
    with staged(rows, "lines") as lines:
        if order_by is None:
            lines = deal_by_files(lines, "schema_id", size, times, payload)
            if copies:
                lines = repeat_copies(lines, times)
            writer = lines.write.option("maxRecordsPerFile", size).partitionBy("schema_id")
        else:
            arrays = ordered_chunks(lines, "schema_id", names, payload, times, size)
            writer = arrays.drop("records").write.partitionBy("schema_id", "chunk")
        if compression:
            writer = writer.option("compression", compression)
        with replaced_folder(spark, path) as folder:
            writer.options(**many_files(spark)).text(folder)
            kept = spark.createDataFrame(_schema_rows(seen.get["types"]), KEPT)
            kept.coalesce(1).write.json(f"{folder}/{SCHEMAS}")


def _schema_rows(types: str | None) -> list[tuple]:
    """``KEPT`` for each set of keys. Keys whose types are unknown are text."""
    rows = []
    for key, fields in sorted(types_by_key(types).items()):
        names = sorted(fields) if fields is not None else json.loads(key or "[]")
        kinds = fields or dict.fromkeys(names, TEXT)
        schema = T.StructType([T.StructField(n, kinds[n]) for n in names])
        fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        rows.append((hashlib.md5(key.encode()).hexdigest(), key, fields, schema.json()))
    return rows
