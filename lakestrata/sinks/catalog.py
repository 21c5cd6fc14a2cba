"""Tables that keep their identity: a run writes a new version of the data, then switches to it.

The data of a table lies in ``<path>/version=<time>-<mark>``. A run writes a folder of its own
and makes it current by one step in the catalog, ``ALTER TABLE .. SET LOCATION``. No folder is
moved, so an object store copies nothing, and whoever reads the table by name has the old rows
or the new ones at any time. A run that dies before the switch leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from lakestrata.layout import new_version
from lakestrata.session import children, folder_bytes, remove_folder, stage, tune, versions, work_dir

# File source tables then find partitions by listing their location, so that a new location
# brings its own partitions; otherwise the catalog would go on naming those of the old one.
_LISTED = "spark.sql.hive.manageFilesourcePartitions"
# Most rows of a bucket, on average.
BUCKET_ROWS = 500_000


def save_table(
    df: DataFrame,
    database: str,
    table: str,
    path: str,
    partition_by: list[str] | None = None,
    max_records_per_file: int = 0,
    rebalance: bool = False,
    keep_versions: int = 0,
    buckets: tuple[str, int] | None = None,
    file_bytes: int | None = None,
) -> str:
    """Write Parquet below ``path`` and make it the data of ``database.table``; return that name.

    A second run replaces the rows, once all its data is written: a run that fails leaves data
    and table as they were. The table itself stays, with its properties. New columns are added
    to it, behind those it has. Only where columns are taken away, change their type, or
    other ones partition the table is it defined anew, with the properties it had.

    ``keep_versions`` earlier versions of the data stay, for queries that still read them;
    older ones go, after the switch. ``sources.read_parquet`` reads the newest complete version
    of a path, and any reader does where no earlier one stays. Files are as many as the last stage
    has tasks; ``rebalance`` adds a shuffle that evens them out.

    ``buckets`` is a column and a number: rows are stored in that many files by a hash of the
    column, each sorted by it. Whoever reads the table by name joins it and groups it by that
    column without a shuffle. A value that fills a third of the rows fills one file. The number
    is the least: it is doubled until a bucket has at most ``BUCKET_ROWS`` rows on average, as a task
    reads a bucket whole. The rows are written once before, to count them.

    ``file_bytes`` is the size that files shall have. What a row takes on disk is measured on
    the rows themselves, which are written once before, and the files are planned by it; it adds
    that write and a shuffle. Files of a partitioned table are as large as their partition, or
    of about that size if it is larger.
    """
    spark = tune(df.sparkSession)
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    path = path.rstrip("/")
    partitions = list(partition_by or [])
    columns = _table_columns(df.schema, partitions)
    if file_bytes:
        df, rows, n = _sized(df, file_bytes)
        if partitions:
            # A task of all partitions' rows would write a file for each of them.
            df = df.hint("rebalance", *partitions)
            max_records_per_file = max(-(-rows // n), 1)
        else:
            df = df.repartition(n)
    if buckets:
        if partitions or max_records_per_file:
            raise ValueError("a bucket is one file of the whole table")
        df = stage(df, "unbucketed")
        buckets = (buckets[0], _enough_buckets(df.count(), buckets[1]))
        df = df.repartition(buckets[1], buckets[0])
    elif rebalance:
        df = df.hint("rebalance", *partitions)
    writer = df.write
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partitions:
        writer = writer.partitionBy(*partitions)
    folder = f"{path}/{new_version()}"
    try:
        if buckets:
            _write_buckets(spark, writer, database, table, folder, buckets)
        else:
            writer.parquet(folder)
        switch(spark, name, columns, partitions, folder, buckets)
    except BaseException:
        remove_folder(spark, folder)
        raise
    _retire(spark, path, folder, keep_versions)
    return name


def _enough_buckets(rows: int, least: int) -> int:
    n = least
    while n * BUCKET_ROWS < rows:
        n *= 2
    return n


def _sized(df: DataFrame, file_bytes: int) -> tuple[DataFrame, int, int]:
    """The stored rows, how many there are, and how many files of that size they fill."""
    spark = df.sparkSession
    path = work_dir(spark, "sized")
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    return stored, stored.count(), max(round(folder_bytes(spark, path) / file_bytes), 1)


def _write_buckets(
    spark: SparkSession,
    writer: DataFrameWriter,
    database: str,
    table: str,
    folder: str,
    buckets: tuple[str, int],
) -> None:
    """Spark writes buckets through the catalog only: under a passing name, which goes again.

    The files stay, as the folder was named by us.
    """
    column, n = buckets
    passing = f"`{database}`.`{table}_{folder[-8:]}`"
    try:
        bucketed = writer.format("parquet").bucketBy(n, column).sortBy(column)
        bucketed.option("path", folder).saveAsTable(passing)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {passing}")


def _table_columns(schema: T.StructType, partitions: Sequence[str]) -> T.StructType:
    """The columns in the order of a table: partition columns come last. All may be null."""
    held = {f.name: f.dataType for f in schema.fields}
    names = [n for n in held if n not in partitions] + list(partitions)
    return T.StructType([T.StructField(n, _nullable(held[n])) for n in names])


def _nullable(kind: T.DataType) -> T.DataType:
    """The type as Parquet tables read it back: any part may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def switch(
    spark: SparkSession,
    name: str,
    columns: T.StructType,
    partitions: Sequence[str],
    folder: str,
    buckets: tuple[str, int] | None = None,
) -> None:
    """Make ``folder`` the data of the table, which is created if it is not there.

    Added columns come before the switch: rows of the old version have null in them.
    """
    place = _quoted(folder)
    if not spark.catalog.tableExists(name):
        _create(spark, name, columns, partitions, folder, {}, buckets)
        return
    held = _nullable(spark.table(name).schema)
    kept = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    added = _added(held, columns, len(kept))
    if kept != list(partitions) or added is None or _buckets(spark, name) != buckets:
        properties = _properties(spark, name)
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, columns, partitions, folder, properties, buckets)
        return
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(added)})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)


def _buckets(spark: SparkSession, name: str) -> tuple[str, int] | None:
    """Column and number of the table's buckets."""
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    if not columns:
        return None
    described = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Num Buckets'")
    return columns[0], int(described.first()["data_type"])


def _added(held: T.StructType, wanted: T.StructType, n_partitions: int) -> list | None:
    """The columns to add to ``held``; None if it has columns that are not wanted as they are.

    A table takes new columns behind its data columns, in front of its partition columns.
    """
    wanted_types = {f.name: f.dataType for f in wanted.fields}
    if any(wanted_types.get(f.name) != f.dataType for f in held.fields):
        return None
    known = set(held.names)
    return [f for f in wanted.fields[: len(wanted.fields) - n_partitions] if f.name not in known]


def _ddl(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {_type(f.dataType)}" for f in fields)


def _type(kind: T.DataType) -> str:
    """The type as SQL, with the names of struct fields quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(
            f"`{f.name.replace('`', '``')}`: {_type(f.dataType)}" for f in kind.fields
        ) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_type(kind.keyType)}, {_type(kind.valueType)}>"
    return kind.simpleString()


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _create(
    spark: SparkSession,
    name: str,
    columns: T.StructType,
    partitions: Sequence[str],
    folder: str,
    properties: dict[str, str],
    buckets: tuple[str, int] | None,
) -> None:
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    if buckets:
        column, n = buckets
        parts = f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {int(n)} BUCKETS"
    kept = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in properties.items())
    before = spark.conf.get(_LISTED)
    spark.conf.set(_LISTED, "false")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({_ddl(columns.fields)}) USING parquet {parts}"
            f" LOCATION '{_quoted(folder)}' {f'TBLPROPERTIES ({kept})' if kept else ''}"
        )
    finally:
        spark.conf.set(_LISTED, before)
    spark.catalog.refreshTable(name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties users have set; the catalog keeps others of its own."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    own = ("spark.sql.", "transient_", "numFiles", "totalSize", "EXTERNAL")
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith(own)}


def _retire(spark: SparkSession, path: str, current: str, keep: int) -> None:
    """Remove all but ``keep`` versions before the current one, and what lay there without one."""
    mine = current.rpartition("/")[2]
    earlier = [v for v in versions(spark, path) if v < mine]
    for version in earlier[: len(earlier) - keep]:
        remove_folder(spark, f"{path}/{version}")
    if len(earlier) >= keep:
        for child in children(spark, path):
            if not child.startswith(("version=", "_", ".")):
                remove_folder(spark, f"{path}/{child}")
