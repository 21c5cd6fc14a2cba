"""What several operators of this folder share: staged tables, files, groups of rows."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import session
from lakestrata.session import stage

__all__ = [
    "files",
    "groups",
    "join_paths",
    "in_fold",
    "ordered_blocks",
    "quiet_tokenizers",
    "shuffle_partitions",
    "stage",
    "text_of",
    "work_dir",
]

_HAS_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def files(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and the path within it.

    A plain path or ``file:`` is a folder that all machines mount; other schemes
    go to Arrow's file systems (hdfs, s3, gs), Hadoop's names for s3 too.
    """
    if not _HAS_SCHEME.match(path):
        return fs.LocalFileSystem(), path
    path = re.sub("^s3[an]:", "s3:", path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for files of tasks, with the scheme of the file system it lies in.

    Without a scheme Spark would take the path for one of its default file system, Arrow for
    one of the machine's own disk.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session.work_dir(spark, name))
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def join_paths(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the key's decimal text leaves ``fold`` modulo ``folds``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from sorted batches; one run is in memory at a time."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    kept.append(batch.slice(start, i - start))
                if kept:
                    yield pa.Table.from_batches(kept)
                kept, start, last = [], i, key
        kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def ordered_blocks(df: DataFrame, key: str, blocks: int) -> tuple[Column, int]:
    """A column that numbers ``blocks`` ranges of ``key`` of about equal size, and their number.

    Only the key is read. The bounds are quantiles, at most ``blocks`` of them;
    null keys come before all others.
    """
    ranges = max(blocks, 1)
    shares = [i / ranges for i in range(1, ranges)]
    bounds: list[int] = []
    if shares:
        row = df.agg(F.percentile_approx(key, shares, 20 * ranges).alias("b")).first()
        bounds = sorted({int(b) for b in row["b"] or []})
    if not bounds:
        return F.lit(0), 1
    # Bisection: the number of bounds below the key, from the highest binary digit down.
    held = F.lit(bounds)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, width: Column) -> Column:
        below = F.try_element_at(held, at + width) < F.col(key)
        return F.when(below, at + width).otherwise(at)

    found = F.aggregate(F.lit(steps), F.lit(0), step)
    return F.when(F.col(key).isNull(), 0).otherwise(found), len(bounds) + 1


def quiet_tokenizers() -> None:
    """One thread for each task: Spark already runs a task on every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
