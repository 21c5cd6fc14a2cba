"""Runtime settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakestrata.layout import VERSION

# Adaptive execution re-plans joins on measured sizes, cuts hot join partitions
# and hot sink partitions into several tasks, and merges tiny ones. The
# "force" switch lets it cut a hot key even if a later join on the same key then
# needs a shuffle of its own: without it a chain of joins on one key keeps the
# hot key in one task. The factor is for what is broadcast by size of file: text
# columns with few values grow several times when they are read. The number of tasks is for
# listing: Spark would start one for each of up to 10,000 folders.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive rules the plans rely on. Sizes stay those of the cluster."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


# Landed files that a task reads, about. Spark takes opening a file for reading 4 MB, so it would read
# some 30, of a few KB each; and a task has a cost of its own, above all where it shuffles or writes files.
_READ_FILES = 128
_MOST, _LEAST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def tune_landed_reads(spark: SparkSession) -> SparkSession:
    """``tune``, and tasks that read about ``_READ_FILES`` landed files each.

    Spark still deals fewer files to all cores, and the bytes of a task stay as they are. A cost of
    opening files that is smaller already stays.
    """
    tune(spark)
    least = max(_bytes(spark, _MOST) // _READ_FILES, 1)
    if _bytes(spark, _LEAST) > least:
        spark.conf.set(_LEAST, f"{least}b")
    return spark


def _bytes(spark: SparkSession, key: str) -> int:
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return size(spark.conf.get(key))


# Most bytes of files that a task reads which makes its rows distinct before they are shuffled. Such
# a task holds all of them: titles of 8 MB take some 600 MB.
_READ_BYTES = 8 << 20


def tune_reads(spark: SparkSession) -> SparkSession:
    """``tune``, and small tasks for reading what is made distinct before it is shuffled.

    The memory of such a task is that of its distinct rows, so it grows with the input up to
    ``spark.sql.files.maxPartitionBytes``, and beyond its share of the executor it spills. As many
    small files as before go to a task. Sizes that are smaller already stay.
    """
    tune(spark)
    held = _bytes(spark, _MOST)
    if held > _READ_BYTES:
        least = _bytes(spark, _LEAST) * _READ_BYTES // held
        spark.conf.set(_LEAST, f"{max(least, 1)}b")
        spark.conf.set(_MOST, f"{_READ_BYTES}b")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder path that every executor can reach.

    It lies under ``spark.checkpoint.dir``, which the cluster sets to a folder that all
    its machines share. Only a session in local mode that names no such folder gets a
    temporary one; elsewhere that is an error. Within ``job_folder`` the path lies in
    the job's folder.
    """
    job = spark.conf.get(_JOB_FOLDER, None)
    return f"{job or _base(spark)}/{name}-{uuid.uuid4().hex}"


_JOB_FOLDER = "spark.lakestrata.job.folder"


def _base(spark: SparkSession) -> str:
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lakestrata-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is staged in this block; it goes when the block ends or fails.

    The block has to finish its writes; a result that is still to be computed may need
    what has been staged.
    """
    outer = spark.conf.get(_JOB_FOLDER, None)
    folder = f"{outer or _base(spark)}/job-{uuid.uuid4().hex}"
    spark.conf.set(_JOB_FOLDER, folder)
    try:
        yield folder
    finally:
        if outer is None:
            spark.conf.unset(_JOB_FOLDER)
        else:
            spark.conf.set(_JOB_FOLDER, outer)
        remove_folder(spark, folder)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder."""
    system, place = _file_system(spark, path)
    return system.getContentSummary(place).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder, sorted; none if there is no such folder."""
    system, place = _file_system(spark, path)
    if not system.exists(place) or not system.getFileStatus(place).isDirectory():
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern with ``*`` for names matches, sorted."""
    system, place = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(place) or [])


def versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of a table's data below ``path``, the oldest first.

    Spark marks the folder of a write that has ended with an empty file.
    """
    path = path.rstrip("/")
    system, _ = _file_system(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = [name for name in children(spark, path) if name.startswith(VERSION)]
    return [name for name in named if system.exists(at(f"{path}/{name}/_SUCCESS"))]


def current_data(spark: SparkSession, path: str) -> str:
    """The folder of the newest complete version below ``path``, or ``path`` if it has none."""
    found = versions(spark, path)
    return f"{path.rstrip('/')}/{found[-1]}" if found else path


@contextmanager
def replaced_folder(spark: SparkSession, path: str, aside: str | None = None) -> Iterator[str]:
    """A new folder beside ``path`` to write to; it takes the place of ``path`` at the end.

    If the block fails, ``path`` stays as it is. A write that reads ``path`` is safe too. ``aside`` is
    the folder to make it in, for a block that reads what lies beside ``path``.
    """
    path = path.rstrip("/")
    mark = uuid.uuid4().hex
    parent, _, name = path.rpartition("/")
    # Readers skip names that begin with an underscore.
    fresh, old = f"{aside or parent}/_{name}-new-{mark}", f"{parent}/_{name}-old-{mark}"
    try:
        yield fresh
    except BaseException:
        remove_folder(spark, fresh)
        raise
    system, place = _file_system(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    had = system.exists(place)
    if had and not system.rename(place, at(old)):
        raise OSError(f"cannot move {path} aside")
    system.mkdirs(place.getParent())
    if not system.rename(at(fresh), place):
        if had:
            system.rename(at(old), place)
        raise OSError(f"cannot put the new data at {path}")
    if had:
        system.delete(at(old), True)


def many_files(spark: SparkSession) -> dict[str, str]:
    """Options of a write into a new folder that makes very many small files.

    Each task moves its own files to their place, where the driver would move all of them one by
    one when the last task has ended. Readers see the folder only when the write has ended. On
    the local file system Hadoop adds a file of checksums to each file, and starts a process for
    each of the two to set its rights, which takes many times as long as the file. Its plain form
    writes no checksums. Other file systems, and one that the session names, stay as they are.
    """
    options = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    if spark.sparkContext._jsc.hadoopConfiguration().get(_LOCAL_FILES) is None:
        options[_LOCAL_FILES] = "org.apache.hadoop.fs.RawLocalFileSystem"
        options[f"{_LOCAL_FILES}.disable.cache"] = "true"
    return options


_LOCAL_FILES = "fs.file.impl"

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs in this block go when it ends, not when the driver's JVM
    happens to collect its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the work folder as Parquet and read it back.

    For results that several later steps read, or whose physical order they rely
    on: the written rows stay as they are when an executor is lost. What the write has shuffled
    goes from the disks when it ends.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for rows that only this block reads: they go when it ends or fails."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    try:
        with _shuffles_dropped(spark):
            df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
