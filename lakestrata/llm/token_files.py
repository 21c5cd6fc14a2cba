"""Token ids in binary files: blocks of ids, each shuffled into planes and compressed.

A file holds the ids of one range of documents, in ascending document order:

    magic  b"IDPLANE1"
    chunk  one for each block and plane: a zstandard frame
    index  a zstandard frame of JSON: block size, planes, and for each block its
           number of ids and for each chunk its offset and size; for each document
           its number, its first id within the file and its number of ids
    tail   offset and size of the index, two little-endian 64-bit integers, magic

A plane has one bit (or byte) of every id of a block, so that the high planes, which
hardly change, compress to almost nothing, and any block can be read by its index.

Ranges come from quantiles of the document numbers, one for each task. A task writes the
file of its range under a name of its own and returns it as a row. Those rows, stored by
Spark, are the list of files: what a lost or repeated task has left is in no list.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import (
    files,
    join_paths,
    ordered_blocks,
    shuffle_partitions,
    stage,
    text_of,
    work_dir,
)
from .tokenize import encoder

MAGIC = b"IDPLANE1"
FILES = "block int, path string, n_ids long, n_docs long, n_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, the lowest first; zero ones are empty."""
    raw = np.ascontiguousarray(ids, dtype="<u4")
    if planes == "byte":
        table = raw.view(np.uint8).reshape(-1, 4).T
        return [row.tobytes() if row.any() else b"" for row in table]
    top = int(raw.max()).bit_length() if len(raw) else 0
    out = []
    for bit in range(32):
        if bit >= top:
            out.append(b"")
            continue
        row = np.packbits(((raw >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8))
        out.append(row.tobytes() if row.any() else b"")
    return out


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    """The block's ids; the inverse of ``to_planes``."""
    if planes == "byte":
        table = np.zeros((4, n), dtype=np.uint8)
        for row, part in zip(table, parts, strict=True):
            if part:
                row[:] = np.frombuffer(part, dtype=np.uint8)
        return np.ascontiguousarray(table.T).view("<u4").reshape(-1)
    ids = np.zeros(n, dtype="<u4")
    for bit, part in enumerate(parts):
        if part:
            on = np.unpackbits(np.frombuffer(part, dtype=np.uint8), count=n)
            ids |= on.astype("<u4") << np.uint32(bit)
    return ids


class PlaneWriter:
    """Writes one file; only the ids of the current block are in memory."""

    def __init__(self, sink, block_size: int, planes: str, level: int) -> None:
        self.sink, self.block_size, self.planes = sink, block_size, planes
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.waiting: list[bytes] = []
        self.n_waiting = self.n_ids = 0
        self.blocks: list[list] = []
        self.docs: list[tuple[int | None, int, int]] = []
        self.at = self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.sink.write(data)
        return len(data)

    def add(self, doc: int | None, raw: bytes) -> None:
        n = len(raw) // 4
        self.docs.append((doc, self.n_ids, n))
        self.n_ids += n
        self.waiting.append(raw)
        self.n_waiting += n
        if self.n_waiting >= self.block_size:
            raw = b"".join(self.waiting)
            size = 4 * self.block_size
            whole = len(raw) // size * size
            for i in range(0, whole, size):
                self._block(np.frombuffer(raw, dtype="<u4", count=self.block_size, offset=i))
            self.waiting, self.n_waiting = [raw[whole:]], (len(raw) - whole) // 4

    def _block(self, ids: np.ndarray) -> None:
        chunks = []
        for plane in to_planes(ids, self.planes):
            data = self.compress(plane) if plane else b""
            chunks.append((self.at, len(data)))
            self.at += self._put(data)
        self.blocks.append([len(ids), chunks])

    def finish(self) -> int:
        """Writes what waits and the index; returns the size of the file."""
        rest = np.frombuffer(b"".join(self.waiting), dtype="<u4")
        if len(rest):
            self._block(rest)
        index = {
            "block_size": self.block_size,
            "planes": self.planes,
            "blocks": self.blocks,
            "docs": self.docs,
        }
        data = self.compress(json.dumps(index).encode())
        start = self.at
        self.at += self._put(data)
        self.at += self._put(struct.pack("<QQ", start, len(data)) + MAGIC)
        return self.at


class PlaneReader:
    """Reads one file by its index."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = self._get(size - 24, 24)
        start, length = struct.unpack("<QQ", tail[:16])
        if tail[16:] != MAGIC or self._get(0, 8) != MAGIC:
            raise ValueError("not a file of id planes")
        self.expand = zstandard.ZstdDecompressor().decompress
        self.index = json.loads(self.expand(self._get(start, length)))

    def _get(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def block(self, i: int) -> np.ndarray:
        """The ids of one block, by a single read of its chunks."""
        n, chunks = self.index["blocks"][i]
        first = chunks[0][0]
        raw = self._get(first, chunks[-1][0] + chunks[-1][1] - first)
        parts = [self.expand(raw[a - first : a - first + k]) if k else b"" for a, k in chunks]
        return from_planes(parts, n, self.index["planes"])

    def ids(self, start: int, n: int) -> np.ndarray:
        """Any run of ids, from the blocks it lies in."""
        size = self.index["block_size"]
        first, last = start // size, (start + max(n, 1) - 1) // size
        run = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return run[start - first * size : start - first * size + n]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Document number, first id and ids of each document, in file order."""
        block, held, begin = -1, np.empty(0, dtype="<u4"), 0
        for doc, start, n in self.index["docs"]:
            while begin + len(held) < start + n:
                held = np.concatenate([held[start - begin :], self.block(block + 1)])
                begin, block = start, block + 1
            yield doc, start, held[start - begin : start - begin + n].tobytes()


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 2,
    planes: str = "bit",
    block_size: int = 65_536,
    level: int = 3,
) -> DataFrame:
    """Writes the ids of all documents; returns the stored list of files in document order.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Null and empty
    texts are ``end_id`` alone. Documents with a null number come first; rows that share
    a number follow each other in the order of their texts. No rows give no files.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    parts = shuffle_partitions(spark)
    block, ranges = ordered_blocks(texts, "doc_id", parts)
    sorted_texts = (
        texts.withColumn("block", block.cast("int"))
        .repartitionById(ranges, "block")
        .sortWithinPartitions("block", "doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encoded
        end = np.array([end_id], dtype="<u4").tobytes()
        system, root = files(folder)
        system.create_dir(root, recursive=True)
        current, writer, sink, name = None, None, None, ""
        done: list[tuple] = []

        def close() -> None:
            if writer:
                size = writer.finish()
                sink.close()
                done.append(
                    (current, join_paths(folder, name), writer.n_ids, len(writer.docs), size)
                )

        for batch in batches:
            numbers = batch.column("block").to_pylist()
            ids_of = batch.column("doc_id").to_pylist()
            raws = encode(batch.column("text"))
            for number, doc, raw in zip(numbers, ids_of, raws, strict=True):
                if number != current:
                    close()
                    current, name = number, f"ids-{number:06d}-{uuid.uuid4().hex}.planes"
                    sink = system.open_output_stream(join_paths(root, name), compression=None)
                    writer = PlaneWriter(sink, block_size, planes, level)
                writer.add(doc, raw + end)
        close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c, t)
                    for c, t in zip(
                        zip(*done),
                        [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()],
                        strict=True,
                    )
                ],
                ["block", "path", "n_ids", "n_docs", "n_bytes"],
            )

    return stage(sorted_texts.mapInArrow(write, FILES), "id-files")


def first_ids(listed: DataFrame) -> dict[int, int]:
    """Each file's first id in the whole corpus. There is one file for each task of the write."""
    sizes = sorted((r["block"], r["n_ids"]) for r in listed.select("block", "n_ids").collect())
    starts = accumulate((n for _, n in sizes), initial=0)
    return {block: start for (block, _), start in zip(sizes, starts)}


def read_ids(listed: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of the listed files: number, first id in the whole corpus, ids.

    ``listed`` has one row for each file, in one block each. The sizes of the files before
    it give each file's first id; they go to the tasks, and no row is joined.
    ``ids`` (little-endian unsigned 32-bit) is read only ``with_ids``; the checksum is
    always of the ids in the file.
    """
    spark = listed.sparkSession
    bases = first_ids(listed)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block in zip(
                batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True
            ):
                base = bases[block]
                system, inner = files(path)
                with system.open_input_file(inner) as source:
                    rows, held = [], 0
                    for doc, start, raw in PlaneReader(source).documents():
                        kept = raw if with_ids else None
                        rows.append((doc, base + start, len(raw) // 4, zlib.crc32(raw), kept))
                        held += len(raw)
                        if held > 16_000_000:
                            yield _documents(rows)
                            rows, held = [], 0
                    if rows:
                        yield _documents(rows)

    paths = listed.select("path", "block").repartitionById(max(len(bases), 1), "block")
    found = paths.mapInArrow(read, DOCUMENTS + ", ids binary")
    return found if with_ids else found.drop("ids")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names
    )


def new_folder(spark: SparkSession, name: str = "planes") -> str:
    return work_dir(spark, name)
