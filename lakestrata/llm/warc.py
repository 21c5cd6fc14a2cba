"""Web archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed each for itself. A bundle ends in a
seek table (a skippable frame, so plain zstd reads the bundle too), from which a reader
gets every frame's place by two short reads at the end. The index maps a record to
its bundle, frame and offset in the frame.

A payload is stored once, in the record of the smallest identifier; other records
with an equal payload refer to that one. Tasks write bundles under names of their own
and return the index as rows. The index that Spark has stored names the bundles that
count; what a lost or repeated task left behind is in no index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import files, join_paths, shuffle_partitions, stage

# Fixed values of the seekable Zstandard format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

INDEX = "record_id string, path string, frame int, offset long, length long"
RECORDS = (
    "record_id string, url string, record_type string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)
_END = b"\r\n\r\n"
_URN = "<urn:record:%s>"


class BundleWriter:
    """Writes one bundle; one frame of records is in memory."""

    def __init__(self, sink, frame_bytes: int, level: int) -> None:
        self.sink, self.frame_bytes = sink, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.frames: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.held = self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The number of the record's frame and its offset in the frame."""
        if self.waiting and self.held + len(record) > self.frame_bytes:
            self.flush()
        at = self.held
        self.waiting.append(record)
        self.held += len(record)
        return len(self.frames), at

    def flush(self) -> None:
        if self.waiting:
            data = self.compress(b"".join(self.waiting))
            self.sink.write(data)
            self.frames.append((len(data), self.held))
            self.size += len(data)
            self.waiting, self.held = [], 0

    def finish(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


class BundleReader:
    """Reads frames of a bundle by its seek table."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self._get(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end")
        table = self._get(size - 9 - 8 * count, 8 * count)
        self.sizes = list(struct.iter_unpack("<II", table))
        self.starts = [0]
        for compressed, _ in self.sizes:
            self.starts.append(self.starts[-1] + compressed)
        self.expand = zstandard.ZstdDecompressor().decompress

    def _get(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def frame(self, i: int) -> bytes:
        compressed, length = self.sizes[i]
        data = self.expand(self._get(self.starts[i], compressed), max_output_size=length)
        if len(data) != length:
            raise ValueError("a frame is not as long as the seek table says")
        return data


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def _header(lines: list[tuple[str, str | None]], first: str) -> bytes:
    held = [first, *(f"{k}: {v}" for k, v in lines if v is not None)]
    return "\r\n".join(held).encode() + _END


def _escaped(value: str) -> str:
    """An identifier that fits in one header line; ``_of_urn`` undoes it."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _of_urn(value: str | None) -> str | None:
    if value is None:
        return None
    held = value[len("<urn:record:") : -1]
    return held.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def encode_record(
    record_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str
) -> bytes:
    """A response record, or a revisit of ``refers_to`` without the payload."""
    revisit = refers_to is not None
    content = _header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
        "HTTP/1.1 200 OK",
    ) + (b"" if revisit else payload)
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head = _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", None if record_id is None else _URN % _escaped(record_id)),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else _one_line(url)),
            ("WARC-Profile", profile if revisit else None),
            ("WARC-Refers-To", _URN % _escaped(refers_to) if revisit else None),
            ("WARC-Payload-Digest", "sha1:" + digest(payload)),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(content))),
        ],
        "WARC/1.1",
    )
    return head + content + _END


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def decode_records(data: bytes) -> Iterator[tuple]:
    """The records of a frame, as rows of ``RECORDS``."""
    at = 0
    while at < len(data):
        body = data.index(_END, at) + 4
        head = _fields(data[at:body])
        end = body + int(head["Content-Length"])
        inner = data.index(_END, body) + 4
        payload = data[inner:end]
        length = int(_fields(data[body:inner])["Content-Length"])
        named = head["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = head["WARC-Type"] == "revisit"
        if not revisit and (len(payload) != length or digest(payload) != named):
            raise ValueError(f"payload of {head.get('WARC-Record-ID')} is damaged")
        yield (
            _of_urn(head.get("WARC-Record-ID")),
            head.get("WARC-Target-URI"),
            head["WARC-Type"],
            _of_urn(head.get("WARC-Refers-To")),
            length,
            named,
            None if revisit else payload,
        )
        at = end + 4


def with_first(pages: DataFrame, payload: Column, key: Column, least_bytes: int) -> DataFrame:
    """``key, url, payload`` of each page and ``first``, the smallest key with that payload.

    Payloads are compared by SHA-256 and length. Only payloads that occur more than once
    have a ``first``. The join splits a payload that fills a large share of the pages.
    """
    rows = pages.select(
        key.alias("key"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(payload.cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"size": F.octet_length("payload"), "name": F.sha2("payload", 256)})
    repeated = (
        rows.filter(F.col("size") >= least_bytes)
        .groupBy("name", "size")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    return rows.join(repeated, ["name", "size"], "left").select("key", "url", "payload", "first")


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    payload: str = "html",
    least_bytes: int = 0,
    frame_bytes: int = 1 << 18,
    bundle_bytes: int = 1 << 27,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record for each page; returns the stored index (``INDEX``).

    ``pages`` has the key, ``url`` and the payload text; other columns are not read. A null
    payload is empty. Of pages with equal payloads of ``least_bytes`` at least, those
    with the smallest key are responses and all others revisit that key. A null key is
    never the smallest; if all are null, all are responses. A null url is left out;
    line breaks in a url are percent-encoded.
    Repeated rows get a record each. No rows give no bundles.
    """
    rows = with_first(pages, F.col(payload), F.col(key), least_bytes).select(
        F.col("key").cast("string").alias("record_id"),
        "url",
        "payload",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias(
            "refers_to"
        ),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = files(folder)
        system.create_dir(root, recursive=True)
        writer, sink, name = None, None, ""
        rows: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for record_id, url, data, refers_to in zip(*columns, strict=True):
                if writer is None:
                    name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    sink = system.open_output_stream(join_paths(root, name), compression=None)
                    writer = BundleWriter(sink, frame_bytes, level)
                record = encode_record(record_id, url, data, refers_to, date)
                frame, offset = writer.add(record)
                rows.append((record_id, join_paths(folder, name), frame, offset, len(record)))
                if writer.size >= bundle_bytes:
                    writer.finish()
                    sink.close()
                    writer = None
            if len(rows) > 20_000:
                yield _rows(rows, INDEX)
                rows = []
        if writer:
            writer.finish()
            sink.close()
        yield _rows(rows, INDEX)

    return stage(rows.mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the indexed bundles, frame after frame (``RECORDS``)."""
    paths = index.select("path").distinct()
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = files(path)
                with system.open_input_file(inner) as source:
                    bundle = BundleReader(source)
                    rows, held = [], 0
                    for i in range(len(bundle.sizes)):
                        for row in decode_records(bundle.frame(i)):
                            rows.append(row if with_payload else (*row[:-1], None))
                        held += bundle.sizes[i][1]
                        if held > 16_000_000 or len(rows) > 10_000:
                            yield _rows(rows, RECORDS)
                            rows, held = [], 0
                    yield _rows(rows, RECORDS)

    # Dealt in turn: dealt by path, as after the distinct, Spark would merge them into one task.
    spread = paths.repartition(shuffle_partitions(index.sparkSession))
    found = spread.mapInArrow(read, RECORDS)
    return found if with_payload else found.select(*names[:-1])


def fetch(index: DataFrame) -> DataFrame:
    """Only the records of these rows of an index, by frame and offset (``RECORDS``).

    A frame is read once for neighbouring rows; other frames are not read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, frame, bundle, data, source = None, None, None, b"", None
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("path", "frame", "offset", "length")]
            for path, number, offset, length in zip(*columns, strict=True):
                if path != at:
                    if source:
                        source.close()
                    system, inner = files(path)
                    source = system.open_input_file(inner)
                    at, frame, bundle = path, None, BundleReader(source)
                if number != frame:
                    frame, data = number, bundle.frame(number)
                rows.extend(decode_records(data[offset : offset + length]))
            yield _rows(rows, RECORDS)
        if source:
            source.close()

    wanted = index.select("path", "frame", "offset", "length")
    near = wanted.repartition(shuffle_partitions(index.sparkSession), "path", "frame")
    return near.sortWithinPartitions("path", "frame", "offset").mapInArrow(read, RECORDS)


_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )
