"""Archives: round trip, seek table, revisits, difficult rows."""

import base64
import hashlib
import io

import pytest
import zstandard

from lakestrata.llm import warc
from lakestrata.llm.shared import files, work_dir

from .helpers import rows_of

PAGES = "page_id long, url string, html string"


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None) if len(data) >= least else None
        refers = first if first is not None and page != first else None
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), name, "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/1", "<p>one</p>"),
    (2, "http://a/ü%20\r\n\r\nx", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (1, "http://a/3", None),
    (0, "", ""),
    (7, "http://a/4", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
    (8, "http://a/5", "x" * 700_000),
    (8, "http://a/5", "x" * 700_000),
    (None, "http://a/6", "<p>one</p>"),
    (None, "http://a/6", "alone"),
    (-4, "http://a/7", "y" * 20),
]


@pytest.mark.parametrize("least", [0, 11])
@pytest.mark.parametrize("frame,bundle", [(1 << 18, 1 << 27), (1, 1), (300, 1000)])
def test_round_trip(spark, least, frame, bundle):
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 AS payload", "2 AS first", "'k' AS key")
    index = warc.write_archives(
        pages.repartition(3), work_dir(spark, "warc"), least_bytes=least, frame_bytes=frame, bundle_bytes=bundle
    )
    rows = rows_of(warc.read_archives(index, with_payload=True))
    got = [
        (
            None if r["record_id"] is None else int(r["record_id"]),
            r["payload_bytes"],
            r["payload_digest"],
            r["record_type"],
            None if r["refers_to"] is None else int(r["refers_to"]),
        )
        for r in rows
    ]
    assert sorted(got, key=repr) == expected(ROWS, least)
    texts = {(p, h or "") for p, _, h in ROWS}
    for r in rows:
        if r["record_type"] == "response":
            page = None if r["record_id"] is None else int(r["record_id"])
            assert (page, r["payload"].decode()) in texts
    assert {r["url"] for r in rows} == {u and u.replace("\r\n", "%0D%0A") for _, u, _ in ROWS}
    some = index.filter("record_id IN ('7', '8', '-4')")
    fetched = rows_of(warc.fetch(some))
    assert sorted(r["record_id"] for r in fetched) == ["-4", "7", "8", "8"]
    assert {r["payload_bytes"] for r in fetched if r["record_id"] == "8"} == {700_000}


def test_plain_zstd_reads_a_bundle_and_the_index_fits(spark):
    pages = spark.range(0, 500, 1, 2).selectExpr(
        "id AS page_id", "concat('u', id) AS url", "concat('text ', id DIV 2) AS html"
    )
    index = warc.write_archives(pages, work_dir(spark, "warc"), frame_bytes=2000)
    rows = rows_of(index)
    assert len({(r["path"], r["frame"]) for r in rows}) > 10
    for path in {r["path"] for r in rows}:
        system, inner = files(path)
        with system.open_input_file(inner) as source:
            bundle = warc.BundleReader(source)
            frames = [bundle.frame(i) for i in range(len(bundle.sizes))]
        with system.open_input_file(inner) as source:
            whole = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(source.read()), read_across_frames=True
            ).read()
        assert whole == b"".join(frames)
        for r in rows:
            if r["path"] == path:
                data = frames[r["frame"]][r["offset"] : r["offset"] + r["length"]]
                assert [x[0] for x in warc.decode_records(data)] == [r["record_id"]]


def test_no_pages_and_all_null_keys(spark):
    empty = warc.write_archives(spark.createDataFrame([], PAGES), work_dir(spark, "warc"))
    assert warc.read_archives(empty).count() == 0
    same = spark.createDataFrame([(None, "u", "same")] * 2, PAGES)
    index = warc.write_archives(same, work_dir(spark, "warc"))
    assert [r["record_type"] for r in rows_of(warc.read_archives(index))] == ["response"] * 2


def test_damage_is_noticed():
    record = warc.encode_record("1", "u", b"payload", None, "1970-01-01T00:00:00Z")
    assert next(warc.decode_records(record))[4] == 7
    with pytest.raises(ValueError):
        list(warc.decode_records(record.replace(b"payload", b"pAyload")))


def test_read_back_uses_many_tasks(spark):
    pages = spark.range(0, 400, 1, 8).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 50) AS html")
    index = warc.write_archives(pages, work_dir(spark, "warc"), bundle_bytes=1 << 10)
    read = warc.read_archives(index)
    assert "REPARTITION_BY_NUM" in read._jdf.queryExecution().executedPlan().toString()
    assert read.rdd.getNumPartitions() == 8
