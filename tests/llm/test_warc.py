"""Archives: round trips, revisits, offsets."""

import gzip
import hashlib
import zlib
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.session import scratch_path

LONG = "<p>" + "é text " * 40 + "</p>"
ROWS = [
    (5, "http://a/\r\nX: y", LONG),
    (2, "http://b", LONG),
    (9, None, LONG),
    (3, "http://c", "short"),
    (4, "http://c", "short"),
    (6, "http://d", None),
    (7, "http://e", ""),
    (8, "http://f", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "z" * 300_000),
    (2, "http://b", LONG),
    (None, "http://n", LONG),
]


def _written(spark, rows, archive_bytes):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    pages = pages.withColumn("payload_bytes_", F.lit(1))
    mono, target = scratch_path(spark, "mono"), scratch_path(spark, "warc")
    warc.write_archives(pages, mono, archive_bytes=archive_bytes)
    warc.normalise_archives(spark, mono, target)
    return mono, target


def test_round_trip(spark):
    mono, target = _written(spark, ROWS, 2000)
    got = warc.read_archives(spark, target).collect()
    assert len(got) == len(ROWS)
    by_id = {}
    for row in got:
        by_id.setdefault(row.page_id, []).append(row)
    for page_id, url, html in ROWS:
        payload = (html or "").encode()
        row = by_id[None if page_id is None else str(page_id)][0]
        assert (row.payload_bytes, row.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert row.url == url
        revisit = html == LONG and page_id != 2
        assert (row.record_type, row.refers_to) == (("revisit", "2") if revisit else ("response", None))


def test_monolithic_input_and_members(spark):
    mono, target = _written(spark, ROWS, 1 << 30)
    for file in Path(mono).glob("*.gz"):
        stream = zlib.decompressobj(wbits=31)
        stream.decompress(file.read_bytes())
        assert stream.eof and not stream.unused_data
    index = warc.read_index(spark, target).collect()
    assert len(index) == len(ROWS)
    records = {(r.archive, r.place): r for r in warc.read_archives(spark, target).collect()}
    for line in index:
        (file,) = Path(target).glob(f"archive={line.archive}/kind=warc/part-*")
        headers, payload = warc.read_at(file.read_bytes(), line.place, line.length)
        record = records[line.archive, line.place]
        assert record.length == line.length and record.page_id == line.page_id
        assert int(headers["Content-Length"]) == len(payload)
        assert gzip.decompress(file.read_bytes()).count(b"WARC-Record-ID") >= 1


def test_empty_table(spark):
    _, target = _written(spark, [], 100)
    assert warc.read_archives(spark, target).count() == 0


def test_records_across_pieces():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    stream = record * 3
    for step in (1, 2, 7, 1000):
        pieces = (stream[i : i + step] for i in range(0, len(stream), step))
        assert list(warc.records_in(pieces)) == [record] * 3
