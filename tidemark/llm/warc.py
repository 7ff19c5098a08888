"""Web archives: write records, normalise whole-file gzip to one member per record, read back.

Three steps, each a Spark job over files in a shared folder:

1. ``write_archives`` writes each partition's records through Spark's gzip text
   writer, so that an archive is one gzip stream over all its records.
2. ``normalise_archives`` inflates each such stream once, piece by piece, writes
   every record as a gzip member of its own and beside the archive a sidecar
   index with the place of each member.
3. ``read_archives`` reads the members; ``read_at`` reads one by its place.

Payloads that are equal and have at least ``min_bytes`` bytes are kept once: the
record with the smallest id is the ``response``, the others are ``revisit``
records that name it.  Smaller payloads are all responses.

Null payloads are empty.  Rows that repeat an id and a payload are all responses
if the id is the smallest of its payload, else all revisits.  A null id is
written as an absent record name, sorts after all others, and revisits no more
than others do.  A null address is written as an absent header.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_BYTES = 100
#: Uncompressed bytes of records per archive.
ARCHIVE_BYTES = 16 << 20
_CRLF = "\r\n"
_READ = 1 << 16
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, id_col: str, html_col: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Payload, size, digest, record type and the id it refers to for every row."""
    payload = F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b""))
    rows = pages.withColumn("payload", payload).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")
    )
    first = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("first_digest"))
        .agg(F.min(id_col).alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    joined = rows.join(
        first, (F.col("payload_digest") == F.col("first_digest")) & (F.col("payload_bytes") >= min_bytes), "left"
    )
    revisits = F.col("first_id").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("first_id"))
    return joined.select(
        *rows.columns,
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first_id")).alias("refers_to"),
    )


def _header(name: str, value: Column) -> Column:
    """A header line, absent where its value is null."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_CRLF))


def record_of(id_col: str, url_col: str, at: str) -> Column:
    """The bytes of a record, but for the line break that ends it."""
    # Addresses are percent-coded, so that a line break in one makes no header.
    url = F.url_encode(url_col)
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    head = F.concat_ws(
        "",
        F.lit(VERSION + _CRLF),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col(id_col), F.lit(">"))),
        _header("WARC-Date", F.lit(at)),
        _header("WARC-Target-URI", F.concat(F.lit("urn:coded:"), url)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Payload-Length", F.col("payload_bytes")),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8" + _CRLF),
        _header("Content-Length", F.octet_length(body)),
    )
    return F.concat(F.encode(head, "UTF-8"), F.lit(_CRLF.encode()), body, F.lit(_CRLF.encode()))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    at: str = "2000-01-01T00:00:00Z",
    min_bytes: int = MIN_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Archives of all pages, each one gzip stream of about ``archive_bytes`` before compression."""
    pages = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))
    total = pages.agg(F.sum(F.octet_length(html_col) + F.lit(500))).first()[0] or 0
    records = with_revisits(pages, id_col, html_col, min_bytes).select(
        record_of(id_col, url_col, at).cast("string").alias("value")
    )
    rows = pages.count()
    per_archive = max(1, rows * archive_bytes // max(total, 1))
    # The text writer ends each row with the separator: with the record's own it makes the two that end a record.
    records.write.option("lineSep", _CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def inflated(content: bytes) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, a piece at a time."""
    stream = zlib.decompressobj(wbits=31)
    for start in range(0, len(content), _READ):
        data = content[start : start + _READ]
        while data:
            piece = stream.decompress(data)
            if piece:
                yield piece
            data = b""
            if stream.eof:
                data = stream.unused_data.lstrip(b"\0")
                stream = zlib.decompressobj(wbits=31)


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def records_in(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, each with the line breaks that end it, from a stream read once."""
    held = bytearray()
    needed = 0
    for piece in pieces:
        held += piece
        while True:
            if not needed:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                length = _LENGTH.search(held, 0, end + 2)
                if length is None:
                    raise ValueError("a record has no Content-Length")
                needed = end + 4 + int(length[1]) + 4
            if len(held) < needed:
                break
            yield bytes(held[:needed])
            del held[:needed]
            needed = 0
    if held:
        raise ValueError("the archive ends inside a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split(_CRLF)[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _page_of(name: str | None) -> str | None:
    return name.removeprefix("<urn:page:").removesuffix(">") if name else None


def _member(record: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(record) + packer.flush()


def normalise_archives(spark: SparkSession, source: str, target: str, level: int = 6) -> None:
    """Every archive of ``source`` again under ``target``, one gzip member per record, with its index.

    ``target/archive=A/kind=warc`` holds the archive and ``target/archive=A/kind=index`` its sidecar:
    lines of place, length and page id.  An archive is at most a few times ``ARCHIVE_BYTES``.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                name = path.as_py().rsplit("/", 1)[1].split(".")[0] + "-" + hashlib.md5(path.as_py().encode()).hexdigest()[:8]
                members, lines, place = [], [], 0
                for record in records_in(inflated(content.as_py())):
                    member = _member(record, level)
                    page = _page_of(parse_record(record)[0].get("WARC-Record-ID"))
                    lines.append(f"{place}\t{len(member)}\t{'' if page is None else page}")
                    members.append(member)
                    place += len(member)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name, name], pa.string()),
                        pa.array(["warc", "index"], pa.string()),
                        pa.array([b"".join(members), "\n".join(lines).encode()], pa.binary()),
                    ],
                    ["archive", "kind", "content"],
                )

    files = spark.read.format("binaryFile").load(source).where("length > 0").select("path", "content")
    rewritten = files.mapInArrow(rewrite, "archive string, kind string, content binary")
    # The zero byte that ends a row is padding after the last member.
    (
        rewritten.select("archive", "kind", F.col("content").cast("string").alias("value"))
        .write.partitionBy("archive", "kind")
        .option("lineSep", "\0")
        .text(target)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar lines of all archives under ``path``."""
    lines = spark.read.option("lineSep", "\n").text(f"{path}/archive=*/kind=index")
    parts = F.split(F.rtrim("value", F.lit("\0")), "\t")
    archive = F.regexp_extract(F.input_file_name(), "archive=([^/]*)", 1)
    return lines.select(
        archive.alias("archive"),
        F.get(parts, F.lit(0)).cast("long").alias("place"),
        F.get(parts, F.lit(1)).cast("long").alias("length"),
        F.nullif(F.get(parts, F.lit(2)), F.lit("")).alias("page_id"),
    ).where("place IS NOT NULL")


def read_at(content: bytes, place: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of a normalised archive, by its index line."""
    return parse_record(zlib.decompress(content[place : place + length], wbits=31))


RECORD_FIELDS = (
    "archive string, place long, length long, page_id string, url string, payload_bytes long, "
    "payload_digest string, record_type string, refers_to string"
)


def _member_at(content: bytes, place: int) -> tuple[bytes, int]:
    """The record of the gzip member at a place, and the member's length."""
    stream = zlib.decompressobj(wbits=31)
    parts, at = [], place
    while not stream.eof:
        if at >= len(content):
            raise ValueError("the archive ends inside a record")
        parts.append(stream.decompress(content[at : at + _READ]))
        at += _READ
    return b"".join(parts), min(at, len(content)) - len(stream.unused_data) - place


def _read_batch(paths: list[str], contents: list[bytes]) -> list[tuple]:
    rows = []
    for path, content in zip(paths, contents):
        archive = re.search("archive=([^/]*)", path)[1]
        place = 0
        while place < len(content) and content[place : place + 1] != b"\0":
            record, length = _member_at(content, place)
            headers, payload = parse_record(record)
            if headers["WARC-Type"] == "revisit":
                size, digest = int(headers["WARC-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
            else:
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            url = headers.get("WARC-Target-URI")
            rows.append(
                (
                    archive,
                    place,
                    length,
                    _page_of(headers.get("WARC-Record-ID")),
                    unquote(url.removeprefix("urn:coded:").replace("+", " ")) if url else None,
                    size,
                    digest,
                    headers["WARC-Type"],
                    _page_of(headers.get("WARC-Refers-To")),
                )
            )
            place += length
    return rows


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the normalised archives under ``path``, each with its place.

    Size and digest of a response are those of the payload read; a revisit has no
    payload and gives what its headers say of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.strip().split(" ")[0] for part in RECORD_FIELDS.split(",")]
        kinds = [pa.int64() if part.endswith("long") else pa.string() for part in RECORD_FIELDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = _read_batch([path.as_py()], [content.as_py()])
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    archives = files.where(F.col("path").contains("/kind=warc/")).select("path", "content")
    return archives.mapInArrow(run, RECORD_FIELDS)
