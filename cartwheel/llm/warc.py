"""Pages to WARC archives and back, with revisit records, segmented records and chunked HTTP bodies.

Writing: each page becomes a record. Of pages with equal payloads the one with the largest id is stored as
a response; the others are revisit records that refer to it and hold the HTTP header alone. A block larger
than ``SEGMENT`` bytes is cut into a first record and continuation records, cut between characters, so an
archive is UTF-8 text and Spark's text writer can write it to any store: one record a row, with the blank
lines that end a record as the line separator. An archive holds at most ``RECORDS`` records, each of bounded size.

Reading: archives are read as they are, whoever wrote them, and parsed by their content lengths. Records
without a segment number pass straight through. Segments are grouped by the identifier of their origin,
ordered by segment number and put together if the numbers run from one on without a gap and the total length of
the last segment is the length found. Then the HTTP header is split off, the chunked transfer framing is decoded and the payload digest
compared with the declared one. Revisits take their payload's size and digest from the record they refer to.

Defined results: a null page is an empty payload, which is a payload like any other; a null id is written
as a record without an id and is the smallest of its group; of equal ids the last in reading order is the response. Control characters
and blanks in an address are percent-encoded; a null address is ``about:blank``. Pages are written
once with their row numbers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import ROW_IDS, in_arrow, numbered, saved, table
from cartwheel.session import scratch

SEGMENT = 16 << 10  # bytes of a block in one record
RECORDS = 2000  # in an archive
CHUNK = 4 << 10  # bytes of an HTTP chunk
LEAST_BYTES = 0  # of a payload that is stored once
BATCH_BYTES = 4 << 20
DATE = "2020-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

PARSED = (
    "record_id string, type string, page_id bigint, refers_to string, origin string, segment int, "
    "total bigint, digest string, block binary"
)
READ = (
    "record_id string, type string, page_id bigint, refers_to string, payload binary, payload_bytes bigint, "
    "payload_digest string, verified boolean"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, row: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{row}').urn}>"


def chunked(payload: bytes) -> bytes:
    """HTTP chunked framing; chunks end between characters."""
    out, begin = bytearray(), 0
    while begin < len(payload):
        end = _cut(payload, begin + CHUNK)
        out += b"%x\r\n" % (end - begin) + payload[begin:end] + b"\r\n"
        begin = end
    return bytes(out + b"0\r\n\r\n")


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        begin = line + 2
        if body[begin + size : begin + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[begin : begin + size])
        at = begin + size + 2


def _cut(data: bytes, most: int) -> int:
    """The last place up to ``most`` that does not part a character."""
    if most >= len(data):
        return len(data)
    while data[most] & 0xC0 == 0x80:
        most -= 1
    return most


def _record(kind: str, name: str, block: bytes, *fields: tuple[str, str]) -> str:
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE), *fields, ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n" + "".join(f"{key}: {value}\r\n" for key, value in head) + "\r\n" + block.decode("utf-8")


def page_records(row: int, page: int | None, url: str | None, payload: bytes, first: tuple[int | None, int] | None) -> Iterator[str]:
    """The records of a page, without the blank lines that end each; ``first`` names the page it revisits."""
    name = record_id(page, row)
    address = re.sub(r"[\x00-\x20\x7f-\x9f]", lambda found: "".join(f"%{b:02X}" for b in found[0].encode()), url or "about:blank")
    fields = [("WARC-Target-URI", address), ("Content-Type", "application/http; msgtype=response")]
    fields += [("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    fields += [("X-Page-Id", str(page))] if page is not None else []
    if first is not None:
        refers = [("WARC-Refers-To", record_id(*first)), ("WARC-Profile", PROFILE)]
        yield _record("revisit", name, HTTP.encode(), *fields, *refers)
        return
    block = HTTP.encode() + chunked(payload)
    if len(block) <= SEGMENT:
        yield _record("response", name, block, *fields)
        return
    begin, number = 0, 0
    while begin < len(block):
        end, number = _cut(block, begin + SEGMENT), number + 1
        place = [("WARC-Segment-Number", str(number))]
        if number == 1:
            yield _record("response", name, block[:end], *fields, *place)
        else:
            place += [("WARC-Segment-Origin-ID", name)]
            place += [("WARC-Segment-Total-Length", str(len(block)))] if end == len(block) else []
            own = f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}:{number}').urn}>"
            yield _record("continuation", own, block[begin:end], *place)
        begin = end


def _batches(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, each with its size, in batches of bounded size."""
    held, size = [], 0
    for row, bytes_ in rows:
        held.append(row)
        size += bytes_ + 200
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)], schema=schema)


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for row, page, url, html, first_page, first_row in zip(*(batch.column(k) for k in range(6))):
                payload = (html.as_py() or "").encode()
                first = None if first_row.as_py() is None else (first_page.as_py(), first_row.as_py())
                for text in page_records(row.as_py(), page.as_py(), url.as_py(), payload, first):
                    yield (text,), len(text)

    return _batches(records(), _schema("record string"))


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
) -> None:
    """Writes all pages to gzipped archives in ``folder``."""
    text = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = numbered(
        pages.select(F.col(f"`{id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), text.alias("html")),
        "numbered",
    ).select("row", "page_id", "url", "html")
    hashed = saved(rows.select("row", "page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("bytes")), "payloads")
    same = hashed.where(F.col("bytes") >= least_bytes).groupBy("sha", "bytes").agg(
        F.max(F.struct("page_id", "row")).alias("first"), F.count(F.lit(1)).alias("pages")
    )
    revisits = saved(
        hashed.join(same.where("pages > 1"), ["sha", "bytes"])
        .where(F.col("row") != F.col("first.row"))
        .select("row", F.col("first.page_id").alias("first_page"), F.col("first.row").alias("first_row")),
        "revisits",
    )
    if revisits.count() <= ROW_IDS // 2:  # three numbers a row; beyond that Spark joins both sides
        revisits = F.broadcast(revisits)
    records = in_arrow(rows.join(revisits, "row", "left"), _written, "record string")
    records.write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).text(folder, compression="gzip")


def parsed_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            key, _, value = line.decode("utf-8").partition(":")
            fields[key.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        yield fields, block


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def records() -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for content in batch.column(0):
                source = io.BytesIO(content.as_buffer())
                packed = bytes(memoryview(content.as_buffer())[:2]) == b"\x1f\x8b"
                for fields, block in parsed_records(gzip.GzipFile(fileobj=source) if packed else source):
                    get = fields.get
                    yield (
                        get("warc-record-id"),
                        get("warc-type"),
                        number(get("x-page-id")),
                        get("warc-refers-to"),
                        get("warc-segment-origin-id"),
                        number(get("warc-segment-number")),
                        number(get("warc-segment-total-length")),
                        get("warc-payload-digest"),
                        block,
                    ), len(block)

    return _batches(records(), _schema(PARSED))


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    framed = re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head)
    return unchunked(body) if framed else body


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            columns = [batch.column(name) for name in ("record_id", "type", "page_id", "refers_to", "digest", "block", "whole")]
            for name, kind, page, refers, digest, block, whole in zip(*columns):
                own = (name.as_py(), kind.as_py(), page.as_py(), refers.as_py())
                if own[1] == "revisit":
                    yield (*own, None, None, (digest.as_py() or "").removeprefix("sha1:") or None, None), 0
                    continue
                try:
                    payload = payload_of(block.as_py()) if whole.as_py() else None
                except (ValueError, zlib.error):
                    payload = None
                if payload is None:
                    yield (*own, None, None, None, False), 0
                    continue
                found = payload_digest(payload)
                agrees = digest.as_py() in (None, f"sha1:{found}")
                yield (*own, payload, len(payload), found, agrees), len(payload)

    return _batches(records(), _schema(READ))


def read_archives(spark: SparkSession, folder: str, *, pattern: str = "*.gz") -> DataFrame:
    """Response and revisit records, with the payloads of responses; what is incomplete or fails its digest is not verified."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("content")
    records = in_arrow(files, _parsed, PARSED).where("type in ('response', 'revisit', 'continuation')")
    single = records.where("segment is null").withColumn("whole", F.lit(True))
    first = F.col("segment") == 1
    segments = F.array_sort(F.collect_list(F.struct("segment", "block")))  # of one record, however large that is
    grouped = (
        records.where("segment is not null")
        .groupBy(F.coalesce("origin", "record_id").alias("record_id"))
        .agg(
            *[F.max(F.when(first, F.col(name))).alias(name) for name in ("type", "page_id", "refers_to", "digest")],
            F.max("total").alias("total"),
            segments.alias("segments"),
        )
        .withColumn("block", F.aggregate("segments", F.lit(b""), lambda all_, one: F.concat(all_, one["block"])))
        .withColumn(
            "whole",
            (F.transform("segments", lambda one: one["segment"]) == F.sequence(F.lit(1), F.size("segments")))
            & (F.octet_length("block") == F.col("total")),
        )
    )
    names = ["record_id", "type", "page_id", "refers_to", "digest", "block", "whole"]
    whole = single.select(names).unionByName(grouped.withColumn("whole", F.coalesce("whole", F.lit(False))).select(names))
    return in_arrow(whole, _decoded, READ)


def resolved(records: DataFrame) -> DataFrame:
    """Each record's page with the size and digest of its payload, taken from the record that a revisit refers to."""
    found = saved(records.select("record_id", "type", "page_id", "refers_to", "payload_bytes", "payload_digest", "verified"), "records")
    responses = found.where("type = 'response'")
    revisits = found.where("type = 'revisit'").select("page_id", "refers_to", F.col("payload_digest").alias("declared"))
    origin = responses.select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("first_page"),
        "payload_bytes",
        "payload_digest",
        "verified",
    )
    return responses.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to"),
        "verified",
    ).unionByName(
        revisits.join(origin, "refers_to", "left").select(
            "page_id",
            "payload_bytes",
            "payload_digest",
            F.lit("revisit").alias("record_type"),
            F.col("first_page").alias("refers_to"),
            (F.col("verified") & F.coalesce(F.col("declared") == F.col("payload_digest"), F.lit(True))).alias("verified"),
        )
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return resolved(read_archives(spark, folder))
