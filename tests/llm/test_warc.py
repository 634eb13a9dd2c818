"""WARC archives: round trips, revisits, segments, and archives written by others."""

import base64
import gzip
import hashlib
import random

import pytest

from cartwheel.llm import warc as W
from cartwheel.llm.queries import QUERIES

PAGES = "page_id bigint, url string, html string"


def brute(pages):
    """One (page_id, bytes, digest, type, refers_to) for each page; ties by reading order."""
    first = {}
    for at, (page, _, html) in enumerate(pages):
        key = (html or "").encode()
        rank = (page is not None, page or 0, at)
        first[key] = max(first.get(key, rank), rank)
    out = []
    for at, (page, _, html) in enumerate(pages):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        best = first[payload]
        own = best[2] == at
        refers = None if own or not best[0] else best[1]
        out.append((page, len(payload), digest, "response" if own else "revisit", refers))
    return out


def plain(rows):
    return sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)))


def test_query_against_brute_force(spark, sf_dir):
    import pyarrow.parquet as pq

    pages = [tuple(row.values()) for row in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist()]
    rows = QUERIES["op9_warc"](spark, sf_dir).collect()
    assert plain(rows) == sorted(map(repr, brute(pages)))
    assert all(row.verified for row in rows)


def test_odd_pages_and_segments(spark, folder):
    draw = random.Random(2)
    large = "".join(draw.choice("aé漢😀\r\n <p>") for _ in range(60_000))
    pages = [
        (1, "http://a/ b\n", large),
        (2, None, large),
        (3, "http://c/", None),
        (4, "http://c/", ""),
        (None, "http://d/", "WARC/1.1\r\n\r\n\r\n"),
        (5, "u", "x\r\n\r\ny"),
        (5, "u", "x\r\n\r\ny"),
        (6, "u", "z" * W.SEGMENT),
    ]
    df = spark.createDataFrame(pages, PAGES).coalesce(1)
    W.write_archives(df, f"{folder}/w")
    read = W.read_archives(spark, f"{folder}/w")
    assert plain(W.resolved(read).collect()) == sorted(map(repr, brute(pages)))
    payloads = {row.page_id: bytes(row.payload) for row in read.where("type = 'response'").collect()}
    assert payloads[2] == large.encode() and payloads[4] == b"" and payloads[None] == b"WARC/1.1\r\n\r\n\r\n"
    W.write_archives(df.where("false"), f"{folder}/none")
    assert W.resolved(W.read_archives(spark, f"{folder}/none")).collect() == []


def test_pages_below_the_least_size_are_all_stored(spark, folder):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], PAGES)
    W.write_archives(df, f"{folder}/w", least_bytes=3)
    rows = W.resolved(W.read_archives(spark, f"{folder}/w")).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def record(**fields):
    block = fields.pop("block")
    head = "".join(f"{key.replace('_', '-')}: {value}\r\n" for key, value in fields.items())
    return f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def foreign(parts, total):
    block = W.HTTP.encode() + W.chunked(b"hello " * 10)
    cuts = [round(len(block) * k / 3) for k in range(4)]
    out = []
    for number in parts:
        fields = {"WARC_Record_ID": f"<urn:{number}>", "WARC_Type": "response" if number == 1 else "continuation", "WARC_Segment_Number": number}
        if number > 1:
            fields["WARC_Segment_Origin_ID"] = "<urn:1>"
        if number == 3:
            fields["WARC_Segment_Total_Length"] = total or len(block)
        out.append(record(**fields, block=block[cuts[number - 1] : cuts[number]]))
    return b"".join(out)


@pytest.mark.parametrize("parts, total, good", [((3, 1, 2), None, True), ((1, 3), None, False), ((1, 2), None, False), ((1, 2, 3), 7, False)])
def test_segments_of_other_writers(spark, tmp_path, parts, total, good):
    (tmp_path / "a.warc").write_bytes(record(WARC_Type="warcinfo", WARC_Record_ID="<urn:i>", block=b"x: y") + foreign(parts, total))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record(WARC_Type="response", WARC_Record_ID="<urn:9>", block=b"HTTP/1.1 200 OK\r\n\r\nplain")))
    rows = {r.record_id: r for r in W.read_archives(spark, str(tmp_path), pattern="*warc*").collect()}
    assert bytes(rows["<urn:9>"].payload) == b"plain" and rows["<urn:9>"].verified
    assert rows["<urn:1>"].verified == good
    assert rows["<urn:1>"].payload == (b"hello " * 10 if good else None)


def test_framing():
    for size in (0, 1, W.CHUNK, 3 * W.CHUNK + 5):
        payload = ("é" * size).encode()
        assert W.unchunked(W.chunked(payload)) == payload
    with pytest.raises(ValueError):
        W.unchunked(b"5\r\nabc\r\n0\r\n\r\n")
