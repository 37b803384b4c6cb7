import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from ramure.llm.common import shared_folder
from ramure.llm.warc import archive_round_trip, inflated, normalise, read_archives, record, records_of, write_monolithic


@pytest.fixture(scope="module")
def pages(spark):
    page = "<p>" + "é" * 60 + "</p>"
    rows = [(3, "http://a.b/c", page), (2, "http://a.b/\n d", page), (9, None, page), (9, None, page), (4, "http://x/", "small"), (5, "http://x/", "small"),
            (6, "u", None), (7, "u", ""), (None, "http://no.id/", page), (8, "long", "x" * 300_000), (1, "head\r\n\r\n", "WARC/1.1\r\n\r\nContent-Length: 3")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {name: F.lit("own") for name in ("digest", "first", "archive")})


def test_round_trip(spark, pages):
    rows = archive_round_trip(spark, pages).collect()
    assert len(rows) == 11
    kinds = sorted((row["page_id"] or 0, row["record_type"], row["refers_to"]) for row in rows)
    assert kinds == [(0, "revisit", 2), (1, "response", None), (2, "response", None), (3, "revisit", 2), (4, "response", None),
                     (5, "response", None), (6, "response", None), (7, "response", None), (8, "response", None), (9, "revisit", 2),
                     (9, "revisit", 2)]
    html = {row["page_id"]: row["html"] or "" for row in pages.collect()}
    for row in rows:
        data = html[row["page_id"]].encode()
        assert (row["payload_bytes"], row["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert row["payload"] is None if row["record_type"] == "revisit" else bytes(row["payload"]) == data
    assert archive_round_trip(spark, pages.limit(0)).count() == 0


def test_one_stream_becomes_a_member_per_record(spark, pages, tmp_path):
    whole, single = (shared_folder(spark, name) for name in ("whole", "single"))
    archives = normalise(write_monolithic(pages.coalesce(1), whole), whole, single)
    (name, count, size), = archives.collect()
    path = single.removeprefix("file:") + "/" + name
    with open(whole.removeprefix("file:") + "/" + name, "rb") as file:
        stream = file.read()
    with open(path, "rb") as file:
        members = file.read()
    first = zlib.decompressobj(31)
    assert first.decompress(stream) and first.eof and not first.unused_data
    assert gzip.decompress(stream) == gzip.decompress(members) and len(members) == size
    with open(path + ".idx") as file:
        lines = [line.split("\t") for line in file]
    assert len(lines) == count == 11
    for offset, length, identifier in lines:
        text = zlib.decompress(members[int(offset):int(offset) + int(length)], 31)
        assert text.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {identifier.strip()}".encode() in text
    assert read_archives(archives, single).count() == 11


def test_records_over_chunk_borders_and_damage():
    data = b"".join(record(n, "http://x/", b"y" * n, "0", None) for n in range(50))
    parts = iter([data[at:at + 7] for at in range(0, len(data), 7)])
    assert b"".join(records_of(parts)) == data
    assert len(list(records_of(iter([data])))) == 50
    with pytest.raises(ValueError):
        list(records_of(iter([data[:-3]])))
    members = gzip.compress(b"one") + gzip.compress(b"two")
    assert b"".join(inflated(io.BytesIO(members))) == b"onetwo"
