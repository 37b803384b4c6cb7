"""Web archives: whole-file gzip streams normalised to a member per record with a sidecar index, repeated payloads as revisits."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ramure.llm.common import opened, put, shared_folder, stored

#: Bytes read at once.
CHUNK = 1 << 20
#: Payloads below this many bytes are never revisits.
LEAST_PAYLOAD = 100


def with_first(pages: DataFrame, key: str, payload: str, least: int = LEAST_PAYLOAD, url: str = "url") -> DataFrame:
    """(key, url, html, digest, first): `first` is the smallest key with the same payload, of payloads of at least `least` bytes that repeat.

    Only digests are grouped, pre-aggregated per task; the table of repeated ones is joined back. Pages that repeat a payload
    without a key of their own are revisits of the first key, if there is one. `url` may be another column than that of this name.
    """
    source = pages.select(pages[key].cast("long").alias("page_id"), pages[url].alias("url"), F.coalesce(pages[payload], F.lit("")).alias("html"))
    digested = source.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    repeated = stored(digested.where(F.octet_length("html") >= least).groupBy("digest")
                      .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "repeated")
    return digested.join(repeated, "digest", "left").select("page_id", "url", "html", "digest", "first")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """A WARC record: a response, or a revisit of page `first` that keeps only the HTTP headers."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = first is not None and first != page_id
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_SAFE)}")
    head += ["WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
        block = http
    else:
        block = http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


_SAFE = "".join(chr(code) for code in range(33, 127))


def write_monolithic(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """Write a record per row into archives that are each one gzip stream; returns (archive, records).

    Null payloads are read as empty, null urls leave the header out; repeated rows are written each; an empty table gives no archive.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((batch for batch in batches if len(batch)), None)
        if first is None:
            return
        name, records = f"{TaskContext.get().partitionId():06d}.warc.gz", 0

        def write(out) -> None:
            nonlocal records
            packer, batch = zlib.compressobj(1, zlib.DEFLATED, 31), first
            while batch is not None:
                for page_id, url_, html, digest, seen in zip(*(column.to_pylist() for column in batch.columns)):
                    out.write(packer.compress(record(page_id, url_, html.encode(), digest, seen)))
                    records += 1
                batch = next(batches, None)
            out.write(packer.flush())

        put(folder, name, write)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records])], ["archive", "records"])

    return stored(with_first(pages, key, payload, url=url).mapInArrow(written, "archive string, records long"), "archives")


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file, one member or many, chunk by chunk."""
    unpacker = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            if part := unpacker.decompress(data, CHUNK):
                yield part
            data = unpacker.unconsumed_tail
            if unpacker.eof:
                data = unpacker.unused_data
                unpacker = zlib.decompressobj(31)
    if rest := unpacker.flush():
        yield rest


_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)


def records_of(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream of WARC bytes, each with its header and its two line ends; holds one record at a time."""
    held = bytearray()

    def more() -> bool:
        part = next(parts, None)
        if part is not None:
            held.extend(part)
        return part is not None

    while held or more():
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("a record's header ends early")
        length = end + 4 + int(_LENGTH.search(held, 0, end + 2)[1]) + 4
        while len(held) < length:
            if not more():
                raise ValueError("a record ends early")
        yield bytes(held[:length])
        del held[:length]


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite archives: every record becomes a gzip member of its own, and a sidecar file lists offset, length and record id.

    Each archive is inflated once, as a stream, by one task; returns (archive, records, bytes).
    """

    def rewritten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name in frame["archive"]:
                lines: list[str] = []
                offset = 0

                def write(out) -> None:
                    nonlocal offset
                    files, path = opened(source)
                    with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                        for whole in records_of(inflated(stream)):
                            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                            member = packer.compress(whole) + packer.flush()
                            out.write(member)
                            lines.append(f"{offset}\t{len(member)}\t{_headers(whole)['warc-record-id']}\n")
                            offset += len(member)

                put(target, name, write)
                put(target, f"{name}.idx", lambda out: out.write("".join(lines).encode()))
                yield pd.DataFrame({"archive": [name], "records": [len(lines)], "bytes": [offset]})

    one_each = archives.select("archive").repartition(max(1, archives.count()))
    return stored(one_each.mapInPandas(rewritten, "archive string, records long, bytes long"), "normalised")


def _headers(whole: bytes) -> dict[str, str]:
    lines = whole[:whole.index(b"\r\n\r\n")].decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _page(identifier: str | None) -> int | None:
    number = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of normalised archives by their index: (page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload).

    A response's digest is taken of the payload read and has to be the recorded one; a revisit has no payload.
    """

    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = opened(folder)
                with files.open_input_stream(f"{path}/{name}.idx", compression=None) as stream:
                    index = [line.split("\t") for line in stream.read().decode().splitlines()]
                rows, held = [], 0
                with files.open_input_file(f"{path}/{name}") as stream:
                    for offset, length, _ in index:
                        stream.seek(int(offset))
                        rows.append(_row(zlib.decompress(stream.read(int(length)), 31)))
                        held += rows[-1][2]
                        if held > 8 * CHUNK:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, one.type) for column, one in zip(zip(*rows), kinds)], schema=kinds)

    one_each = archives.select("archive").repartition(max(1, archives.count()))
    return one_each.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                                     "refers_to long, payload binary")


def _row(whole: bytes) -> tuple:
    headers = _headers(whole)
    block = whole[whole.index(b"\r\n\r\n") + 4:-4]
    edge = block.index(b"\r\n\r\n")
    size = int(_LENGTH.search(block, 0, edge + 2)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    payload = block[edge + 4:] if headers["warc-type"] == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {headers['warc-record-id']} is damaged")
    return (_page(headers["warc-record-id"]), headers.get("warc-target-uri"), size, digest, headers["warc-type"],
            _page(headers.get("warc-refers-to")), payload)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write whole-file streams, normalise them and read the result by its index, in new folders of the shared one."""
    whole, single = shared_folder(spark, "warc-streams"), shared_folder(spark, "warc-members")
    return read_archives(normalise(write_monolithic(pages, whole), whole, single), single)
