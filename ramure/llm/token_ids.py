"""Token ids of whole documents in binary files: frequency ranks in one to four bytes, lengths in separate control bytes."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ramure.llm.common import Encoder, put, shared_folder, slices, stored

#: Tokens of a file, and of a block of documents that is coded at once; a longer document is a block of its own.
FILE_TOKENS, BLOCK_TOKENS = 8_000_000, 65_536

# Fixed values of the file format.
MAGIC = b"RIDS0001"
HEADER = struct.Struct("<8sI")       # magic, entries of the rank table (unsigned 32-bit ids follow)
FOOTER = struct.Struct("<QQ8s")      # blocks, documents, magic
#: Bytes of the four values that a control byte describes, two bits each, lowest first.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
#: Which of four bytes a value of that many bytes keeps.
KEPT = np.arange(4) < np.arange(5)[:, None]

_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced)
    return _ENCODERS[path, spaced]


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.astype("<u4").view(np.uint8).reshape(-1, 4)[KEPT[codes + 1]]
    four = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    four[:len(codes)] = codes
    four = four.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The values again: lengths of four at a time are looked up, then all bytes are dealt out at once."""
    values = np.zeros((count, 4), np.uint8)
    values[KEPT[LENGTHS[control].reshape(-1)[:count]]] = data
    return values.reshape(-1).view("<u4")


class FileWriter:
    """Writes documents into a stream: header with the rank table, blocks (control bytes, then data bytes), index, footer."""

    def __init__(self, out, ids_by_rank: np.ndarray):
        self.out, self.rank = out, np.zeros(int(ids_by_rank.max(initial=0)) + 1, np.uint32)
        self.rank[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)
        out.write(HEADER.pack(MAGIC, len(ids_by_rank)) + ids_by_rank.astype("<u4").tobytes())
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.blocks: list[tuple[int, int, int]] = []  # values, control bytes, data bytes
        self.docs: list[tuple[int, int, int]] = []    # whether it has an id, id, tokens

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_TOKENS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            control, data = encode_values(self.rank[np.concatenate(self.waiting)])
            self.out.write(control + data)
            self.blocks.append((self.held, len(control), len(data)))
        self.waiting, self.held = [], 0

    def close(self) -> None:
        self.flush()
        for rows in (self.blocks, self.docs):
            self.out.write(np.array(rows, "<i8").reshape(-1, 3).tobytes())
        self.out.write(FOOTER.pack(len(self.blocks), len(self.docs), MAGIC))


def read_file(content: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document, ids of the file before it, ids) for every document of a file."""
    magic, entries = HEADER.unpack_from(content)
    blocks, docs, end = FOOTER.unpack_from(content, len(content) - FOOTER.size)
    if magic != MAGIC or end != MAGIC:
        raise ValueError("not a whole file of token ids")
    table = np.frombuffer(content, "<u4", entries, HEADER.size)
    index = len(content) - FOOTER.size - 24 * (blocks + docs)
    sizes = np.frombuffer(content, "<i8", 3 * blocks, index).reshape(-1, 3).tolist()
    documents = iter(np.frombuffer(content, "<i8", 3 * docs, index + 24 * blocks).reshape(-1, 3).tolist())
    at, start = HEADER.size + 4 * entries, 0
    for count, control, data in sizes:
        ranks = decode_values(np.frombuffer(content, np.uint8, control, at), np.frombuffer(content, np.uint8, data, at + control), count)
        ids, used = table[ranks], 0
        at += control + data
        while used < count:
            known, doc_id, length = next(documents)
            yield (doc_id if known else None), start + used, ids[used:used + length]
            used += length
        start += count
    for known, doc_id, _ in documents:  # empty ones at the end
        yield (doc_id if known else None), start, table[:0]


def encode_documents(docs: DataFrame, path: str, spaced: bool, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids) of every row: the ids of the whole text and the end id, as little-endian 16- or 32-bit integers."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, spaced)
        last = np.array([end_id], ids_of.kind).tobytes()
        for batch in slices(batches, 1):
            ids, ends = ids_of(batch.column(1))
            content, places = ids.tobytes(), (ends * ids.itemsize).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([content[low:high] + last for low, high in zip(places, places[1:])], pa.binary())], ["key", "ids"])

    source = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    return source.mapInArrow(encoded, "key long, ids binary")


def frequencies(encoded: DataFrame, kind: str) -> DataFrame:
    """(id, n): how often each id occurs; one row per id and task reaches the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in slices(batches, 0, 1_000_000):  # counting takes eight bytes an id
            some = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=len(total))
            some[:len(total)] += total
            total = some
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return encoded.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, folder: str, path: str, spaced: bool, end_id: int, text: str = "text", key: str = "doc_id",
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of all documents in ascending order of `key` into files of about `file_tokens`; returns (file, n_docs, n_tokens).

    Null texts are read as empty and have only the end id; rows without a key come first; repeated keys stay, ordered by their ids;
    other columns aren't read; an empty table gives no file. Documents are encoded once and kept in the shared folder. The table of
    ids by frequency (a row per vocabulary entry at most) is the only thing the driver sees.
    """
    spark = docs.sparkSession
    encoded = stored(encode_documents(docs, path, spaced, end_id, text, key), "ids")
    kind = encoder(path, spaced).kind
    counts = frequencies(encoded, kind).orderBy(F.desc("n"), "id").collect()
    by_rank = np.array([row["id"] for row in counts], np.uint32)
    files = max(1, -(-sum(row["n"] for row in counts) // file_tokens))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((batch for batch in batches if len(batch)), None)
        if first is None:
            return
        number, totals = TaskContext.get().partitionId(), [0, 0]

        def write(out) -> None:
            writer = FileWriter(out, by_rank)
            batch = first
            while batch is not None:
                for key_, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    writer.add(key_, np.frombuffer(ids, kind))
                batch = next(batches, None)
            writer.close()
            totals[:] = len(writer.docs), sum(count for count, _, _ in writer.blocks)

        put(folder, f"{number:06d}.ids", write)
        yield pa.RecordBatch.from_arrays([pa.array([one]) for one in (number, *totals)], ["file", "n_docs", "n_tokens"])

    ordered = encoded.repartitionByRange(files, "key").sortWithinPartitions("key", "ids")
    return stored(ordered.mapInArrow(written, "file long, n_docs long, n_tokens long"), "files")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents of the files: (doc_id, start, n_tokens, ids), ids as little-endian unsigned 32-bit integers.

    `start` counts the ids of all documents before it: within its file, and in the files before by a sum over one row per file.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                for doc_id, start, ids in read_file(content):
                    rows.append((int(name[-10:-4]), doc_id, start, len(ids), ids.tobytes()))
                    held += len(ids)
                    if held > 500_000:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(column, kind_) for column, kind_ in zip(zip(*rows), kinds)],
                                          ["file", "doc_id", "inside", "n_tokens", "ids"])

    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(manifest.select("file", before.alias("before")), "starts")
    schema = "path string, modificationTime timestamp, length long, content binary"
    if starts.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    content = spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.ids").load(folder).select("path", "content")
    rows = content.mapInArrow(read, "file long, doc_id long, inside long, n_tokens long, ids binary")
    return (rows.join(starts, "file").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids"))


def round_trip(docs: DataFrame, path: str, spaced: bool, end_id: int) -> DataFrame:
    """Write the files into a new folder of the shared one and read them."""
    folder = shared_folder(docs.sparkSession, "token-files")
    return read_token_files(docs.sparkSession, folder, write_token_files(docs, folder, path, spaced, end_id))
