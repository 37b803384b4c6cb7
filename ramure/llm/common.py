"""Helpers shared by the operators: reading, whole-text words, the shared work folder, components, batches and encoding."""

from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separator of words; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of a batch of rows on its way to Python, about; one row at least.
BATCH_BYTES = 4_000_000

#: Bytes that a task writes of a table whose size is known beforehand, about.
FILE_BYTES = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body`."""
    return F.transform(F.array(value), body)[0]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for files that the driver and all executors see.

    It lies in `spark.checkpoint.dir`; where that is unset and Spark runs on one machine, as in tests, in the session's warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, most: int | None = None) -> DataFrame:
    """Write a table into the shared folder and go on from the files: lineage ends there, and lost executors cost nothing.

    Batches for Python are bounded by bytes while it is written, so long texts don't pile up in a worker. Where it is known that the
    last step works on `most` bytes, about, it has no more tasks and files than these need, however many partitions shuffles have.
    """
    if most is not None:
        df = df.coalesce(max(1, math.ceil(most / FILE_BYTES)))
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    bytes_, setting = BATCH_BYTES, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(bytes_))
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(folder)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables made by `stored` that nothing reads any more."""
    for one in tables:
        spark, files = one.sparkSession, one.inputFiles()
        folder = files[0].rpartition("/")[0] if files else ""
        if re.search("-[0-9a-f]{32}$", folder):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def opened(folder: str):
    """The file system of a folder's address and the path there, for files that tasks write."""
    from pyarrow import fs

    if not re.match(r"\w+://", folder):
        folder = re.sub(r"^file:/*", "/", folder)
    return fs.FileSystem.from_uri(folder)


def put(folder: str, name: str, write: Callable) -> None:
    """Write a file under a name of this attempt, then give it its own: a repeated task replaces the file by an equal one."""
    from pyspark import TaskContext

    files, path = opened(folder)
    files.create_dir(path, recursive=True)
    own = f"{path}/_{name}.{TaskContext.get().taskAttemptId()}"
    with files.open_output_stream(own, compression=None) as out:
        write(out)
    files.move(own, f"{path}/{name}")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (a, b): every node with the smallest node it can reach (id, component).

    Labels spread to neighbours and jump to the label of their label until nothing changes. Each round ends in a written table.
    """
    width = 64  # bytes of a row, about
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges", 2 * width * edges.count())
    most = width * both.count()
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                    .select("id", F.least("id", "m").alias("component")), "labels", most)
    while True:
        reached = (both.join(labels.select(F.col("id").alias("b"), "component"), "b")
                   .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        nearer = stored(labels.join(reached, "id")
                        .select("id", F.col("component").alias("before"), F.least("component", "near").alias("via")), "labels", most)
        jump = nearer.select(F.col("id").alias("via"), F.col("via").alias("component"))
        after = stored(nearer.join(jump, "via").select("id", "before", "component"), "labels", most)
        dropped(labels, nearer)
        labels = after.select("id", "component")
        if after.where("before <> component").isEmpty():
            dropped(both)
            return labels


def texts_of(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes of some texts after one another and where each begins and the last ends, for about `most` bytes at once; null is empty.

    A text of more bytes comes alone.
    """
    whole = pc.cast(pc.cast(column, pa.large_string()).fill_null(""), pa.large_binary())  # of no type, if all are null
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(whole):
        high = max(int(np.searchsorted(ends, ends[low] + most, "right")) - 1, low + 1)
        yield data[ends[low]:ends[high]], ends[low:high + 1] - ends[low]
        low = high


_IS_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def words_in(data: np.ndarray, ends: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and how many words come before each text and before the end.

    Words are runs of anything but ASCII white space; `fold` takes A-Z for a-z. A hash adds up a number for each byte, of up to 32 bytes
    for all words at once; longer words have one of their own. It is the same in every process.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    inside = ~_IS_SPACE[data]
    begins, closes = inside.copy(), inside.copy()
    edge = np.zeros(len(data) + 1, bool)  # a text's end parts words too
    edge[ends] = True
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    lengths = stops - starts
    numbers = _NUMBERS[int(fold)]
    order = np.argsort(-np.minimum(lengths, 33), kind="stable")
    at, sizes = starts[order], lengths[order]
    hashes = np.zeros(len(at), np.uint64)
    longer = np.searchsorted(-np.minimum(sizes, 33), -np.arange(33), "left")  # words of more than n bytes
    for n in range(32):
        some = longer[n]
        if not some:
            break
        hashes[:some] = hashes[:some] * _FACTOR + numbers[data[at[:some] + n]]
    for place in range(longer[32]):
        word = data[at[place]:at[place] + sizes[place]].tobytes()
        hashes[place] = hash64(word.lower() if fold else word)
    found = np.empty_like(hashes)
    found[order] = mix(hashes)
    return found, np.searchsorted(starts, ends)


def hash64(word: bytes) -> int:
    """A 64-bit hash that is the same in every process."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NUMBERS = np.stack([mix(np.arange(1, 257, dtype=np.uint64) * _FACTOR)] * 2)
_NUMBERS[1, 65:91] = _NUMBERS[1, 97:123]


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs of `values` after one another."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BEYOND = "[\\x{130}-\\x{10ffff}]"
_RUNS = "  |\n\n|\n | \n|[\t\r\x0b\x0c\\x{85}\\x{a0}\\x{130}-\\x{10ffff}\\x00]"
_CHUNK = re.compile(r"\s+(?!\S)| ?\S+|\s")


#: Byte-level vocabularies write every byte as a sign: those of printable Latin-1 signs as themselves, the others as signs from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [byte for byte in range(256) if byte not in _PRINTABLE]
_BYTE_SIGNS = [chr(byte if byte in _PRINTABLE else 256 + _OTHERS.index(byte)) for byte in range(256)]


class Encoder:
    """Ids of a public tokenizer for whole texts, by the tokenizers library.

    Both vocabularies split a text before merging, and white space always ends a piece, so the ids of a text are those of its chunks
    between white space; a run of letters and the signs after it are pieces of their own too. Chunks of many texts are cut and counted as
    different ones by Arrow; each different run is encoded once and remembered. Where there are more than `bound`, those looked up least
    are forgotten and encoded again when they come back. New runs of letters go to the library's model, without the steps before it that
    leave them as they are; everything else goes through the whole of it. Ids are then gathered for all texts at once. `spaced` tells a
    byte-level vocabulary, whose pieces keep the space before them, from one that lower-cases and drops white space.
    """

    def __init__(self, path: str, spaced: bool, bound: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced, self.bound = spaced, bound
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        # special tokens, and characters that are white space for Python alone
        special = (*(token.content for token in self.tokenizer.get_added_tokens_decoder().values()), *"\x1c\x1d\x1e\x1f")
        self.special = "|".join(re.escape(one) for one in special)
        self.forget()

    def forget(self) -> None:
        """Begin with an empty memory: number of a run or chunk, and where its ids are."""
        self.numbers: tuple[dict[str, int], dict[str, int]] = ({}, {})  # of chunks of any kind, of runs of letters
        self.ids = np.zeros(0, self.kind)
        self.starts, self.lengths, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def shrink(self) -> None:
        """Remember only the half that was looked up most, of equal ones the latest; what was long ago counts less each time."""
        half = min(len(self.used), self.bound) // 2
        kept = np.sort(np.argsort(self.used, kind="stable")[len(self.used) - half:])
        after = np.full(len(self.used), -1, np.int64)
        after[kept] = np.arange(len(kept))
        renumbered = after.tolist()
        self.numbers = tuple({name: renumbered[number] for name, number in some.items() if renumbered[number] >= 0} for some in self.numbers)
        self.ids, self.lengths, self.used = gathered(self.ids, self.starts[kept], self.lengths[kept]), self.lengths[kept], self.used[kept] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts by the whole of the library."""
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def known(self, different: pa.Array, letters: bool) -> np.ndarray:
        """Numbers of different runs of letters, or of chunks of any kind; new ones are encoded."""
        numbers, names = self.numbers[letters], different.to_numpy(zero_copy_only=False).tolist()
        found = np.fromiter(map(numbers.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(found < 0)
        fresh = [names[place] for place in new.tolist()]
        ids, lengths = array("I"), []
        if letters:  # straight to the model, as pieces that the steps before it would leave as they are
            tokenize, signs = self.model.tokenize, _BYTE_SIGNS
            for name in fresh:
                tokens = tokenize(name.replace(" ", "Ġ") if name.isascii() else "".join([signs[byte] for byte in name.encode()]))
                lengths.append(len(tokens))
                ids.extend([token.id for token in tokens])
        else:
            for at in range(0, len(fresh), 2000):
                for one in self.whole(fresh[at:at + 2000]):
                    lengths.append(len(one))
                    ids.extend(one)
        if fresh:
            sizes, count = np.array(lengths, np.int64), len(self.starts)
            numbers.update(zip(fresh, range(count, count + len(fresh))))
            found[new] = np.arange(count, count + len(fresh))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.lengths = np.concatenate([self.lengths, sizes])
            self.ids = np.concatenate([self.ids, np.frombuffer(ids, np.uint32).astype(self.kind)])
            self.used = np.concatenate([self.used, np.zeros(len(fresh), np.int64)])
        self.used[found] += 1
        return found

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks after one another, and how many each has."""
        coded = pc.dictionary_encode(chunks)
        different, places = coded.dictionary, np.asarray(coded.indices)
        runs = pc.utf8_rtrim(different, characters=_SIGNS)
        letters = np.asarray(pc.utf8_is_alpha(pc.utf8_ltrim(runs, characters=" ") if self.spaced else runs))
        first, second = np.zeros(len(different), np.int64), np.full(len(different), -1, np.int64)
        lettered, others = np.flatnonzero(letters), np.flatnonzero(~letters)
        words = pc.dictionary_encode(runs.take(pa.array(lettered)))
        first[lettered] = self.known(words.dictionary, True)[np.asarray(words.indices)]
        first[others] = self.known(different.take(pa.array(others)), False)
        ended = lettered[np.asarray(pc.not_equal(pc.binary_length(runs), pc.binary_length(different)))[lettered]]
        if len(ended):  # the signs after the letters: the rest of the chunk's bytes
            some = pc.cast(different.take(pa.array(ended)), pa.large_binary())
            offsets = np.frombuffer(some.buffers()[1], np.int64)[:len(some) + 1]
            begins = offsets[:-1] + np.asarray(pc.binary_length(runs.take(pa.array(ended))), np.int64)
            rest = gathered(np.frombuffer(some.buffers()[2], np.uint8), begins, offsets[1:] - begins)
            ends = np.concatenate([[0], np.cumsum(offsets[1:] - begins)])
            signs = pc.dictionary_encode(pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(rest)))
            second[ended] = self.known(signs.dictionary, False)[np.asarray(signs.indices)]
        starts, lengths = np.append(self.starts, 0), np.append(self.lengths, 0)  # no second part: number -1
        parts = np.stack([first, second], axis=1).ravel()
        flat, sizes = gathered(self.ids, starts[parts], lengths[parts]), lengths[parts].reshape(-1, 2).sum(axis=1)
        counts = sizes[places]
        return gathered(flat, (np.cumsum(sizes) - sizes)[places], counts), counts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and where each begins and the last ends; null is read as empty."""
        if max(len(self.starts), len(self.ids) // 16) > self.bound:  # long chunks without a space count by their ids
            self.shrink()
        texts = pc.cast(texts.fill_null(""), pa.large_string())
        special = np.asarray(pc.match_substring_regex(texts, self.special))
        odd = np.asarray(pc.match_substring_regex(texts, _RUNS if self.spaced else _BEYOND))
        kinds = np.where(special | (odd & (not self.spaced)), 2, np.where(odd, 1, 0))
        flats, begins, sizes, base = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), 0
        for kind in (0, 1, 2):
            rows = np.flatnonzero(kinds == kind)
            if not len(rows):
                continue
            some = texts.take(pa.array(rows)) if len(rows) < len(texts) else texts
            if kind == 2:
                encoded = self.whole(some.to_pylist())
                lengths, flat = np.array([len(one) for one in encoded], np.int64), np.array([id_ for one in encoded for id_ in one], self.kind)
            else:
                if kind == 1:
                    split = pa.array([_CHUNK.findall(text) for text in some.to_pylist()], pa.large_list(pa.large_string()))
                elif self.spaced:  # single spaces and line ends only: a space begins the chunk after it, a line end is a chunk
                    split = pc.split_pattern(pc.replace_substring(pc.replace_substring(some, " ", "\0 "), "\n", "\0\n\0"), "\0")
                else:  # such letters are composed already and have one lower-case form
                    split = pc.utf8_split_whitespace(pc.utf8_lower(some))
                flat, counts = self.chunk_ids(split.flatten())
                totals = np.concatenate([[0], np.cumsum(counts)])
                edges = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(split), np.int64))])
                lengths = np.diff(totals[edges])
            flats.append(flat)
            sizes[rows] = lengths
            begins[rows] = base + np.cumsum(lengths) - lengths
            base += len(flat)
        ids = np.concatenate(flats) if flats else np.zeros(0, self.kind)
        if len(flats) > 1:
            ids = gathered(ids, begins, sizes)
        return ids, np.concatenate([[0], np.cumsum(sizes)])


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches into ones with about `most` bytes in a column, one row at least."""
    for batch in batches:
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
        low = 0
        while low < len(batch):
            high = max(int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + most, "right")), low + 1)
            yield batch.slice(low, high - low)
            low = high
