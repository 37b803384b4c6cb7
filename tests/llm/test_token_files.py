import io
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ramure.llm.common import Encoder, shared_folder
from ramure.llm.token_ids import FileWriter, decode_values, encode_values, read_file, read_token_files, round_trip, write_token_files

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
FRAGMENTS = ["token", "Don't", " ", "  ", "\n", "\n\n", "é", "É", "İ", "Σας", "日本", "1234", "a1", "'s", "x'", "<|endoftext|>", "\t", " ",
             "\x1c", "\x85", "\x0b", "ß", "²", "_", "...", "|", "a|b", "​", "\r\n", "ĳ"]


@pytest.fixture(scope="module")
def encoders():
    return {(path, spaced): (Encoder(path, spaced, bound=40), Tokenizer.from_file(path)) for path, spaced in ((WORD, False), (BYTE, True))}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(FRAGMENTS), max_size=9).map("".join), max_size=5))
def test_ids_equal_those_of_whole_texts(encoders, texts):
    for encoder, whole in encoders.values():
        ids, ends = encoder(pa.array(texts, pa.string()))
        assert [ids[low:high].tolist() for low, high in zip(ends, ends[1:])] == [whole.encode(text, add_special_tokens=False).ids for text in texts]


def test_frequent_runs_stay_in_a_full_memory():
    """Runs of every batch are encoded once, however many others come between; before, a full memory forgot them all."""

    class Counting:
        def __init__(self, model):
            self.model, self.asked = model, Counter()

        def tokenize(self, run):
            self.asked[run] += 1
            return self.model.tokenize(run)

    letters = "abcdefghijklmnopqrst"
    batches = [[f"water stone house {a}{b}{c}" for b in letters for c in "xyz"] for a in letters]
    for path, spaced in ((WORD, False), (BYTE, True)):
        encoder, whole = Encoder(path, spaced, bound=200), Tokenizer.from_file(path)
        encoder.model = counting = Counting(encoder.model)
        for texts in batches:
            ids, ends = encoder(pa.array(texts))
            assert [ids[low:high].tolist() for low, high in zip(ends, ends[1:])] == [whole.encode(text, add_special_tokens=False).ids for text in texts]
            assert len(encoder.starts) <= 200 + 63
        frequent = ["water", "Ġstone", "Ġhouse"] if spaced else ["water", "stone", "house"]
        assert [counting.asked[run] for run in frequent] == [1, 1, 1]


def test_long_chunks_are_forgotten_by_their_ids():
    """A memory of few chunks is full too, if they are long."""
    encoder, whole = Encoder(BYTE, True, bound=200), Tokenizer.from_file(BYTE)
    for n in range(40):
        text = f"https://{n}/" + "%2f7" * 200
        ids, _ = encoder(pa.array([text]))
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(encoder.ids) <= 16 * 200 + 1000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_values_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = encode_values(values)
    assert len(control) == -(-len(values) // 4)
    assert decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)).tolist() == values.tolist()


def test_file_round_trip():
    table = np.array([7, 3, 900, 5], np.uint32)
    docs = [(None, [7, 7, 900]), (1, []), (2, [5] * 70_000), (3, [3]), (4, [])]
    out = io.BytesIO()
    writer = FileWriter(out, table)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, np.uint16))
    writer.close()
    read = [(doc_id, start, ids.tolist()) for doc_id, start, ids in read_file(out.getvalue())]
    starts = np.cumsum([0, *[len(ids) for _, ids in docs]])[:-1].tolist()
    assert read == [(doc_id, start, ids) for (doc_id, ids), start in zip(docs, starts)]
    with pytest.raises(ValueError):
        list(read_file(out.getvalue()[:-1] + b"x"))


def test_many_files_are_in_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = shared_folder(spark, "test-files")
    manifest = write_token_files(docs, folder, WORD, False, 2, file_tokens=20_000)
    assert manifest.count() > 3
    rows = read_token_files(spark, folder, manifest).orderBy("start").collect()
    whole, start = Tokenizer.from_file(WORD), 0
    for row, doc in zip(rows, docs.orderBy("doc_id").collect(), strict=True):
        ids = np.array([*whole.encode(doc["text"], add_special_tokens=False).ids, 2], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc["doc_id"], start, len(ids))
        assert zlib.crc32(row["ids"]) == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_awkward_rows(awkward):
    rows = round_trip(awkward, WORD, False, 2).orderBy(F.col("start")).collect()
    assert [row["doc_id"] for row in rows] == [None, 1, 2, 3, 4, 5, 5, 7, 8, 9, 10]
    assert {row["doc_id"]: row["n_tokens"] for row in rows}[1] == 1
    assert round_trip(awkward.limit(0), WORD, False, 2).count() == 0
