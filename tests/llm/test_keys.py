"""Keys that must come through unchanged: beyond 2 ** 53 beside nulls, and null keys among equal rows."""

import public_tokenizers
import pytest

from ramure.llm.common import table
from ramure.llm.near_dedup import Similarity, deduplicate, link_documents
from ramure.llm.packing import pack_documents
from ramure.llm.token_counts import count_tokens
from ramure.llm.token_ids import round_trip
from ramure.llm.warc import archive_round_trip

LARGE = [2**60 + n for n in (1, 3, 5)]


def keys(df, name="doc_id"):
    return sorted((row[name] for row in df.select(name).collect()), key=lambda key: (key is None, key))


@pytest.fixture
def large(make_docs):
    return make_docs([(key, f"text number {at} of some") for at, key in enumerate(LARGE)] + [(None, "text without a key")])


def test_large_keys_beside_null(spark, large):
    byte, word = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    expected = [*LARGE, None]
    linked = link_documents(large)
    assert keys(linked) == expected and keys(linked, "component_id") == expected
    assert keys(count_tokens(large, byte)) == expected
    assert keys(pack_documents(large, byte)) == expected
    assert keys(round_trip(large, word, spaced=False, end_id=2)) == expected


def test_large_keys_of_pages_with_equal_payloads(spark):
    html = "<p>" + "x" * 200 + "</p>"
    rows = [(LARGE[1], "http://b", html), (LARGE[0], "http://a", html), (LARGE[2], "http://c", "other"), (None, None, None), (None, "http://d", html)]
    read = archive_round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(((row["page_id"], row["record_type"], row["refers_to"]) for row in read), key=str) == sorted([
        (LARGE[0], "response", None), (LARGE[1], "revisit", LARGE[0]), (LARGE[2], "response", None), (None, "response", None),
        (None, "revisit", LARGE[0])], key=str)
    assert [bytes(row["payload"]).decode() for row in read if row["page_id"] == LARGE[0]] == [html]


def test_a_null_key_never_names_a_component_with_others(spark, make_docs):
    text = "one two three four five six seven eight"
    docs = make_docs([(7, text), (None, text), (5, text), (None, "quite another text than that one"), (None, "")])
    rows = {(row["doc_id"], row["component_id"], row["kept"]) for row in link_documents(docs, Similarity(shingle=3, percent=85)).collect()}
    assert rows == {(5, 5, True), (7, 5, False), (None, 5, False), (None, None, True)}
    kept = deduplicate(docs)
    assert keys(kept) == [5, None, None] and kept.columns == docs.columns


def test_stages_keep_columns_and_take_awkward_rows(spark, awkward):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    columns = table(spark, folder, "documents").columns
    for docs in (awkward, awkward.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs.select(*columns), folder)
            assert result.columns == columns and set(keys(result)) <= set(keys(docs)), name
        assert set(keys(corpus_pipeline.packing(spark, docs.select(*columns), folder))) == set(keys(docs))
