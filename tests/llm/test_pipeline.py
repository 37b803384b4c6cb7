import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from ramure.llm.common import stored
from ramure.llm.queries import ORACLES, QUERIES
from test_decontaminate import brute as leaks
from test_near_dedup import brute as groups
from test_secrets import brute as spans

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, by name."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {"documents": docs}
    for name, stage in pipeline.STAGES:
        docs = found[name] = stored(stage(spark, docs, FOLDER), name)
    return {name: {row[0]: row for row in df.collect()} if name != "packing" else df.collect() for name, df in found.items()} | {
        "columns": {name: df.columns for name, df in found.items()}}


def test_stages_equal_brute_force(spark, stages):
    columns = stages["columns"]
    assert all(columns[name] == columns["documents"] for name, _ in pipeline.STAGES[:-1])
    before = stages["quality_classifier"]
    kept = {doc_id for doc_id, _, _, stays in groups([(n, row["text"]) for n, row in before.items()], 5, 80) if stays}
    assert set(stages["near_dedup"]) == kept < set(before)
    items = [(row["item_id"], row["text"]) for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = {doc_id for doc_id, _ in leaks([(n, row["text"]) for n, row in stages["near_dedup"].items()], items)}
    assert set(stages["decontamination"]) == kept - found
    assert set(stages["secret_scan"]) == set(stages["decontamination"])
    for n, row in stages["secret_scan"].items():
        old = stages["decontamination"][n]
        assert (row["text"] == old["text"]) == (not spans(old["text"])) and not spans(row["text"]) and row["n_chars"] == len(row["text"])
    ids, whole = defaultdict(list), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in sorted(stages["packing"], key=lambda row: row["piece"]):
        ids[row["doc_id"]] += np.frombuffer(row["ids"], "<u4").tolist()
    assert ids == {n: [*whole.encode(row["text"], add_special_tokens=False).ids, 0] for n, row in stages["secret_scan"].items()}


def test_the_classifier_rejects_bad_documents_only(spark, stages):
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = set(stages["documents"]) - set(stages["quality_classifier"])
    known = Counter(labels[n] for n in gone if n in labels)
    assert known[0] > 0 and known[1] <= 1


def test_run_and_registration(spark):
    found = contract.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES} and set(QUERIES) < set(found)
    assert found["pipeline"] is pipeline.run and "pipeline" not in contract.oracle_sql()
    assert pipeline.run(spark, FOLDER).columns == ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    rows = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(rows.columns)
    assert Counter(map(tuple, result.fetchall())) == Counter(tuple(row) for row in rows.select(*names).collect())


def test_brute_force_of_ids(spark):
    """The queries on ids against whole texts in the library."""
    docs = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    whole, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    found = {row["doc_id"]: tuple(row)[1:] for row in QUERIES["op7_token_ids"](spark, FOLDER).collect()}
    for doc_id, text in docs:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert found[doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
