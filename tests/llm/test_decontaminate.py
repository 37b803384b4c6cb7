import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ramure.llm.decontaminate import MASKS, SHORT_MASKS, SUBSTITUTIONS, WINDOW, contaminated, decontaminate, find_overlaps


def tokens(text):
    return [token for token in re.split(r"[\W_]+", (text or "").lower()) if token]


def brute(docs, items):
    """(document, item) pairs by trying every alignment."""
    pairs = set()
    for item_id, text in items:
        item = tokens(text)
        width = min(WINDOW, len(item))
        need = width - width * SUBSTITUTIONS // WINDOW
        places = defaultdict(list)
        for at, token in enumerate(item):
            places[token].append(at)
        for doc_id, body in docs:
            doc = tokens(body)
            for shift in {at - there for at, token in enumerate(doc) for there in places.get(token, ())}:
                equal = [0 <= at + shift < len(doc) and doc[at + shift] == item[at] for at in range(len(item))]
                if len(item) >= 5 and max(sum(equal[at:at + width]) for at in range(len(item) - width + 1)) >= need:
                    pairs.add((doc_id, item_id))
                    break
    return pairs


def test_table_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    expected = brute([(row["doc_id"], row["text"]) for row in docs.collect()], [(row["item_id"], row["text"]) for row in items.collect()])
    found = contaminated(docs, items)
    assert {(row["doc_id"], row["item_id"]) for row in found.collect()} == expected and expected
    left = {row["doc_id"] for row in decontaminate(docs, items).select("doc_id").collect()}
    assert left == {row["doc_id"] for row in docs.select("doc_id").collect()} - {doc_id for doc_id, _ in expected}


@pytest.fixture(scope="module")
def items(spark):
    words = [f"word{n}" for n in range(200)]
    rows = [(1, " ".join(words[:30])), (2, " ".join(words[30:42])), (3, "the of"), (4, None), (5, ""), (6, " ".join(words[100:130])),
            (6, " ".join(words[100:130])), (None, " ".join(words[:30]))]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("seed", F.lit("own"))


def test_substitutions_and_awkward_rows(awkward, make_docs, items):
    words = [f"Word{n}" for n in range(200)]

    def replaced(start, end, *places):
        return "before, " + "; ".join("other" if at in places else word for at, word in enumerate(words[start:end])) + " after"

    rows = [(101, replaced(0, 30)), (102, replaced(0, 30, 4, 12, 20, 28)), (103, replaced(0, 13, 3, 7, 9)), (104, replaced(0, 13, 3, 5, 7, 9)),
            (105, replaced(0, 10)), (106, replaced(30, 42)), (107, replaced(30, 42, 3, 8)), (108, replaced(100, 130) * 50), (108, replaced(100, 130) * 50),
            (109, replaced(0, 30) + replaced(100, 130)), (110, "the of the of"), (None, replaced(0, 30))]
    docs = awkward.union(make_docs(rows))
    found = {(row["doc_id"], row["item_id"]): row for row in contaminated(docs, items).collect()}
    assert set(found) == {(101, 1), (102, 1), (103, 1), (105, 1), (106, 2), (107, 2), (108, 6), (109, 1), (109, 6)}
    assert (found[101, 1]["position"], found[101, 1]["matched"]) == (1, 13) and found[103, 1]["matched"] == 10
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(row["doc_id"] or 0 for row in left.collect()) == sorted([row["doc_id"] or 0 for row in awkward.collect()] + [104, 110])
    assert contaminated(docs.limit(0), items).count() == 0 and contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == docs.count()


def test_seeds_tolerate_substitutions():
    """Of 13 tokens with three random substitutions most alignments hold a seed; an item of 30 with one in eight replaced nearly always."""
    rng = random.Random(5)

    def share(size, count):
        hits = 0
        for _ in range(2000):
            other = set(rng.sample(range(size), count))
            hits += any(all(at + n not in other for n, sign in enumerate(mask) if sign == "1")
                        for mask in MASKS for at in range(size - len(mask) + 1))
        return hits / 2000

    assert share(13, 1) > 0.99 and share(13, 2) > 0.9 and share(30, 4) > 0.99


@pytest.mark.parametrize("size", range(5, WINDOW + 1))
def test_a_seed_is_left_by_every_layout(size):
    masks = MASKS if size == WINDOW else [*MASKS, *SHORT_MASKS]
    for other in itertools.combinations(range(size), size * SUBSTITUTIONS // WINDOW):
        assert any(all(at + n not in other for n, sign in enumerate(mask) if sign == "1")
                   for mask in masks for at in range(size - len(mask) + 1)), other


def test_short_items_equal_brute_force(spark, make_docs):
    texts = {size: [f"item{size}word{n}" for n in range(size)] for size in (4, 5, 6, 7, 9, 13)}
    rows, doc_id = [], 1000
    for size, words in texts.items():
        for count in range(size * SUBSTITUTIONS // WINDOW + 2):
            for other in itertools.combinations(range(size), min(count, 3)):
                doc_id += 1
                rows.append((doc_id, " ".join("other" if at in other else word for at, word in enumerate(words))))
    items = spark.createDataFrame([(size, " ".join(words)) for size, words in texts.items()], "item_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in contaminated(make_docs(rows), items).collect()}
    assert found == brute(rows, [(size, " ".join(words)) for size, words in texts.items()])
    assert {item for _, item in found} == {5, 6, 7, 9, 13}


def test_no_python_in_the_plan(spark, items):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = find_overlaps(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
