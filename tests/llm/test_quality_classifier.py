import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ramure.llm.quality_classifier import FEATURES, accept, coordinate_descent, fit, indicators, log_count_ratios, train, with_scores


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = train(docs, labels.where(~held))
    scored = with_scores(docs.select("doc_id", "text"), model).where(held).join(labels, "doc_id")
    rows = [(row["score"], row["quality"]) for row in scored.select("score", "quality").collect()]
    assert all(0 <= score <= 1 for score, _ in rows)
    good = [score >= 0.3 for score, quality in rows if quality == 1]
    bad = [score < 0.3 for score, quality in rows if quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) > 0.9
    # the scores are chances: their mean is near the share of label 1
    assert abs(np.mean([score for score, _ in rows]) - np.mean([quality for _, quality in rows])) < 0.05


def test_ratios_and_descent():
    rows = [np.array([1, 2, FEATURES - 1]), np.array([1, 3, FEATURES - 1]), np.array([2, FEATURES - 1]), np.array([3, 4, FEATURES - 1])]
    labels = np.array([1, 0, 1, 0])
    ratios = log_count_ratios(rows, labels)
    assert ratios[2] > 0.5 and ratios[3] < -0.5 and abs(ratios[1]) < 0.1 and ratios[FEATURES - 1] == 1.0
    weights = coordinate_descent(rows, labels, ratios, cost=10.0, epochs=200)
    for row, label in zip(rows, labels):
        values = ratios[row] / np.linalg.norm(ratios[row])
        assert float(weights[row] @ values) * (1 if label else -1) > 0.95  # outside the margin, as the classes can be told apart


@pytest.mark.parametrize("labels, share", [([], 0.5), ([1, 1], 1.0), ([0], 0.0)])
def test_one_label_or_none(labels, share):
    model = fit([*indicators(pa.array(["a b"]))] * len(labels), np.array(labels, np.int64))
    assert model.scores(pa.array(["anything", None])).tolist() == pytest.approx([share, share], abs=1e-6)


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(5, 0), (5, 1), (4, 1), (8, 1), (10, 0), (None, 1), (1, None), (99, 1)], "doc_id long, quality int")
    model = train(awkward, labels)
    scored = with_scores(awkward, model)
    rows = [(row["doc_id"], row["score"]) for row in scored.collect()]
    assert len(rows) == 11 and all(score is not None and 0 <= score <= 1 for _, score in rows)
    assert len({score for doc_id, score in rows if doc_id in (1, 2, 7)}) == 1
    assert accept(awkward, model, 0.0).columns == awkward.columns and accept(awkward, model, 0.0).count() == 11
    assert with_scores(awkward.limit(0), train(awkward.limit(0), labels)).count() == 0


def test_the_descent_reaches_the_dual_optimum():
    """Against projected gradient steps on the whole dual of a few dozen drawn rows."""
    draw = np.random.default_rng(3)
    rows = [np.append(np.unique(draw.integers(0, 40, draw.integers(1, 9))), FEATURES - 1) for _ in range(60)]
    labels = (draw.random(60) < 0.4).astype(np.int64)
    ratios = log_count_ratios(rows, labels)
    weights = coordinate_descent(rows, labels, ratios, cost=0.7, epochs=3000)
    places = [*range(40), FEATURES - 1]
    values = np.array([[ratios[place] if place in set(row.tolist()) else 0.0 for place in places] for row in rows])
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    signs = np.where(labels == 1, 1.0, -1.0)
    bound = 0.7 * 60 / (2 * np.where(labels == 1, labels.sum(), 60 - labels.sum()))
    products = (values * signs[:, None]) @ (values * signs[:, None]).T
    dual = np.zeros(60)
    for _ in range(100_000):
        dual = np.clip(dual - (products @ dual - 1) / 60, 0, bound)
    np.testing.assert_allclose(weights[places], (dual * signs) @ values, atol=0.01)


def test_indicators_are_those_of_a_plain_dictionary():
    """As many features as a dictionary of words, pairs and runs has keys, equal keys equal features, and texts don't mix."""
    texts = ["one two one two three", "", None, "x", "ab ab  ab\tab", "zwölf Boxkämpfer", "one two"]
    found = [set(one.tolist()) for one in indicators(pa.array(texts))]
    alone = [set(next(indicators(pa.array([text]))).tolist()) for text in texts]
    assert found == alone
    for text, features in zip(texts, found):
        data = (text or "").encode()
        words = data.split()
        grams = {*words, *zip(words, words[1:]), *((data[n:n + 3],) for n in range(len(data) - 2))}
        assert len(grams) + 4 - 3 <= len(features) <= len(grams) + 4
    assert found[1] == found[2] and len(found[0] & found[6]) > 6


def test_fitting_holds_no_copies_of_the_indicators():
    """Counting and descent work on the rows as collected; values of all rows at once would be twice their size or more."""
    import tracemalloc

    from ramure.llm.quality_classifier import FEATURES, coordinate_descent, log_count_ratios

    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, FEATURES, 10_000)).astype(np.int32) for _ in range(600)]
    labels = np.arange(600) % 2
    tracemalloc.start()
    ratios = log_count_ratios(rows, labels)
    coordinate_descent(rows, labels, ratios, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(row.nbytes for row in rows)
