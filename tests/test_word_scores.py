"""The naive Bayes models fitted on sums and scored by words are those of Spark ML on rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from tables import values
from ramure.functions import codes
from ramure.functions.ngrams import words
from ramure.operators import models, word_scores


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    names = ["".join(draw.choices("abéño€ß", k=draw.randint(1, 9))) for _ in range(40)]
    data = [(i, " ".join(draw.choices(names, k=i % 5)) if i % 11 else None, f"{draw.randint(1, 3):02}.{draw.randint(1, 2)}.{draw.randint(1, 2)}") for i in range(240)]
    df = spark.createDataFrame([*data, (None, "seul", "09.1"), (5, "abé  abé", None)], "id int, text string, code string")
    return codes.with_levels(df).withColumn("code8", codes.code_prefix("code")).cache()


def test_hashes_are_those_of_hashing_tf(spark):
    draw = random.Random(1)
    grams = [""] + ["".join(draw.choices("abé€𝄞 <>z", k=n % 9 + 1)) for n in range(300)]
    hashing = HashingTF(inputCol="g", outputCol="f", numFeatures=1000)
    expected = [row["f"].indices[0] for row in hashing.transform(spark.createDataFrame([(i, [gram]) for i, gram in enumerate(grams)], "i int, g array<string>"))
                .orderBy("i").collect()]
    assert word_scores.hashed(pa.array(grams), 1000).tolist() == expected


@pytest.mark.parametrize("tokens", [None, 150])
def test_flat_model_is_that_of_spark_ml(rows, tokens):
    fitted = models.fit_flat(rows, num_features=1 << 9, num_tokens=tokens)
    kept = models.tr.filter_rare(rows.select("id", "text", "code8"), "code8")
    train = models.tr.stratified_split(kept, "code8").where("NOT is_validation")
    features = models.ngram_features(models._indexer(kept, "code8").transform(train), num_features=1 << 9, vocabulary=fitted.vocabulary)
    expected = NaiveBayes(featuresCol="features", labelCol="__code8_index").fit(features)
    found = fitted.stages.stages[0]
    assert np.array_equal(found.theta.toArray(), expected.theta.toArray()) and np.array_equal(found.pi.toArray(), expected.pi.toArray())
    # every row with what Spark ML makes of its features
    scored = fitted.stages.transform(models.ngram_features(rows, num_features=1 << 9, vocabulary=fitted.vocabulary))
    ranked = scored.withColumn("p", models._ranked(F.col("flat_probability"), fitted.labels, 3))
    plain = ranked.select("id", "text", "code", F.transform("p", lambda x: x["code"]).alias("c"), F.transform("p", lambda x: F.round(x["confidence"], 9)).alias("p"))
    got = fitted.predict(rows, top_k=3).select("id", "text", "code", F.transform("predictions", lambda x: x["code"]).alias("c"),
                                               F.transform("predictions", lambda x: F.round(x["confidence"], 9)).alias("p"))
    assert values(got, "*") == values(plain, "*") and got.count() == 242


def test_steps_and_memory_do_not_matter(rows, monkeypatch):
    fitted = models.fit_flat(rows, num_features=1 << 9)
    texts = pa.array([row["w"] for row in rows.select(words(F.coalesce("text", F.lit(""))).alias("w")).collect()], pa.list_(pa.string()))
    weights = word_scores.weights(fitted.stages.stages[0], fitted.labels, 1 << 9)
    whole = word_scores.Scorer(weights, 20).best(texts).to_pylist()
    assert [len(found) for found in whole] == [len(fitted.labels)] * 242
    monkeypatch.setattr(word_scores, "KEPT", 3 * len(fitted.labels))
    monkeypatch.setattr(word_scores, "CELLS", 7 * len(fitted.labels))
    for one, other in zip(word_scores.Scorer(weights, 20).best(texts).to_pylist(), whole):
        assert [pair["code"] for pair in one] == [pair["code"] for pair in other]
        assert np.allclose([pair["confidence"] for pair in one], [pair["confidence"] for pair in other], rtol=1e-9)


def test_rows_are_counted_as_words_and_scored_without_a_column_of_probabilities(rows):
    sums = models._text_sums(rows, "code8", "text", 1 << 9)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[code8#\d+, __word#", plan)
    # no sum of a label, as long as all features, is shuffled in parts
    aggregates = [line for line in plan.splitlines() if "Aggregate(" in line or "Exchange" in line]
    assert "aggregate_metrics" in aggregates[0] and "aggregate_metrics" in aggregates[1], aggregates
    scored = models.fit_flat(rows, num_features=1 << 9).predict(rows)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in scored and "Exchange" not in scored and "flat_probability" not in scored


def test_ranks_do_not_sort_once_for_every_class(spark):
    vector = spark.createDataFrame([([0.2, 0.5, 0.3],)], "p array<double>").select(models._ranked(models_vector("p"), ["a", "b", "c"], 2).alias("r"))
    assert [tuple(pair) for pair in vector.first()["r"]] == [("b", 0.5), ("c", 0.3)]
    # within the function called for each class there is no sort
    text = vector._jdf.queryExecution().analyzed().toString()
    inner = re.findall(r"zip_with\((?:[^()]|\([^()]*\))*?lambdafunction\(CASE WHEN (.*?) THEN", text)
    assert inner and not any("sort_array" in part for part in inner)


def models_vector(name):
    from pyspark.ml.functions import array_to_vector
    return array_to_vector(F.col(name))


@pytest.fixture(scope="module")
def fed(rows):
    """Rows with a code above and its confidence, some without, some unknown."""
    code = F.when(F.col("id") % 4 == 0, "03").when(F.col("id") % 4 == 1, "01").when(F.col("id") % 4 == 2, "99")
    return rows.withColumns({"__code": code, "__confidence": F.when(F.col("id") % 5 > 0, (F.col("id") % 11) / 10.0)}).cache()


def test_level_model_is_that_of_spark_ml(fed):
    fitted = models._fit_level(fed, 2, "id", 2, 0.5, 42, "bayes", first=False, num_features=1 << 9)
    kept = models.tr.filter_rare(fed, "level2")
    indexer, parents = models._indexer(kept, "level2"), list(models._indexer(kept, "level1").labels)
    assert (fitted.labels, fitted.parents) == (list(indexer.labels), parents)
    drawn = models.seeded_fraction(42, F.lit(2), F.col("id")) < 0.5
    used = F.when(drawn & F.col("__code").isNotNull(), F.col("__code")).otherwise(F.col("level1"))
    ready = models._with_parent(kept, parents, used, models.bucket_confidence(F.coalesce("__confidence", F.lit(0.9))))
    encoding, assembler = fitted.stages.stages[:2]
    features = assembler.transform(encoding.transform(models.ngram_features(indexer.transform(ready), num_features=1 << 9)))
    expected = NaiveBayes(featuresCol="__all2", labelCol="__level2_index").fit(features)
    found = fitted.stages.stages[2]
    assert np.array_equal(found.theta.toArray(), expected.theta.toArray()) and np.array_equal(found.pi.toArray(), expected.pi.toArray())


def test_codes_between_levels_are_those_of_spark_ml(fed):
    fitted = models._fit_level(fed, 2, "id", 2, 0.5, 42, "bayes", first=False, num_features=1 << 9)
    previous = F.struct(F.col("__code").alias("code"), F.coalesce("__confidence", F.lit(0.5)).alias("confidence"))
    best = F.get(F.col("alternatives2"), F.lit(0))
    plain = models._score_level(models.ngram_features(fed, num_features=1 << 9), fitted, previous, 1)
    expected = values(plain, "id", "text", best["code"], F.round(best["confidence"], 9))
    assert values(models._choose(fed, fitted, "text", 1 << 9), "id", "text", "__code", F.round("__confidence", 9)) == expected


def test_nothing_is_predicted_when_all_levels_are_there(rows, tmp_path, monkeypatch):
    settings = {"max_level": 2, "min_samples": 10, "num_features": 1 << 8}
    stored = models.fit_hierarchical(rows, **settings, save_to=str(tmp_path / "m"))

    def never(*_, **__):
        raise AssertionError("predicted or fitted again")

    for name in ("_choose", "_score_level", "_fit_level"):
        monkeypatch.setattr(models, name, never)
    resumed = models.fit_hierarchical(rows, **settings, resume_from=str(tmp_path / "m"))
    assert {n: model.labels for n, model in resumed.levels.items()} == {n: model.labels for n, model in stored.levels.items()}
