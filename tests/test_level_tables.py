"""Level classifiers as tables: fit, held-out rows, cascade against plain naive Bayes, tuning, saving and masks."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.functions import codes
from ramure.operators import level_tables as lt

PRODUCTS = {"pain": "01.1.1", "baguette": "01.1.2", "biere": "02.1.1", "vin": "02.1.2", "robe": "03.1.1", "pantalon": "03.1.2"}
EXTRAS = ("bio", "frais", "rouge", "petit", "grand", "bleu", "vert", "neuf", "doux", "rond")


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"{word} {extra}", code) for i, (word, code, extra) in enumerate((w, c, e) for e in EXTRAS for w, c in PRODUCTS.items())]
    return codes.with_levels(spark.createDataFrame(data, "id int, text string, code string")).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return lt.fit_levels(rows, max_level=3, min_samples=10)


def grams(text):
    return [f"<{w}>"[i:i + n] for w in text.split() for n in range(3, 7) for i in range(len(w) + 3 - n)]


def test_first_level_equals_plain_naive_bayes(spark, rows, fitted):
    tables, _ = fitted
    kept = {row["label"]: row["n"] for row in tables.classes.where("level = 1").collect()}
    assert set(kept) == {"01", "02", "03"} and sum(kept.values()) == 48  # a fifth of each division is set aside
    counts = {(row["label"], row["feature"][1:]): row["n"] for row in tables.counts.where("level = 1").collect()}
    vocabulary = {row["feature"][1:] for row in tables.vocabulary.collect()}
    totals = Counter()
    for (label, _), n in counts.items():
        totals[label] += n
    got = {row["text"]: (row["predicted_level1"], row["confidence_level1"]) for row in lt.predict_levels(tables, rows).collect()}
    for text in ("pain bio", "robe rond"):
        known = [gram for gram in grams(text) if gram in vocabulary]
        scores = {c: math.log((n + 1) / (48 + 3)) + sum(math.log((counts.get((c, gram), 0) + 1) / (totals[c] + len(vocabulary))) for gram in known)
                  for c, n in kept.items()}
        best = max(scores, key=scores.get)
        assert got[text] == (best, pytest.approx(math.exp(scores[best]) / sum(map(math.exp, scores.values())), abs=1e-9))


def test_report_counts_rows_set_aside(fitted):
    report = {row["level"]: row for row in fitted[1].collect()}
    assert {n: (row["n_classes"], row["n_train"], row["n_validation"]) for n, row in report.items()}[1] == (3, 48, 12)
    assert all(row["n_train"] + row["n_validation"] == 60 and row["accuracy"] == row["n_right"] / row["n_validation"] for row in report.values())
    assert report[1]["accuracy"] > 0.8


def test_saved_and_tuned_models(spark, rows, fitted, tmp_path):
    tables, _ = fitted
    tables.save(str(tmp_path / "m"))
    loaded = lt.LevelTables.load(spark, str(tmp_path / "m"))
    assert loaded.levels == (1, 2, 3) and values(loaded.counts, *loaded.counts.columns) == values(tables.counts, *tables.counts.columns)
    new = codes.with_levels(spark.createDataFrame([(1, "pain kiwi", "01.1.1"), (2, "pain kiwi", "09.9.9"), (3, None, "02.1.1")],
                                                  "id int, text string, code string"))
    tuned = lt.tune_levels(loaded, new, levels=(2,), weight=0.5)
    for level in (1, 3):  # untouched
        assert values(tuned.counts.where(F.col("level") == level), *tuned.counts.columns) == values(tables.counts.where(F.col("level") == level), *tuned.counts.columns)
    before = {row["label"]: row["n"] for row in tables.classes.where("level = 2").collect()}
    after = {row["label"]: row["n"] for row in tuned.classes.where("level = 2").collect()}
    assert {label: after[label] - before[label] for label in after} == {"01.1": 0.5, "02.1": 0.5, "03.1": 0.0}
    expected = values(tuned.classes, "level", "label", "n")
    tuned.save(str(tmp_path / "m"))  # a model can replace the one it was read from
    assert values(lt.LevelTables.load(spark, str(tmp_path / "m")).classes, "level", "label", "n") == expected


def test_one_beam_is_the_cascade_and_null_texts_are_scored(spark, rows, fitted):
    tables, _ = fitted
    more = rows.select("id", "text").union(spark.createDataFrame([(99, None), (100, "")], "id int, text string"))
    greedy = lt.predict_levels(tables, more).select("id", "predicted_code", F.round("combined_confidence", 9).alias("c"))
    beam = lt.predict_beams(tables, more, 1).select("id", "predicted_code", F.round("combined_confidence", 9).alias("c"))
    assert greedy.count() == 62
    got, expected = values(beam.where("id < 99"), "*"), values(greedy.where("id < 99"), "*")
    assert got == expected


def test_heads_give_children_of_the_code_above(rows):
    tables, _ = lt.fit_levels(rows, max_level=3, heads=True, min_samples=10)
    got = lt.predict_levels(tables, rows, top_k=2)
    assert got.where(~F.col("predicted_level2").startswith(F.col("predicted_level1")) | ~F.col("predicted_level3").startswith(F.col("predicted_level2"))).count() == 0
    assert got.where("confidence_level2 < 0.999999").count() == 0  # one child each


def test_nothing_to_train(rows):
    with pytest.raises(ValueError, match="no level"):
        lt.fit_levels(rows.limit(3))
