import itertools
import math

import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.operators import bayes, decode

CODES = {1: [("", "01"), ("", "02")], 2: [("01", "01.1"), ("01", "01.2"), ("02", "02.1")],
         3: [("01.1", "01.1.1"), ("01.1", "01.1.2"), ("01.2", "01.2.1"), ("02.1", "02.1.1"), ("02.1", "02.1.2")]}


def confidence(i, level, code):
    return ((i * 37 + level * 11 + sum(map(ord, code)) * 7) % 19 + 1) / 20


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(i, level, parent, code, confidence(i, level, code)) for i in range(20) for level, pairs in CODES.items() for parent, code in pairs]
    return spark.createDataFrame(rows, "id int, level int, parent_code string, code string, confidence double").cache()


def brute_cascade(i):
    path, parent = [], ""
    for level, pairs in CODES.items():
        options = sorted((-confidence(i, level, code), code) for p, code in pairs if p == parent)
        if options:
            path.append((level, options[0][1], -options[0][0]))
            parent = options[0][1]
    return path


def brute_beam(i, size):
    beams = [(0.0, ())]
    for level, pairs in CODES.items():
        grown = []
        for lp, path in beams:
            options = sorted((-confidence(i, level, code), code) for p, code in pairs if p == (path[-1] if path else ""))[:size]
            grown += [(lp + math.log(-neg), (*path, code)) for neg, code in options] or [(lp, path)]
        beams = sorted(grown, key=lambda beam: (round(-beam[0], 9), beam[1]))[:size]
    return beams


def test_cascade_against_brute_force(scores):
    got = {row["id"]: [(s["level"], s["code"], s["confidence"]) for s in row["path"]] for row in decode.cascade_decode(scores).collect()}
    assert got == {i: brute_cascade(i) for i in range(20)}


@pytest.mark.parametrize("size", [1, 2, 4])
def test_beam_against_brute_force(scores, size):
    got = {row["id"]: [tuple(beam["path"]) for beam in row["beams"]] for row in decode.beam_decode(scores, size).collect()}
    assert got == {i: [path for _, path in brute_beam(i, size)] for i in range(20)}


def test_beam_of_one_is_the_cascade(scores):
    beam = decode.beam_result(decode.beam_decode(scores, 1))
    cascade = decode.combine_confidence(decode.cascade_decode(scores))
    rounded = ["id", "final_code", "final_level", F.round("combined_confidence", 9)]
    assert values(beam, *rounded) == values(cascade, *rounded)


def test_skipped_level_keeps_the_parent(spark):
    rows = [(1, 1, None, "01", 0.5), (1, 3, "01", "01.1.1", 0.25)]
    df = spark.createDataFrame(rows, "id int, level int, parent_code string, code string, confidence double")
    row = decode.combine_confidence(decode.cascade_decode(df)).first()
    assert (row["final_code"], row["final_level"], row["combined_confidence"]) == ("01.1.1", "level3", 0.125)


def test_threshold_stops_before_the_first_low_level(spark):
    paths = [(1, [(1, "a", 0.9), (2, "b", 0.4), (3, "c", 0.8)]), (2, [(1, "a", 0.1)]), (3, [(1, "a", 0.5), (2, "b", 0.5)]), (4, [])]
    df = spark.createDataFrame(paths, f"id int, path {decode.PATH_TYPE}")
    got = values(decode.combine_confidence(df, 0.5), "id", "final_code", "final_level", "final_confidence", "combined_confidence")
    assert got == [(1, "a", "level1", 0.9, 0.9), (2, "", "", 0.0, 1.0), (3, "b", "level2", 0.5, 0.25), (4, "", "", 0.0, 1.0)]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.0999, 0.1, 0.95, 1.0, 1.5, -0.2)], "c double")
    assert [row[0] for row in df.select(decode.bucket_confidence(F.col("c"))).collect()] == [0, 0, 1, 9, 9, 9, 0]


def test_teacher_forcing_ends(spark):
    df = spark.createDataFrame([(i, "t", "p" if i % 2 else None, None) for i in range(40)], "id int, parent string, predicted_parent string, confidence double")
    assert {row[0] for row in decode.teacher_force(df, 2, 1.0).select("parent_used").collect()} == {"t"}
    always = decode.teacher_force(df, 2, 0.0)
    assert values(always.groupBy("parent_used", "bucket").count(), "*") == [("p", 9, 20), ("t", 9, 20)]


def test_mask_laws(spark):
    rows = [
        (1, 1, "01", 0.6), (1, 1, "02", 0.4), (1, 2, "01.1", 0.2), (1, 2, "01.2", 0.3), (1, 2, "02.1", 0.5),  # children share
        (2, 1, "01", 0.5), (2, 1, "02", 0.5), (2, 2, "01.1", 0.7), (2, 2, "01.2", 0.3), (2, 2, "02.1", 0.0),  # tie: highest; zero sum: even
        (3, 1, "03", 0.9), (3, 1, "01", 0.1), (3, 2, "01.1", 0.7), (3, 2, "01.2", 0.3)]  # parent without children
    probs = spark.createDataFrame(rows, "id int, level int, code string, p double")
    children = spark.createDataFrame([(2, "01", "01.1"), (2, "01", "01.2"), (2, "02", "02.1")], "level int, parent string, child string")
    got = {(row["id"], row["code"]): row["p"] for row in decode.mask_children(probs, children).where("level = 2").collect()}
    assert got == {(1, "01.1"): pytest.approx(0.4), (1, "01.2"): pytest.approx(0.6), (1, "02.1"): 0.0,
                   (2, "01.1"): 0.0, (2, "01.2"): 0.0, (2, "02.1"): 1.0, (3, "01.1"): 0.7, (3, "01.2"): 0.3}


def test_wide_columns_and_missing_alternatives(spark):
    long = spark.createDataFrame([(1, 1, 1, "01", 0.9), (1, 1, 2, "02", 0.8), (1, 2, 1, "01.1", 0.7)], "id int, level int, rank int, code string, confidence double")
    one = decode.to_wide(long, (1, 2), 1)
    assert one.columns == ["id", "predicted_level1", "confidence_level1", "predicted_level2", "confidence_level2"]
    three = decode.to_wide(long, (1, 2), 3).first().asDict()
    assert three["predicted_level1_top2"] == "02" and three["predicted_level2_top2"] == "" and three["confidence_level1_top3"] == 0.0
    assert "predicted_level2_top3" in three


def brute_bayes(train, text):
    def grams(t):
        return [f"<{w}>"[i:i + n] for w in t.split() for n in range(3, 7) for i in range(len(w) + 3 - n)]

    counts, docs = {}, {}
    for t, label in train:
        docs[label] = docs.get(label, 0) + 1
        for g in grams(t):
            counts.setdefault(label, {}).setdefault(g, 0)
            counts[label][g] += 1
    vocabulary = {g for c in counts.values() for g in c}
    known = [g for g in grams(text) if g in vocabulary]
    raw = {label: math.log(docs[label]) + sum(
        math.log((counts[label].get(g, 0) + 1) / (sum(counts[label].values()) + len(vocabulary))) for g in known) for label in docs}
    top = max(raw.values())
    total = sum(math.exp(v - top) for v in raw.values())
    return {label: math.exp(v - top) / total for label, v in raw.items()}


def test_bayes_against_brute_force(spark):
    train = [("pain blanc", "01"), ("pain complet", "01"), ("eau minerale", "02"), ("lait entier", "03")]
    asked = [(1, "pain"), (2, "eau pain"), (3, "zzz"), (4, "")]
    counts = bayes.nb_counts(spark.createDataFrame(train, "t string, l string"), "t", "l")
    got = bayes.nb_score(spark.createDataFrame(asked, "id int, t string"), counts, "t", top_k=3)
    for row in got.collect():
        expected = brute_bayes(train, dict(asked)[row["id"]])
        assert row["confidence"] == pytest.approx(expected[row["code"]])
    assert got.count() == 12
    assert got.groupBy("id").agg(F.sum("confidence").alias("s")).where("abs(s - 1) > 1e-9").count() == 0


def test_fine_tuning_adds_known_labels_only(spark):
    schema = "t string, l string"
    base = spark.createDataFrame([("ab", "01"), ("cd", "02")], schema)
    new = spark.createDataFrame([("ab", "02"), ("ef", "99")], schema)
    tuned = bayes.fine_tune(bayes.nb_counts(base, "t", "l"), new, "t", "l")
    whole = bayes.nb_counts(base.union(new.where("l = '02'")), "t", "l")
    assert values(tuned.grams, "label", "ngram", "n") == values(whole.grams, "label", "ngram", "n")
    assert values(tuned.classes, "label", "n") == [("01", 1.0), ("02", 2.0)]


def test_fine_tuning_of_chosen_levels(spark):
    rows = spark.createDataFrame([("ab", "01", "01.1")], "t string, level1 string, level2 string")
    counts = {n: bayes.nb_counts(rows, "t", f"level{n}") for n in (1, 2)}
    tuned = bayes.fine_tune_levels(counts, rows, "t", [2], 2.0)
    assert tuned[1] is counts[1] and values(tuned[2].classes, "label", "n") == [("01.1", 3.0)]


def test_codes_are_all_paths():
    assert all(any(child == parent for _, child in CODES[level - 1]) for level in (2, 3) for parent, _ in itertools.chain(CODES[level]))
