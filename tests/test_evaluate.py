import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.operators import evaluate as ev


@pytest.fixture(scope="module")
def preds(spark):
    rows = [
        (1, "01.1", "01.1", "02.1", True, False), (2, "01.1", "02.1", "01.1", True, True), (3, "02.1", "02.2", "", False, None),
        (4, "02.1", None, "02.1", False, False), (5, "03", "03.1", None, None, False)]
    df = spark.createDataFrame(rows, "id int, code string, predicted_code string, predicted_code_top2 string, manual_from_app boolean, suggester boolean")
    df = df.withColumns({"manual_from_books": F.lit(False), "receips_from_app": F.lit(False)})
    df = ev.ensure_predicted_levels(ev.ensure_true_labels(df))
    return df.withColumns({f"confidence_level{n}": F.col("id") / 10 for n in (1, 2, 3, 4)})


def test_levels_are_derived_once(spark, preds):
    assert ev.ensure_predicted_levels(preds) is preds and ev.ensure_true_labels(preds) is preds
    row = preds.where("id = 3").first()
    assert row["predicted_level1_top2"] == "" and row["predicted_level2"] == "02.2" and row["level3"] is None
    with pytest.raises(ValueError):
        ev.ensure_true_labels(spark.range(1))


def test_topk_counts_rows_with_truth_and_prediction(preds):
    got = {(row["level"], row["k"]): (row["accuracy"], row["n"]) for row in ev.topk_overall(preds, (1, 2, 3)).collect()}
    assert got[2, 1] == (1 / 3, 3) and got[2, 2] == (2 / 3, 3)
    assert got[2, 3] == (None, 3)  # beyond the ranks there are
    assert got[1, 1] == (3 / 4, 4) and got[3, 1] == (None, 0)
    everything = {(row["level"], row["k"]): row["accuracy"] for row in ev.topk_all_rows(preds, (1, 2, 3)).collect()}
    assert everything[2, 1] == 1 / 5 and everything[2, 2] == everything[2, 3] == 3 / 5


def test_topk_grows_with_k(preds):
    rows = ev.topk_overall(preds, (1, 2)).orderBy("level", "k").collect()
    for first, second in zip(rows[::2], rows[1::2]):
        assert first["accuracy"] is None or first["accuracy"] <= second["accuracy"]


def test_topk_by_group_and_flags(preds):
    got = {(row["group_value"], row["level"], row["k"]): row["accuracy"] for row in ev.topk_by_group(preds, "level1", (1,)).collect()}
    assert got["01", 2, 1] == 0.5 and ("01", 1, 1) not in got
    assert ("03", 2, 1) in got and got["03", 2, 1] is None  # predicted, but without truth at the level
    assert ("02", 3, 1) not in got  # never predicted
    flags = {(row["flag"], row["value"], row["level"]): (row["accuracy"], row["n_subset"])
             for row in ev.topk_by_flags(preds, ["suggester", "absent"], (1,)).collect()}
    assert flags["all", None, 1] == (0.75, 5) and flags["suggester", True, 1] == (0.0, 1) and flags["suggester", False, 1] == (1.0, 4)


def test_source_filters(preds):
    def ids(logic, sources=("manual_from_app", "suggester")):
        return [row[0] for row in values(ev.filter_sources(preds, list(sources), logic), "id")]

    assert ids("any") == [1, 2] and ids("all") == [2] and ids("only") == [2] and ids("none") == [3, 4, 5]
    assert ids("only", ["manual_from_app"]) == [1, 5]  # NULL doesn't speak against `all`
    with pytest.raises(ValueError):
        ev.filter_sources(preds, ["nope"])
    with pytest.raises(ValueError):
        ev.filter_sources(preds, ["suggester"], "some")
    with pytest.raises(ValueError):
        ev.filter_true(preds, ["nope"])
    assert values(ev.filter_true(preds, ["manual_from_app"]), "id") == [(1,), (2,)]


def test_metrics_by_confidence(preds):
    got = {(row["level"], row["threshold"]): row for row in ev.metrics_by_confidence(preds, (1, 2), (0.0, 0.2, 0.9)).collect()}
    row = got[2, 0.0]
    assert (row["n_samples"], row["coverage"], row["accuracy"]) == (3, 0.6, 1 / 3)
    # classes 01.1: p 1, r 1/2, f 2/3 (support 2); 02.1: 0 (support 1); 02.2: 0 (support 0)
    assert row["f1"] == pytest.approx(4 / 9) and row["precision"] == pytest.approx(2 / 3) and row["recall"] == pytest.approx(1 / 3)
    assert got[2, 0.2]["n_samples"] == 2  # the threshold itself counts
    last = got[2, 0.9]
    assert (last["n_samples"], last["coverage"], last["accuracy"]) == (0, 0.0, None)
    macro = ev.metrics_by_confidence(preds, (2,), (0.0,), "macro").first()
    assert macro["f1"] == pytest.approx(2 / 9)
    micro = ev.metrics_by_confidence(preds, (2,), (0.0,), "micro").first()
    assert micro["f1"] == micro["precision"] == micro["recall"] == pytest.approx(1 / 3)


def test_coverage_falls_with_the_threshold(preds):
    rows = ev.metrics_by_confidence(preds, (1,)).orderBy("threshold").collect()
    assert all(a["coverage"] >= b["coverage"] for a, b in zip(rows, rows[1:]))


def test_metrics_all_sources_equal_single_filters(preds):
    both = ev.metrics_all_sources(preds, (1, 2), (0.0, 0.3))
    labels = {row[0] for row in both.select("source_filter").distinct().collect()}
    none = "none(manual_from_app, manual_from_books, receips_from_app, suggester)"
    assert labels == {"all", "any(manual_from_app)", "any(suggester)", none}
    columns = ["level", "threshold", "accuracy", "f1", "coverage", "n_samples"]
    single = ev.metrics_by_confidence(preds, (1, 2), (0.0, 0.3), sources=["suggester"])
    assert values(both.where("source_filter = 'any(suggester)'"), *columns) == values(single, *columns)


def test_no_filter_label_is_lost_without_rows(preds):
    some = preds.where("manual_from_app")
    rows = ev.metrics_all_sources(some, (1,), (0.0,)).where("startswith(source_filter, 'none')").collect()
    assert [(row["n_samples"], row["coverage"], row["accuracy"]) for row in rows] == [(0, 0.0, None)]


def test_classification_report(preds):
    got = {(row["kind"], row["label"]): row for row in ev.classification_report(preds, 2).collect()}
    assert (got["class", "01.1"]["precision"], got["class", "01.1"]["recall"], got["class", "01.1"]["support"]) == (1.0, 0.5, 2)
    assert got["class", "02.2"]["support"] == 0 and got["accuracy", "accuracy"]["f1"] == pytest.approx(1 / 3)
    assert got["macro avg", "macro avg"]["recall"] == pytest.approx(0.5 / 3)


def test_exact_match_and_code_topk(preds):
    row = ev.exact_match(preds).first()
    assert (row["n"], row["accuracy"]) == (5, 0.2)
    assert values(ev.code_topk(preds, 2), "k", "accuracy") == [(1, 0.2), (2, 0.6)]


def test_blank_alternatives_take_no_rank(spark):
    df = spark.createDataFrame([("a", "x", " ", "a")], "code string, predicted_code string, predicted_code_top2 string, predicted_code_top3 string")
    assert values(ev.code_topk(df, 3), "k", "accuracy") == [(1, 0.0), (2, 1.0), (3, 1.0)]


def test_evaluation_report_facets(preds):
    df = preds.withColumns({"amount": F.when(F.col("id") < 4, F.col("id") * 100.0), "is_hypermarche": F.when(F.col("id") == 1, F.lit(True)),
                            "source_file": F.lit("f é")})
    report = ev.evaluation_report(df, 2, 200.0)
    got = {(row["facet"], row["key"]): row for row in report.collect()}
    assert set(got) == {("overall", "overall"), ("level", "level1"), ("level", "level2"), ("source", "f é"),
                        ("amount", "<= 200€"), ("amount", "> 200€"), ("store", "Hypermarchés")}
    assert got["amount", "<= 200€"]["n"] == 2 and got["amount", "<= 200€"]["top_2"] == 1.0
    assert got["level", "level1"]["top_1"] is None and got["level", "level1"]["n"] == 4
    keys = {row["key"]: row["value"] for row in ev.flatten_metrics(report).collect()}
    assert keys["eval.overall.accuracy"] == 0.2 and "eval.source.f__.top_1" in keys and "eval.amount.___200_.top_2" in keys
    assert "eval.level1.f1_weighted" in keys and "eval.level1.top_1" not in keys


def test_long_form(preds):
    rows = values(ev.to_long(preds).where("id = 2 and level = 2"), "rank", "truth", "code", "confidence")
    assert rows == [(1, "01.1", "02.1", 0.2), (2, "01.1", "01.1", None)]
