import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.operators import analytics as an
from ramure.operators.evaluate import ensure_predicted_levels
from ramure.operators.statistics import exact_median


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (1, "01.1.1.1", "01.1.1.1", 0.0, "0", "s1"), (2, "01.1.1.1", "01.1.1.2", 0.05, "2", "s1"), (3, "01.1.1.1", "01.1.2.1", 0.1, "2.5", "s1"),
        (4, "01.1.1.1", "01.2.1.1", 0.15, "-1", "s2"), (5, "01.1.1.1", "02.1.1.1", 0.85, "150", None), (6, "1.1.1.1", None, 1.0, "n/a", "s2"),
        (7, "98.1", "98.1", None, None, "s2"), (8, "02", "02.1", 0.9, "100", "s2")]
    df = spark.createDataFrame(rows, "id int, code string, predicted_code string, confidence double, budget string, shop string")
    return ensure_predicted_levels(df).withColumns({"annee": F.lit("2024"), "l_pr_product": F.lit("pain"), "source": F.lit("x"), "shop_type_name": F.lit(None).cast("string")})


@pytest.fixture(scope="module")
def base(raw):
    return an.enrich_predictions(raw).cache()


@pytest.fixture(scope="module")
def report(raw):
    return an.enrich_predictions(raw, null_pred_is_error=True).cache()


def test_severity_partitions_the_rows(base):
    got = dict(values(base, "id", "error_severity"))
    assert got == {1: "correct", 2: "near-miss", 3: "L3 faux", 4: "L2 faux", 5: "far-miss", 6: None, 7: None, 8: None}
    assert sum(row["n"] for row in an.severity_distribution(base).collect()) == 5


def test_two_error_laws(base, report):
    assert dict(values(base, "id", "err_l4"))[6] is False and dict(values(report, "id", "err_l4"))[6] is True
    assert dict(values(report, "id", "err_l4"))[8] is False  # no truth, no error


def test_budget_bands_at_zero_and_edges(base, report):
    assert dict(values(base, "id", "budget_tranche")) == {1: "0-2 €", 2: "0-2 €", 3: "2-5 €", 4: None, 5: "100+ €", 6: None, 7: None, 8: "50-100 €"}
    assert dict(values(report, "id", "budget_tranche"))[1] is None


def test_kpi_counts_technical_rows_as_wrong(base):
    row = an.kpi(base).first()
    assert (row["n_total"], row["n_tech"]) == (8, 1) and row["acc_l1"] == pytest.approx(5 / 8 * 100)


def test_accuracy_by_level(base):
    got = {row["level"]: row for row in an.accuracy_by_level(an.clean(base)).collect()}
    assert (got[1]["n"], got[1]["n_true"], got[1]["n_pred"]) == (6, 2, 2) and got[1]["accuracy"] == pytest.approx(500 / 6)
    assert got[4]["n"] == 5 and got[4]["accuracy"] == 20.0


def test_curves(base, report):
    assert values(an.topk_curve(base, max_k=3), "k", "accuracy", "n") == [(1, 0.2, 5), (2, 0.2, 5), (3, 0.2, 5)]
    assert an.topk_curve(report, require_prediction=False).first()["n"] == 6
    curve = {row["threshold"]: (row["coverage"], row["accuracy"]) for row in an.coverage_curve(base).collect()}
    assert curve[0.0] == (1.0, 0.2) and curve[0.05][0] == 0.8 and curve[0.15][0] == 0.4 and curve[0.85][0] == 0.2 and curve[0.9] == (0.0, 0.0)
    with_null = {row["threshold"]: row["accuracy"] for row in an.coverage_curve(report, null_when_empty=True, require_prediction=False).collect()}
    assert with_null[1.0] == 0.0 and len(with_null) == 21


def test_calibration_bins_are_right_closed(report):
    assert values(an.calibration(report), "bin", "n") == [(1, 1), (17, 1), (2, 1), (20, 1), (3, 1)]
    bands = {row["band"]: row["n_band"] for row in an.accuracy_by_confidence_band(report).where("level = 1").collect()}
    assert bands == {"0.0-0.1": 3, "0.1-0.2": 1, "0.8-0.9": 2, "0.9-1.0": 1}


def test_missing_dimension_values(base, report):
    assert dict(values(an.volume_by_dim(base, "shop"), "dim_val", "n")) == {"s1": 3, "s2": 4, "N/A": 1}
    kept = an.accuracy_by_dim(an.clean(report), "shop", None, "valid", None)
    assert {row["dim_val"]: (row["n_total"], row["acc_l4"]) for row in kept.collect()} == {"s1": (3, pytest.approx(100 / 3)), "s2": (3, 0.0)}


def test_ties_are_broken_by_value(base):
    tied = base.withColumn("shop", F.when(F.col("id") <= 4, F.lit("b")).otherwise(F.lit("a")))
    assert [row["dim_val"] for row in an.volume_by_dim(tied, "shop", 1).collect()] == ["a"]


def test_error_reports(base, report):
    counts = dict(values(an.error_categories(report), "category", "n"))
    assert sum(counts.values()) == 6 and counts["Tout correct"] == 1 and counts["Erreur des L1"] == 2
    assert {row["level"]: row["n_ok"] for row in an.error_cascade(report).collect()} == {2: 4, 3: 4, 4: 4}
    assert an.error_filter(base, text="100%").count() == 0 and an.error_filter(base, text=" PAIN ", severity="errors").count() == 4
    assert an.error_filter(base, true_code="01.1", conf_min=0.05, conf_max=0.15).count() == 3
    assert [row["conf_pct"] for row in an.error_listing(an.error_filter(base), 2).collect()] == [85.0, 15.0]


def test_confusion_matrix_has_zero_cells(report):
    cells = {(row["truth"], row["pred"]): (row["n"], row["pct"]) for row in an.confusion_matrix(report).collect()}
    assert len(cells) == 9 and cells["01", "98"] == (0, 0.0) and cells["01", "02"] == (1, 20.0)


def test_histogram_of_one_value(report):
    same = report.where("id = 2")
    row = an.confidence_by_correctness(same, 10).first()
    assert (row["n"], row["bin_low"], row["density"]) == (1, pytest.approx(0.05), pytest.approx(10.0))


def test_revenue(report):
    row = an.revenue_totals(report).first()
    assert row["n"] == 5 and row["ca_total"] == pytest.approx(153.5) and row["ca_correct"] == 0.0 and row["n_correct"] == 1
    shares = an.revenue_summary(report).agg(F.sum("pct_ca_total")).first()[0]
    assert shares == pytest.approx(100.0)


@pytest.mark.parametrize("numbers", [[3.0], [1.0, 2.0], [5.0] * 50 + [1.0, 9.0], [float(i % 97) for i in range(1000)], [1.0] * 400 + [float(i) for i in range(599)]])
def test_exact_median(spark, numbers):
    import statistics

    df = spark.createDataFrame([(v,) for v in [*numbers, None]], "v double")
    row = exact_median(df, "v", accuracy=100).first()
    assert (row["median"], row["n"]) == (statistics.median(numbers), len(numbers))


def test_exact_median_by_key_with_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, 7.0)], "k string, v double")
    assert values(exact_median(df, "v", ["k"]), "k", "median") == [("a", 2.5), (None, 7.0)]


def test_enrichment_reads_only_needed_columns(spark, tmp_path, raw):
    path = str(tmp_path / "p.parquet")
    raw.write.parquet(path)
    plan = an.technical_by_source(an.enrich_predictions(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<code:string,source:string>" in plan
