"""Joins with tables of classes: any number of classes, one row in for one row out."""

from tables import values
from ramure.operators.decode import mask_children
from ramure.operators.requests import attach_labels, parse_code_response
from ramure.operators.training import dedup_pairs, filter_rare, first_per_key, known_labels_only


def test_more_classes_than_can_be_broadcast(spark):
    rows = spark.range(600_000).selectExpr("id", "cast(id % 300000 as string) AS code")
    assert filter_rare(rows, "code", 2).count() == 600_000
    known = spark.range(250_000).selectExpr("cast(id as string) AS label")
    assert known_labels_only(rows, "code", known).count() == 500_000


def test_no_single_partition(spark):
    rows = spark.range(100).selectExpr("id", "cast(id % 7 as string) AS code")
    assert "SinglePartition" not in filter_rare(rows, "code", 2)._jdf.queryExecution().toString()


def test_a_code_listed_twice_gives_one_label(spark):
    taxonomy = spark.createDataFrame([("01", "b"), ("01", "a"), ("02", "c")], "code string, libelle string")
    rows = spark.createDataFrame([(1, "01"), (2, "02"), (3, "03"), (4, None)], "id int, code string")
    assert values(attach_labels(rows, taxonomy), "id", "coicop_libelle") == [(1, "a"), (2, "c"), (3, ""), (4, "")]


def test_a_child_listed_twice_keeps_its_row(spark):
    probs = spark.createDataFrame([(1, 1, "01", 0.6), (1, 1, "02", 0.4), (1, 2, "01.1", 0.3), (1, 2, "02.1", 0.7)],
                                  "id int, level int, code string, p double")
    children = spark.createDataFrame([(2, "01", "01.1"), (2, "01", "01.1"), (2, "02", "02.1"), (2, "03", "02.1")],
                                     "level int, parent string, child string")
    assert values(mask_children(probs, children, (1, 2)), "level", "code", "p") == [
        (1, "01", 0.6), (1, "02", 0.4), (2, "01.1", 1.0), (2, "02.1", 0.0)]


def test_pairs_are_rows_of_the_table(spark):
    rows = spark.createDataFrame([("p", "c", "z", "a1"), ("p", "c", "a", "b2"), ("p", "c", "a", "b3"), ("q", "c", None, None)],
                                 "product string, code string, product_orig string, extra string")
    assert values(dedup_pairs(rows), "product", "product_orig", "extra") == [("p", "a", "b2"), ("q", None, None)]
    assert dedup_pairs(rows.select("product", "code")).count() == 2


def test_answers_must_be_an_array_and_nothing_else(spark):
    valid = spark.createDataFrame([("01.1",)], "code string")
    answers = ['["01.1"] trailing', '["01.1"]["01.1"]', '{"codes": 1}', '["01.1"', '["01.1"]', '```json\n["01.1"]\n```', "", None]
    rows = spark.createDataFrame(list(enumerate(answers)), "id int, answer string")
    codes = dict(values(parse_code_response(rows, "answer", 1, valid), "id", "code"))
    assert [n for n, code in codes.items() if code] == [4, 5]


def test_one_plan_for_every_number_of_rows(spark):
    rows = spark.range(9000).selectExpr("id % 2 AS k", "id")
    for n in (3, 1500):
        best = first_per_key(rows, ["k"], ["id"], n)
        assert best.count() == 2 * n and best.agg({"id": "max"}).first()[0] == 2 * n - 1
        assert best._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2
