from pyspark.sql import functions as F

from tables import values
from ramure.functions import codes
from ramure.operators import training as tr


def pairs(spark, rows):
    return spark.createDataFrame(rows, "product string, code string, source string")


def test_cap_prefers_observed_rows(spark):
    observed = pairs(spark, [(f"a{i}", "01.1.1.1.1", "ddc") for i in range(5)] + [("b0", "01.1.1.2", "ddc")])
    synthetic = pairs(spark, [(f"s{i}", "01.1.1.1", "synthetic") for i in range(5)] + [(f"t{i}", "01.1.1.2.9", "synthetic") for i in range(5)]
                      + [(f"u{i}", "02", "synthetic") for i in range(5)])
    got = tr.cap_by_stratum(observed, synthetic, 3)
    counts = {(row["k"], row["source"]): row["n"] for row in got.groupBy(codes.level4_key("code").alias("k"), "source").agg(
        F.count("*").alias("n")).collect()}
    # full: no synthetic row; partly filled: topped up; unseen: synthetic up to the cap
    assert counts == {("01.1.1.1", "ddc"): 3, ("01.1.1.2", "ddc"): 1, ("01.1.1.2", "synthetic"): 2, ("02", "synthetic"): 3}


def test_cap_is_reproducible_whatever_the_partitioning(spark):
    observed = pairs(spark, [(f"a{i}", "01", "ddc") for i in range(50)])
    nothing = pairs(spark, []).limit(0)
    first = values(tr.cap_by_stratum(observed.repartition(1), nothing, 7), "product")
    assert first == values(tr.cap_by_stratum(observed.repartition(6), nothing, 7), "product") and len(first) == 7


def test_hot_stratum_is_limited_before_the_shuffle(spark):
    df = tr.first_per_key(spark.range(1000).withColumn("k", F.floor(F.col("id") / 900)), ["k"], ["id"], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # before and after each of the two shuffles
    assert values(df.where("k = 0"), "id", "rn") == [(i, i + 1) for i in range(5)] and df.count() == 10


def test_large_caps_have_the_same_plan(spark):
    df = spark.range(0, 6000, 1, 4).withColumn("k", F.col("id") % 2)
    got = tr.first_per_key(df, ["k"], ["id"], 1500, salts=2)
    assert got.count() == 3000 and got.agg(F.max("id")).first()[0] == 2999
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 4


def test_dedup_keeps_smallest_original(spark):
    df = spark.createDataFrame([("a", "1", "A!"), ("a", "1", "A"), ("a", "2", "x")], "product string, code string, product_orig string")
    assert values(tr.dedup_pairs(df), "product", "code", "product_orig") == [("a", "1", "A"), ("a", "2", "x")]


def test_build_training_data(spark):
    observed = spark.createDataFrame([("Pain !!", "01.1.1.1.1"), ("pain", "01.1.1.1.1"), ("12", "01")], "description_ean string, coicop_code string")
    synthetic = spark.createDataFrame([("Eau", "02.1.1.1.1")], "product string, code string")
    got = tr.build_training_data(observed, synthetic)
    assert got.columns == ["product", "code", "product_orig", "source", "code8"]
    assert values(got, "product", "code", "source", "product_orig", "code8") == [
        ("eau", "02.1.1.1.1", "synthetic", "Eau", "02.1.1.1"), ("pain", "01.1.1.1.1", "ddc", "Pain !!", "01.1.1.1")]


def test_load_annotations_excludes_technical(spark):
    df = spark.createDataFrame([("Pain", "01.1"), ("Divers", "989.1"), ("Eau", "99")], "product string, code string")
    assert values(tr.load_annotations(df), "text", "level2") == [("pain", "01.1")]
    assert tr.load_annotations(df, exclude_technical=False).count() == 3


def test_class_weights_count_null_rows_in_the_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "l string")
    assert values(tr.class_weights(df, "l"), "label", "n", "weight") == [("a", 2, 1.0), ("b", 1, 2.0)]


def test_rare_known_and_indexed_labels(spark):
    df = spark.createDataFrame([(1, "b"), (2, "b"), (3, "a"), (4, None)], "id int, l string")
    assert values(tr.filter_rare(df, "l"), "id") == [(1,), (2,)]
    assert tuple(tr.rare_report(df, "l").first()) == (2, 1, 1, 1)
    assert values(tr.label_index(df, "l"), "label", "index") == [("a", 0), ("b", 1)]
    known = spark.createDataFrame([("a",)], "label string")
    assert values(tr.known_labels_only(df, "l", known), "id") == [(3,)]
    assert tuple(tr.unknown_label_count(df, "l", known).first()) == (1, 3)


def test_usable_levels(spark):
    df = codes.with_levels(spark.createDataFrame([("01.1",), ("01.1",), ("02.1",), ("02.1",), ("03",)], "code string"))
    got = {row["level"]: (row["n_rows"], row["n_classes"], row["status"]) for row in tr.usable_levels(df, 5).collect()}
    assert got[1] == (5, 2, "train") and got[2] == (4, 2, "too few rows") and got[3] == (0, 0, "too few rows")


def test_split_is_exact_disjoint_and_complete(spark):
    # one class holds most rows
    df = spark.range(2000).withColumn("l", F.when(F.col("id") % 50 == 0, F.lit("rare")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.lit("hot")))
    got = tr.stratified_split(df, "l")
    counts = {row["l"]: (row["n"], row["v"]) for row in got.groupBy("l").agg(F.count("*").alias("n"), F.count_if("is_validation").alias("v")).collect()}
    assert counts == {"rare": (40, 8), "hot": (1920, 384), None: (40, 0)}
    brute = {}
    for row in df.withColumn("h", tr.hash_order(42, "id")).collect():
        brute.setdefault(row["l"], []).append((row["h"], row["id"]))
    expected = {i for label in ("rare", "hot") for _, i in sorted(brute[label])[: round(0.2 * len(brute[label]))]}
    assert {row["id"] for row in got.where("is_validation").collect()} == expected


def test_multi_level_labels_and_parents(spark):
    df = codes.with_levels(spark.createDataFrame([(1, "01.1"), (2, "01.1"), (3, "02.1"), (4, "01")], "id int, code string"))
    assert values(tr.multi_level_labels(df, (1, 2)), "id", "label1", "label2") == [(1, 0, 0), (2, 0, 0), (3, None, None), (4, 0, None)]
    vocab = tr.parent_vocab(df, 2)
    assert values(vocab, "parent", "index") == [("01", 0), ("02", 1)]
    asked = spark.createDataFrame([("02",), ("77",)], "p string")
    assert values(tr.parent_index(asked, "p", vocab), "p", "parent_index") == [("02", 1), ("77", 0)]


def test_training_summary(spark):
    df = pairs(spark, [("a", "1", "ddc"), ("b", "1", "ddc"), ("c", "2", "synthetic"), ("d", "1", "synthetic")])
    assert values(tr.training_summary(df), "source", "n", "n_codes", "share") == [("ddc", 2, 1, 50.0), ("synthetic", 2, 2, 50.0), (None, 4, 2, 100.0)]
