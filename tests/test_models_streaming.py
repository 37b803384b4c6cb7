import shutil

import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.functions import codes
from ramure.operators import models
from ramure.streaming.incremental import clean_stream, score_incrementally, score_new_keys

PRODUCTS = {"pain": "01.1.1", "baguette": "01.1.2", "biere": "02.1.1", "vin": "02.1.2", "robe": "03.1.1", "pantalon": "03.1.2"}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"{word} {extra}", code) for i, (word, code, extra) in enumerate(
        (word, code, extra) for extra in ("bio", "frais", "rouge", "petit", "grand", "bleu") for word, code in PRODUCTS.items())]
    df = spark.createDataFrame(data, "id int, text string, code string")
    return codes.with_levels(df).withColumn("code8", codes.code_prefix("code")).cache()


@pytest.fixture(scope="module")
def hierarchical(rows):
    return models.fit_hierarchical(rows, max_level=4, min_samples=10, num_features=1 << 12)


def accuracy(df, predicted, true):
    return df.agg(F.avg((F.col(predicted) == F.col(true)).cast("double"))).first()[0]


def test_flat_model_learns_and_counts(rows):
    model = models.fit_flat(rows, num_features=1 << 12)
    assert model.stats == {"num_classes": 6, "train": 30, "val": 6, "total": 36, "dropped": 0}
    got = model.predict(rows, top_k=3)
    assert accuracy(got, "predicted_code", "code8") > 0.9
    row = got.first()
    assert row["confidence"] >= row["confidence_top2"] >= row["confidence_top3"]
    with pytest.raises(ValueError):
        models.fit_flat(rows.limit(1), num_features=16)


def test_logistic_option(rows):
    model = models.fit_flat(rows, num_features=1 << 10, estimator="logistic")
    assert accuracy(model.predict(rows), "predicted_code", "code8") > 0.9
    with pytest.raises(ValueError):
        models.fit_flat(rows, estimator="forest")


def test_hierarchical_levels_and_skips(hierarchical, rows):
    assert {n: len(model.labels) for n, model in hierarchical.levels.items()} == {1: 3, 2: 3, 3: 6}
    assert hierarchical.skipped == {4: "too few rows"} and hierarchical.levels[1].parents is None
    assert hierarchical.levels[2].parents == ["01", "02", "03"]
    got = hierarchical.predict_wide(rows, top_k=2)
    assert accuracy(got, "predicted_code", "level3") > 0.9
    assert {"predicted_level3_top2", "confidence_level3_top2", "final_level", "combined_confidence"} <= set(got.columns)


def test_beam_of_one_equals_greedy(hierarchical, rows):
    greedy = hierarchical.predict_wide(rows).select("id", "predicted_code", "final_level", F.round("combined_confidence", 9).alias("c"))
    beam = hierarchical.predict_beam(rows, 1).select("id", "predicted_code", "final_level", F.round("combined_confidence", 9).alias("c"))
    assert values(greedy, "*") == values(beam, "*")
    wide = hierarchical.predict_beam(rows, 3)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert wide.count() == 36


def test_save_load_resume(spark, hierarchical, rows, tmp_path):
    path = str(tmp_path / "model")
    hierarchical.save(path)
    loaded = models.HierarchicalModel.load(spark, path)
    assert loaded.max_level == 4
    columns = ["id", "predicted_code", "confidence"]
    assert values(loaded.predict_wide(rows), *columns) == values(hierarchical.predict_wide(rows), *columns)
    again = str(tmp_path / "again")
    settings = {"max_level": 4, "min_samples": 10, "num_features": 1 << 12}
    stored = models.fit_hierarchical(rows, **settings, save_to=again)
    shutil.rmtree(f"{again}/level3")  # a level that was never finished
    resumed = models.fit_hierarchical(rows.repartition(3), **settings, resume_from=again)
    assert values(resumed.predict_wide(rows), *columns) == values(stored.predict_wide(rows), *columns)
    assert len(models.HierarchicalModel.load(spark, again).levels) == 3
    other = rows.withColumns({f"level{n}": F.regexp_replace(f"level{n}", "^0", "1") for n in range(1, 6)})
    for changed, more in ((other, {}), (rows, {"num_features": 1 << 11})):
        with pytest.raises(ValueError, match="other rows or with other settings"):
            models.fit_hierarchical(changed, **{**settings, **more}, resume_from=again)
    refitted = models.fit_hierarchical(other, **settings, save_to=again)
    assert refitted.levels[1].labels == models.HierarchicalModel.load(spark, again).levels[1].labels == ["11", "12", "13"]


def test_parents_from_the_second_level_on(rows):
    model = models.fit_hierarchical(rows.withColumn("level1", F.when(F.col("id") % 6 == 0, F.col("level1"))), max_level=3, min_samples=10,
                                    num_features=1 << 12)
    assert 1 not in model.levels and model.levels[2].parents is not None
    assert model.predict_wide(rows).count() == 36


def test_rare_classes_are_those_of_all_rows(spark, rows):
    more = spark.createDataFrame([(100 + i, f"kiwi {i}", "02.9") for i in range(3)], "id int, text string, code string")
    every = rows.unionByName(codes.with_levels(more), allowMissingColumns=True)
    model = models.fit_multihead(every, max_level=2, min_samples=10, min_count=3, num_features=1 << 12)
    assert "02.9" in model.levels[2].labels


def test_beams_per_level(hierarchical, rows):
    table = rows.select("id", F.col("text").alias("product"))
    got = models.predict_table(hierarchical, table, top_k=2, beam=3)
    assert {"predicted_level3", "predicted_level3_top2", "confidence_level1_top2"} <= set(got.columns)
    first = got.select("id", *[F.col(f"predicted_level{n}") for n in (1, 2, 3)])
    second = got.select("id", *[F.col(f"predicted_level{n}_top2") for n in (1, 2, 3)])
    assert first.count() == 36 and values(first, "*") != values(second, "*")
    assert got.where("predicted_level3 <> predicted_code OR confidence_level3 <> confidence").count() == 0, got.first()


def test_multihead_children_follow_parents(spark, rows, tmp_path):
    model = models.fit_multihead(rows, max_level=3, min_samples=10, num_features=1 << 12)
    got = model.predict_wide(rows, top_k=2)
    wrong = got.where(~F.col("predicted_level2").startswith(F.col("predicted_level1")) | ~F.col("predicted_level3").startswith(F.col("predicted_level2")))
    assert wrong.count() == 0
    model.save(str(tmp_path / "m"))
    loaded = models.MultiheadModel.load(spark, str(tmp_path / "m"))
    assert values(loaded.predict_wide(rows), "id", "predicted_code") == values(got, "id", "predicted_code")


def test_summary(spark, hierarchical):
    got = {row["level"]: (row["n_classes"], row["samples"]) for row in models.model_summary(hierarchical.summary(spark), 2).collect()}
    assert got == {1: (3, "01, 02"), 2: (3, "01.1, 02.1"), 3: (6, "01.1.1, 01.1.2")}


def test_predict_table_drops_blank_rows(spark, hierarchical):
    df = spark.createDataFrame([(1, "Pain BIO !"), (2, "12")], "id int, product string")
    got = models.predict_table(hierarchical, df)
    assert values(got, "id", "product", "product_orig", "predicted_level1") == [(1, "pain bio", "Pain BIO !", "01")]


def test_incremental_runs_score_each_row_once(spark, hierarchical, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        stream = clean_stream(spark, source, "id int, product string", "product")
        score_incrementally(stream, lambda df: hierarchical.predict_wide(df, "product"), sink, checkpoint).awaitTermination()
        return values(spark.read.parquet(sink), "id", "predicted_level1")

    schema = "id int, product string"
    spark.createDataFrame([(1, "Pain bio"), (2, "!")], schema).write.parquet(source)
    assert run() == [(1, "01")]
    assert run() == [(1, "01")]
    spark.createDataFrame([(3, "robe")], schema).write.mode("append").parquet(source)
    assert run() == [(1, "01"), (3, "03")]


def test_keys_are_scored_once_by_any_plan(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "id long, product string, note string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        # a plan that a plain stream couldn't run: a join with a count per product
        def score(df):
            return df.join(df.groupBy("product").count(), "product", "left")

        score_new_keys(spark.readStream.schema(schema).parquet(source), score, sink, checkpoint).awaitTermination()
        return values(spark.read.parquet(sink), "id", "product", "count", "batch")

    arrive((2**60 + 1, "pain", None), (2, "vin", "b"), (2, "eau", "z"), (None, "sel", None), (None, "sel", None))
    first = run()
    assert first == [(2**60 + 1, "pain", 1, 0), (2, "eau", 1, 0), (None, "sel", 2, 0), (None, "sel", 2, 0)]
    assert run() == first
    arrive((2, "robe", "later"), (3, "robe", None))
    second = run()
    assert second == sorted([*first, (3, "robe", 1, 1)], key=lambda row: tuple((value is None, str(value)) for value in row))
    # killed between the write and the commit: the batch comes again and replaces what it wrote
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    assert run() == second


def test_arrivals_without_rows(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    spark.createDataFrame([], "id int, product string").write.parquet(source)
    stream = spark.readStream.schema("id int, product string").parquet(source)
    score_new_keys(stream, lambda df: df, sink, checkpoint).awaitTermination()
    found = [row for part in (tmp_path / "out").glob("batch=*") for row in spark.read.parquet(str(part)).collect()]
    assert found == []
