"""What keeps queries in proportion to their input: rows that are shuffled, exploded and scored."""

import re

from pyspark.sql import functions as F

from tables import values
from ramure.functions.ngrams import ngram_counts
from ramure.operators import bayes, decode, level_tables
from ramure.plans.registry import Inputs
from ramure.session import spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ngrams_of_a_text_are_one_row(spark):
    texts = spark.createDataFrame([(1, "ab ab"), (2, "zz"), (None, "ab"), (3, None)], "id int, text string")
    vocabulary = spark.createDataFrame([("t<ab",), ("tab>",)], "feature string")
    assert values(level_tables.bags(texts, "text", "id", vocabulary), "id", "grams") == [(1, [0, 0, 1, 1])]


def test_scores_do_not_depend_on_blocks_and_steps(spark, monkeypatch):
    data = [(i, f"{word} {extra}", code) for i, (word, code, extra) in enumerate(
        (w, c, e) for e in ("bio", "frais", "rouge", "petit") for w, c in {"pain": "01.1", "vin": "02.1", "robe": "03.1", "pull": "03.2"}.items())]
    rows = spark.createDataFrame(data, "id int, text string, code string").withColumns({"level1": F.substring("code", 1, 2), "level2": F.col("code")})
    tables, _ = level_tables.fit_levels(rows, max_level=2, min_samples=10)
    whole = values(level_tables.predict_levels(tables, rows, top_k=2), "id", "predicted_code", "predicted_level2_top2", F.round("confidence", 9))
    for name in ("MOST_ROWS", "ENTRIES", "CELLS"):
        monkeypatch.setattr(level_tables, name, 3)
    assert values(level_tables.predict_levels(tables, rows, top_k=2), "id", "predicted_code", "predicted_level2_top2", F.round("confidence", 9)) == whole
    assert len(whole) == 16


def test_words_are_counted_before_they_are_cut(spark):
    texts = spark.createDataFrame([("pain pain", "a"), ("pain", "a"), (None, "a"), ("pain", None)], "t string, l string")
    for counted in (ngram_counts(texts, "t"), bayes.nb_counts(texts, "t", "l").grams):
        before = plan(counted)
        assert re.search(r"HashAggregate\(keys=\[[^\]]*word#", before)
    assert {row["n"] for row in bayes.nb_counts(texts, "t", "l").grams.collect()} == {3.0}


def test_candidates_are_moved_to_their_customer_once(spark, tmp_path):
    tables = {"orders": [(1, 5), (2, 5), (3, 6)], "lineitem": [(1, 1), (1, 2), (2, 1), (3, 2)], "part": [(1, "hot bolt", "SMALL", 1), (2, "old ring", "LARGE", 2)]}
    schemas = {"orders": "o_orderkey int, o_custkey int", "lineitem": "l_orderkey int, l_partkey int", "part": "p_partkey int, p_name string, p_type string, p_size int"}
    for name, rows in tables.items():
        spark.createDataFrame(rows, schemas[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    inputs = Inputs(spark, str(tmp_path))
    decoded = decode.beam_decode(inputs.scores, 2)
    assert len(re.findall(r"Exchange hashpartitioning\(id#", plan(decoded))) == 1
    names = ("id", "level", "parent_code", "code", "confidence")
    assert values(inputs.scores, *names) == values(inputs.sql("SELECT * FROM scores"), *names)


def test_rows_are_spread(spark):
    few = spark.range(10).coalesce(1)
    assert spread(few).rdd.getNumPartitions() == 1 and spread(few, 3).rdd.getNumPartitions() == 4 and values(spread(few, 3), "id") == values(few, "id")


def test_a_fit_takes_few_jobs_and_blocks_stay_apart(spark):
    """What levels count is counted for all of them at once, and blocks of a few bytes are not put into one task."""
    data = [(i, f"{word} {extra}", code) for i, (word, code, extra) in enumerate(
        (w, c, e) for e in ("bio", "frais", "rouge", "petit") for w, c in {"pain": "01.1", "vin": "02.1", "robe": "03.1", "pull": "03.2"}.items())]
    rows = spark.createDataFrame(data, "id int, text string, code string").withColumns({"level1": F.substring("code", 1, 2), "level2": F.col("code")})
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    before = max(jobs())
    tables, _ = level_tables.fit_levels(rows, max_level=2, min_samples=10)
    assert max(jobs()) - before < 85
    level = level_tables._Level(tables, 1)
    some = spark.range(64).select("id", F.array(F.lit(0)).alias("grams"), F.array(F.lit(None).cast("string")).alias("parents"), F.array(F.lit(0.5)).alias("confidences"))
    assert level.best(some, 4, 1).select("id").rdd.getNumPartitions() == 4
