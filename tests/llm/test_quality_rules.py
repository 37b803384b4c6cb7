import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ramure.llm.quality_rules import Condition, DecisionList, judge, learn_decision_list, quality_rules, text_statistics


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[at:at + 8]) for at in range(len(words) - 7))
    covered = [False] * len(words)
    for at in range(len(words) - 7):
        if windows[tuple(words[at:at + 8])] > 1:
            covered[at:at + 8] = [True] * 8
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(covered))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_brute_force(spark, awkward, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = make_docs([(900_001, "a b c d e f g h a b c d e f g h i"), (900_002, "x " * 50), (900_003, "l\nl\n\nl \n#|\n#|"), (900_004, "a b c d e f g h"),
                      (900_005, "a a a a a a a a a"), (900_006, "\x0b\x0c\r")]).select("doc_id", "text")
    rows = docs.union(more).union(awkward.select("doc_id", "text"))
    expected = Counter((row["doc_id"], *brute(row["text"])) for row in rows.collect())
    assert Counter(tuple(row) for row in text_statistics(rows).select("doc_id", *COLUMNS).collect()) == expected
    assert text_statistics(awkward.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = text_statistics(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_learns_a_conjunction(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 50).alias("symbols"), (F.col("id") % 7 * 10).alias("digits"), F.lit(5).alias("marks"))
    labelled = rows.withColumn("quality", F.when((F.col("symbols") > 30) & (F.col("digits") > 35), 0).otherwise(1))
    learned = learn_decision_list(labelled, features=["symbols", "digits", "marks"])
    assert len(learned.rules) == 1 and {(c.feature, c.above) for c in learned.rules[0]} == {("symbols", True), ("digits", True)}
    wrong = labelled.where(learned.verdict() != (F.col("quality") == 1)).count()
    assert wrong == 0, str(learned)


def test_nothing_to_learn_keeps_everything(spark):
    empty = spark.createDataFrame([], "doc_id long, symbols long, quality int")
    assert learn_decision_list(empty, features=["symbols"]).rules == []
    good = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").alias("symbols"), F.lit(1).alias("quality"))
    assert learn_decision_list(good, features=["symbols"]).rules == []
    assert good.where(DecisionList([]).verdict()).count() == 100


def test_rules_are_tried_in_order_and_null_statistics_stay(spark):
    learned = DecisionList([(Condition("a", True, 3), Condition("b", False, 1)), (Condition("b", True, 8),)])
    rows = spark.createDataFrame([(4, 1), (4, 2), (1, 9), (None, 0)], "a int, b int")
    assert [row[0] for row in rows.select(learned.verdict()).collect()] == [False, True, False, True]
    assert str(learned) == "reject if a > 3 and b <= 1\nreject if b > 8\nkeep"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    judged, learned = quality_rules(spark.read.parquet(f"{folder}/documents.parquet"), labels.where(~held))
    rows = judged.join(labels.where(held), "doc_id").groupBy("quality", "base_failed", "kept").count().collect()

    def share(quality, of, kept):
        some = [row for row in rows if row["quality"] == quality and row["base_failed"] in of]
        return sum(row["count"] for row in some if row["kept"] == kept) / sum(row["count"] for row in some)

    # of good rows that pass the base rule the list keeps nearly all; of bad ones nearly none gets through both
    assert learned.rules and share(1, (False,), True) > 0.99 and share(0, (False, True), False) > 0.95, (rows, str(learned))


def test_judged_rows(spark, awkward):
    judged = judge(text_statistics(awkward), DecisionList([(Condition("n_words", True, 1000),)]))
    rows = {row["doc_id"]: (row["base_failed"], row["kept"]) for row in judged.collect()}
    assert rows[1] == (True, False) and rows[4] == (True, False)
    assert judged.count() == 11


@pytest.mark.parametrize("doc_id", [0, 17])
def test_spark_and_python_agree_on_held_out(spark, doc_id):
    assert spark.range(1).select(F.crc32(F.lit(str(doc_id)))).first()[0] == zlib.crc32(str(doc_id).encode())
