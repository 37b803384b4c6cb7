"""Naive Bayes on character n-grams as plain relational algebra.

The model is a table of additive counts, so training is a group-by, further training is an addition, and scoring is
a join. Scores match multinomial naive Bayes with Laplace smoothing; n-grams the model never saw are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ramure.functions.ngrams import char_ngrams, words


class Counts(NamedTuple):
    """`grams(label, ngram, n)` and `classes(label, n)`."""

    grams: DataFrame
    classes: DataFrame


def nb_counts(df: DataFrame, text: str, label: str, min_n: int = 3, max_n: int = 6) -> Counts:
    """Counts per label and n-gram, and rows per label."""
    labelled = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
    # words are counted first, and each different one of a label is cut once
    counted = labelled.select("label", F.explode(words("text")).alias("word")).groupBy("label", "word").agg(F.count("*").alias("n"))
    grams = (
        counted.select("label", "n", F.explode(char_ngrams("word", min_n, max_n)).alias("ngram"))
        .groupBy("label", "ngram").agg(F.sum("n").cast("double").alias("n"))
    )
    classes = labelled.groupBy("label").agg(F.count("*").cast("double").alias("n"))
    return Counts(grams, classes)


def fine_tune(counts: Counts, df: DataFrame, text: str, label: str, weight: float = 1.0, min_n: int = 3,
              max_n: int = 6) -> Counts:
    """Add the weighted counts of new rows whose label the model knows."""
    known = df.join(counts.classes.select(F.col("label").alias(label)), label, "left_semi")
    new = nb_counts(known, text, label, min_n, max_n)

    def added(old: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
        weighted = fresh.withColumn("n", F.col("n") * weight)
        return old.unionByName(weighted).groupBy(*keys).agg(F.sum("n").alias("n"))

    return Counts(added(counts.grams, new.grams, ["label", "ngram"]), added(counts.classes, new.classes, ["label"]))


def fine_tune_levels(counts: Mapping[int, Counts], df: DataFrame, text: str, levels: Sequence[int], weight: float = 1.0) -> dict[int, Counts]:
    """`fine_tune` for the chosen levels, labels in `level{N}`; the other levels keep their counts."""
    return {n: fine_tune(old, df, text, f"level{n}", weight) if n in levels else old for n, old in counts.items()}


def nb_score(df: DataFrame, counts: Counts, text: str, key: str = "id", alpha: float = 1.0, top_k: int = 1,
             min_n: int = 3, max_n: int = 6) -> DataFrame:
    """`(id, rank, code, confidence)`: the `top_k` most probable labels of each row.

    Only labels that have an n-gram take part in the join; what all labels share is added per row from one small array
    of the classes, so no row is paired with every label before the sums are done.
    """
    per_gram = counts.grams.groupBy("ngram").agg(F.collect_list(F.struct(
        F.col("label"), F.log(F.col("n") / alpha + 1).alias("w"))).alias("weights"))
    vocabulary = per_gram.agg(F.count("*").alias("v")).scalar()
    totals = counts.grams.groupBy("label").agg(F.sum("n").alias("total"))
    # one entry per class of the nomenclature
    classes = counts.classes.join(totals, "label", "left").select(
        "label", F.log("n").alias("log_n"),
        (F.lit(alpha).cast("double") / (F.coalesce("total", F.lit(0.0)) + alpha * vocabulary)).alias("unseen"))
    table = classes.agg(F.sort_array(F.collect_list(F.struct(
        "label", "log_n", F.log("unseen").alias("log_unseen")))).alias("t")).scalar()

    # each different word is weighted once: a row for every label that has an n-gram of it, and one without label that counts them
    different = df.select(F.explode(words(text)).alias("word")).distinct()
    grams = different.select("word", F.explode(char_ngrams("word", min_n, max_n)).alias("ngram"))
    one = F.struct(F.lit(None).cast("string").alias("label"), F.lit(1.0).alias("w"))
    per_word = grams.join(per_gram, "ngram").select("word", F.inline(F.array_append("weights", one))).groupBy("word", "label").agg(
        F.sum("w").alias("w")).groupBy("word").agg(F.collect_list(F.struct("label", "w")).alias("weights"))
    weighted = df.select(F.col(key).alias("id"), F.explode_outer(words(text)).alias("word")).join(per_word, "word", "left")
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("w")))
    sums = weighted.select("id", F.inline(F.coalesce("weights", nothing))).groupBy("id", "label").agg(F.sum("w").alias("w"))
    gathered = sums.groupBy("id").agg(
        F.max(F.when(F.col("label").isNull(), F.col("w"))).alias("known"),
        F.map_from_entries(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "w")))).alias("found"))
    def score(c: Column) -> Column:
        neg = -(c["log_n"] + F.col("known") * c["log_unseen"] + F.coalesce(F.try_element_at("found", c["label"]), F.lit(0.0)))
        # the order is compared to nine digits, so that equal scores stay equal however they were added up
        return F.struct(F.round(neg, 9).alias("order"), c["label"].alias("code"), neg.alias("neg"))

    scored = gathered.withColumn("classes", table).withColumn("scores", F.transform("classes", score))
    best = F.array_min("scores")["neg"]
    normal = F.aggregate("scores", F.lit(0.0), lambda acc, s: acc + F.exp(best - s["neg"]))
    ranked = scored.select("id", best.alias("best"), normal.alias("normal"),
                           F.posexplode(F.slice(F.sort_array("scores"), 1, top_k)).alias("pos", "s"))
    return ranked.select("id", (F.col("pos") + 1).alias("rank"), F.col("s.code").alias("code"),
                         (F.exp(F.col("best") - F.col("s.neg")) / F.col("normal")).alias("confidence"))
