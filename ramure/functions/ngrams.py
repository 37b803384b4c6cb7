"""Character n-grams of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def words(column: Column | str) -> Column:
    """The words of a text, which is what n-grams are made of: those of a text are those of its words."""
    text = F.col(column) if isinstance(column, str) else column
    return F.filter(F.split(text, r"\s+"), lambda word: word != "")


def char_ngrams(column: Column | str, min_n: int = 3, max_n: int = 6, max_tokens: int | None = None) -> Column:
    """All `min_n..max_n` character n-grams of each `<word>`, in text order.

    `max_tokens` keeps the first so many, for models with a fixed input width; by default the whole text counts.
    """
    marked = F.transform(words(column), lambda word: F.concat(F.lit("<"), word, F.lit(">")))
    sizes = F.sequence(F.lit(min_n), F.lit(max_n))

    def grams(word: Column) -> Column:
        fitting = F.filter(sizes, lambda n: n <= F.length(word))
        return F.flatten(F.transform(
            fitting,
            lambda n: F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, n)),
        ))

    result = F.flatten(F.transform(marked, grams))
    return F.slice(result, 1, max_tokens) if max_tokens else result


def ngram_counts(df: DataFrame, column: str, min_n: int = 3, max_n: int = 6) -> DataFrame:
    """Occurrences of each n-gram over the table; words are counted first, and each different one is cut once."""
    counted = df.select(F.explode(words(column)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.select("n", F.explode(char_ngrams("word", min_n, max_n)).alias("ngram")).groupBy("ngram").agg(F.sum("n").alias("n"))


def ngram_vocab(df: DataFrame, column: str, min_count: int = 1, num_tokens: int = 100_000,
                min_n: int = 3, max_n: int = 6) -> DataFrame:
    """The `num_tokens` most frequent n-grams that occur `min_count` times, with a dense id from 0.

    The vocabulary size is the operator's own bound, so numbering it in one partition is safe: the top is
    taken per partition before anything is gathered.
    """
    top = (
        ngram_counts(df, column, min_n, max_n)
        .where(F.col("n") >= min_count)
        .orderBy(F.desc("n"), "ngram").limit(num_tokens)
    )
    return top.select("ngram", "n", (F.row_number().over(W.orderBy(F.desc("n"), "ngram")) - 1).alias("id"))
