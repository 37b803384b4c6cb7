"""Exact order statistics that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W



def exact_median(df: DataFrame, value: str, keys: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Interpolated median of the non-NULL values per key: `keys, median, n`.

    A mergeable quantile sketch brackets the middle; a second pass counts what lies below the bracket and the
    distinct values inside it, about 10/accuracy of the rows. Only those few counts are put in order. A key of all
    rows or one value in a third of them costs no more than any other. Keys must have few values, such as bands.
    """
    margin = 5.0 / accuracy
    valued = df.select(*[F.col(key) for key in keys], F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    brackets = valued.groupBy(*keys).agg(
        F.percentile_approx("v", [0.5 - margin, 0.5 + margin], accuracy).alias("q"), F.count("*").alias("n"))
    brackets = brackets.select(*[F.col(key).alias(f"k_{key}") for key in keys], F.col("q")[0].alias("lo"),
                               F.col("q")[1].alias("hi"), "n")
    if keys:
        same = [F.col(key).eqNullSafe(F.col(f"k_{key}")) for key in keys]
        joined = valued.join(brackets, same)
    else:
        joined = valued.withColumn("b", brackets.select(F.struct("lo", "hi", "n")).scalar()).select("v", "b.*")
    outside = F.when(F.col("v") < F.col("lo"), F.lit(-1)).when(F.col("v") > F.col("hi"), F.lit(1)).otherwise(F.lit(0))
    counts = (
        joined.select(*keys, "n", outside.alias("side"), F.when(outside == 0, F.col("v")).alias("v"))
        .groupBy(*keys, "n", "side", "v").agg(F.count("*").alias("c"))
        .where(F.col("side") < 1)
    )
    order = W.partitionBy(*keys).orderBy("side", "v").rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("c").over(order)).where(F.col("side") == 0)
    low, high = F.floor((F.col("n") + 1) / 2), F.ceil((F.col("n") + 1) / 2)

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") >= position, F.col("v")))

    return ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias("median"), F.max("n").alias("n"))
