"""Shared cores of the evaluation reports: level rows, confusion counts and class scores.

Everything here first shrinks the predictions table to counts per (key, true code, predicted code) with a
map-side combine; whatever follows (averages, thresholds, facets) works on that small table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def one_if(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def prediction_levels(columns: Sequence[str]) -> list[int]:
    """Levels that have a `predicted_level{N}` column."""
    found = (re.fullmatch(r"predicted_level(\d+)", name) for name in columns)
    return sorted(int(match.group(1)) for match in found if match)


def max_rank(columns: Sequence[str], level: int) -> int:
    """Highest rank with a column for the level, at least 1."""
    found = (re.fullmatch(rf"predicted_level{level}_top(\d+)", name) for name in columns)
    return max([1, *(int(match.group(1)) for match in found if match)])


def rank_columns(columns: Sequence[str], level: int, up_to: int | None = None) -> list[str]:
    """Prediction columns of a level in rank order."""
    last = max_rank(columns, level) if up_to is None else up_to
    names = [f"predicted_level{level}"] + [f"predicted_level{level}_top{rank}" for rank in range(2, last + 1)]
    return [name for name in names if name in columns]


def level_rows(df: DataFrame, levels: Sequence[int], keep: Sequence[str | Column] = (), true_prefix: str = "level",
               pred_prefix: str = "predicted_level", conf_prefix: str | None = None) -> DataFrame:
    """One row per input row and level: `level, truth, pred[, conf]` next to the kept columns."""
    def row(level: int) -> Column:
        fields = [
            F.lit(level).alias("level"),
            F.col(f"{true_prefix}{level}").alias("truth"),
            F.col(f"{pred_prefix}{level}").alias("pred"),
        ]
        if conf_prefix:
            fields.append(F.col(f"{conf_prefix}{level}").cast("double").alias("conf"))
        return F.struct(*fields)

    return df.select(*keep, F.inline(F.array(*[row(level) for level in levels])))


def confusion_counts(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per `(keys, truth, pred)`."""
    return rows.groupBy(*keys, "truth", "pred").agg(F.count("*").alias("n"))


def class_scores(confusion: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per class: support, predicted, tp, precision, recall and F1, a zero denominator giving 0.

    Each confusion cell counts once for its true and once for its predicted class, so no self-join is needed.
    """
    zero = F.lit(0).cast("long")
    sides = confusion.select(*keys, F.inline(F.array(
        F.struct(F.col("truth").alias("cls"), F.col("n").alias("support"), zero.alias("predicted"),
                 F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("pred").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    ))).where(F.col("cls").isNotNull())
    totals = sides.groupBy(*keys, "cls").agg(*[F.sum(name).alias(name) for name in ("support", "predicted", "tp")])
    return with_class_metrics(totals)


def with_class_metrics(totals: DataFrame) -> DataFrame:
    """Add `precision, recall, f1` to rows with `support, predicted, tp`."""
    none = F.lit(0.0)
    return totals.withColumns({
        "precision": F.coalesce(ratio(F.col("tp"), F.col("predicted")), none),
        "recall": F.coalesce(ratio(F.col("tp"), F.col("support")), none),
        "f1": F.coalesce(ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")), none),
    })


def averaged(metric: str, average: str) -> Column:
    """Aggregate of a class metric: weighted by support, plain mean, or micro (share of correct rows)."""
    if average == "weighted":
        return ratio(F.sum(F.col(metric) * F.col("support")), F.sum("support"))
    if average == "macro":
        return F.avg(metric)
    if average == "micro":
        return ratio(F.sum("tp"), F.sum("support"))
    raise ValueError(f"average must be weighted, macro or micro, not {average!r}")


def accuracy_and_f1(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`n, accuracy, f1_weighted, n_true, n_pred` per key from class scores."""
    return scores.groupBy(*keys).agg(
        F.sum("support").alias("n"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        averaged("f1", "weighted").alias("f1_weighted"),
        F.count_if(F.col("support") > 0).alias("n_true"),
        F.count_if(F.col("predicted") > 0).alias("n_pred"),
    )


def hit_rank(true: Column, candidates: Sequence[Column]) -> Column:
    """1-based rank of the first candidate equal to the truth, 0 when none is."""
    return F.coalesce(F.array_position(F.array(*candidates), true).cast("int"), F.lit(0))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions, F.lit(False))
