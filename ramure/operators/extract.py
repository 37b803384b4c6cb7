"""From transactions to products with a code."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ramure.sources.readers import read_periods

OUTPUT = ("description_ean", "variete", "coicop_code")


def distinct_products(tx: DataFrame) -> DataFrame:
    """Distinct `(description_ean, variete, id_famille)`; duplicates are dropped before the shuffle."""
    return tx.select("description_ean", "variete", "id_famille").distinct()


def map_codes(tx: DataFrame, family: DataFrame) -> DataFrame:
    """Add `coicop_code`: the family's code when the variety starts with 99, else the variety.

    A family listed twice yields the product twice, whatever its variety. No broadcast hint: Spark broadcasts the
    mapping below its size threshold, and splits a hot family in the sort-merge join above it.
    """
    mapping = family.select("id_famille", F.col("coicop").alias("__family_code"))
    code = F.when(F.col("variete").startswith("99"), F.col("__family_code")).otherwise(F.col("variete"))
    return tx.join(mapping, "id_famille", "left").select("description_ean", "variete", code.alias("coicop_code"))


def filter_codes(df: DataFrame) -> DataFrame:
    """Codes of ten characters or more that don't start with 99; products without a code are dropped."""
    return df.where((F.length("coicop_code") >= 10) & (F.substring("coicop_code", 1, 2) != "99"))


def union_periods(periods: Sequence[DataFrame]) -> DataFrame:
    """Union by name; the rows of several periods are distinct, those of a single one stay as they are."""
    result = periods[0]
    for period in periods[1:]:
        result = result.unionByName(period, allowMissingColumns=True)
    return result.distinct() if len(periods) > 1 else result


def extract_products(tx: DataFrame, family: DataFrame, n_periods: int = 1) -> DataFrame:
    """Map and filter the products of one table holding `n_periods` periods.

    Several periods end in distinct output rows, so nothing is gained by removing duplicates before the mapping too:
    the whole job has one shuffle either way.
    """
    if n_periods > 1:
        return filter_codes(map_codes(tx, family)).distinct()
    return filter_codes(map_codes(distinct_products(tx), family))


def extract(spark: SparkSession, base: str, family: DataFrame, years: Sequence[int],
            months: Sequence[int] | None = None) -> DataFrame:
    """Products of the given years (and months) with their code; a period is a year, or a month of a year."""
    tx = read_periods(spark, base, years, months)
    return extract_products(tx, family, len(years) * len(months or [None]))


def plan_text(df: DataFrame) -> str:
    """The formatted plan of a table, for a dry run."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def passage_map(sample: DataFrame, passage: DataFrame) -> DataFrame:
    """`(product, code)`: varieties translated by the passage table, others dropped."""
    translated = passage.select(F.col("code_variete_ecoicopv1").alias("variete"), F.col("code_sous_classe_ecoicopv2").alias("code"))
    return sample.join(translated, "variete").select(F.col("description_ean").alias("product"), "code")


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct `(product, code)` of both tables."""
    return first.select("product", "code").union(second.select("product", "code")).distinct()
