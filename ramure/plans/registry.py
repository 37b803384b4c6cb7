"""The registry of queries: each is a Spark plan on a data folder, most with equivalent SQL for DuckDB."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ramure.functions.codes import with_levels
from ramure.operators.analytics import enrich_predictions
from ramure.operators.evaluate import ensure_predicted_levels
from ramure.plans.fixtures import Views, with_views

SHIFT = 1e-9

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs(Views):
    """Views plus the prepared predictions tables the reports take."""

    @cached_property
    def base(self) -> DataFrame:
        return enrich_predictions(ensure_predicted_levels(self.preds))

    @cached_property
    def report_base(self) -> DataFrame:
        return enrich_predictions(ensure_predicted_levels(self.preds), null_pred_is_error=True)

    @cached_property
    def evaluated(self) -> DataFrame:
        """Predictions with their level columns and a confidence per level."""
        leveled = with_levels(ensure_predicted_levels(self.preds))
        return leveled.withColumns({f"confidence_level{n}": F.col("confidence") for n in range(1, 6)})


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that the order of additions can't show; the shift keeps exact halves off the edge."""
    return df.select(*[
        F.round(F.col(f"`{field.name}`") + SHIFT, 6).alias(field.name) if isinstance(field.dataType, T.DoubleType)
        else F.col(f"`{field.name}`")
        for field in df.schema.fields
    ])


def z(text: str) -> str:
    """SQL: zero-padded to two characters, never cut."""
    return f"(CASE WHEN length({text}) < 2 THEN lpad({text}, 2, '0') ELSE {text} END)"


def level_sql(code: str, n: int, padded: bool = False) -> str:
    """SQL: level `n` of a code by splitting and joining its segments."""
    parts = f"string_split({code}, '.')"
    first = z(f"split_part({code}, '.', 1)")
    if n == 1:
        return f"(CASE WHEN {code} IS NOT NULL THEN {first} END)"
    if padded:
        return f"(CASE WHEN len({parts}) >= {n} THEN {first} || '.' || array_to_string(list_slice({parts}, 2, {n}), '.') END)"
    return f"(CASE WHEN len({parts}) >= {n} THEN array_to_string(list_slice({parts}, 1, {n}), '.') END)"


def _predicted_sql() -> str:
    columns = [f"{level_sql('predicted_code', n)} AS predicted_level{n}" for n in range(1, 6)]
    for rank in (2, 3):
        code = f"predicted_code_top{rank}"
        columns += [
            f"CASE WHEN coalesce({code}, '') = '' THEN '' ELSE {level_sql(code, n)} END AS predicted_level{n}_top{rank}"
            for n in range(1, 6)
        ]
    return "SELECT *, " + ", ".join(columns) + " FROM preds"


def _base_sql(report: bool) -> str:
    trues = ", ".join(f"{level_sql('code', n, True)} AS true_level{n}" for n in (1, 2, 3, 4))
    if report:
        errors = ", ".join(
            f"(true_level{n} IS NOT NULL AND true_level{n} IS DISTINCT FROM predicted_level{n}) AS err_l{n}" for n in (1, 2, 3, 4))
        low, unit = "> 0", ""
    else:
        errors = ", ".join(f"coalesce(true_level{n} <> predicted_level{n}, false) AS err_l{n}" for n in (1, 2, 3, 4))
        low, unit = ">= 0", " €"
    bands = " ".join(
        f"WHEN budget_num {low if a == 0 else f'> {a}'} AND budget_num <= {b} THEN '{a}-{b}{unit}'"
        for a, b in ((0, 2), (2, 5), (5, 10), (10, 20), (20, 50), (50, 100)))
    return f"""
        SELECT *, true_level1 IN ('98', '99') AS is_technical, {errors},
               coalesce(true_level4 = predicted_level4, false) AS correct_l4,
               CASE WHEN true_level4 IS NULL OR predicted_level4 IS NULL THEN NULL
                    WHEN true_level1 <> predicted_level1 THEN 'far-miss' WHEN true_level2 <> predicted_level2 THEN 'L2 faux'
                    WHEN true_level3 <> predicted_level3 THEN 'L3 faux' WHEN true_level4 <> predicted_level4 THEN 'near-miss'
                    ELSE 'correct' END AS error_severity,
               CASE {bands} WHEN budget_num > 100 THEN '100+{unit}' END AS budget_tranche
        FROM (SELECT *, {trues}, CAST(len(string_split(code, '.')) AS INTEGER) AS code_depth,
                     TRY_CAST(confidence AS DOUBLE) AS confidence_num, TRY_CAST(budget AS DOUBLE) AS budget_num,
                     TRY_CAST(annee AS INTEGER) AS annee_int, CAST(length(coalesce(l_pr_product, '')) AS INTEGER) AS text_len
              FROM predicted) leveled"""


# Prepared inputs, written for the oracle independently of the Spark operators.
PREPARED = {
    "predicted": _predicted_sql(),
    "base": _base_sql(False),
    "report_base": _base_sql(True),
    "evaluated": "SELECT *, " + ", ".join(
        [f"{level_sql('code', n)} AS level{n}" for n in range(1, 6)]
        + [f"confidence AS confidence_level{n}" for n in range(1, 6)]) + " FROM predicted",
}
_PREPARED_NEEDS = {"predicted": (), "base": ("predicted",), "report_base": ("predicted",), "evaluated": ("predicted",)}


def register(name: str, build: Callable[[Inputs], DataFrame], sql: str | None = None,
             ctes: dict[str, str] | None = None) -> None:
    """Register a query; `sql` may use the views, the prepared inputs and its own `ctes`."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: _rounded(build(Inputs(spark, sf_dir)))
    if sql is not None:
        text = " ".join([sql, *(ctes or {}).values()])
        extra: dict[str, str] = {}
        for prepared in PREPARED:
            if prepared in text.replace("report_base", "" if prepared == "base" else "report_base"):
                for need in (*_PREPARED_NEEDS[prepared], prepared):
                    extra[need] = PREPARED[need]
        # the same rounding rule as `_rounded`
        ORACLES[name] = re.sub(r"(?<!range\(1), 6\)", f" + {SHIFT}, 6)", with_views(sql, {**extra, **(ctes or {})}))
