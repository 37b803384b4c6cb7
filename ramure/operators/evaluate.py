"""Evaluation of a predictions table: top-k accuracy, confidence thresholds, class reports, facets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ramure.functions.codes import LEVELS, code_level, with_levels
from ramure.operators.scoring import (
    accuracy_and_f1, all_of, any_of, averaged, class_scores, confusion_counts, hit_rank, level_rows, max_rank, one_if,
    prediction_levels, rank_columns, ratio, with_class_metrics,
)

SOURCE_FLAGS = ("manual_from_app", "manual_from_books", "receips_from_app", "suggester")
THRESHOLDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def ensure_true_labels(df: DataFrame, code_column: str = "code") -> DataFrame:
    """Add `level1..5` from the code column unless `level1` is there."""
    if "level1" in df.columns:
        return df
    if code_column not in df.columns:
        raise ValueError(f"the table has neither level1..level5 nor {code_column}")
    return with_levels(df, code_column)


def ensure_predicted_levels(df: DataFrame) -> DataFrame:
    """Derive `predicted_level{N}[_top{R}]` from full predicted codes; blank alternatives give ''."""
    if "predicted_level1" in df.columns or "predicted_code" not in df.columns:
        return df
    derived = {f"predicted_level{n}": code_level("predicted_code", n) for n in LEVELS}
    rank = 2
    while f"predicted_code_top{rank}" in df.columns:
        code = F.col(f"predicted_code_top{rank}")
        for n in LEVELS:
            derived[f"predicted_level{n}_top{rank}"] = F.when(
                F.coalesce(code, F.lit("")) == "", F.lit("")).otherwise(code_level(code, n))
        rank += 1
    return df.withColumns(derived)


def to_long(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Wide predictions to `(id, level, rank, truth, code, confidence)`, levels and ranks read from the schema."""
    columns = df.columns

    def row(level: int, rank: int, name: str) -> Column:
        confidence = name.replace("predicted_", "confidence_")
        value = F.col(confidence).cast("double") if confidence in columns else F.lit(None).cast("double")
        return F.struct(F.lit(level).alias("level"), F.lit(rank).alias("rank"), F.col(f"level{level}").alias("truth"),
                        F.col(name).alias("code"), value.alias("confidence"))

    rows = [
        row(level, rank, name)
        for level in prediction_levels(columns) if f"level{level}" in columns
        for rank, name in enumerate(rank_columns(columns, level), start=1)
    ]
    return df.select(F.col(id_column), F.inline(F.array(*rows)))


def topk_accuracy(df: DataFrame, ks: Sequence[int] = (1, 2, 3, 4, 5), keys: Sequence[str] = (),
                  levels: Sequence[int] | None = None, denominator: str = "valid") -> DataFrame:
    """Share of rows whose true code is among the first k predictions: `keys, level, k, accuracy, n`, with the
    number of rows that have a prediction and of all rows (`n_predicted, n_rows`).

    `denominator` is `valid` (truth and first prediction present) or `all` (every row of the subset). A k beyond
    the available ranks gives NULL. All levels and ks come from one scan and one aggregation.
    """
    columns = df.columns
    levels = [n for n in (levels or prediction_levels(columns)) if f"predicted_level{n}" in columns]
    if not levels:
        raise ValueError("no predicted_level{N} column")

    def row(level: int) -> Column:
        true = F.col(f"level{level}")
        candidates = [F.col(name) for name in rank_columns(columns, level)]
        present = true.isNotNull() & candidates[0].isNotNull()
        counted = present if denominator == "valid" else F.lit(True)
        return F.struct(F.lit(level).alias("level"), F.lit(max_rank(columns, level)).alias("max_k"),
                        counted.alias("counted"), candidates[0].isNotNull().alias("predicted"),
                        hit_rank(true, candidates).alias("hit"))

    rows = df.select(*keys, F.inline(F.array(*[row(level) for level in levels])))
    hits = [F.sum(one_if(F.col("counted") & F.col("hit").between(1, k))).alias(f"hits_{k}") for k in ks]
    summed = rows.groupBy(*keys, "level", "max_k").agg(
        F.sum(one_if(F.col("counted"))).alias("n"), F.sum(one_if(F.col("predicted"))).alias("n_predicted"),
        F.count("*").alias("n_rows"), *hits)
    per_k = [
        F.struct(F.lit(k).alias("k"),
                 F.when((F.col("max_k") >= k) if denominator == "valid" else F.lit(True),
                        ratio(F.col(f"hits_{k}"), F.col("n"))).alias("accuracy"))
        for k in ks
    ]
    return summed.select(*keys, "level", "n", "n_predicted", "n_rows", F.inline(F.array(*per_k))).select(
        *keys, "level", "k", "accuracy", "n", "n_predicted", "n_rows")


def topk_overall(df: DataFrame, ks: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Top-k accuracy per level over rows with a truth and a first prediction."""
    return topk_accuracy(df, ks).drop("n_predicted", "n_rows")


def topk_by_group(df: DataFrame, group: str, ks: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Top-k accuracy per value of `group` and level; the group's own level and groups never predicted are left out."""
    named = df.withColumn("group_value", F.col(group)).where(F.col("group_value").isNotNull())
    levels = [n for n in prediction_levels(df.columns) if f"level{n}" != group]
    return topk_accuracy(named, ks, ["group_value"], levels).where(F.col("n_predicted") > 0).drop("n_predicted", "n_rows")


def topk_all_rows(df: DataFrame, ks: Sequence[int] = (1, 3, 5), keys: Sequence[str] = ()) -> DataFrame:
    """Top-k accuracy over every row; a k beyond the available ranks uses those there are."""
    return topk_accuracy(df, ks, keys, None, "all").drop("n_predicted", "n_rows")


def topk_by_flags(df: DataFrame, flags: Sequence[str], ks: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Top-k accuracy overall and for each flag true and false (NULL counts as false), with the subset's size."""
    columns = set(df.columns)
    facets = [F.struct(F.lit("all").alias("flag"), F.lit(None).cast("boolean").alias("value"))] + [
        F.struct(F.lit(name).alias("flag"), F.coalesce(F.col(name), F.lit(False)).alias("value"))
        for name in flags if name in columns
    ]
    levels = prediction_levels(df.columns)
    needed = [name for n in levels for name in [f"level{n}", *rank_columns(df.columns, n)]]
    rows = df.select(*dict.fromkeys(needed), F.inline(F.array(*facets)))
    return topk_accuracy(rows, ks, ["flag", "value"], levels).drop("n_predicted").withColumnRenamed("n_rows", "n_subset")


def filter_true(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where all the named flags are true."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"filter columns not found: {missing}")
    return df.where(all_of([F.coalesce(F.col(name).cast("boolean"), F.lit(False)) for name in columns]))


def filter_sources(df: DataFrame, sources: Sequence[str] | None = None, logic: str = "any") -> DataFrame:
    """Rows by source flags: `any`, `all`, `only` (all of them, none of the others) or `none` of the listed."""
    if sources is None:
        return df
    unknown = [name for name in sources if name not in SOURCE_FLAGS]
    if unknown:
        raise ValueError(f"unknown source flags {unknown}, valid are {list(SOURCE_FLAGS)}")
    some = any_of([F.coalesce(F.col(name), F.lit(False)) for name in sources])
    every = all_of([F.coalesce(F.col(name), F.lit(True)) for name in sources])
    others = any_of([F.coalesce(F.col(name), F.lit(False)) for name in SOURCE_FLAGS if name not in sources])
    conditions = {"any": some, "all": every, "only": every & ~others, "none": ~some}
    if logic not in conditions:
        raise ValueError(f"logic must be any, all, only or none, not {logic!r}")
    return df.where(conditions[logic])


def _threshold_metrics(counts: DataFrame, keys: Sequence[str], thresholds: Sequence[float], average: str) -> DataFrame:
    """Metrics per key and threshold from `keys, bucket, truth, pred, n`.

    `bucket` says how many thresholds the confidence reaches; a counted cell takes part in each of them. Position 0
    carries all rows of the key, which gives the coverage its denominator without a second scan.
    """
    zero = F.lit(0).cast("long")

    def side(position: Column, cls: Column, support: Column, predicted: Column, tp: Column) -> Column:
        return F.struct(position.alias("position"), cls.alias("cls"), support.alias("support"),
                        predicted.alias("predicted"), tp.alias("tp"))

    true, pred, n = F.col("truth"), F.col("pred"), F.col("n")
    correct = F.when(true == pred, n).otherwise(zero)
    reached = F.filter(F.sequence(F.lit(0), F.col("bucket")), lambda p: p > 0)
    entries = F.concat(
        F.array(side(F.lit(0), F.lit(None).cast("string"), n, zero, zero)),
        F.transform(reached, lambda p: side(p, true, n, zero, correct)),
        F.transform(reached, lambda p: side(p, pred, zero, n, zero)),
    )
    totals = (
        counts.select(*keys, F.inline(entries)).groupBy(*keys, "position", "cls")
        .agg(*[F.sum(name).alias(name) for name in ("support", "predicted", "tp")])
    )
    per_position = with_class_metrics(totals).groupBy(*keys, "position").agg(
        F.sum("support").alias("n_samples"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[averaged(name, average).alias(name) for name in ("f1", "precision", "recall")],
    )
    values = F.struct("n_samples", "accuracy", "f1", "precision", "recall")
    by_key = per_position.groupBy(*keys).agg(
        F.max(F.when(F.col("position") == 0, F.col("n_samples"))).alias("total"),
        F.map_from_entries(F.collect_list(F.struct(F.col("position"), values.alias("v")))).alias("found"),
    )
    grid = F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.lit(i).alias("position"))
        for i, t in enumerate(sorted(thresholds), start=1)
    ])
    spread = by_key.select(*keys, "total", "found", F.inline(grid)).withColumn(
        "v", F.try_element_at("found", F.col("position")))
    n_samples = F.coalesce(F.col("v.n_samples"), zero)
    return spread.select(
        *keys, "threshold", *[F.col(f"v.{name}").alias(name) for name in ("accuracy", "f1", "precision", "recall")],
        F.coalesce(ratio(n_samples, F.col("total")), F.lit(0.0)).alias("coverage"), n_samples.alias("n_samples"),
    )


def _bucketed(rows: DataFrame, keys: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """Counts per `keys, bucket, truth, pred`; rows without truth or prediction collapse into bucket 0."""
    present = F.col("truth").isNotNull() & F.col("pred").isNotNull()
    reached = sum((one_if(F.col("conf") >= float(t)) for t in sorted(thresholds)), F.lit(0))
    bucket = F.when(present, reached).otherwise(F.lit(0))
    text = F.lit(None).cast("string")
    return (
        rows.select(*keys, bucket.alias("bucket"), F.when(bucket > 0, F.col("truth")).otherwise(text).alias("truth"),
                    F.when(bucket > 0, F.col("pred")).otherwise(text).alias("pred"))
        .groupBy(*keys, "bucket", "truth", "pred").agg(F.count("*").alias("n"))
    )


def _source_label(sources: Sequence[str] | None, logic: str) -> str:
    return f"{logic}({', '.join(sources)})" if sources else "all"


def metrics_by_confidence(df: DataFrame, levels: Sequence[int] = (1, 2, 3, 4), thresholds: Sequence[float] = THRESHOLDS,
                          average: str = "weighted", sources: Sequence[str] | None = None,
                          logic: str = "any") -> DataFrame:
    """Accuracy, F1, precision, recall, coverage and size per level and minimum confidence.

    Needs `level{N}, predicted_level{N}, confidence_level{N}`; levels with a missing column are left out.
    """
    levels = [n for n in levels
              if {f"level{n}", f"predicted_level{n}", f"confidence_level{n}"} <= set(df.columns)]
    rows = level_rows(filter_sources(df, sources, logic), levels, conf_prefix="confidence_level")
    result = _threshold_metrics(_bucketed(rows, ["level"], thresholds), ["level"], thresholds, average)
    return result.withColumn("source_filter", F.lit(_source_label(sources, logic)))


def metrics_all_sources(df: DataFrame, levels: Sequence[int] = (1, 2, 3, 4),
                        thresholds: Sequence[float] = (0.0, 0.3, 0.5, 0.7, 0.9), average: str = "weighted") -> DataFrame:
    """`metrics_by_confidence` for all rows, for each source flag, and for rows without any flag, in one job.

    The table is counted once per combination of flags; only those counts are repeated per filter.
    """
    flags = [name for name in SOURCE_FLAGS if name in df.columns]
    known = df.withColumns({name: F.coalesce(F.col(name), F.lit(False)) for name in flags})
    rows = level_rows(known, levels, flags, conf_prefix="confidence_level")
    counts = _bucketed(rows, [*flags, "level"], thresholds)
    labels = [F.lit("all")] + [F.when(F.col(name), F.lit(f"any({name})")) for name in flags]
    always = ["all"]
    if len(flags) == len(SOURCE_FLAGS):
        none_label = _source_label(SOURCE_FLAGS, "none")
        labels.append(F.when(~any_of([F.col(name) for name in flags]), F.lit(none_label)))
        always.append(none_label)
    labelled = counts.select(F.explode(F.array_compact(F.array(*labels))).alias("source_filter"),
                             "level", "bucket", "truth", "pred", "n")
    # the two filters that are always reported, even without rows
    empty = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(label) for label in always])).alias("source_filter"), F.lit(0).alias("bucket"),
        F.lit(None).cast("string").alias("truth"), F.lit(None).cast("string").alias("pred"),
        F.lit(0).cast("long").alias("n"),
    ).withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels])))
    return _threshold_metrics(labelled.unionByName(empty), ["source_filter", "level"], thresholds, average)


def report_rows(scores: DataFrame) -> DataFrame:
    """Class rows followed by accuracy, macro and weighted averages: `kind, label, precision, recall, f1, support`."""
    kinds = F.array(
        F.struct(F.lit("class").alias("kind"), F.col("cls").alias("label")),
        *[F.struct(F.lit(name).alias("kind"), F.lit(name).alias("label"))
          for name in ("accuracy", "macro avg", "weighted avg")],
    )
    rows = scores.select("support", "tp", "precision", "recall", "f1", F.inline(kinds))

    def metric(name: str) -> Column:
        return (
            F.when(F.col("kind") == "accuracy", averaged(name, "micro"))
            .when(F.col("kind") == "weighted avg", averaged(name, "weighted"))
            .otherwise(averaged(name, "macro")).alias(name)
        )

    return rows.groupBy("kind", "label").agg(metric("precision"), metric("recall"), metric("f1"),
                                             F.sum("support").alias("support"))


def classification_report(df: DataFrame, level: int, min_confidence: float = 0.0,
                          sources: Sequence[str] | None = None, logic: str = "any") -> DataFrame:
    """Per-class precision, recall, F1 and support of one level at a minimum confidence, with the averages."""
    kept = filter_sources(df, sources, logic).where(F.col(f"confidence_level{level}") >= min_confidence)
    rows = level_rows(kept, [level]).where(F.col("truth").isNotNull() & F.col("pred").isNotNull())
    return report_rows(class_scores(confusion_counts(rows)))


def exact_match(df: DataFrame, true: str = "code", predicted: str = "predicted_code") -> DataFrame:
    """Accuracy and weighted F1 on the full code; a missing prediction is wrong."""
    rows = df.select(F.col(true).alias("truth"), F.col(predicted).alias("pred")).where(F.col("truth").isNotNull())
    return accuracy_and_f1(class_scores(confusion_counts(rows))).select("n", "accuracy", "f1_weighted")


def _code_hit(columns: Sequence[str]) -> Column:
    """Rank of the true code after blank alternatives were removed."""
    ranks = []
    while f"predicted_code_top{len(ranks) + 2}" in columns:
        ranks.append(F.col(f"predicted_code_top{len(ranks) + 2}"))
    if not ranks:
        return hit_rank(F.col("code"), [F.col("predicted_code")])
    alternatives = F.filter(F.array(*ranks), lambda code: F.trim(code) != "")
    candidates = F.concat(F.array("predicted_code"), alternatives)
    return F.coalesce(F.array_position(candidates, F.col("code")).cast("int"), F.lit(0))


def code_topk(df: DataFrame, k: int = 5) -> DataFrame:
    """Full-code top-1..k accuracy; blank alternatives don't take up a rank."""
    hits = df.select(_code_hit(df.columns).alias("hit"))
    summed = hits.agg(F.count("*").alias("n"),
                      *[F.sum(one_if(F.col("hit").between(1, i))).alias(f"h{i}") for i in range(1, k + 1)])
    return summed.select("n", F.inline(F.array(*[
        F.struct(F.lit(i).alias("k"), ratio(F.col(f"h{i}"), F.col("n")).alias("accuracy")) for i in range(1, k + 1)
    ]))).select("k", "accuracy", "n")


def evaluation_report(df: DataFrame, top_k: int = 5, amount_threshold: float = 200.0) -> DataFrame:
    """Accuracy, weighted F1 and top-k overall and by level, source file, amount and kind of shop.

    Rows `facet, key, n, accuracy, f1_weighted, top_1..top_k`; a row counts in each facet it belongs to.
    Facets by level carry no top-k.
    """
    code, pred = F.col("code"), F.col("predicted_code")
    hit = _code_hit(df.columns)
    label = f"{amount_threshold:.0f}"

    def facet(name: str, key: Column, true: Column = code, predicted: Column = pred, rank: Column = hit) -> Column:
        return F.struct(F.lit(name).alias("facet"), key.alias("key"), true.alias("truth"), predicted.alias("pred"),
                        rank.alias("hit"))

    def by_level(n: int) -> Column:
        true, predicted = code_level(code, n), code_level(pred, n)
        key = F.when(true.isNotNull() & predicted.isNotNull(), F.lit(f"level{n}"))
        return facet("level", key, true, predicted, F.lit(None).cast("int"))

    amount = F.when(F.col("amount") <= amount_threshold, F.lit(f"<= {label}€")).when(
        F.col("amount") > amount_threshold, F.lit(f"> {label}€"))
    shop = F.when(F.col("is_hypermarche"), F.lit("Hypermarchés")).when(~F.col("is_hypermarche"), F.lit("Autres"))
    facets = [facet("overall", F.lit("overall")), *[by_level(n) for n in LEVELS],
              facet("source", F.col("source_file")), facet("amount", amount), facet("store", shop)]
    rows = df.select(F.inline(F.array(*facets))).where(F.col("key").isNotNull())
    counts = rows.groupBy("facet", "key", "truth", "pred", "hit").agg(F.count("*").alias("n"))
    # the rank rides along as a pseudo class, so the counts are shuffled once for both kinds of metric
    zero = F.lit(0).cast("long")

    def side(cls: Column, support: Column, predicted: Column, tp: Column, hits: Column, ranked: Column) -> Column:
        return F.struct(cls.alias("cls"), support.alias("support"), predicted.alias("predicted"), tp.alias("tp"),
                        hits.alias("hit"), ranked.alias("ranked"))

    true, predicted, n = F.col("truth"), F.col("pred"), F.col("n")
    sides = counts.select("facet", "key", F.inline(F.array(
        side(true, n, zero, F.when(true == predicted, n).otherwise(zero), F.lit(None).cast("int"), zero),
        side(predicted, zero, n, zero, F.lit(None).cast("int"), zero),
        side(F.lit(None).cast("string"), zero, zero, zero, F.col("hit"), n),
    ))).where(F.col("cls").isNotNull() | F.col("hit").isNotNull())
    totals = sides.groupBy("facet", "key", "cls", "hit").agg(
        *[F.sum(name).alias(name) for name in ("support", "predicted", "tp", "ranked")])
    tops = [
        ratio(F.sum(F.when(F.col("hit").between(1, k), F.col("ranked"))), F.sum("ranked")).alias(f"raw_{k}")
        for k in range(1, top_k + 1)
    ]
    summed = with_class_metrics(totals).groupBy("facet", "key").agg(
        F.sum("support").alias("n"), ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        averaged("f1", "weighted").alias("f1_weighted"), F.sum("ranked").alias("n_ranked"), *tops)
    return summed.select("facet", "key", "n", "accuracy", "f1_weighted", *[
        F.when(F.col("n_ranked") > 0, F.coalesce(F.col(f"raw_{k}"), F.lit(0.0))).alias(f"top_{k}")
        for k in range(1, top_k + 1)
    ])


def flatten_metrics(report: DataFrame, prefix: str = "eval") -> DataFrame:
    """Report rows as `(key, value)` metrics, unsafe characters of the keys replaced by `_`."""
    metrics = [name for name in report.columns if name in ("accuracy", "f1_weighted") or name.startswith("top_")]
    safe = F.regexp_replace("key", r"[^a-zA-Z0-9_\-.]", "_")
    scope = (
        F.when(F.col("facet") == "overall", F.lit(f"{prefix}.overall"))
        .when(F.col("facet") == "level", F.concat(F.lit(f"{prefix}."), safe))
        .otherwise(F.concat(F.lit(f"{prefix}."), F.col("facet"), F.lit("."), safe))
    )
    return (
        report.select(scope.alias("scope"), "facet", *metrics)
        .unpivot(["scope", "facet"], metrics, "metric", "value")
        .where((F.col("facet") != "level") | ~F.col("metric").startswith("top_"))
        .select(F.concat("scope", F.lit("."), "metric").alias("key"), "value")
    )
