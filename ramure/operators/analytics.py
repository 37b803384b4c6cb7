"""Reports on an enriched predictions table.

`enrich_predictions` derives the columns all reports share; each report is one filtered scan, one map-side combined
aggregation, and arithmetic on the few rows that leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ramure.functions.codes import TECHNICAL, code_depth, code_level
from ramure.operators.scoring import (
    accuracy_and_f1, class_scores, confusion_counts, hit_rank, level_rows, one_if, rank_columns, ratio,
)
from ramure.operators.statistics import exact_median

REPORT_LEVELS = (1, 2, 3, 4)
BUDGET_EDGES = (0.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, None)
BUDGET_LABELS = ("0-2", "2-5", "5-10", "10-20", "20-50", "50-100", "100+")
LENGTH_EDGES = (0.0, 5.0, 10.0, 15.0, 20.0, 30.0, 50.0, None)
LENGTH_LABELS = ("0-5", "5-10", "10-15", "15-20", "20-30", "30-50", "50+")

# Names of the first wrong level, in report order.
ERROR_CATEGORIES = ("Tout correct", "L1-3 ok, erreur L4 seul", "L1-2 ok, erreur des L3", "L1 ok, erreur des L2",
                    "Erreur des L1")


# ---- shared pieces -------------------------------------------------------------------------------------------------

def band(value: Column, edges: Sequence[float | None], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Label of the interval `(a, b]` holding the value; NULL outside. A None edge is unbounded."""
    result = None
    for i, name in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        inside = (value >= low) if i == 0 and include_lowest else (value > low)
        if high is not None:
            inside = inside & (value <= high)
        result = F.when(inside, F.lit(name)) if result is None else result.when(inside, F.lit(name))
    return result


def confidence_bands(parts: int = 10) -> tuple[list[float], list[str]]:
    """Edges `i/parts` and their labels."""
    edges = [i / parts for i in range(parts + 1)]
    return edges, [f"{edges[i]:.1f}-{edges[i + 1]:.1f}" for i in range(parts)]


def grid_index(value: Column, parts: int) -> Column:
    """Index i of the right-closed interval `((i-1)/parts, i/parts]`, compared against the edges themselves."""
    guess = F.ceil(value * parts)
    return (
        F.when(value > guess / F.lit(float(parts)), guess + 1)
        .when(value <= (guess - 1) / F.lit(float(parts)), guess - 1)
        .otherwise(guess).cast("int")
    )


def clean(df: DataFrame) -> DataFrame:
    """Rows whose true code isn't technical."""
    return df.where(~F.col("is_technical"))


def _match(level: int) -> Column:
    return F.col(f"true_level{level}") == F.col(f"predicted_level{level}")


def _both(level: int) -> Column:
    return F.col(f"true_level{level}").isNotNull() & F.col(f"predicted_level{level}").isNotNull()


def _level_sums(levels: Sequence[int] = REPORT_LEVELS) -> list[Column]:
    """Per level: rows with a truth, with truth and prediction, and correct ones."""
    return [
        column for n in levels for column in (
            F.sum(one_if(F.col(f"true_level{n}").isNotNull())).alias(f"t{n}"),
            F.sum(one_if(_both(n))).alias(f"b{n}"),
            F.sum(one_if(_match(n))).alias(f"c{n}"),
        )
    ]


def _dimension(name: str, missing: str | None = "N/A") -> Column:
    value = F.col(name).cast("string")
    return F.coalesce(value, F.lit(missing)) if missing is not None else value


# ---- base view -----------------------------------------------------------------------------------------------------

def budget_bands(budget: Column, include_zero: bool = False, suffix: str = "") -> Column:
    """Spending band; 0 belongs to the first band only when `include_zero`, negatives never."""
    return band(budget, BUDGET_EDGES, [f"{label}{suffix}" for label in BUDGET_LABELS], include_zero)


def enrich_predictions(df: DataFrame, null_pred_is_error: bool = False) -> DataFrame:
    """Add true levels, typed confidence, budget and year, text length, error flags, severity and spending band.

    Two laws for errors: by default both codes must be present and differ; with `null_pred_is_error` a missing
    prediction is an error and 0 euros belong to no band.
    """
    code = F.col("code").cast("string")
    leveled = df.withColumns({
        **{f"true_level{n}": code_level(code, n, padded=True) for n in REPORT_LEVELS},
        "code_depth": code_depth(code),
        "confidence_num": F.col("confidence").try_cast("double"),
        "budget_num": F.col("budget").try_cast("double"),
        "annee_int": F.col("annee").try_cast("int"),
        "text_len": F.length(F.coalesce("l_pr_product", F.lit(""))),
    })

    def wrong(n: int) -> Column:
        true, pred = F.col(f"true_level{n}"), F.col(f"predicted_level{n}")
        if null_pred_is_error:
            return true.isNotNull() & ~true.eqNullSafe(pred)
        return F.coalesce(true != pred, F.lit(False))

    def differs(n: int) -> Column:
        return F.col(f"true_level{n}") != F.col(f"predicted_level{n}")

    severity = (
        F.when(~_both(4), F.lit(None).cast("string"))
        .when(differs(1), F.lit("far-miss")).when(differs(2), F.lit("L2 faux")).when(differs(3), F.lit("L3 faux"))
        .when(differs(4), F.lit("near-miss")).otherwise(F.lit("correct"))
    )
    bands = budget_bands(F.col("budget_num"), not null_pred_is_error, "" if null_pred_is_error else " €")
    return leveled.withColumns({
        "is_technical": F.coalesce(F.col("true_level1").isin(*TECHNICAL), F.lit(False)),
        **{f"err_l{n}": wrong(n) for n in REPORT_LEVELS},
        "correct_l4": F.coalesce(_match(4), F.lit(False)),
        "error_severity": severity,
        "budget_tranche": bands,
    })


def filter_predictions(df: DataFrame, exclude_tech: bool = False, source: str | None = None, year: int | None = None,
                       conf_min: float = 0.0) -> DataFrame:
    """The reports' common filter; each part is optional."""
    if exclude_tech:
        df = clean(df)
    if source is not None:
        df = df.where(F.col("source") == source)
    if year is not None:
        df = df.where(F.col("annee_int") == year)
    if conf_min > 0:
        df = df.where(F.col("confidence_num") >= conf_min)
    return df


def filter_domains(df: DataFrame) -> DataFrame:
    """Distinct sources, years and kinds of shop as `(domain, value)`."""
    values = F.array(
        F.struct(F.lit("source").alias("domain"), F.col("source").alias("value")),
        F.struct(F.lit("annee").alias("domain"), F.col("annee_int").cast("string").alias("value")),
        F.struct(F.lit("shop_type_name").alias("domain"), F.col("shop_type_name").alias("value")),
    )
    return df.select(F.inline(values)).where(F.col("value").isNotNull()).distinct()


# ---- accuracy ------------------------------------------------------------------------------------------------------

def kpi(df: DataFrame) -> DataFrame:
    """Rows, technical rows, accuracy in percent at levels 1 and 4 over all rows, mean confidence."""
    regular = ~F.col("is_technical")
    return df.agg(
        F.count("*").alias("n_total"), F.sum(one_if(F.col("is_technical"))).alias("n_tech"),
        *[(F.avg(one_if(regular & _match(n))) * 100).alias(f"acc_l{n}") for n in (1, 4)],
        F.avg(F.when(regular, F.col("confidence_num"))).alias("mean_conf"),
    )


def accuracy_by_level(df: DataFrame, levels: Sequence[int] = REPORT_LEVELS) -> DataFrame:
    """Per level, over rows with truth and prediction: rows, accuracy in percent, weighted F1, classes."""
    rows = level_rows(df, levels, true_prefix="true_level").where(F.col("truth").isNotNull() & F.col("pred").isNotNull())
    scores = class_scores(confusion_counts(rows, ["level"]), ["level"])
    return accuracy_and_f1(scores, ["level"]).select(
        "level", "n", (F.col("accuracy") * 100).alias("accuracy"), "f1_weighted", "n_true", "n_pred")


def topk_curve(df: DataFrame, level: int = 4, max_k: int = 10, require_prediction: bool = True,
               keys: Sequence[str] = ()) -> DataFrame:
    """Top-1..max_k accuracy at one level; ranks without a column leave the curve flat.

    Counted are rows with a truth, and with a first prediction unless `require_prediction` is off.
    """
    names = rank_columns(df.columns, level, max_k)
    true = F.col(f"true_level{level}")
    counted = df.where(true.isNotNull())
    if require_prediction:
        counted = counted.where(F.col(names[0]).isNotNull())
    # a rank column may be missing in between, so every candidate keeps its own rank
    ranks = [int(name.rsplit("top", 1)[1]) if "_top" in name else 1 for name in names]
    position = hit_rank(true, [F.col(name) for name in names])
    rank = F.coalesce(F.get(F.array(*[F.lit(r) for r in ranks]), position - 1), F.lit(0))
    summed = counted.select(*keys, rank.alias("hit")).groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(one_if(F.col("hit").between(1, k))).alias(f"h{k}") for k in range(1, max_k + 1)])
    return summed.select(*keys, "n", F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), ratio(F.col(f"h{k}"), F.col("n")).alias("accuracy")) for k in range(1, max_k + 1)
    ]))).select(*keys, "k", "accuracy", "n")


def topk_by_dim(df: DataFrame, dim: str, max_k: int = 10, level: int = 4) -> DataFrame:
    """`topk_curve` per value of a dimension; rows without a value are left out."""
    named = df.withColumn("dim_val", _dimension(dim, None)).where(F.col("dim_val").isNotNull())
    return topk_curve(named, level, max_k, require_prediction=False, keys=["dim_val"])


def accuracy_by_dim(df: DataFrame, dim: str, limit: int | None = 20, denominator: str = "all",
                    missing: str | None = "N/A") -> DataFrame:
    """Rows and accuracy in percent at levels 1 to 4 per value, largest values first.

    `denominator` is `all` rows of the value or only `valid` ones, with truth and prediction at the level.
    """
    grouped = df.select(_dimension(dim, missing).alias("dim_val"), *_level_columns(df)).where(
        F.col("dim_val").isNotNull()).groupBy("dim_val").agg(F.count("*").alias("n_total"), *_level_sums())
    result = grouped.select("dim_val", "n_total", *[
        (ratio(F.col(f"c{n}"), F.col("n_total" if denominator == "all" else f"b{n}")) * 100).alias(f"acc_l{n}")
        for n in REPORT_LEVELS
    ])
    return result.orderBy(F.desc("n_total"), "dim_val").limit(limit) if limit else result


def _level_columns(df: DataFrame) -> list[str]:
    return [name for n in REPORT_LEVELS for name in (f"true_level{n}", f"predicted_level{n}") if name in df.columns]


def volume_by_dim(df: DataFrame, dim: str, limit: int = 20) -> DataFrame:
    """Rows and mean confidence of the largest values."""
    return (
        df.groupBy(_dimension(dim).alias("dim_val"))
        .agg(F.count("*").alias("n"), F.avg("confidence_num").alias("mean_conf"))
        .orderBy(F.desc("n"), "dim_val").limit(limit)
    )


def heatmap_by_dim(df: DataFrame, dim: str, top: int = 15, denominator: str = "truth",
                   missing: str | None = "N/A") -> DataFrame:
    """`(dim_val, level, accuracy, n)` in percent for the largest values.

    `denominator` is rows with a `truth` at the level, or with `both` truth and prediction. The largest values are
    picked from the same counts that give the accuracies, so the table is read once.
    """
    sizes = (
        df.select(_dimension(dim, missing).alias("dim_val"), *_level_columns(df)).where(F.col("dim_val").isNotNull())
        .groupBy("dim_val").agg(F.count("*").alias("n_total"), *_level_sums())
        .orderBy(F.desc("n_total"), "dim_val").limit(top)
    )
    base = "t" if denominator == "truth" else "b"
    return sizes.select("dim_val", F.inline(F.array(*[
        F.struct(F.lit(n).alias("level"), (ratio(F.col(f"c{n}"), F.col(f"{base}{n}")) * 100).alias("accuracy"),
                 F.col(f"{base}{n}").alias("n"))
        for n in REPORT_LEVELS
    ]))).where(F.col("n") > 0)


def top_dim_accuracy(df: DataFrame, dim: str, top: int = 20) -> DataFrame:
    """Level-4 accuracy of the largest values, next to the accuracy over all rows."""
    sizes = df.where(F.col("true_level4").isNotNull()).groupBy(F.col(dim).alias("dim_val")).agg(
        F.count("*").alias("n"), F.sum(one_if(F.col("correct_l4"))).alias("correct"))
    overall = sizes.agg(ratio(F.sum("correct"), F.sum("n")).alias("mean")).scalar()
    return (
        sizes.where(F.col("dim_val").isNotNull()).orderBy(F.desc("n"), "dim_val").limit(top)
        .select("dim_val", "n", ratio(F.col("correct"), F.col("n")).alias("accuracy"), overall.alias("global_accuracy"))
    )


def dim_accuracy_spread(df: DataFrame, dim: str, min_n: int = 20, bins: int = 30) -> DataFrame:
    """Histogram of the accuracies of all values with `min_n` rows, and the mean of those accuracies."""
    sizes = df.where(F.col("true_level4").isNotNull() & F.col(dim).isNotNull()).groupBy(F.col(dim).alias("dim_val")).agg(
        F.count("*").alias("n"), F.avg(one_if(F.col("correct_l4"))).alias("accuracy")).where(F.col("n") >= min_n)
    limits = sizes.agg(F.struct(F.min("accuracy").alias("lo"), F.max("accuracy").alias("hi"),
                                F.avg("accuracy").alias("mean")).alias("s")).scalar()
    return _histogram(sizes.select("accuracy", limits.alias("s")), "accuracy", bins, ["mean_accuracy"], F.col("s.mean"))


def _histogram(rows: DataFrame, value: str, bins: int, extra: Sequence[str], *extra_values: Column) -> DataFrame:
    """Counts per equal bin of `[s.lo, s.hi]`, the last one closed; a single value gets a range of one around it."""
    flat = F.col("s.lo") == F.col("s.hi")
    low = F.when(flat, F.col("s.lo") - 0.5).otherwise(F.col("s.lo"))
    high = F.when(flat, F.col("s.hi") + 0.5).otherwise(F.col("s.hi"))
    width = (high - low) / F.lit(float(bins))
    index = F.least(F.floor((F.col(value) - low) / (high - low) * bins).cast("int") + 1, F.lit(bins))
    return (
        rows.groupBy(index.alias("bin"), (low + (index - 1) * width).alias("bin_low"), *[
            column.alias(name) for name, column in zip(extra, extra_values)])
        .agg(F.count("*").alias("n"))
    )


# ---- confidence ----------------------------------------------------------------------------------------------------

def confidence_histogram(df: DataFrame) -> DataFrame:
    """Rows and level-4 accuracy per confidence rounded to the nearest twentieth; a missing prediction is wrong."""
    kept = df.where(F.col("confidence_num").isNotNull() & F.col("true_level4").isNotNull())
    return kept.groupBy((F.round(F.col("confidence_num") * 20) / 20).alias("conf_bin")).agg(
        F.count("*").alias("n"), F.avg(one_if(_match(4))).alias("accuracy"))


def coverage_curve(df: DataFrame, steps: int = 20, null_when_empty: bool = False, require_prediction: bool = True) -> DataFrame:
    """Share of rows at or above each threshold `i/steps` and their accuracy.

    Rows are counted per highest threshold they reach; the curve is a running sum over those `steps + 2` counts.
    A missing confidence reaches none but stays in the denominator.
    """
    kept = df.where(F.col("true_level4").isNotNull())
    if require_prediction:
        kept = kept.where(F.col("predicted_level4").isNotNull())
    conf = F.col("confidence_num")
    guess = F.floor(conf * steps)
    reached = (
        F.when(conf < guess / F.lit(float(steps)), guess - 1)
        .when(conf >= (guess + 1) / F.lit(float(steps)), guess + 1).otherwise(guess)
    )
    bucket = F.coalesce(F.least(F.greatest(reached, F.lit(-1)), F.lit(steps)), F.lit(-1)).cast("int")
    counts = kept.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(one_if(F.col("correct_l4"))).alias("correct"))
    summed = counts.groupBy().agg(F.sum("n").alias("total"), F.collect_list(F.struct("bucket", "n", "correct")).alias("cells"))
    at = summed.select("total", "cells", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("i"))

    def above(field: str) -> Column:
        return F.aggregate(F.filter("cells", lambda cell: cell["bucket"] >= F.col("i")), F.lit(0).cast("long"),
                           lambda acc, cell: acc + cell[field])

    accuracy = ratio(above("correct"), above("n"))
    return at.where(F.col("total") > 0).select(
        (F.col("i") / F.lit(float(steps))).alias("threshold"), ratio(above("n"), F.col("total")).alias("coverage"),
        (accuracy if null_when_empty else F.coalesce(accuracy, F.lit(0.0))).alias("accuracy"))


def calibration(df: DataFrame, bins: int = 20) -> DataFrame:
    """Accuracy, rows and mean confidence per right-closed confidence bin; 0 falls out, empty bins are absent."""
    index = grid_index(F.col("confidence_num"), bins)
    return (
        df.where(F.col("true_level4").isNotNull()).withColumn("bin", index).where(F.col("bin").between(1, bins))
        .groupBy("bin").agg(F.avg(one_if(F.col("correct_l4"))).alias("accuracy"), F.count("*").alias("n"),
                            F.avg("confidence_num").alias("mean_conf"))
    )


def accuracy_by_confidence_band(df: DataFrame) -> DataFrame:
    """Rows, rows with truth and prediction, and accuracy in percent per band of a tenth and level."""
    edges, labels = confidence_bands()
    banded = df.withColumn("band", band(F.col("confidence_num"), edges, labels, include_lowest=True))
    summed = banded.where(F.col("band").isNotNull()).groupBy("band").agg(F.count("*").alias("n_band"), *_level_sums())
    return summed.select("band", "n_band", F.inline(F.array(*[
        F.struct(F.lit(n).alias("level"), F.col(f"b{n}").alias("n"),
                 (ratio(F.col(f"c{n}"), F.col(f"b{n}")) * 100).alias("accuracy"))
        for n in REPORT_LEVELS
    ])))


def confidence_by_correctness(df: DataFrame, bins: int = 50) -> DataFrame:
    """Density histogram of the confidence of correct and of wrong rows, over each group's own range."""
    kept = df.where(F.col("true_level4").isNotNull() & F.col("confidence_num").isNotNull())
    limits = kept.groupBy("correct_l4").agg(F.struct(
        F.min("confidence_num").alias("lo"), F.max("confidence_num").alias("hi"), F.count("*").alias("total")).alias("s"))
    # at most two rows: correct and wrong
    rows = kept.select("correct_l4", "confidence_num").join(F.broadcast(limits), "correct_l4")
    counts = _histogram(rows, "confidence_num", bins, ["correct_l4", "total", "range"], F.col("correct_l4"),
                        F.col("s.total"), F.when(F.col("s.lo") == F.col("s.hi"), F.lit(1.0)).otherwise(
                            F.col("s.hi") - F.col("s.lo")))
    return counts.select("correct_l4", "bin", "bin_low", "n",
                         (F.col("n") / (F.col("total") * F.col("range") / bins)).alias("density"))


def high_confidence_errors(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Rows at or above the threshold, their share of all, and their errors at level 4."""
    high = F.col("confidence_num") >= threshold
    return df.where(F.col("true_level4").isNotNull()).agg(
        F.count("*").alias("n_total"), F.sum(one_if(high)).alias("n_high"),
        F.sum(one_if(high & F.col("err_l4"))).alias("n_errors"),
    ).select("n_high", (ratio(F.col("n_high"), F.col("n_total")) * 100).alias("share"), "n_errors",
             (ratio(F.col("n_errors"), F.col("n_high")) * 100).alias("error_rate"))


def error_rate_by_high_band(df: DataFrame, start: int = 10, bins: int = 20) -> DataFrame:
    """Error rate at level 4 per right-closed band of a twentieth from one half upwards."""
    index = grid_index(F.col("confidence_num"), bins)
    return (
        df.where(F.col("true_level4").isNotNull()).withColumn("bin", index).where(F.col("bin").between(start + 1, bins))
        .groupBy("bin").agg(F.avg(one_if(F.col("err_l4"))).alias("error_rate"), F.count("*").alias("n"))
    )


# ---- errors --------------------------------------------------------------------------------------------------------

# Severity choices of `error_filter`: a class of `error_severity`, or `errors` for any level-4 error.
def error_filter(df: DataFrame, text: str | None = None, true_code: str | None = None, pred_code: str | None = None,
                 source: str | None = None, year: int | None = None, shop_type: str | None = None, conf_min: float = 0.0,
                 conf_max: float = 1.0, severity: str | None = None, exclude_tech: bool = False) -> DataFrame:
    """Rows with truth and prediction at level 4 that meet all given conditions.

    `text` is a literal part of the product text, case ignored; codes are prefixes; the confidence range is closed.
    """
    df = filter_predictions(df, exclude_tech, source, year).where(_both(4))
    if text and text.strip():
        df = df.where(F.contains(F.lower("l_pr_product"), F.lit(text.strip().lower())))
    if true_code and true_code.strip():
        prefix = true_code.strip()
        df = df.where(F.col("true_level4").startswith(prefix) | F.col("true_level1").startswith(prefix))
    if pred_code and pred_code.strip():
        df = df.where(F.col("predicted_level4").startswith(pred_code.strip()))
    if shop_type is not None:
        df = df.where(F.col("shop_type_name") == shop_type)
    df = df.where(F.col("confidence_num").between(conf_min, conf_max))
    if severity == "errors":
        return df.where("err_l4")
    return df.where(F.col("error_severity") == severity) if severity else df


def error_stats(df: DataFrame) -> DataFrame:
    """Rows, level-4 errors, mean confidence and distinct true codes."""
    return df.where(_both(4)).agg(
        F.count("*").alias("n_total"), F.sum(one_if(F.col("err_l4"))).alias("n_errors"),
        F.avg("confidence_num").alias("mean_conf"), F.count_distinct("true_level4").alias("n_codes"))


def error_listing(df: DataFrame, limit: int = 500, tie_break: str = "id") -> DataFrame:
    """Display rows, most confident first."""
    return df.orderBy(F.desc_nulls_last("confidence_num"), tie_break).limit(limit).select(
        F.col("l_pr_product").alias("produit"), F.col("code").cast("string").alias("code_vrai"),
        F.col("true_level4").alias("vrai_l4"), F.col("predicted_level4").alias("pred_l4"),
        F.round(F.col("confidence_num") * 100, 1).alias("conf_pct"), F.col("error_severity").alias("severite"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.col("annee_int").cast("string"), F.lit("")).alias("annee"))


def confusion_pairs(df: DataFrame, level: int = 4, n: int = 20, min_conf: float | None = None) -> DataFrame:
    """Most frequent pairs of true and predicted code among the errors."""
    wrong = df.where(F.col(f"err_l{level}") & F.col(f"predicted_level{level}").isNotNull())
    if min_conf is not None:
        wrong = wrong.where(F.col("confidence_num") >= min_conf)
    return (
        wrong.groupBy(F.col(f"true_level{level}").alias("truth"), F.col(f"predicted_level{level}").alias("pred"))
        .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "truth", "pred").limit(n)
    )


def severity_distribution(df: DataFrame) -> DataFrame:
    """Rows and mean confidence per severity."""
    return df.where(_both(4)).groupBy(F.coalesce("error_severity", F.lit("N/A")).alias("severity")).agg(
        F.count("*").alias("n"), F.avg("confidence_num").alias("mean_conf"))


def error_cascade(df: DataFrame) -> DataFrame:
    """Error rate in percent at levels 2 to 4 given level 1 right or wrong, with the rows of each case."""
    ok, ko = ~F.col("err_l1"), F.col("err_l1")
    sums = [F.sum(one_if(ok)).alias("n_ok"), F.sum(one_if(ko)).alias("n_ko")]
    for n in (2, 3, 4):
        sums += [F.sum(one_if(ok & F.col(f"err_l{n}"))).alias(f"ok{n}"), F.sum(one_if(ko & F.col(f"err_l{n}"))).alias(f"ko{n}")]
    return df.where(F.col("true_level4").isNotNull()).agg(*sums).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("level"), (ratio(F.col(f"ok{n}"), F.col("n_ok")) * 100).alias("l1_correct"),
                 (ratio(F.col(f"ko{n}"), F.col("n_ko")) * 100).alias("l1_wrong"), F.col("n_ok"), F.col("n_ko"))
        for n in (2, 3, 4)
    ])))


def error_categories(df: DataFrame) -> DataFrame:
    """Rows per first wrong level; categories without rows count 0."""
    none, only4, from3, from2, from1 = ERROR_CATEGORIES
    any_error = F.col("err_l1") | F.col("err_l2") | F.col("err_l3") | F.col("err_l4")
    category = (
        F.when(~any_error, F.lit(none)).when(F.col("err_l1"), F.lit(from1)).when(F.col("err_l2"), F.lit(from2))
        .when(F.col("err_l3"), F.lit(from3)).otherwise(F.lit(only4))
    )
    named = df.where(F.col("true_level4").isNotNull()).select(category.alias("category"))
    sums = named.agg(*[F.count_if(F.col("category") == name).alias(f"c{i}") for i, name in enumerate(ERROR_CATEGORIES)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("category"), F.col(f"c{i}").alias("n")) for i, name in enumerate(ERROR_CATEGORIES)
    ])))


def confusion_matrix(df: DataFrame, level: int = 1) -> DataFrame:
    """`(truth, pred, n, pct)` over the codes present in the truth, zero cells included, percent by row.

    Works on the counts per pair of codes, so its size is that of the nomenclature's level.
    """
    counts = df.where(F.col(f"true_level{level}").isNotNull()).groupBy(
        F.col(f"true_level{level}").alias("truth"), F.col(f"predicted_level{level}").alias("pred")).agg(
        F.count("*").alias("n"))
    rows = counts.groupBy("truth").agg(F.map_from_entries(F.collect_list(F.when(
        F.col("pred").isNotNull(), F.struct("pred", "n")))).alias("cells"))
    labels = rows.agg(F.sort_array(F.collect_list("truth")).alias("labels")).scalar()
    cells = rows.select("truth", "cells", F.explode(labels).alias("pred")).select(
        "truth", "pred", F.coalesce(F.try_element_at("cells", F.col("pred")), F.lit(0).cast("long")).alias("n"))
    total = F.sum("n").over(W.partitionBy("truth"))
    return cells.select("truth", "pred", "n", (ratio(F.col("n"), total) * 100).alias("pct"))


def code_error_rates(df: DataFrame, min_n: int = 10) -> DataFrame:
    """Rows, error rate and mean confidence of every level-4 code with `min_n` rows."""
    return df.where(F.col("true_level4").isNotNull()).groupBy(F.col("true_level4").alias("code")).agg(
        F.count("*").alias("n"), F.avg(one_if(F.col("err_l4"))).alias("error_rate"),
        F.avg("confidence_num").alias("mean_conf")).where(F.col("n") >= min_n)


def best_worst_codes(df: DataFrame, min_n: int = 10, top: int = 15) -> DataFrame:
    """The `top` codes with the highest and with the lowest error rate, `side` worst or best."""
    rates = code_error_rates(df, min_n)
    worst = rates.orderBy(F.desc("error_rate"), "code").limit(top).withColumn("side", F.lit("worst"))
    best = rates.orderBy("error_rate", "code").limit(top).withColumn("side", F.lit("best"))
    return worst.unionByName(best)


# ---- distributions -------------------------------------------------------------------------------------------------

def code_distribution(df: DataFrame, level: int, top: int | None = None) -> DataFrame:
    """Rows per true code of a level, the `top` most frequent or all."""
    counts = df.where(F.col(f"true_level{level}").isNotNull()).groupBy(F.col(f"true_level{level}").alias("code")).agg(
        F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "code").limit(top) if top else counts


def class_counts(df: DataFrame) -> DataFrame:
    """Per level: classes and rows, with and without technical codes."""
    rows = df.select("is_technical", F.inline(F.array(*[
        F.struct(F.lit(n).alias("level"), F.col(f"true_level{n}").alias("code")) for n in REPORT_LEVELS
    ]))).where(F.col("code").isNotNull())
    regular = ~F.col("is_technical")
    # one row per class before counting classes, which is cheaper than distinct aggregates over the rows
    per_class = rows.groupBy("level", "code").agg(F.count("*").alias("n"), F.sum(one_if(regular)).alias("n_regular"))
    return per_class.groupBy("level").agg(
        F.count("*").alias("n_classes"), F.count_if(F.col("n_regular") > 0).alias("n_classes_regular"),
        F.sum("n").alias("n_obs"), F.sum("n_regular").alias("n_obs_regular"))


def depth_distribution(df: DataFrame) -> DataFrame:
    """Rows per depth of the true code, with the technical ones and their share."""
    return df.groupBy("code_depth").agg(
        F.count("*").alias("n"), F.sum(one_if(F.col("is_technical"))).alias("n_tech"),
        (F.avg(one_if(F.col("is_technical"))) * 100).alias("tech_share"))


def technical_by_source(df: DataFrame) -> DataFrame:
    """Rows and technical rows per source."""
    return df.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count("*").alias("n"), F.sum(one_if(F.col("is_technical"))).alias("n_tech"))


def accuracy_by_text_length(df: DataFrame) -> DataFrame:
    """Rows, error rate at level 4 and mean confidence per band of text length."""
    length = F.col("text_len").cast("double")
    banded = df.where(F.col("true_level4").isNotNull()).withColumn("len_bin", band(length, LENGTH_EDGES, LENGTH_LABELS))
    return banded.where(F.col("len_bin").isNotNull()).groupBy("len_bin").agg(
        F.count("*").alias("n"), F.avg(one_if(F.col("err_l4"))).alias("error_rate"),
        F.avg("confidence_num").alias("mean_conf"))


def text_length_median(df: DataFrame) -> DataFrame:
    """Median text length of rows with a level-4 truth."""
    return exact_median(df.where(F.col("true_level4").isNotNull()), "text_len")


def error_vs_training_share(df: DataFrame, train: DataFrame) -> DataFrame:
    """Per division: test rows, level-1 error rate, training rows and their share in percent."""
    tested = df.where(F.col("true_level1").isNotNull()).groupBy("true_level1").agg(
        F.count("*").alias("n_test"), F.avg(one_if(F.col("err_l1"))).alias("error_rate_l1"))
    trained = train.groupBy(code_level("code", 1).alias("true_level1")).agg(F.count("*").alias("n_train"))
    total = trained.agg(F.sum("n_train").alias("total")).scalar()
    n_train = F.coalesce("n_train", F.lit(0).cast("long"))
    return tested.join(trained, "true_level1", "left").select(
        "true_level1", "n_test", "error_rate_l1", n_train.alias("n_train"), (ratio(n_train, total) * 100).alias("pct_train"))


# ---- spending ------------------------------------------------------------------------------------------------------

def budget_stats(df: DataFrame) -> DataFrame:
    """Valid budgets, their minimum, maximum and exact median."""
    summary = df.agg(F.count("budget_num").alias("n_valid"), F.min("budget_num").alias("min"), F.max("budget_num").alias("max"))
    return summary.withColumn("median", exact_median(df, "budget_num").select("median").scalar())


def accuracy_by_budget(df: DataFrame) -> DataFrame:
    """Rows and level-4 accuracy per spending band."""
    return df.where(F.col("budget_tranche").isNotNull() & F.col("true_level4").isNotNull()).groupBy("budget_tranche").agg(
        F.count("*").alias("n"), F.avg(one_if(F.col("correct_l4"))).alias("accuracy"))


def confidence_by_budget(df: DataFrame) -> DataFrame:
    """Rows, mean and exact median confidence per spending band."""
    banded = df.where(F.col("budget_tranche").isNotNull())
    means = banded.groupBy("budget_tranche").agg(F.count("*").alias("n"), F.avg("confidence_num").alias("mean_conf"))
    medians = exact_median(banded, "confidence_num", ["budget_tranche"]).select(
        "budget_tranche", F.col("median").alias("median_conf"))
    return means.join(medians, "budget_tranche", "left")


def _spending(df: DataFrame) -> DataFrame:
    return df.where(F.col("budget_num").isNotNull() & F.col("true_level4").isNotNull())


def _spending_sums() -> list[Column]:
    correct = F.col("correct_l4")
    return [F.sum("budget_num").alias("ca_total"),
            F.sum(F.when(correct, F.col("budget_num")).otherwise(F.lit(0.0))).alias("ca_correct"),
            F.count("*").alias("n"), F.sum(one_if(correct)).alias("n_correct")]


def revenue_totals(df: DataFrame) -> DataFrame:
    """Spending in total, coded right and wrong, with shares in percent; the same by rows."""
    return _spending(df).agg(*_spending_sums()).select(
        "n", "ca_total", "ca_correct", (F.col("ca_total") - F.col("ca_correct")).alias("ca_wrong"),
        (ratio(F.col("ca_correct"), F.col("ca_total")) * 100).alias("pct_correct"), "n_correct",
        (F.col("n") - F.col("n_correct")).alias("n_wrong"),
        (ratio(F.col("n_correct"), F.col("n")) * 100).alias("pct_n_correct"))


def revenue_by(df: DataFrame, key: str | Column) -> DataFrame:
    """Spending, correct spending, rows and percent correct per value; rows without a value are left out."""
    value = (F.col(key) if isinstance(key, str) else key).cast("string")
    return _spending(df).withColumn("value", value).where(F.col("value").isNotNull()).groupBy("value").agg(
        *_spending_sums()).select("value", "ca_total", "ca_correct", "n",
                                  (ratio(F.col("ca_correct"), F.col("ca_total")) * 100).alias("pct_correct"))


def confidence_band_label() -> Column:
    edges, labels = confidence_bands()
    return band(F.col("confidence_num"), edges, labels, include_lowest=True)


def revenue_summary(df: DataFrame) -> DataFrame:
    """Spending per band of confidence with its share of all spending, rows without confidence included there."""
    label = F.coalesce(confidence_band_label(), F.lit(""))
    by_band = revenue_by(df, label)
    total = F.sum("ca_total").over(W.partitionBy())  # at most 11 rows: the bands and the rest
    return by_band.withColumn("pct_ca_total", ratio(F.col("ca_total"), total) * 100).where(F.col("value") != "")


# ---- summary -------------------------------------------------------------------------------------------------------

def summary(df: DataFrame) -> DataFrame:
    """Key figures as `(metric, value)`: sizes, accuracy and F1 by level, top-1/5/10, confidence."""
    regular = clean(df)
    with_truth = ~F.col("is_technical") & F.col("true_level4").isNotNull()
    sizes = df.agg(
        F.count("*").alias("n_total"), F.sum(one_if(F.col("is_technical"))).alias("n_tech"),
        F.count_distinct(F.when(~F.col("is_technical"), F.col("code"))).alias("n_codes"),
        F.avg(F.when(with_truth, F.col("confidence_num"))).alias("mean_conf"))
    median = exact_median(df.where(with_truth), "confidence_num").select(F.col("median").alias("median_conf"))

    def long(table: DataFrame, names: Sequence[str], prefix: Column | None = None) -> DataFrame:
        return table.select(F.inline(F.array(*[
            F.struct((F.concat(prefix, F.lit(name)) if prefix is not None else F.lit(name)).alias("metric"),
                     F.col(name).cast("double").alias("value")) for name in names
        ])))

    levels = long(accuracy_by_level(regular), ["accuracy", "f1_weighted", "n_true", "n"],
                  F.concat(F.lit("level"), F.col("level").cast("string"), F.lit("_")))
    tops = topk_curve(regular, 4, 10, require_prediction=False).where(F.col("k").isin(1, 5, 10)).select(
        F.concat(F.lit("top_"), F.col("k").cast("string")).alias("metric"), (F.col("accuracy") * 100).alias("value"))
    parts = [long(sizes, ["n_total", "n_tech", "n_codes", "mean_conf"]), levels, tops, long(median, ["median_conf"])]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
