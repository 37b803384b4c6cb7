"""Building training sets: deduplication, capped strata, label tables and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ramure.functions.codes import LEVELS, code_prefix, is_technical, level4_key, with_levels
from ramure.functions.text import DEFAULT_STOPWORDS, preprocess_text
from ramure.operators.scoring import ratio


def load_annotations(df: DataFrame, exclude_technical: bool = True, preprocess: bool = True, code_column: str = "code",
                     words: Sequence[str] = DEFAULT_STOPWORDS) -> DataFrame:
    """Annotated rows ready for training: clean product, levels, `text`; technical codes left out by default."""
    if exclude_technical:
        df = df.where(~is_technical(code_column))
    if preprocess:
        df = preprocess_text(df, "product", words)
    return with_levels(df, code_column).withColumn("text", F.lower(F.trim("product")))


def dedup_pairs(df: DataFrame) -> DataFrame:
    """One row per `(product, code)`: of its rows the first by original text, then by the other columns."""
    others = sorted((name for name in df.columns if name not in ("product", "code")), key=lambda name: name != "product_orig")
    if not others:
        return df.distinct()
    first = df.groupBy("product", "code").agg(F.min(F.struct(*others)).alias("__first"))
    return first.select("product", "code", *[F.col(f"__first.{name}").alias(name) for name in others])


def hash_order(seed: int, *columns: str) -> Column:
    """A reproducible random order: md5 of the seed and the columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(name) for name in columns]))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, salts: int = 64,
                  rank: str = "rn") -> DataFrame:
    """The first `n` rows of each key with their rank; exact however many rows one key has.

    Input partitions are dealt over `salts` slices. Each task keeps its own best `n` of a key before the shuffle, each
    slice the best of those, and the last step sees `salts * n` candidates of a key at most. Any way of slicing gives
    the same rows, and the plan is the same for every `n`; `build_session` lets Spark cut before the shuffle for any.
    """
    window = W.partitionBy(*keys, "__slice").orderBy(*order)
    sliced = df.withColumn("__slice", F.pmod(F.spark_partition_id(), F.lit(salts)))
    best = sliced.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= n).drop("__rn")
    return best.drop("__slice").withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def cap_by_stratum(observed: DataFrame, synthetic: DataFrame, max_per_code: int = 1000, seed: int = 42) -> DataFrame:
    """At most `max_per_code` rows per level-4 key, observed rows first, synthetic ones filling up.

    Which rows are taken is decided by a hash of product and code, so it doesn't depend on partitioning. Rows need
    `product, code, source`.
    """
    order = [F.col("__order"), F.col("product"), F.col("code")]

    def capped(df: DataFrame) -> DataFrame:
        keyed = df.withColumns({"__key": level4_key("code"), "__order": hash_order(seed, "product", "code")})
        return first_per_key(keyed, ["__key"], order, max_per_code)

    first, second = capped(observed), capped(synthetic)
    # after the cap a stratum holds max_per_code rows at most, so its count is small and exact up to the cap
    n_observed = first.groupBy("__key").agg(F.count("*").alias("__n"))
    filling = second.join(n_observed, "__key", "left").where(
        F.col("rn") <= max_per_code - F.coalesce("__n", F.lit(0))).drop("__n")
    return first.unionByName(filling, allowMissingColumns=True).drop("__key", "__order", "rn")


def training_summary(df: DataFrame) -> DataFrame:
    """Rows, share in percent and distinct codes per source and in total (`source` NULL)."""
    per_source = df.groupBy("source", "code").agg(F.count("*").alias("n"))
    sides = per_source.rollup("source").agg(F.sum("n").alias("n"), F.count_distinct("code").alias("n_codes"))
    total = F.max(F.when(F.col("source").isNull(), F.col("n"))).over(W.partitionBy())  # one row per source
    return sides.withColumn("share", ratio(F.col("n"), total) * 100)


def build_training_data(observed: DataFrame, synthetic: DataFrame, max_per_code: int = 1000, seed: int = 42,
                        preprocess: bool = True, text_column: str = "description_ean", code_column: str = "coicop_code",
                        words: Sequence[str] = DEFAULT_STOPWORDS) -> DataFrame:
    """The balanced training set `product, code, source, product_orig, code8` from observed and synthetic products."""
    def prepared(df: DataFrame, source: str) -> DataFrame:
        if preprocess:
            df = preprocess_text(df, "product", words)
        return dedup_pairs(df).withColumns({"source": F.lit(source), "code8": code_prefix("code", 8)})

    first = prepared(observed.select(F.col(text_column).alias("product"), F.col(code_column).alias("code")), "ddc")
    second = prepared(synthetic.select("product", "code"), "synthetic")
    return cap_by_stratum(first, second, max_per_code, seed)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """`total / (classes * count)` per label; rows without label count in the total only."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    size = F.sum("n").over(W.partitionBy())  # one row per class
    classes = F.count(label).over(W.partitionBy())
    return counts.select(F.col(label).alias("label"), "n", ratio(size, classes * F.col("n")).alias("weight")).where(
        F.col("label").isNotNull())


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def filter_rare(df: DataFrame, label: str, min_count: int = 2) -> DataFrame:
    """Rows whose label occurs at least `min_count` times; rows without label are dropped."""
    frequent = class_sizes(df, label).where(F.col("n") >= min_count).select(label)
    return df.join(frequent, label, "left_semi")


def rare_report(df: DataFrame, label: str, min_count: int = 2) -> DataFrame:
    """Rows and classes kept and dropped by `filter_rare`."""
    kept = F.col("n") >= min_count
    return class_sizes(df, label).agg(
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("n_kept"),
        F.coalesce(F.sum(F.when(~kept, F.col("n"))), F.lit(0)).alias("n_dropped"),
        F.count_if(kept).alias("classes_kept"), F.count_if(~kept).alias("classes_dropped"))


def usable_levels(df: DataFrame, min_samples: int = 50, min_classes: int = 2, min_count: int = 2,
                  levels: Sequence[int] = LEVELS) -> DataFrame:
    """Per level: rows, valid classes, and whether to train it or why not; one job for all levels."""
    rows = df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("level"), F.col(f"level{n}").alias("label")) for n in levels])))
    per_class = rows.groupBy("level", "label").agg(F.count("*").alias("n"))
    known = F.col("label").isNotNull()
    summed = per_class.groupBy("level").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_rows"),
        F.count_if(known & (F.col("n") >= min_count)).alias("n_classes"))
    status = (
        F.when(F.col("n_rows") < min_samples, F.lit("too few rows"))
        .when(F.col("n_classes") < min_classes, F.lit("too few classes")).otherwise(F.lit("train"))
    )
    return summed.withColumn("status", status)


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Dense index from 0 over the sorted labels; numbered on the distinct labels only."""
    labels = df.select(F.col(label).alias("label")).where(F.col("label").isNotNull()).distinct()
    return labels.withColumn("index", F.row_number().over(W.orderBy("label")) - 1)


def stratified_split(df: DataFrame, label: str, fraction: float = 0.2, seed: int = 42, key: str = "id") -> DataFrame:
    """Add `is_validation`: exactly `round(fraction * n)` rows of each class, in hash order; rows without label train.

    `key` must be unique. No class is ranked as a whole: counts per class and leading hash digits tell the digits where
    the quota ends, only the rows sharing those four digits are put in order, and the last hash of the quota then
    decides for every row without moving it.
    """
    hashed = df.withColumn("__h", hash_order(seed, key))
    slot = F.substring("__h", 1, 4)
    cells = hashed.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("__label"), slot.alias("__slot")).agg(
        F.count("*").alias("__c"))
    upto = W.partitionBy("__label").orderBy("__slot").rowsBetween(W.unboundedPreceding, 0)
    quota = F.round(F.lit(fraction) * F.sum("__c").over(W.partitionBy("__label")))
    ranked = cells.withColumns({"__before": F.sum("__c").over(upto) - F.col("__c"), "__quota": quota})
    edges = ranked.where(
        (F.col("__before") < F.col("__quota")) & (F.col("__before") + F.col("__c") >= F.col("__quota"))
    ).select("__label", "__slot", (F.col("__quota") - F.col("__before")).alias("__left"))
    near = hashed.select(F.col(label).alias("__label"), "__h", slot.alias("__slot")).join(
        edges, ["__label", "__slot"])
    rank = F.row_number().over(W.partitionBy("__label").orderBy("__h"))
    last = near.withColumn("__rank", rank).where(F.col("__rank") == F.col("__left")).select(
        "__label", F.col("__h").alias("__last"))
    placed = hashed.join(last, F.col(label) == F.col("__label"), "left")
    return placed.select(*df.columns, F.coalesce(F.col("__h") <= F.col("__last"), F.lit(False)).alias("is_validation"))


def known_labels_only(df: DataFrame, label: str, labels: DataFrame) -> DataFrame:
    """Rows whose label is among `labels` (column `label`)."""
    known = labels.select(F.col("label").alias(label))
    return df.join(known, label, "left_semi")


def unknown_label_count(df: DataFrame, label: str, labels: DataFrame) -> DataFrame:
    """Rows kept and dropped by `known_labels_only`, from the counts per label."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    marked = counts.join(labels.select(F.col("label").alias(label), F.lit(True).alias("known")), label, "left")
    return marked.agg(F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("n_known"),
                      F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("n_unknown"))


def multi_level_labels(df: DataFrame, levels: Sequence[int] = LEVELS, min_count: int = 2) -> DataFrame:
    """Add `label{N}`: the index of the level's code among its frequent codes, NULL when missing or rare."""
    result = df
    for n in levels:
        name = f"level{n}"
        frequent = class_sizes(df, name).where(F.col("n") >= min_count)
        index = label_index(frequent, name).select(F.col("label").alias(name), F.col("index").alias(f"label{n}"))
        result = result.join(index, name, "left")
    return result.select(*df.columns, *[f"label{n}" for n in levels])


def parent_vocab(df: DataFrame, level: int) -> DataFrame:
    """Sorted distinct codes of the level above, with their index."""
    return label_index(df.where(F.col(f"level{level}").isNotNull()), f"level{level - 1}").withColumnRenamed("label", "parent")


def parent_index(df: DataFrame, parent: str, vocab: DataFrame) -> DataFrame:
    """Add `parent_index`; a code outside the vocabulary gets 0."""
    known = vocab.select(F.col("parent").alias(parent), F.col("index").alias("parent_index"))
    joined = df.join(known, parent, "left")
    return joined.withColumn("parent_index", F.coalesce("parent_index", F.lit(0))).select(*df.columns, "parent_index")
