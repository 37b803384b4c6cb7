"""Level-by-level classifiers as tables: class and feature counts, scored by joins and sums per row.

A level is multinomial naive Bayes on the n-grams of a vocabulary and, below the first level, on the code above and the bucket of its
confidence. Its model is nothing but counts, so it is fitted by a grouped count, tuned by adding weighted counts, saved as Parquet, and
no label or n-gram is a literal of a plan. The vocabulary and the nomenclature bound the tables; rows never reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ramure.functions.codes import children_map
from ramure.functions.ngrams import char_ngrams, ngram_vocab, words
from ramure.functions.text import DEFAULT_STOPWORDS, preprocess_text
from ramure.operators import training as tr
from ramure.operators.decode import PATH_TYPE, bucket_confidence, combine_confidence, seeded_fraction
from ramure.operators.evaluate import topk_by_flags
from ramure.session import spread, written

#: Buckets of the confidence of the code above, each a feature of its own.
BUCKETS = 10
#: Confidence of the code above where there is none: while predicting, while fitting, and in a beam that skipped the level above.
NO_PARENT, NO_PREDICTION, NO_STEP = 0.5, 0.9, 0.9
#: Rows of a block that is scored at once, at most and at least; weights added up, and scores held, at a time.
MOST_ROWS, LEAST_ROWS, ENTRIES, CELLS = 50_000, 1_000, 1_000_000, 500_000


@dataclass(frozen=True)
class LevelTables:
    """`counts(level, label, feature, n)`, `classes(level, label, n)`, `vocabulary(feature, f)` with numbers, `parents(level, parent)` and, for
    heads that share their features, `children(level, parent, child)`.

    Features are `t` and an n-gram, `p` and a code above, `b` and a bucket. `heads` don't look at the level above while scoring; what
    they give is masked by it instead.
    """

    counts: DataFrame
    classes: DataFrame
    vocabulary: DataFrame
    parents: DataFrame
    children: DataFrame
    levels: tuple[int, ...]
    heads: bool = False
    alpha: float = 1.0
    min_n: int = 3
    max_n: int = 6

    def save(self, path: str) -> None:
        """Write the tables and settings; the tables' files are apart from those that are read, so a model can replace itself."""
        spark = self.counts.sparkSession
        for name in ("counts", "classes", "vocabulary", "parents", "children"):
            written(getattr(self, name), f"saving-{name}").write.mode("overwrite").parquet(f"{path}/{name}")
        spark.createDataFrame([(list(self.levels), self.heads, self.alpha, self.min_n, self.max_n)],
                              "levels array<int>, heads boolean, alpha double, min_n int, max_n int").write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LevelTables:
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("counts", "classes", "vocabulary", "parents", "children")}
        settings = spark.read.parquet(f"{path}/settings").first().asDict()
        return LevelTables(**tables, **{**settings, "levels": tuple(settings["levels"])})

    def summary(self) -> DataFrame:
        """`level, index, code` of the labels of each level."""
        order = tr.W.partitionBy("level").orderBy("label")  # one row per code of the nomenclature
        return self.classes.select("level", (F.row_number().over(order) - 1).alias("index"), F.col("label").alias("code"))


def _numbered(vocabulary: DataFrame) -> DataFrame:
    """`(feature, f)`: n-grams of a vocabulary with their numbers; where it has none, in their order, bounded as the vocabulary is."""
    if "f" in vocabulary.columns:
        return vocabulary.select("feature", "f")
    return tr.label_index(vocabulary, "feature").select(F.col("label").alias("feature"), F.col("index").alias("f"))


def bags(df: DataFrame, text: str, key: str, vocabulary: DataFrame, min_n: int = 3, max_n: int = 6) -> DataFrame:
    """`(id, grams)`: numbers of the known n-grams of each id's text, as often as they occur; ids without any and null ones have no row.

    Each different word is cut and looked up once.
    """
    long = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.explode(words(F.coalesce(F.col(text), F.lit("")))).alias("word"))
    cut = long.select("word").distinct().select("word", F.explode(char_ngrams("word", min_n, max_n)).alias("gram"))
    known = (cut.select("word", F.concat(F.lit("t"), "gram").alias("feature")).join(_numbered(vocabulary), "feature")
             .groupBy("word").agg(F.collect_list("f").alias("found")))
    return long.join(known, "word").groupBy("id").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("grams"))


class _Level:
    """What scoring one level needs, as a table: a row for each class and parent, for the counts of each label, and for the vocabulary."""

    def __init__(self, tables: LevelTables, n: int):
        self.n, self.tables = n, tables
        self.fed = not tables.heads and n > tables.levels[0]
        here = F.col("level") == n
        columns = {"name": "string", "parent": "string", "n": "double", "features": "array<struct<feature:string,n:double>>"}

        def part(df: DataFrame, kind: str, **values: Column | str) -> DataFrame:
            given = {name: F.col(value) if isinstance(value, str) else value for name, value in values.items()}
            return df.select(F.lit(kind).alias("kind"), *[given.get(name, F.lit(None)).cast(type_).alias(name) for name, type_ in columns.items()])

        counts = tables.counts.where(here).groupBy("label").agg(F.collect_list(F.struct("feature", "n")).alias("features"))
        numbers = _numbered(tables.vocabulary).agg(F.collect_list(F.struct("feature", F.col("f").cast("double").alias("n"))).alias("features"))
        self.table = part(tables.classes.where(here), "class", name="label", n="n").union(part(counts, "count", name="label", features="features"))
        self.table = self.table.union(part(numbers, "number", features="features"))
        if tables.heads:
            self.table = self.table.union(part(tables.children.where(here), "child", name="child", parent="parent"))
        if self.fed:
            self.table = self.table.union(part(tables.parents.where(here), "parent", name="parent"))

    def best(self, rows: DataFrame, blocks: int, top_k: int) -> DataFrame:
        """Add `alternatives`, for each of the row's `parents` with its `confidences` the best `(code, confidence)`: those equal to nine
        digits by code.

        Rows have the `grams` of a text, null where it has none, and are dealt to `blocks`, each of which meets the level's table once.
        Heads after the first keep the children of the code above, in `parents`: their probabilities then add up to 1 again, or are all
        equal if they were 0; a code without children leaves everything as it is, and of equal probabilities the highest code is first.
        """
        fed, heads, alpha = self.fed, self.tables.heads, self.tables.alpha

        def scored(_, texts: pa.Table, model: pa.Table) -> pa.Table:
            found = _Scorer(model, fed, heads, alpha).best(texts, top_k) if len(texts) else []
            texts = texts.drop_columns("__block")
            return texts.append_column("alternatives", pa.chunked_array(found, ALTERNATIVES))

        # a number of partitions that is given isn't made smaller, however few bytes the blocks have
        dealt = rows.withColumn("__block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).repartition(blocks, "__block")
        copies = self.table.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(blocks, "__block")
        schema = StructType([*rows.schema.fields, _ALTERNATIVES])
        return dealt.groupBy("__block").cogroup(copies.groupBy("__block")).applyInArrow(scored, schema)


_ALTERNATIVES = StructField("alternatives", ArrayType(ArrayType(StructType([StructField("code", StringType()), StructField("confidence", DoubleType())]))))
ALTERNATIVES = pa.list_(pa.list_(pa.struct([("code", pa.string()), ("confidence", pa.float64())])))


class _Scorer:
    """A level's counts as arrays: the n-grams' weights class by class, of those classes only that have them."""

    def __init__(self, model: pa.Table, fed: bool, heads: bool, alpha: float):
        kinds = {kind: model.filter(pc.equal(model["kind"], kind)) for kind in ("class", "count", "number", "child", "parent")}
        classes = kinds["class"].sort_by("name")
        self.fed, self.heads = fed, heads
        self.labels = classes["name"].combine_chunks()
        count = len(self.labels)
        n = np.asarray(classes["n"], float)
        self.prior = np.log(n + alpha) - np.log(n.sum() + alpha * count)
        above = dict(zip(kinds["child"]["name"].to_pylist(), kinds["child"]["parent"].to_pylist()))
        self.above = np.array([above.get(label) for label in self.labels.to_pylist()], object)
        numbered = pc.list_flatten(kinds["number"]["features"]).combine_chunks()
        numbers = np.asarray(numbered.field("n")).astype(np.int64)
        counted = kinds["count"].filter(pc.is_in(kinds["count"]["name"], self.labels))
        entries = pc.list_flatten(counted["features"]).combine_chunks()
        lengths = np.asarray(pc.list_value_length(counted["features"]), np.int64)
        i = np.repeat(np.asarray(pc.index_in(counted["name"], self.labels), np.int64), lengths)
        n, names = np.asarray(entries.field("n"), float), entries.field("feature")
        size = len(numbers) + (len(kinds["parent"]) + BUCKETS if fed else 0)
        self.unseen = np.log(alpha) - np.log(np.bincount(i, n, count) + alpha * size)
        weights = np.log(n + alpha) - np.log(alpha)
        place = np.asarray(pc.fill_null(pc.index_in(names, numbered.field("feature")), -1))
        known = np.flatnonzero(place >= 0)
        place = numbers[place[known]]
        order = np.argsort(place, kind="stable")
        self.i, self.w = i[known[order]], weights[known[order]]
        self.lengths = np.bincount(place, minlength=numbers.max(initial=-1) + 1)
        self.starts = np.cumsum(self.lengths) - self.lengths
        # what a code above or a bucket adds to every class
        self.parents = pc.unique(kinds["parent"]["name"].drop_null()).sort()
        others = np.flatnonzero(np.asarray(pc.is_null(pc.index_in(names, numbered.field("feature")))))
        self.codes, self.buckets = (self._added(names.take(pa.array(others)), i[others], weights[others], some) for some in (
            [f"p{code}" for code in self.parents.to_pylist()] or [None], [f"b{bucket}" for bucket in range(BUCKETS)]))

    def _added(self, names: pa.Array, i: np.ndarray, weights: np.ndarray, features: list[str | None]) -> np.ndarray:
        """What each of some features adds to every class."""
        found = np.zeros((len(features), len(self.labels)))
        row = np.asarray(pc.fill_null(pc.index_in(names, pa.array(features, pa.string())), -1))
        found[row[row >= 0], i[row >= 0]] = weights[row >= 0]
        return found

    def _sums(self, grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Summed weights of every class for texts given by their n-grams, some of them at a time."""
        count = len(self.labels)
        sums = np.zeros((len(ends) - 1, count))
        inside = grams < len(self.starts)  # others occur in no class
        text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[inside]
        grams = grams[inside]
        lengths = self.lengths[grams]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        low = 0
        while low < len(grams):
            high = max(int(np.searchsorted(upto, upto[low] + ENTRIES, "right")) - 1, low + 1)
            some = lengths[low:high]
            at = np.repeat(self.starts[grams[low:high]] - upto[low:high] + upto[low], some) + np.arange(upto[high] - upto[low])
            first, last = text[low], text[high - 1] + 1
            cells = np.repeat((text[low:high] - first) * count, some) + self.i[at]
            sums[first:last] += np.bincount(cells, self.w[at], (last - first) * count).reshape(-1, count)
            low = high
        return sums

    def best(self, texts: pa.Table, top_k: int) -> list[pa.Array]:
        """For every row and each of its parents the best classes, some rows at a time."""
        found = []
        for rows in texts.select(["grams", "parents", "confidences"]).to_batches(max_chunksize=max(1, CELLS // max(1, len(self.labels)))):
            grams = pc.fill_null(pc.list_value_length(rows.column("grams")), 0)
            ends = np.concatenate([[0], np.cumsum(np.asarray(grams, np.int64))])
            base = self.prior + self._sums(np.asarray(pc.list_flatten(rows.column("grams")), np.int64), ends)
            base += (np.diff(ends)[:, None] + 2 * self.fed) * self.unseen
            ways = np.asarray(pc.list_value_length(rows.column("parents")), np.int64)
            parent, confidence = (pc.list_flatten(rows.column(name)) for name in ("parents", "confidences"))
            flat = base[np.repeat(np.arange(len(base)), ways)]
            if self.fed:
                code = np.asarray(pc.fill_null(pc.index_in(parent, self.parents), 0))  # the first for one not seen
                bucket = np.clip((np.asarray(confidence, float) * BUCKETS).astype(np.int64), 0, BUCKETS - 1)
                flat += self.codes[code] + self.buckets[bucket]
            ends = np.concatenate([[0], np.cumsum(ways)]).astype(np.int32)
            found.append(pa.ListArray.from_arrays(pa.array(ends), self._chosen(flat, parent, top_k)))
        return found

    def _chosen(self, scores: np.ndarray, parent: pa.Array, top_k: int) -> pa.Array:
        top = min(top_k, len(self.labels))
        if not top:
            return pa.array([[] for _ in range(len(scores))], ALTERNATIVES.value_type)
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        if self.heads:
            for code in pc.unique(parent.drop_null()).to_pylist():
                own = np.flatnonzero(self.above == code)
                if len(own):
                    rows = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(parent, code), False)))
                    total = p[np.ix_(rows, own)].sum(axis=1, keepdims=True)
                    kept = np.where(total > 0, p[np.ix_(rows, own)] / np.where(total > 0, total, 1), 1 / len(own))
                    p[rows] = 0
                    p[np.ix_(rows, own)] = kept
        order = np.round(p, 9)
        if self.heads:  # of equal ones the last
            order = order[:, ::-1]
        rows, picked = np.arange(len(p)), []
        for _ in range(top):
            best = order.argmax(axis=1)
            order[rows, best] = -1
            picked.append(len(self.labels) - 1 - best if self.heads else best)
        classes = np.stack(picked, axis=1)
        pairs = pa.StructArray.from_arrays([self.labels.take(pa.array(classes.ravel())), pa.array(p[rows[:, None], classes].ravel())], ["code", "confidence"])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(pairs) + 1, top, np.int32)), pairs)


def _blocks(df: DataFrame) -> int:
    """Blocks to deal a table's rows to: enough for all cores, and for a block to fit a task's memory."""
    count = df.count()
    return max(math.ceil(count / MOST_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(count / LEAST_ROWS)), 1)


def _with_grams(rows: DataFrame, bag: DataFrame) -> DataFrame:
    return rows.join(bag, "id", "left")


def _prepared(rows: DataFrame, vocabulary: DataFrame, min_n: int = 3, max_n: int = 6) -> DataFrame:
    """Rows with their `grams` and how many rows have their id, `copies`, written; what a level chose is carried along from here."""
    repeated = rows.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("copies")).where("copies > 1")
    known = _with_grams(rows.drop("text"), bags(rows, "text", "id", vocabulary, min_n, max_n)).join(repeated, "id", "left")
    none = {"__code": F.lit(None).cast("string"), "__confidence": F.lit(None).cast("double")}
    return written(known.withColumns({"copies": F.coalesce("copies", F.lit(1).cast("long")), **none}), "rows-with-grams")


def _per_level(rows: DataFrame, levels: Sequence[int], weights: dict[int, Column], *also: str) -> DataFrame:
    """`(level, label, parent, n, *also)`: the sum of a level's weights over rows, by the codes of all levels first."""
    codes = [name for name in rows.columns if name.startswith("level")]
    different = {str(weight): weight for weight in weights.values()}
    named = {text: f"__weight{at}" for at, text in enumerate(different)}
    cells = rows.groupBy(*codes, *also).agg(*[F.sum(weight).alias(named[text]) for text, weight in different.items()])
    labels = [F.struct(F.lit(n).alias("level"), F.col(f"level{n}").alias("label"),
                       (F.col(f"level{n - 1}") if f"level{n - 1}" in codes else F.lit(None).cast("string")).alias("parent"),
                       F.col(named[str(weights[n])]).cast("double").alias("n")) for n in levels]
    return cells.select(F.inline(F.array(*labels)), *also).where("label IS NOT NULL AND n > 0")


def _predicted(model: _Level, rows: DataFrame, blocks: int, top_k: int) -> DataFrame:
    """Add `alternatives{N}` for the code chosen last, `__code` with `__confidence`, and choose this level's."""
    fed = rows.withColumns({"parents": F.array("__code"), "confidences": F.array(F.coalesce("__confidence", F.lit(NO_PARENT)))})
    name = f"alternatives{model.n}"
    found = model.best(fed, blocks, top_k).withColumn(name, F.get("alternatives", F.lit(0)))
    first = F.get(F.col(name), F.lit(0))
    return found.withColumns({"__code": first["code"], "__confidence": first["confidence"]}).drop("alternatives", "parents", "confidences")


def fit_levels(df: DataFrame, text: str = "text", key: str = "id", max_level: int = 5, heads: bool = False, num_tokens: int = 39_000,
               min_tokens: int = 1, min_samples: int = 50, min_count: int = 2, fraction: float = 0.2, teacher_forcing: float = 0.7,
               seed: int = 42, alpha: float = 1.0) -> tuple[LevelTables, DataFrame]:
    """Fit all levels on the rows that aren't set aside, and measure them on those that are.

    A share of each class of the first usable level is set aside before anything is counted, the vocabulary included. Levels with too
    few rows or classes are left out; rare classes are those of all rows. A level sees the code above partly as predicted (see
    `teacher_force`); rows set aside go through the cascade with predicted codes only, by models that never saw them.

    Returns the tables and `(level, n_classes, n_train, n_validation, n_right, accuracy)`: validation rows are those whose label the
    level knows.
    """
    columns = [f"level{n}" for n in range(1, max_level + 1)]
    source = written(spread(df.select(F.col(key).alias("id"), F.col(text).alias("text"), *columns)), "source")
    reasons = {row["level"]: row["status"] for row in tr.usable_levels(source, min_samples, 2, min_count, range(1, max_level + 1)).collect()}
    usable = tuple(n for n in range(1, max_level + 1) if reasons.get(n) == "train")
    if not usable:
        raise ValueError(f"no level could be trained: {reasons}")
    spark = df.sparkSession
    rows = written(tr.stratified_split(source, f"level{usable[0]}", fraction, seed, "id"), "rows")
    found = ngram_vocab(rows.where(~F.col("is_validation")), "text", min_tokens, num_tokens)
    vocabulary = written(found.select(F.concat(F.lit("t"), "ngram").alias("feature"), F.col("id").alias("f")), "vocabulary")
    current = _prepared(rows, vocabulary)
    blocks = _blocks(current)
    children = written(children_map(source.select(*columns), range(1, max_level + 1)), "children") if max_level > 1 else _nothing(
        spark, "level int, parent string, child string")
    # what doesn't depend on predictions is counted for all levels at once; levels that are fed count rows by what their id was given
    fed = () if heads else usable[1:]
    weights = {n: F.when(F.col("id").isNotNull(), F.col("copies")) if n in fed else F.lit(1) for n in usable}
    sizes = _per_level(current, usable, {n: F.lit(1) for n in usable}).groupBy("level", "label").agg(F.sum("n").alias("n"))
    frequent = written(sizes.where(F.col("n") >= min_count).select("level", "label"), "frequent")
    train = current.where(~F.col("is_validation"))
    paths = written(_per_level(train, usable, weights).join(frequent, ["level", "label"], "left_semi"), "paths")
    classes = written(paths.groupBy("level", "label").agg(F.sum("n").alias("n")), "classes")
    parents = paths.where(F.col("level").isin(*fed)).select("level", "parent").distinct() if fed else _nothing(spark, "level int, parent string")
    counted = _per_level(train.withColumn("f", F.explode("grams")), usable, weights, "f").join(frequent, ["level", "label"], "left_semi")
    counted = counted.groupBy("level", "label", "f").agg(F.sum("n").alias("n")).join(vocabulary, "f").select("level", "label", "feature", "n")
    tables = LevelTables(written(counted, "counts"), classes, vocabulary, written(parents, "parents"), children, usable, heads, alpha)
    for n in usable:
        if n in fed:
            known = frequent.where(F.col("level") == n).select(F.col("label").alias(f"level{n}"))
            used = _forced(train.where("id IS NOT NULL").join(known, f"level{n}", "left_semi").withColumn("label", F.col(f"level{n}")), n,
                           tables.parents.where(F.col("level") == n).select("parent"), teacher_forcing, seed)
            tables = replace(tables, counts=tables.counts.union(written(used.select(F.lit(n).alias("level"), "label", "feature", "n"), "counts")))
        current = _predicted(_Level(tables, n), current, blocks, 1).drop(f"alternatives{n}").withColumn(f"__code{n}", F.col("__code"))
        current = written(current, "predicted")
        train = current.where(~F.col("is_validation"))
    return tables, written(_report(current, classes, usable), "report")


def _nothing(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows that the optimizer knows to have none."""
    return spark.range(0).select(*[F.lit(None).cast(type_).alias(name) for name, type_ in (column.split() for column in schema.split(", "))])


def _report(rows: DataFrame, classes: DataFrame, levels: Sequence[int]) -> DataFrame:
    """What `fit_levels` reports, of rows with the code chosen at each level; rows without an id are not counted."""
    judged = [F.struct(F.lit(n).alias("level"), F.col(f"level{n}").alias("label"), F.coalesce(F.col(f"__code{n}") == F.col(f"level{n}"), F.lit(False)).alias("right"))
              for n in levels]
    cells = (rows.where("id IS NOT NULL").select("is_validation", "copies", F.inline(F.array(*judged))).where("label IS NOT NULL")
             .groupBy("level", "label", "is_validation", "right").agg(F.sum("copies").alias("n")))
    held = F.col("is_validation")
    counts = cells.join(classes.select("level", "label"), ["level", "label"], "left_semi").groupBy("level").agg(
        F.sum(F.when(~held, F.col("n"))).alias("n_train"), F.sum(F.when(held, F.col("n"))).alias("n_validation"),
        F.sum(F.when(held & F.col("right"), F.col("n"))).alias("n_right"))
    found = (rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in levels])).alias("level"))
             .join(classes.groupBy("level").agg(F.count("*").alias("n_classes")), "level", "left").join(counts, "level", "left").na.fill(0))
    return found.select("level", "n_classes", "n_train", "n_validation", "n_right", F.try_divide(F.col("n_right").cast("double"), F.col("n_validation")).alias("accuracy"))


def _forced(train: DataFrame, n: int, parents: DataFrame, teacher_forcing: float, seed: int) -> DataFrame:
    """`(label, feature, n)` of the code above and the bucket of its confidence, for rows with their predicted code, `copies` times each."""
    drawn = seeded_fraction(seed, F.lit(n), F.col("id")) < (1 - teacher_forcing)
    used = F.when(drawn & F.col("__code").isNotNull(), F.col("__code")).otherwise(F.col(f"level{n - 1}"))
    bucket = bucket_confidence(F.coalesce("__confidence", F.lit(NO_PREDICTION)), BUCKETS).cast("string")
    cells = train.groupBy("label", used.alias("used"), bucket.alias("bucket")).agg(F.sum("copies").alias("n"))
    with_parent = cells.join(parents.select(F.col("parent").alias("used"), F.col("parent").alias("known")), "used", "left")
    first = parents.agg(F.min("parent").alias("p")).scalar()
    features = F.array(F.concat(F.lit("p"), F.coalesce("known", first)), F.concat(F.lit("b"), "bucket"))
    return with_parent.select("label", "n", F.explode(features).alias("feature")).groupBy("label", "feature").agg(F.sum("n").cast("double").alias("n"))


def tune_levels(tables: LevelTables, df: DataFrame, levels: Sequence[int] | None = None, weight: float = 1.0, text: str = "text",
                key: str = "id", teacher_forcing: float = 0.7, seed: int = 42) -> LevelTables:
    """Go on training chosen levels (all by default) on new rows, each counting `weight` times; the other levels stay as they are.

    New rows count where the level knows their label; vocabulary, labels and codes above stay those of the model. Levels go in order, and
    the predictions that feed a level are made again by the levels above as tuned. Saved and loaded models are tuned alike.
    """
    columns = [f"level{n}" for n in range(1, max(tables.levels) + 1)]
    rows = written(spread(df.select(F.col(key).alias("id"), F.col(text).alias("text"), *columns)), "rows")
    current = _prepared(rows, tables.vocabulary, tables.min_n, tables.max_n)
    blocks = _blocks(current)
    chosen = tables.levels if levels is None else tuple(n for n in tables.levels if n in levels)
    here = F.col("level").isin(*chosen)
    once = {n: F.lit(1) for n in chosen}
    added = _per_level(current, chosen, once).select("level", "label", "n")
    labels = tables.classes.select("level", "label")
    fresh = _per_level(current.withColumn("f", F.explode("grams")), chosen, once, "f").join(labels, ["level", "label"], "left_semi")
    fresh = written(fresh.groupBy("level", "label", "f").agg(F.sum("n").alias("n")).join(_numbered(tables.vocabulary), "f")
                    .select("level", "label", "feature", "n"), "fresh")
    more = added.join(labels, ["level", "label"], "left_semi").select("level", "label", F.col("n") * weight)
    classes = written(tables.classes.where(here).union(more).groupBy("level", "label").agg(F.sum("n").alias("n")), "tuned")
    tables = replace(tables, classes=tables.classes.where(~here).union(classes))
    for n in tables.levels:
        at = F.col("level") == n
        if n in chosen:
            new = fresh.where(at).select("label", "feature", "n")
            if not tables.heads and n > tables.levels[0]:
                fed = tr.known_labels_only(current.where("id IS NOT NULL").withColumn("label", F.col(f"level{n}")), "label", labels.where(at).select("label"))
                new = new.union(_forced(fed, n, tables.parents.where(at).select("parent"), teacher_forcing, seed).select("label", "feature", "n"))
            both = tables.counts.where(at).select("label", "feature", "n").union(new.withColumn("n", F.col("n") * weight))
            summed = written(both.groupBy("label", "feature").agg(F.sum("n").alias("n")), "tuned")
            tables = replace(tables, counts=tables.counts.where(~at).union(summed.select(F.lit(n).alias("level"), "label", "feature", "n")))
        if tables.heads or n >= max(chosen, default=0):  # no level that is tuned looks at what would be chosen here
            continue
        current = written(_predicted(_Level(tables, n), current, blocks, 1).drop(f"alternatives{n}"), "predicted")
    return tables


def _texts(tables: LevelTables, df: DataFrame, text: str) -> DataFrame:
    """Each different text once, as `id`, with its known n-grams; written, as what follows is dealt by their number."""
    texts = written(df.select(F.coalesce(text, F.lit("")).alias("id")).distinct(), "texts")
    return written(_with_grams(texts, bags(spread(texts), "id", "id", tables.vocabulary, tables.min_n, tables.max_n)), "bag")


def predict_levels(tables: LevelTables, df: DataFrame, text: str = "text", top_k: int = 1, threshold: float | None = None) -> DataFrame:
    """Add `predicted_code, final_level, confidence, combined_confidence` and per level and rank `predicted_level{N}`, `confidence_level{N}`.

    The code chosen at a level feeds the next one (or masks it). Each different text is scored once; null texts count as empty.
    """
    texts = _texts(tables, df, text)
    blocks = _blocks(texts)
    rows = texts.withColumns({"__code": F.lit(None).cast("string"), "__confidence": F.lit(None).cast("double")})
    path = []
    for n in tables.levels:
        rows = _predicted(_Level(tables, n), rows, blocks, top_k)
        path.append(F.struct(F.lit(n).alias("level"), F.get(f"alternatives{n}", F.lit(0))["code"].alias("code"),
                             F.get(f"alternatives{n}", F.lit(0))["confidence"].alias("confidence")))
    decoded = combine_confidence(rows.withColumn("path", F.array(*path).cast(PATH_TYPE)), threshold)
    wide = [F.coalesce(F.get(f"alternatives{n}", F.lit(rank - 1))[name], F.lit(none)).alias(f"{column}_level{n}{'' if rank == 1 else f'_top{rank}'}")
            for n in tables.levels for rank in range(1, top_k + 1) for column, name, none in (("predicted", "code", ""), ("confidence", "confidence", 0.0))]
    found = decoded.select(F.col("id").alias("__text"), F.col("final_code").alias("predicted_code"), "final_level",
                           F.col("final_confidence").alias("confidence"), "combined_confidence", *wide)
    clash = [name for name in found.columns if name in df.columns]
    return df.drop(*clash).join(found, F.coalesce(F.col(text), F.lit("")) == F.col("__text")).drop("__text")


def predict_beams(tables: LevelTables, df: DataFrame, beam_size: int, text: str = "text", top_k: int = 0) -> DataFrame:
    """`predict_levels` with the best of `beam_size` paths; with `top_k` its best paths give the columns per level.

    At each level every path is scored with its own code above and grows by the best codes; the best paths of a text are kept, those
    equal to nine digits by their codes. A path that skipped the level above is scored with the first code above. The paths stay in the
    row of their text and share the summed weights of its n-grams.
    """
    texts = _texts(tables, df, text)
    blocks = _blocks(texts)
    rows = texts.withColumn("beams", F.array(F.struct(
        F.lit(0.0).alias("order"), F.array().cast("array<string>").alias("codes"), F.lit(0.0).alias("lp"), F.array().cast(PATH_TYPE).alias("trail"))))
    for n in tables.levels:
        def last(beam: Column) -> Column:
            step = F.get(beam["trail"], F.size(beam["trail"]) - 1)
            return F.when(step["level"] == n - 1, step)

        def grown(beam: Column, item: Column) -> Column:
            lp = beam["lp"] + F.log(F.greatest(item["confidence"], F.lit(1e-9)))
            step = F.struct(F.lit(n).alias("level"), item["code"].alias("code"), item["confidence"].alias("confidence"))
            return F.struct(F.round(-lp, 9).alias("order"), F.array_append(beam["codes"], item["code"]).alias("codes"), lp.alias("lp"),
                            F.concat(beam["trail"], F.array(step)).cast(PATH_TYPE).alias("trail"))

        fed = rows.withColumns({"parents": F.transform("beams", lambda beam: last(beam)["code"]),
                                "confidences": F.transform("beams", lambda beam: F.coalesce(last(beam)["confidence"], F.lit(NO_STEP)))})
        # beam_size * beam_size paths of a text at most
        paths = F.flatten(F.zip_with("beams", "alternatives", lambda beam, items: F.transform(items, lambda item: grown(beam, item))))
        rows = _Level(tables, n).best(fed, blocks, beam_size).withColumn("beams", F.slice(F.sort_array(paths), 1, beam_size)).select("id", "grams", "beams")
    best = F.get("beams", F.lit(0))
    last_step = F.get(best["trail"], F.size(best["trail"]) - 1)
    wide = []
    for n in tables.levels:
        for rank in range(1, top_k + 1):
            step = F.get(F.filter(F.get("beams", F.lit(rank - 1))["trail"], lambda entry: entry["level"] == n), F.lit(0))
            suffix = "" if rank == 1 else f"_top{rank}"
            wide += [F.coalesce(step["code"], F.lit("")).alias(f"predicted_level{n}{suffix}"),
                     F.coalesce(step["confidence"], F.lit(0.0)).alias(f"confidence_level{n}{suffix}")]
    found = rows.select(F.col("id").alias("__text"), last_step["code"].alias("predicted_code"),
                        F.concat(F.lit("level"), last_step["level"].cast("string")).alias("final_level"), last_step["confidence"].alias("confidence"),
                        F.exp(best["lp"]).alias("combined_confidence"), *wide)
    clash = [name for name in found.columns if name in df.columns]
    return df.drop(*clash).join(found, F.coalesce(F.col(text), F.lit("")) == F.col("__text")).drop("__text")


def predict_clean(tables: LevelTables, df: DataFrame, text: str = "product", top_k: int = 1, threshold: float | None = None,
                  words: Sequence[str] = DEFAULT_STOPWORDS, beam: int = 1) -> DataFrame:
    """Clean the text, then predict; rows without any word are not in the result."""
    cleaned = preprocess_text(df, text, words)
    return predict_beams(tables, cleaned, beam, text, top_k) if beam > 1 else predict_levels(tables, cleaned, text, top_k, threshold)


def evaluate_levels(tables: LevelTables, annotated: DataFrame, flags: Sequence[str] = (), ks: Sequence[int] = (1, 2, 3), text: str = "text") -> DataFrame:
    """Predict annotated rows (`level1..5` and flags) and return their top-k accuracy per level, overall and for each flag."""
    predicted = predict_levels(tables, annotated, text, max(ks))
    return topk_by_flags(predicted, flags, ks)
