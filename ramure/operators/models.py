"""Classifiers on hashed character n-grams with Spark ML: flat, level by level, and one model per level.

Fitting and prediction run on the executors; the driver holds the models, whose size is set by the number of classes
and of features, never by the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import CountVectorizerModel, HashingTF, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ramure.functions.codes import LEVELS, children_map
from ramure.functions.ngrams import char_ngrams, ngram_vocab, words
from ramure.functions.text import DEFAULT_STOPWORDS, let, preprocess_text
from ramure.operators import training as tr
from ramure.operators import word_scores
from ramure.operators.decode import PATH_TYPE, bucket_confidence, combine_confidence, seeded_fraction
from ramure.session import written

FEATURES = 1 << 16


def ngram_features(df: DataFrame, text: str = "text", num_features: int = FEATURES, output: str = "features",
                   vocabulary: Sequence[str] | None = None) -> DataFrame:
    """Add n-gram counts: those of a vocabulary in its order, or of all n-grams, hashed."""
    grams = df.withColumn("__ngrams", char_ngrams(F.coalesce(F.col(text), F.lit(""))))
    if vocabulary:
        model = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol="__ngrams", outputCol=output)
        return model.transform(grams).drop("__ngrams")
    return HashingTF(inputCol="__ngrams", outputCol=output, numFeatures=num_features).transform(grams).drop("__ngrams")


def _estimator(kind: str, features: str, label: str, prefix: str):
    common = {"featuresCol": features, "labelCol": label, "predictionCol": f"{prefix}_prediction",
              "probabilityCol": f"{prefix}_probability", "rawPredictionCol": f"{prefix}_raw"}
    if kind == "bayes":
        return NaiveBayes(smoothing=1.0, modelType="multinomial", **common)
    if kind == "logistic":
        return LogisticRegression(maxIter=20, regParam=1e-4, **common)
    raise ValueError(f"estimator must be bayes or logistic, not {kind!r}")


def _ranked(probability: Column, labels: Sequence[str], top_k: int) -> Column:
    """Best `top_k` `(code, confidence)` of a probability vector, those equal to nine digits by code."""
    names = F.array(*[F.lit(label) for label in labels])

    def best(values: Column) -> Column:
        # only those that can be among the best after rounding are rounded and sorted as pairs
        return let(F.get(F.sort_array(values, asc=False), F.lit(min(top_k, len(labels)) - 1)), lambda last: chosen(values, last))

    def chosen(values: Column, last: Column) -> Column:
        pairs = F.zip_with(values, names, lambda p, code: F.when(p > last - 2e-9, F.struct(code.alias("code"), p.alias("p"))))
        ordered = F.transform(F.array_compact(pairs), lambda pair: F.struct(
            F.round(-pair["p"], 9).alias("order"), pair["code"].alias("code"), (-pair["p"]).alias("neg")))
        return F.slice(F.sort_array(ordered), 1, top_k)

    return F.transform(let(vector_to_array(probability), best),
                       lambda pair: F.struct(pair["code"].alias("code"), (-pair["neg"]).alias("confidence")))


def _local(df: DataFrame) -> DataFrame:
    """A table with a row for each class, computed once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema).coalesce(1)


def _indexer(df: DataFrame, column: str) -> StringIndexerModel:
    """Labels in alphabetical order; unseen ones are kept apart."""
    return StringIndexer(inputCol=column, outputCol=f"__{column}_index", stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)


def _text_sums(rows: DataFrame, label: str, text: str, num_features: int, vocabulary: Sequence[str] | None = None) -> DataFrame:
    """`(label, features)`: the summed n-gram counts of each label's texts.

    Words are counted first and cut once for each label; all words of a label are added up in one place, so that of a label's sum, which is
    as long as all features, there are no parts to be shuffled.
    """
    counted = rows.select(label, F.explode_outer(words(F.coalesce(F.col(text), F.lit("")))).alias("__word")).groupBy(label, "__word").agg(
        F.count("*").cast("double").alias("__n"))
    featured = ngram_features(counted.repartition(label), "__word", num_features, vocabulary=vocabulary)
    return featured.groupBy(label).agg(Summarizer.sum(F.col("features"), F.col("__n")).alias("features"))


def _fit_sums(estimator: NaiveBayes, indexer: StringIndexerModel, classes: DataFrame, sums: DataFrame, size: int) -> NaiveBayesModel:
    """What the estimator fits on rows, from the rows `n` of each label and the sum of their features, which is all naive Bayes takes of them.

    A label is a row with its sum, and one without features that weighs as much as its other rows: both totals are exact.
    """
    label, features = indexer.getInputCol(), estimator.getFeaturesCol()
    none = classes.sparkSession.createDataFrame([(Vectors.sparse(size, {}),)], ["__none"]).coalesce(1)
    every = indexer.transform(classes).crossJoin(none)
    whole = every.join(sums, label).select(estimator.getLabelCol(), features, F.lit(1.0).alias("__weight"))
    rest = every.where("n > 1").select(estimator.getLabelCol(), F.col("__none").alias(features), (F.col("n") - 1).cast("double").alias("__weight"))
    return estimator.setWeightCol("__weight").fit(whole.union(rest))


# ---- flat ----------------------------------------------------------------------------------------------------------


@dataclass
class FlatModel:
    """One classifier for the whole code."""

    stages: PipelineModel
    labels: list[str]
    num_features: int = FEATURES
    stats: dict[str, int] = field(default_factory=dict)
    vocabulary: list[str] = field(default_factory=list)

    def predict(self, df: DataFrame, text: str = "text", top_k: int = 1) -> DataFrame:
        """Add `predictions`, the best codes with their confidence, and the wide columns of each rank."""
        model = self.stages.stages[-1]
        if isinstance(model, NaiveBayesModel):
            weights = word_scores.weights(model, self.labels, len(self.vocabulary) or self.num_features, self.vocabulary)
            result = df.withColumn("predictions", word_scores.best(weights, top_k, words(F.coalesce(F.col(text), F.lit("")))))
        else:
            scored = self.stages.transform(ngram_features(df, text, self.num_features, vocabulary=self.vocabulary))
            result = scored.withColumn("predictions", _ranked(F.col("flat_probability"), self.labels, top_k))
        wide = {}
        for rank in range(1, top_k + 1):
            suffix = "" if rank == 1 else f"_top{rank}"
            item = F.get(F.col("predictions"), F.lit(rank - 1))
            wide[f"predicted_code{suffix}"] = F.coalesce(item["code"], F.lit(""))
            wide[f"confidence{suffix}"] = F.coalesce(item["confidence"], F.lit(0.0))
        return result.withColumns(wide).select(*df.columns, "predictions", *wide)

    def summary(self, spark: SparkSession) -> DataFrame:
        return _label_table(spark, {0: self.labels})

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.stages.write().overwrite().save(f"{path}/stages")
        _label_table(spark, {0: self.labels}).write.mode("overwrite").parquet(f"{path}/labels")
        spark.createDataFrame([(self.num_features, self.vocabulary)], "num_features int, vocabulary array<string>").write.mode(
            "overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FlatModel:
        labels = _read_labels(spark, f"{path}/labels")
        settings = spark.read.parquet(f"{path}/settings").first()
        return FlatModel(PipelineModel.load(f"{path}/stages"), labels[0], settings["num_features"], vocabulary=list(settings["vocabulary"]))


def fit_flat(df: DataFrame, label: str = "code8", text: str = "text", key: str = "id", min_count: int = 2, fraction: float = 0.2,
             seed: int = 42, num_features: int = FEATURES, estimator: str = "bayes", num_tokens: int | None = None,
             min_tokens: int = 1) -> FlatModel:
    """Drop rare classes, set a validation share aside, fit on the rest; `stats` counts them.

    Features are hashed n-grams, or with `num_tokens` the so many most frequent n-grams of the rows fitted on, of those
    that occur `min_tokens` times; their list is part of the model.
    """
    rows = df.select(key, text, label).persist()
    try:
        return _fit_flat(rows, label, text, key, min_count, fraction, seed, num_features, estimator, num_tokens, min_tokens)
    finally:
        rows.unpersist()


def _fit_flat(df: DataFrame, label: str, text: str, key: str, min_count: int, fraction: float, seed: int, num_features: int,
              estimator: str, num_tokens: int | None, min_tokens: int) -> FlatModel:
    sizes = tr.rare_report(df, label, min_count).first()
    if not sizes["n_kept"]:
        raise ValueError("no class has enough rows")
    kept = tr.filter_rare(df, label, min_count).persist()
    split = tr.stratified_split(kept, label, fraction, seed, key).persist()
    try:
        # as many rows as there are classes
        counts = _local(split.groupBy(label).agg(F.count_if("is_validation").alias("v"), F.count("*").alias("n")))
        indexer = _indexer(counts, label)
        fitted = split.where(~F.col("is_validation"))
        vocabulary = [row["ngram"] for row in ngram_vocab(fitted, text, min_tokens, num_tokens).orderBy("id").collect()] if num_tokens else []
        builder = _estimator(estimator, "features", f"__{label}_index", "flat")
        if estimator == "bayes":
            classes = counts.select(label, (F.col("n") - F.col("v")).alias("n")).where("n > 0")
            sums = written(_text_sums(fitted, label, text, num_features, vocabulary), "sums")
            model = _fit_sums(builder, indexer, classes, sums, len(vocabulary) or num_features)
        else:
            model = builder.fit(ngram_features(indexer.transform(fitted), text, num_features, vocabulary=vocabulary))
    finally:
        split.unpersist()
        kept.unpersist()
    total = counts.agg(F.sum("v").alias("v"), F.sum("n").alias("n")).first()
    stats = {"num_classes": len(indexer.labels), "train": total["n"] - total["v"], "val": total["v"], "total": total["n"],
             "dropped": int(sizes["n_dropped"])}
    return FlatModel(PipelineModel([model]), list(indexer.labels), num_features, stats, vocabulary)


# ---- level by level ------------------------------------------------------------------------------------------------


@dataclass
class LevelModel:
    """The classifier of one level, with the codes it gives and the parent codes it takes."""

    level: int
    stages: PipelineModel
    labels: list[str]
    parents: list[str] | None = None


@dataclass
class HierarchicalModel:
    """One classifier per level, each fed with the code chosen above and the bucket of its confidence."""

    levels: dict[int, LevelModel]
    max_level: int
    num_features: int = FEATURES
    skipped: dict[int, str] = field(default_factory=dict)

    def predict(self, df: DataFrame, text: str = "text", top_k: int = 1, threshold: float | None = None) -> DataFrame:
        """Add per level the best codes (`alternatives{N}`), the chosen `path`, and the final code.

        The code chosen at a level feeds the next one; levels without a classifier are skipped.
        """
        scored = ngram_features(df, text, self.num_features)
        path = []
        previous: Column | None = None
        for n in range(1, self.max_level + 1):
            model = self.levels.get(n)
            if model is None:
                continue
            scored = _score_level(scored, model, previous, top_k)
            best = F.get(F.col(f"alternatives{n}"), F.lit(0))
            path.append(F.struct(F.lit(n).alias("level"), best["code"].alias("code"), best["confidence"].alias("confidence")))
            previous = best
        result = scored.withColumn("path", F.array(*path).cast(PATH_TYPE)).select(
            *df.columns, *[f"alternatives{n}" for n in sorted(self.levels)], "path")
        return combine_confidence(result, threshold)

    def predict_wide(self, df: DataFrame, text: str = "text", top_k: int = 1, threshold: float | None = None) -> DataFrame:
        return _widened(self.predict(df, text, top_k, threshold), df.columns, sorted(self.levels), top_k)

    def predict_beam(self, df: DataFrame, beam_size: int, text: str = "text", top_k: int = 0) -> DataFrame:
        """Add `predicted_code, final_level, confidence, combined_confidence` of the best of `beam_size` paths.

        With `top_k` the best so many beams also give their code and confidence at every level, `predicted_level{N}` and
        `confidence_level{N}` with `_top{R}` from the second beam on; '' and 0.0 where a beam has none.

        The beams of a row stay in the row: each level is scored once per beam and the best are kept, so nothing is
        shuffled. A beam that skipped the level above is scored with parent index 0 and confidence 0.9.
        """
        scored = ngram_features(df, text, self.num_features).withColumn("__beams", F.array(F.struct(
            F.lit(0.0).alias("order"), F.array().cast("array<string>").alias("codes"), F.lit(0.0).alias("lp"),
            F.array().cast(PATH_TYPE).alias("trail"))))
        width = 1
        for n in range(1, self.max_level + 1):
            model = self.levels.get(n)
            if model is None:
                continue
            grown = []
            for b in range(width):
                beam = F.get(F.col("__beams"), F.lit(b))
                last = F.get(beam["trail"], F.size(beam["trail"]) - 1)
                above = last["level"] == n - 1
                previous = F.struct(F.when(above, last["code"]).alias("code"),
                                    F.coalesce(F.when(above, last["confidence"]), F.lit(0.9)).alias("confidence"))
                scored = _score_level(scored, model, previous, beam_size).withColumnRenamed(f"alternatives{n}", f"__next{b}")
                grown.append(F.when(beam.isNotNull(), F.transform(f"__next{b}", _grower(beam, n))))
            kept = F.flatten(F.array_compact(F.array(*grown)))
            scored = scored.withColumn("__beams", F.slice(F.sort_array(kept), 1, beam_size)).drop(*[f"__next{b}" for b in range(width)])
            width = beam_size
        best = F.get(F.col("__beams"), F.lit(0))
        last = F.get(best["trail"], F.size(best["trail"]) - 1)
        return scored.select(
            *df.columns, F.coalesce(last["code"], F.lit("")).alias("predicted_code"),
            F.coalesce(F.concat(F.lit("level"), last["level"].cast("string")), F.lit("")).alias("final_level"),
            F.coalesce(last["confidence"], F.lit(0.0)).alias("confidence"), F.exp(best["lp"]).alias("combined_confidence"),
            *self._beam_levels(top_k))

    def _beam_levels(self, top_k: int) -> list[Column]:
        def at(level: int, rank: int) -> Column:
            trail = F.get(F.col("__beams"), F.lit(rank - 1))["trail"]
            return F.get(F.filter(trail, lambda entry: entry["level"] == level), F.lit(0))

        columns = []
        for n in sorted(self.levels):
            for rank in range(1, top_k + 1):
                suffix = "" if rank == 1 else f"_top{rank}"
                step = at(n, rank)
                columns += [F.coalesce(step["code"], F.lit("")).alias(f"predicted_level{n}{suffix}"),
                            F.coalesce(step["confidence"], F.lit(0.0)).alias(f"confidence_level{n}{suffix}")]
        return columns

    def summary(self, spark: SparkSession) -> DataFrame:
        return _label_table(spark, {n: model.labels for n, model in self.levels.items()})

    def save(self, path: str) -> None:
        for model in self.levels.values():
            _save_level(model, path)
        _save_settings(self, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> HierarchicalModel:
        settings, levels = _load_settings(spark, path)
        return HierarchicalModel(levels, settings["max_level"], settings["num_features"])


def _grower(beam: Column, level: int):
    """A function adding one more code to a beam; equal joint confidences to nine digits are ordered by the codes."""
    def grown(item: Column) -> Column:
        lp = beam["lp"] + F.log(F.greatest(item["confidence"], F.lit(1e-9)))
        entry = F.struct(F.lit(level).alias("level"), item["code"].alias("code"), item["confidence"].alias("confidence"))
        return F.struct(F.round(-lp, 9).alias("order"), F.array_append(beam["codes"], item["code"]).alias("codes"), lp.alias("lp"),
                        F.concat(beam["trail"], F.array(entry)).cast(PATH_TYPE).alias("trail"))
    return grown


def _save_settings(model: HierarchicalModel | MultiheadModel, path: str) -> None:
    """Settings and the numbers of the model's own levels; what an earlier model left in the folder isn't read."""
    SparkSession.active().createDataFrame(
        [(model.max_level, model.num_features, sorted(model.levels))], "max_level int, num_features int, levels array<int>").write.mode(
        "overwrite").parquet(f"{path}/settings")


def _load_settings(spark: SparkSession, path: str):
    settings = spark.read.parquet(f"{path}/settings").first()
    found = {n: _load_level(spark, path, n) for n in settings["levels"]}
    missing = [n for n, model in found.items() if model is None]
    if missing:
        raise ValueError(f"{path} lacks levels {missing}")
    return settings, found


def _save_level(model: LevelModel, path: str, fingerprint: str = "") -> None:
    spark = SparkSession.active()
    spark.createDataFrame([(fingerprint,)], "fingerprint string").write.mode("overwrite").parquet(f"{path}/level{model.level}/fit")
    tables = {"labels": model.labels, "parents": model.parents or []}
    for name, values in tables.items():
        spark.createDataFrame(list(enumerate(values)), "index int, label string").write.mode("overwrite").parquet(
            f"{path}/level{model.level}/{name}")
    # written last: its presence says the level is complete
    model.stages.write().overwrite().save(f"{path}/level{model.level}/stages")


def _load_level(spark: SparkSession, path: str, n: int, fingerprint: str | None = None) -> LevelModel | None:
    """A saved level, None when it isn't there or incomplete; an error if it isn't the one of `fingerprint`."""
    folder = f"{path}/level{n}"
    try:
        spark.read.text(f"{folder}/stages/metadata").first()
    except AnalysisException:
        return None
    if fingerprint is not None and spark.read.parquet(f"{folder}/fit").first()["fingerprint"] != fingerprint:
        raise ValueError(f"level {n} in {path} was fitted on other rows or with other settings")
    values = {
        name: [row["label"] for row in spark.read.parquet(f"{folder}/{name}").orderBy("index").collect()] for name in ("labels", "parents")}
    return LevelModel(n, PipelineModel.load(f"{folder}/stages"), values["labels"], values["parents"] or None)


def _label_table(spark: SparkSession, labels: dict[int, list[str]]) -> DataFrame:
    """`level, index, code` of a model's labels."""
    return spark.createDataFrame([(n, i, code) for n, codes in labels.items() for i, code in enumerate(codes)], "level int, index int, code string")


def _read_labels(spark: SparkSession, path: str) -> dict[int, list[str]]:
    labels: dict[int, list[str]] = {}
    for row in spark.read.parquet(path).orderBy("level", "index").collect():
        labels.setdefault(row["level"], []).append(row["code"])
    return labels


def model_summary(table: DataFrame, samples: int = 5) -> DataFrame:
    """`level, n_classes, samples` of a label table."""
    first = F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(F.struct("index", "code"))), 1, samples), lambda s: s["code"]), ", ")
    return table.groupBy("level").agg(F.count("*").alias("n_classes"), first.alias("samples"))


def _with_parent(df: DataFrame, parents: Sequence[str], parent: Column, bucket: Column) -> DataFrame:
    """Add the indexes of the parent code (unknown ones 0) and of the confidence bucket as doubles."""
    position = F.array_position(F.array(*[F.lit(code) for code in parents]), parent)
    return df.withColumns({"__parent": F.greatest(F.coalesce(position, F.lit(0)) - 1, F.lit(0)).cast("double"),
                           "__bucket": bucket.cast("double")})


def _parent_stages(n_parents: int, n: int):
    """One-hot parent and bucket next to the n-gram counts."""
    encoder = OneHotEncoder(inputCols=["__parent", "__bucket"], outputCols=["__parent_vec", "__bucket_vec"], dropLast=False)
    assembler = VectorAssembler(inputCols=["features", "__parent_vec", "__bucket_vec"], outputCol=f"__all{n}")
    return encoder, assembler


def _score_level(df: DataFrame, model: LevelModel, previous: Column | None, top_k: int) -> DataFrame:
    """Add `alternatives{N}`; without a previous level the parent is index 0 with confidence 0.5."""
    n = model.level
    if model.parents is not None:
        parent = previous["code"] if previous is not None else F.lit(None).cast("string")
        confidence = previous["confidence"] if previous is not None else F.lit(0.5)
        df = _with_parent(df, model.parents, parent, bucket_confidence(confidence))
    scored = model.stages.transform(df).withColumn(f"alternatives{n}", _ranked(F.col(f"level{n}_probability"), model.labels, top_k))
    work = ("__parent", "__bucket", "__parent_vec", "__bucket_vec", f"__all{n}", f"level{n}_prediction", f"level{n}_raw", f"level{n}_probability")
    return scored.drop(*work)


def _choose(df: DataFrame, model: LevelModel, text: str, num_features: int) -> DataFrame:
    """Rows with the level's best code and its confidence as `__code, __confidence`, given those of the level above."""
    n = model.level
    bayes = model.stages.stages[-1]
    confidence = F.coalesce("__confidence", F.lit(0.5))
    if isinstance(bayes, NaiveBayesModel):
        weights = word_scores.weights(bayes, model.labels, num_features, parents=model.parents)
        found = df.withColumn(f"alternatives{n}", word_scores.best(
            weights, 1, words(F.coalesce(F.col(text), F.lit(""))), F.col("__code"), bucket_confidence(confidence)))
    else:
        found = _score_level(df, model, F.struct(F.col("__code").alias("code"), confidence.alias("confidence")), 1)
    best = F.get(F.col(f"alternatives{n}"), F.lit(0))
    return found.withColumns({"__code": best["code"], "__confidence": best["confidence"]}).drop(f"alternatives{n}")


def _widened(df: DataFrame, kept: Sequence[str], levels: Sequence[int], top_k: int) -> DataFrame:
    """`predicted_code, final_level, confidence, combined_confidence` and the columns per level and rank."""
    wide = {
        "predicted_code": F.col("final_code"), "confidence": F.col("final_confidence"),
    }
    for n in levels:
        for rank in range(1, top_k + 1):
            suffix = "" if rank == 1 else f"_top{rank}"
            item = F.get(F.col(f"alternatives{n}"), F.lit(rank - 1))
            wide[f"predicted_level{n}{suffix}"] = F.coalesce(item["code"], F.lit(""))
            wide[f"confidence_level{n}{suffix}"] = F.coalesce(item["confidence"], F.lit(0.0))
    return df.withColumns(wide).select(
        *kept, "predicted_code", "final_level", "confidence", "combined_confidence",
        *[name for name in wide if name not in ("predicted_code", "confidence")])


def fit_hierarchical(df: DataFrame, max_level: int = 5, text: str = "text", key: str = "id", min_samples: int = 50, min_count: int = 2,
                     teacher_forcing: float = 0.7, seed: int = 42, num_features: int = FEATURES, estimator: str = "bayes",
                     save_to: str | None = None, resume_from: str | None = None) -> HierarchicalModel:
    """Fit the levels in order; each sees the level above, partly as predicted (see `teacher_force`).

    With `save_to` every level is stored when done, over what is there. With `resume_from` the levels found in that
    folder are reused and only their predictions made again, where a level below is to be fitted, and the others are
    fitted and stored there (or in `save_to`); a level that was fitted on other rows or with other settings is an error.
    Predictions between levels are persisted on the executors.
    """
    if resume_from:
        save_to = save_to or resume_from
    settings = [max_level, min_samples, min_count, teacher_forcing, seed, num_features, estimator]
    columns = [key, text, *[f"level{n}" for n in range(1, max_level + 1)]]
    rows = df.select(*columns).persist()
    persisted = [rows]
    models: dict[int, LevelModel] = {}
    skipped: dict[int, str] = {}
    try:
        fingerprint = _fingerprint(rows, columns, settings) if save_to else ""
        levels = [n for n in LEVELS if n <= max_level]
        reasons = {row["level"]: row["status"] for row in tr.usable_levels(rows, min_samples, 2, min_count, levels).collect()}
        current = rows if estimator == "bayes" else ngram_features(rows, text, num_features)
        current = current.withColumns({"__code": F.lit(None).cast("string"), "__confidence": F.lit(None).cast("double")})
        waiting: list[LevelModel] = []  # levels whose predictions no fit has asked for yet
        for n in range(1, max_level + 1):
            if reasons.get(n) != "train":
                skipped[n] = reasons.get(n, "no rows")
                continue
            saved = _load_level(df.sparkSession, resume_from, n, fingerprint) if resume_from else None
            if saved is None:
                for above in waiting:
                    current = _choose(current, above, text, num_features).persist()
                    persisted.append(current)
                waiting = []
            model = saved or _fit_level(current, n, key, min_count, teacher_forcing, seed, estimator, first=n == 1, text=text, num_features=num_features)
            if saved is None:
                for table in persisted[1:-1]:  # the fit has read the last one
                    table.unpersist()
                del persisted[1:-1]
            models[n] = model
            waiting.append(model)
            if save_to and not (saved and save_to == resume_from):
                _save_level(model, save_to, fingerprint)
    finally:
        for table in persisted:
            table.unpersist()
    if not models:
        raise ValueError(f"no level could be trained: {skipped}")
    model = HierarchicalModel(models, max_level, num_features, skipped)
    if save_to:
        _save_settings(model, save_to)
    return model


def _fingerprint(df: DataFrame, columns: Sequence[str], settings: Sequence[object]) -> str:
    """Rows and settings of a fit in a few numbers: equal for equal rows in any order."""
    hashed = F.xxhash64(*columns)
    found = df.agg(F.count("*").alias("n"), F.bit_xor(hashed).alias("x"), F.sum(F.pmod(hashed, F.lit(1_000_003))).alias("s")).first()
    return "|".join(map(str, [*settings, *found]))


def _fit_level(df: DataFrame, n: int, key: str, min_count: int, teacher_forcing: float, seed: int, estimator: str, first: bool,
               frequent: DataFrame | None = None, text: str = "text", num_features: int = FEATURES) -> LevelModel:
    """Naive Bayes is fitted on sums for each label, from `text`; other estimators on the rows' `features`."""
    label = f"level{n}"
    rows = df.where(F.col(label).isNotNull())
    rows = tr.filter_rare(rows, label, min_count) if frequent is None else rows.join(frequent, label, "left_semi")
    target, parent, bayes = f"__{label}_index", f"level{n - 1}", estimator == "bayes"
    drawn = seeded_fraction(seed, F.lit(n), F.col(key)) < (1 - teacher_forcing)
    used = F.lit(None).cast("string") if first else F.when(drawn & F.col("__code").isNotNull(), F.col("__code")).otherwise(F.col(parent))
    bucket = F.lit(None).cast("int") if first else bucket_confidence(F.coalesce("__confidence", F.lit(0.9)))
    if bayes:  # all that naive Bayes takes of the rows: cells of the codes and buckets, and the words of each label
        above = used if first else F.col(parent)
        cells = written(rows.groupBy(label, above.alias("__above"), used.alias("__used"), bucket.alias("__of")).agg(F.count("*").alias("n")), "cells")
        classes, parent_codes = _local(cells.groupBy(label).agg(F.sum("n").alias("n"))), cells.select(F.col("__above").alias(parent)).distinct()
        texts = _text_sums(rows, label, text, num_features)
    else:
        classes, parent_codes = rows, rows
    indexer = _indexer(classes, label)
    if first:
        builder = _estimator(estimator, "features", target, label)
        model = _fit_sums(builder, indexer, classes, written(texts, "sums"), num_features) if bayes else builder.fit(indexer.transform(rows))
        return LevelModel(n, PipelineModel([model]), list(indexer.labels))
    parents = list(_indexer(parent_codes, parent).labels)
    # the encoder's sizes are those of the vocabulary and the buckets, whatever rows come by
    sizes = df.sparkSession.createDataFrame([(float(i), float(j)) for i, j in _corner(len(parents))], "__parent double, __bucket double")
    encoder, assembler = _parent_stages(len(parents), n)
    encoding = encoder.fit(sizes)
    builder = _estimator(estimator, f"__all{n}", target, label)
    if bayes:
        fed = encoding.transform(_with_parent(cells, parents, F.col("__used"), F.col("__of"))).groupBy(label).agg(
            *[Summarizer.sum(F.col(name), F.col("n").cast("double")).alias(name) for name in ("__parent_vec", "__bucket_vec")])
        sums = assembler.transform(written(texts.join(fed, label), "sums")).select(label, f"__all{n}")
        model = _fit_sums(builder, indexer, classes, sums, num_features + max(len(parents), 2) + 10)
    else:
        model = builder.fit(assembler.transform(encoding.transform(indexer.transform(_with_parent(rows, parents, used, bucket)))))
    return LevelModel(n, PipelineModel([encoding, assembler, model]), list(indexer.labels), parents)


def _corner(n_parents: int) -> list[tuple[int, int]]:
    """The highest index of both categories, which is what an encoder learns."""
    return [(max(n_parents - 1, 1), 9)]


# ---- one model per level on shared features ------------------------------------------------------------------------


@dataclass
class MultiheadModel:
    """One classifier per level on the same features; a code must be a child of the best code above."""

    levels: dict[int, LevelModel]
    children: dict[int, dict[str, list[str]]]
    max_level: int
    num_features: int = FEATURES
    skipped: dict[int, str] = field(default_factory=dict)

    def predict(self, df: DataFrame, text: str = "text", top_k: int = 1, threshold: float | None = None) -> DataFrame:
        """Add per level the best codes after masking, the chosen `path`, and the final code."""
        scored = ngram_features(df, text, self.num_features)
        path = []
        above: str | None = None
        for n in sorted(self.levels):
            model = self.levels[n]
            scored = model.stages.transform(scored).withColumn(f"__p{n}", vector_to_array(f"level{n}_probability")).drop(
                f"level{n}_prediction", f"level{n}_raw", f"level{n}_probability")
            if above is not None:
                scored = scored.withColumn(f"__p{n}", self._masked(n, F.col(f"__p{n}"), F.col(above)))
            names = F.array(*[F.lit(label) for label in model.labels])
            pairs = F.zip_with(F.col(f"__p{n}"), names, lambda p, code: F.struct(p.alias("confidence"), code.alias("code")))
            # of equal probabilities the highest label comes first, here and for the mask below
            scored = scored.withColumn(f"alternatives{n}", F.transform(
                F.slice(F.sort_array(pairs, asc=False), 1, top_k),
                lambda pair: F.struct(pair["code"].alias("code"), pair["confidence"].alias("confidence"))))
            best = F.get(F.col(f"alternatives{n}"), F.lit(0))
            scored = scored.withColumn(f"__best{n}", best["code"])
            above = f"__best{n}"
            path.append(F.struct(F.lit(n).alias("level"), best["code"].alias("code"), best["confidence"].alias("confidence")))
        result = scored.withColumn("path", F.array(*path).cast(PATH_TYPE)).select(
            *df.columns, *[f"alternatives{n}" for n in sorted(self.levels)], "path")
        return combine_confidence(result, threshold)

    def predict_wide(self, df: DataFrame, text: str = "text", top_k: int = 1, threshold: float | None = None) -> DataFrame:
        return _widened(self.predict(df, text, top_k, threshold), df.columns, sorted(self.levels), top_k)

    def _masked(self, n: int, probabilities: Column, above: Column) -> Column:
        """Probabilities of the children of the code above, summing to 1; unchanged when it has none."""
        parent_of = {child: parent for parent, children in self.children.get(n, {}).items() for child in children}
        parents = F.array(*[F.lit(parent_of.get(label, "")) for label in self.levels[n].labels])
        kept = F.zip_with(probabilities, parents, lambda p, parent: F.when(parent == above, p).otherwise(F.lit(0.0)))
        n_valid = F.size(F.filter(parents, lambda parent: parent == above))
        total = F.aggregate(kept, F.lit(0.0), lambda acc, p: acc + p)
        even = F.transform(parents, lambda parent: F.when(parent == above, F.lit(1.0) / n_valid).otherwise(F.lit(0.0)))
        return (
            F.when(n_valid == 0, probabilities)
            .when(total > 0, F.transform(kept, lambda p: p / total)).otherwise(even)
        )

    def summary(self, spark: SparkSession) -> DataFrame:
        return _label_table(spark, {n: model.labels for n, model in self.levels.items()})

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        for model in self.levels.values():
            _save_level(model, path)
        pairs = [(n, parent, child) for n, by_parent in self.children.items() for parent, kids in by_parent.items() for child in kids]
        spark.createDataFrame(pairs, "level int, parent string, child string").write.mode("overwrite").parquet(f"{path}/children")
        _save_settings(self, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> MultiheadModel:
        settings, levels = _load_settings(spark, path)
        children = _children_lists(spark.read.parquet(f"{path}/children"))
        return MultiheadModel(levels, children, settings["max_level"], settings["num_features"])


def _children_lists(pairs: DataFrame) -> dict[int, dict[str, list[str]]]:
    """Children per level and parent; as many entries as the nomenclature has codes."""
    result: dict[int, dict[str, list[str]]] = {}
    for row in pairs.orderBy("level", "parent", "child").collect():
        result.setdefault(row["level"], {}).setdefault(row["parent"], []).append(row["child"])
    return result


def fit_multihead(df: DataFrame, max_level: int = 4, text: str = "text", key: str = "id", min_samples: int = 50, min_count: int = 2,
                  fraction: float = 0.2, seed: int = 42, num_features: int = FEATURES, estimator: str = "bayes") -> MultiheadModel:
    """One classifier per level on features computed once.

    Rare classes are those of all rows; then a validation share of each class of the first usable level is set aside.
    """
    reasons = {row["level"]: row["status"] for row in tr.usable_levels(df, min_samples, 2, min_count).collect()}
    columns = [key, text, *[f"level{n}" for n in range(1, max_level + 1)]]
    usable = next((n for n in range(1, max_level + 1) if reasons.get(n) == "train"), 1)
    split = tr.stratified_split(df.select(*columns), f"level{usable}", fraction, seed, key)
    train = split.where(~F.col("is_validation"))
    train = (train if estimator == "bayes" else ngram_features(train, text, num_features)).persist()
    models: dict[int, LevelModel] = {}
    skipped: dict[int, str] = {}
    for n in range(1, max_level + 1):
        if reasons.get(n) != "train":
            skipped[n] = reasons.get(n, "no rows")
            continue
        frequent = tr.class_sizes(df, f"level{n}").where(F.col("n") >= min_count).select(f"level{n}")
        models[n] = _fit_level(train, n, key, min_count, 1.0, seed, estimator, first=True, frequent=frequent, text=text, num_features=num_features)
    train.unpersist()
    if not models:
        raise ValueError(f"no level could be trained: {skipped}")
    known = {n: set(model.labels) for n, model in models.items()}
    pairs = _children_lists(children_map(df, range(1, max_level + 1)))
    children = {
        n: {parent: [kid for kid in kids if kid in known[n]] for parent, kids in by_parent.items()}
        for n, by_parent in pairs.items() if n in known
    }
    return MultiheadModel(models, children, max_level, num_features, skipped)


# ---- prediction of tables ------------------------------------------------------------------------------------------


def predict_table(model: FlatModel | HierarchicalModel | MultiheadModel, df: DataFrame, text: str = "product", top_k: int = 1,
                  threshold: float | None = None, words: Sequence[str] = DEFAULT_STOPWORDS, beam: int = 1) -> DataFrame:
    """Clean the text, then predict; rows without any word are not in the result. A flat model scores each different text once.

    With `beam` over 1 a level-by-level model keeps so many paths, and the best `top_k` of them give the columns per level.
    """
    cleaned = preprocess_text(df, text, words)
    if isinstance(model, FlatModel):
        texts = model.predict(cleaned.select(text).distinct(), text, top_k).drop("predictions")
        return cleaned.join(texts, text).select(*cleaned.columns, *[name for name in texts.columns if name != text])
    if isinstance(model, HierarchicalModel) and beam > 1:
        return model.predict_beam(cleaned, beam, text, top_k)
    return model.predict_wide(cleaned, text, top_k, threshold)
