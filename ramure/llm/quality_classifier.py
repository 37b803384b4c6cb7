"""A quality classifier: n-gram indicators scaled by log-count ratios of naive Bayes, and a linear hinge-loss model on them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ramure.llm.common import mix, stored, texts_of, words_in

#: Features that n-grams are hashed to; the last one is always on.
FEATURES = 1 << 18
#: Labelled texts that a model is fitted on, about: of more, those with the smallest hashes of their keys.
MOST_ROWS = 10_000
#: Rows whose indicators are counted at once.
AT_ONCE = 100


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted numbers of the n-grams in each whole text: words, pairs of words, runs of three bytes, and how often n-grams repeat.

    For the last, the share of distinct words, of distinct pairs and of pairs of equal words is told in eighths. Null is read as empty.
    """
    for data, ends in texts_of(texts):
        hashes, before = words_in(data, ends, fold=False)
        letters = data.astype(np.uint64)
        every = mix((letters[:-2] << np.uint64(16)) + (letters[1:-1] << np.uint64(8)) + letters[2:])
        for begin, end, low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), before[:-1].tolist(), before[1:].tolist()):
            words, runs = hashes[low:high], every[begin:max(end - 2, begin)]
            pairs = mix(words[:-1] + mix(words[1:]))
            shares = [len(np.unique(some)) / max(len(some), 1) for some in (words, pairs)] + [np.count_nonzero(words[:-1] == words[1:]) / max(len(pairs), 1)]
            repeated = mix(np.array([8 * (n + 1) + int(7.999 * share) for n, share in enumerate(shares)], np.uint64))
            found = np.concatenate([words, pairs, runs, repeated]) % np.uint64(FEATURES - 1)
            yield np.append(np.unique(found), np.uint64(FEATURES - 1)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """`ratios` scale the indicators, `weights` are those of the scaled ones; a margin m has the score 1 / (1 + exp(-(slope m + shift)))."""

    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        values = self.ratios[features]
        return float(values @ self.weights[features]) / max(float(np.sqrt(values @ values)), 1e-12)

    def scores(self, texts: pa.Array) -> np.ndarray:
        margins = np.fromiter(map(self.margin, indicators(texts)), np.float64)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """ln of the smoothed share of each indicator among rows of label 1 over that among those of label 0; 1 for the one always on."""
    shares = []
    for label in (1, 0):
        some = [row for row, own in zip(rows, labels) if own == label]
        counts = np.ones(FEATURES)
        for low in range(0, len(some), AT_ONCE):
            counts += np.bincount(np.concatenate(some[low:low + AT_ONCE]), minlength=FEATURES)
        shares.append(counts / counts.sum())
    ratios = np.log(shares[0] / shares[1])
    ratios[FEATURES - 1] = 1.0
    return ratios


def coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = 1.0, epochs: int = 10,
                       seed: int = 7) -> np.ndarray:
    """Weights of the hinge loss with squared norm, by descent on one dual variable at a time; both labels weigh the same in all."""
    signs = np.where(labels == 1, 1.0, -1.0)
    bound = cost * len(labels) / (2 * np.where(labels == 1, (labels == 1).sum(), (labels == 0).sum()))
    lengths = [max(float(np.sqrt(ratios[row] @ ratios[row])), 1e-12) for row in rows]
    dual, weights = np.zeros(len(rows)), np.zeros(FEATURES)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for n in order.permutation(len(rows)):
            values = ratios[rows[n]] / lengths[n]  # length 1, so the curvature of every variable is 1; not kept, as they are many
            slack = signs[n] * float(weights[rows[n]] @ values) - 1.0
            new = min(max(dual[n] - slack, 0.0), bound[n])
            if new != dual[n]:
                weights[rows[n]] += (new - dual[n]) * signs[n] * values
                largest = max(largest, abs(new - dual[n]))
                dual[n] = new
        if largest < 1e-3:
            break
    return weights


def _calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins, by Newton's method on smoothed labels."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    curve = np.array([1.0, np.log((ones + 1) / (zeros + 1))])
    for _ in range(50):
        share = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (share - target) + 1e-3 * curve
        step = np.linalg.solve(x.T @ (x * (share * (1 - share))[:, None]) + 1e-3 * np.eye(2), slope)
        curve = curve - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(curve[0]), 1e-6), float(curve[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit weights on four fifths of the rows and the curve on the rest. With one label only the score is its share, with none 0.5."""
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 1.0, float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -30, 30)))
    held = np.zeros(len(labels), bool)
    for label in (0, 1):
        held[np.flatnonzero(labels == label)[::5]] = True
    if len(set(labels[~held].tolist())) < 2:
        held[:] = False
    train = [row for row, out in zip(rows, held) if not out]
    ratios = log_count_ratios(train, labels[~held])
    model = Model(ratios, coordinate_descent(train, labels[~held], ratios), 1.0, 0.0)
    tried = held if held.any() else ~held
    margins = np.array([model.margin(row) for row, out in zip(rows, tried) if out])
    return Model(model.ratios, model.weights, *_calibrated(margins, labels[tried]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id",
          most_rows: int = MOST_ROWS) -> Model:
    """A model of `labels` (key, label) on the texts of `docs`.

    Rows with null keys or labels are left out; of a repeated label the smaller counts. Of more labelled texts than `most_rows`, about
    so many are used, chosen by a hash of the key; their indicators, a few KB each, are what the driver sees.
    """
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("k")).agg(F.min(label).cast("int").alias("label")))
    known = stored(known, "known")
    share = min(1.0, most_rows / max(known.count(), 1))
    chosen = stored(known.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < int(share * 1_000_000)), "chosen")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([one.tobytes() for one in indicators(batch.column(2))], pa.binary())],
                                             ["k", "label", "features"])

    labelled = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(chosen, "k").select("k", "label", "text")
    kind = docs.schema[key].dataType.simpleString()
    rows = stored(labelled.mapInArrow(found, f"k {kind}, label int, features binary"), "indicators").toArrow()
    order = pc.sort_indices(rows, [("k", "ascending"), ("features", "ascending")]).to_numpy()
    features = [np.frombuffer(value.as_buffer(), np.int32) for value in rows["features"]]  # views of what was collected
    return fit([features[n] for n in order], np.asarray(rows["label"], np.int64)[order])


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with a column of scores from 0 to 1, higher for label 1; null and empty texts have that of no n-grams.

    The model, of fixed size, is broadcast; texts are scored in batches without a shuffle. An existing column of that name is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(sent.value.scores(batch))

    return docs.withColumn(name, scores(F.col(text)))


def accept(docs: DataFrame, model: Model, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of `docs` that score at least `least`, with their own columns only."""
    score = "score"
    while score in docs.columns:
        score += "_"
    return with_scores(docs, model, text, score).where(F.col(score) >= least).drop(score)
