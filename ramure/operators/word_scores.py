"""Texts scored by a fitted multinomial naive Bayes of Spark ML, in numpy on Arrow arrays.

N-grams are those of words, so the weights of a text are the sum of those of its words. Each different word of a step is cut and weighted
once, and kept while there is room; what a step holds is bounded by cells of a row or word by a class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.common import _java2py
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Cells of the words kept, and of the rows scored at once.
KEPT, CELLS = 8_000_000, 64_000


@dataclass(frozen=True)
class Weights:
    """Logarithms a model adds up: of its classes, and by feature and class; classes are ordered by their code.

    The first features are n-grams, those of the vocabulary or hashed; with `parents` there follow the codes above and the buckets.
    """

    labels: list[str]
    prior: np.ndarray
    features: np.ndarray
    vocabulary: list[str] | None
    n_grams: int
    parents: list[str] | None = None


def weights(model: NaiveBayesModel, labels: Sequence[str], n_grams: int, vocabulary: Sequence[str] | None = None,
            parents: Sequence[str] | None = None) -> Weights:
    """What is added up by a model whose classes are the labels; a large matrix comes class by class, so that the driver makes no second one."""
    order = sorted(range(len(labels)), key=lambda i: labels[i].encode())
    if model.numFeatures * len(labels) <= KEPT:
        found = np.ascontiguousarray(model.theta.toArray()[order].T)
    else:
        place = {i: at for at, i in enumerate(order)}
        found = np.empty((model.numFeatures, len(labels)))
        context, rows = SparkSession.active().sparkContext, model._java_obj.theta().rowIter()
        for i in range(len(labels)):
            found[:, place[i]] = _java2py(context, rows.next()).toArray()
    return Weights([labels[i] for i in order], model.pi.toArray()[order], found, list(vocabulary) if vocabulary else None, n_grams,
                   list(parents) if parents is not None else None)


def hashed(grams: pa.Array, size: int) -> np.ndarray:
    """The numbers that `HashingTF` gives to strings: murmur3 of their UTF-8 bytes with seed 42, for all of one length at once."""
    encoded = grams.cast(pa.binary())
    lengths = np.asarray(pc.binary_length(encoded), np.int64)
    hashes = np.zeros(len(grams), np.uint32)

    def mixed(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(0xCC9E2D51)
        return ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)

    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        padded = np.zeros((len(rows), -(-length // 4) * 4), np.uint8)
        padded[:, :length] = np.frombuffer(b"".join(encoded.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), length)
        parts = padded.view("<u4")
        h = np.full(len(rows), 42, np.uint32)
        for at in range(length // 4):
            h ^= mixed(parts[:, at])
            h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
        if length % 4:
            h ^= mixed(parts[:, -1])
        h ^= np.uint32(length)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        hashes[rows] = h ^ (h >> np.uint32(16))
    return hashes.view(np.int32).astype(np.int64) % size


def _add(sums: np.ndarray, table: np.ndarray, at: np.ndarray, ends: np.ndarray) -> None:
    """Add to each row of `sums` the rows `at` of a table between its ends: the first of all rows, then the second, and so on."""
    starts, lengths = ends[:-1], np.diff(ends)
    rows = np.flatnonzero(lengths)
    j = 0
    while len(rows):
        sums[rows] += table[at[starts[rows] + j]]
        j += 1
        rows = rows[lengths[rows] > j]


class Scorer:
    """Scores texts, given by their words, with the weights of words at hand."""

    def __init__(self, model: Weights, top_k: int, min_n: int = 3, max_n: int = 6):
        self.model, self.top_k, self.sizes = model, top_k, range(min_n, max_n + 1)
        count = len(model.labels)
        self.labels = pa.array(model.labels, pa.string())
        self.numbers = {gram: i for i, gram in enumerate(model.vocabulary)} if model.vocabulary else None
        self.above = {code: i for i, code in enumerate(model.parents or [])}
        self.room, self.rows = max(1, KEPT // count), max(1, CELLS // count)
        self.kept, self.place = np.empty((self.room, count)), {}

    def _numbered(self, grams: list[str]) -> np.ndarray:
        """Numbers of n-grams, -1 for those the vocabulary lacks."""
        if self.numbers is None:
            return hashed(pa.array(grams, pa.string()), self.model.n_grams)
        return np.array([self.numbers.get(gram, -1) for gram in grams], np.int64)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the weights of different words are kept, `room` of them at most; all others are forgotten when it is full."""
        new = [word for word in words if word not in self.place]
        if len(self.place) + len(new) > self.room:
            self.place, new = {}, words
        for low in range(0, len(new), self.rows):
            some = new[low:low + self.rows]
            marked = [f"<{word}>" for word in some]
            cut = [[word[i:i + n] for n in self.sizes for i in range(len(word) - n + 1)] for word in marked]
            numbers = self._numbered([gram for grams in cut for gram in grams])
            owner = np.repeat(np.arange(len(some)), [len(grams) for grams in cut])[numbers >= 0]
            first = len(self.place)
            self.kept[first:first + len(some)] = 0
            _add(self.kept[first:first + len(some)], self.model.features, numbers[numbers >= 0],
                 np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(some)))]))
            self.place.update(zip(some, range(first, first + len(some))))
        return np.array([self.place[word] for word in words], np.int64)

    def best(self, texts: pa.Array, parent: pa.Array | None = None, bucket: pa.Array | None = None) -> pa.Array:
        """For each text, a list of words, the best `(code, confidence)`, those equal to nine digits by code; a parent not known is the first."""
        lengths = np.asarray(pc.fill_null(pc.list_value_length(texts), 0), np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        coded = texts.flatten().dictionary_encode()
        different, which = coded.dictionary.to_pylist(), np.asarray(coded.indices)
        top = min(self.top_k, len(self.labels))
        classes, confidences = np.empty((len(texts), top), np.int64), np.empty((len(texts), top))
        fed = self.model.parents is not None
        if fed:
            n_grams, many = self.model.n_grams, len(self.model.features) - self.model.n_grams - 10
            parents = np.array([self.above.get(code, 0) for code in parent.to_pylist()], np.int64) + n_grams
            buckets = np.asarray(bucket, np.int64) + n_grams + many
        for low in range(0, len(texts), self.rows):
            high = min(low + self.rows, len(texts))
            sums = np.tile(self.model.prior, (high - low, 1))
            for start in range(ends[low], ends[high], self.room):
                stop = min(start + self.room, ends[high])
                used, at = np.unique(which[start:stop], return_inverse=True)
                places = self._places([different[i] for i in used])
                _add(sums, self.kept, places[at], np.clip(ends[low:high + 1], start, stop) - start)
            if fed:
                sums += self.model.features[parents[low:high]]
                sums += self.model.features[buckets[low:high]]
            classes[low:high], confidences[low:high] = _chosen(sums, top)
        pairs = pa.StructArray.from_arrays([self.labels.take(pa.array(classes.ravel())), pa.array(confidences.ravel())], ["code", "confidence"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * top), pairs)


def _chosen(scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The best classes of each row and their probabilities; of those equal to nine digits the first."""
    scores -= scores.max(axis=1, keepdims=True)
    p = np.exp(scores, out=scores)
    p /= p.sum(axis=1, keepdims=True)
    order = np.round(p, 9)
    rows, classes = np.arange(len(p)), np.empty((len(p), top), np.int64)
    for rank in range(top):
        classes[:, rank] = order.argmax(axis=1)
        order[rows, classes[:, rank]] = -1
    return classes, p[rows[:, None], classes]


def best(model: Weights, top_k: int, texts: Column, parent: Column | None = None, bucket: Column | None = None) -> Column:
    """The best codes of texts given by their words, `array<struct<code, confidence>>`; the weights are sent to each executor once."""
    sent = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("array<struct<code:string,confidence:double>>")
    def scored(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        scorer = Scorer(sent.value, top_k)
        for batch in batches:
            yield scorer.best(*batch)

    none = F.lit(None)
    return scored(texts, none.cast("string") if parent is None else parent, none.cast("int") if bucket is None else bucket)
