"""Near duplicates: banded MinHash candidates, pruned batch by batch by their posterior similarity, verified on whole shingle sets.

Nodes of the similarity graph are distinct shingle sets, named by a 128-bit hash, so copies of a set cost one node however many they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ramure.llm.common import components, dropped, mix, stored, texts_of, words_in

#: Pairs of signatures compared at once by a task, shingles in a block of sets, shingles in a product of matrices.
PAIRS, BLOCK, COLUMNS = 4_096, 65_536, 4_096
#: Bytes of the shingles of a pair to be verified, about: a task gets `FILE_BYTES` of them where shuffles would have more tasks.
PAIR_BYTES = 4_096
#: Bits of a page of a bitmap, as Spark's functions make them; pages at most, as a power of 2.
PAGE_BITS, PAGES = 32_768, 11


@dataclass(frozen=True)
class Similarity:
    """Links between sets of word shingles with 100 * intersection >= percent * union.

    `miss` is the chance allowed to lose a pair just at the threshold, once when bands choose candidates and at each batch of
    signature values when candidates are pruned. Bands of `rows` values each; as many as `miss` needs.
    """

    shingle: int = 5
    percent: int = 80
    miss: float = 1e-6
    rows: int = 5
    batch: int = 20

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-((self.percent / 100) ** self.rows)))

    @property
    def values(self) -> int:
        return self.bands * self.rows

    def steps(self) -> list[tuple[int, int]]:
        """(values compared, least that must be equal to go on).

        With m of n values equal and a uniform prior, the similarity has a Beta(m + 1, n - m + 1) posterior; it reaches the threshold t
        with the chance that a binomial variable of n + 1 trials at t is at most m. Pairs below `miss` are pruned.
        """
        t, found = self.percent / 100, []
        for n in (*range(self.batch, self.values, self.batch), self.values):
            chance, least = 0.0, 0
            for m in range(n + 1):
                chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if chance >= self.miss:
                    least = m
                    break
            found.append((n, least))
        return found


@cache
def _functions(values: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the hash functions of a signature, fixed."""
    numbers = mix(np.arange(1, 2 * values + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:values] | np.uint64(1), numbers[values:]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; with fewer words, of the whole sequence; of no words, none."""
    if not len(words):
        return words
    width = min(size, len(words))
    joined = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        joined = mix(joined + words[at:len(words) - width + 1 + at])
    return np.unique(joined)


def signature(shingles: np.ndarray, values: int) -> np.ndarray:
    """The smallest value of every hash function over a set, as 32 bits."""
    factors, offsets = _functions(values)
    least = np.full(values, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at:at + 512, None] * factors + offsets).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _sets_of(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text; words are runs of anything but ASCII white space, A-Z lower-cased."""
    for data, ends in texts_of(texts):
        words, before = words_in(data, ends, fold=True)
        for low, high in zip(before[:-1].tolist(), before[1:].tolist()):
            yield shingle_set(words[low:high], size)


def _name(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def set_signatures(docs: DataFrame, similarity: Similarity, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text_hash, n_shingles, node, signature) of every row; texts without words have no node and no signature."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, signatures = [], [], []
            for one in _sets_of(batch.column(1), similarity.shingle):
                counts.append(len(one))
                nodes.append(_name(one) if len(one) else None)
                signatures.append(signature(one, similarity.values).tobytes() if len(one) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
                ["key", "text_hash", "n_shingles", "node", "signature"])

    source = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("text_hash"))
    return source.mapInArrow(signed, "key long, text_hash long, n_shingles long, node binary, signature binary")


def _bands(similarity: Similarity) -> Column:
    width = 4 * similarity.rows
    return F.array(*[F.xxhash64(F.lit(band), F.substring("signature", 1 + band * width, width)) for band in range(similarity.bands)])


def _alike(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the pairs of signatures that no batch prunes."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    done = 0
    for values, least in steps:
        equal = equal + (left[alive, done:values] == right[alive, done:values]).sum(axis=1)
        stay = equal >= least
        alive, equal, done = alive[stay], equal[stay], values
        if not len(alive):
            break
    return alive


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right, by products of incidence matrices."""
    sides = []
    for sets in (left, right):
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sides.append((values, np.repeat(np.arange(len(sets)), [len(one) for one in sets]), len(sets)))
    common = np.intersect1d(sides[0][0], sides[1][0])
    placed = []
    for values, rows, count in sides:
        at = np.searchsorted(common, values)
        inside = np.flatnonzero((at < len(common)) & (common[np.minimum(at, max(len(common) - 1, 0))] == values)) if len(common) else []
        placed.append((rows[inside], at[inside], count))
    counts = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(common), COLUMNS):
        matrices = []
        for rows, at, count in placed:
            here = (at >= low) & (at < low + COLUMNS)
            matrix = np.zeros((count, min(COLUMNS, len(common) - low)), np.float32)
            matrix[rows[here], at[here] - low] = 1
            matrices.append(matrix)
        counts += matrices[0] @ matrices[1].T
    return counts.astype(np.int64)


def _joining(fewer: list[dict], more: list[dict], percent: int) -> list[tuple[bytes, bytes]]:
    """Of the links between two blocks those that join components not joined by the ones before."""
    left, right = ([np.frombuffer(member["shingles"], np.uint64) for member in side] for side in (fewer, more))
    shared = shared_counts(left, right)
    union = np.array([len(one) for one in left])[:, None] + np.array([len(one) for one in right]) - shared
    above: dict[bytes, bytes] = {}

    def root(name: bytes) -> bytes:
        while name in above:
            name = above[name]
        return name

    found = []
    for a, b in np.argwhere(100 * shared >= percent * union).tolist():
        one, other = root(fewer[a]["component"]), root(more[b]["component"])
        if one != other:
            above[one] = other
            found.append((fewer[a]["node"], more[b]["node"]))
    return found


def _matrix(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), "<u4").reshape(len(signatures), -1)


def prune_pairs(pairs: DataFrame, signatures: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (a, b) whose signatures don't make a similarity at the threshold unlikely."""
    steps = similarity.steps()

    def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), PAIRS):
                part = batch.slice(low, PAIRS)
                alive = _alike(_matrix(part.column(2).to_pylist()), _matrix(part.column(3).to_pylist()), steps)
                yield part.select(["a", "b"]).take(pa.array(alive))

    sides = [signatures.select(F.col("node").alias(node), F.col("signature").alias(side)) for node, side in (("a", "left"), ("b", "right"))]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "left", "right").mapInArrow(pruned, "a binary, b binary")


def verify_pairs(pairs: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """(a, b, linked): whether the whole sets of a pair are similar enough."""
    percent = similarity.percent

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one, other = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * shared >= percent * (len(one) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    sides = [sets.select(F.col("node").alias(node), F.col("shingles").alias(side)) for node, side in (("a", "left"), ("b", "right"))]
    return (pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "left", "right")
            .mapInArrow(verified, "a binary, b binary, linked boolean"))


def _mapped(rows: DataFrame, value: Column, hashes: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with what tells whether their `value`, a hash, may be in `hashes` (hash); where it isn't so, it is not there."""
    pages = 1 << min(max(math.ceil(math.log2(max(hashes.count(), 1) * 32 / PAGE_BITS)), 0), PAGES)
    set_bits = hashes.select(F.pmod("hash", F.lit(pages * PAGE_BITS)).alias("bit"))
    page = F.floor(F.col("bit") / PAGE_BITS).alias("__page")
    bits = set_bits.groupBy(page).agg(F.bitmap_construct_agg(F.col("bit") % PAGE_BITS).alias("__bits"))
    placed = rows.withColumn("__bit", F.pmod(value, F.lit(pages * PAGE_BITS)))
    met = placed.withColumn("__page", F.floor(F.col("__bit") / PAGE_BITS)).join(F.broadcast(bits), "__page", "left")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(F.col("__bit") % PAGE_BITS / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met, F.coalesce(F.floor(byte / F.pow(F.lit(2), F.col("__bit") % 8)) % 2 == 1, F.lit(False))


def likely(rows: DataFrame, value: Column, hashes: DataFrame) -> DataFrame:
    """Rows whose `value`, a hash, is in `hashes` (hash), and a few others: so an exact join after it moves hardly more than it needs.

    The hashes set bits of a map, about 32 bits each and 8 MB at most, which is broadcast; with more of them more other rows get through.
    """
    met, there = _mapped(rows, value, hashes)
    return met.where(there).select(*rows.columns)


def unlikely(rows: DataFrame, value: Column, hashes: DataFrame) -> DataFrame:
    """The rows that `likely` leaves out: none of them is in `hashes`."""
    met, there = _mapped(rows, value, hashes)
    return met.where(~there).select(*rows.columns)


class _Graph:
    """Links found so far, between nodes that share a bucket."""

    def __init__(self, docs: DataFrame, signed: DataFrame, similarity: Similarity, text: str, key: str):
        self.docs, self.similarity, self.text, self.key = docs, similarity, text, key
        self.nodes = stored(signed.where("node IS NOT NULL").groupBy("node").agg(
            F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "text_hash")).alias("first"),
            F.any_value("signature").alias("signature")), "nodes")
        # one shuffle of all bands: a bucket streams by sorted, with its smallest node, and buckets of one node go nowhere
        bucket = Window.partitionBy("bucket")
        banded = self.nodes.select("node", F.explode(_bands(similarity)).alias("bucket"))
        starred = banded.withColumns({"star": F.min("node").over(bucket), "n": F.count("*").over(bucket)})
        self.members = stored(starred.where("n > 1").select("bucket", "node", "star"), "members")
        self.n = self.members.count()
        involved = stored(self.members.select("node").distinct(), "involved", self.n * 32)
        # signatures are large: those of other nodes are left where they are
        near = likely(self.nodes, F.xxhash64("node"), involved.select(F.xxhash64("node").alias("hash")))
        chosen = near.join(involved.select(F.col("node").alias("__node")), F.col("node") == F.col("__node"))  # a semi join would be moved before the map of bits
        self.signatures = stored(chosen.select("node", "signature", "first"), "signatures", involved.count() * (4 * similarity.values + 64))
        dropped(involved)
        self.tested: DataFrame | None = None
        self.rounds: list[DataFrame] = []
        self.labels: DataFrame | None = None

    def test(self, pairs: DataFrame, most: int) -> None:
        """Prune and verify pairs (a, b), so many at most, not tested before, and label components again."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            ordered = ordered.join(self.tested, ["a", "b"], "left_anti")
        ordered = stored(ordered, "ordered", most * 64)
        alike = stored(prune_pairs(ordered, self.signatures, self.similarity), "alike", ordered.count() * 8 * self.similarity.values)
        n = alike.count()
        sets = self.sets(alike.select(F.col("a").alias("node")).union(alike.select("b")).distinct(), 2 * n)
        verified = stored(verify_pairs(alike, sets, self.similarity), "tested", n * PAIR_BYTES)
        dropped(ordered, alike, sets)
        self.rounds.append(verified)
        self.tested = verified if self.tested is None else verified.union(self.tested)
        self.join(verified.where("linked").select("a", "b"))

    def join(self, links: DataFrame) -> None:
        """Label components again where links (a, b) join those that are known; only these are gone through."""
        if self.labels is None:
            self.labels = components(links)
            return
        n = links.count()
        if not n:
            return
        named = self.labels.select(F.col("id").alias("node"), "component")
        for side in ("a", "b"):
            links = links.join(named.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
        links = stored(links.where("a <> b").distinct(), "links", n * 64)
        moved = components(links)
        to = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
        again = self.labels.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        before = self.labels
        self.labels = stored(again.union(moved.join(before, "id", "left_anti").select("id", "component")), "labels", (before.count() + moved.count()) * 64)
        dropped(before, moved, links)

    def tables(self) -> list[DataFrame]:
        """What of the graph is stored."""
        return [self.nodes, self.members, self.signatures, *self.rounds, *([] if self.labels is None else [self.labels])]

    def sets(self, needed: DataFrame, most: int) -> DataFrame:
        """(node, shingles) of some nodes, so many at most, each from the first document that has it."""
        size, key, text = self.similarity.shingle, self.key, self.text
        first = stored(self.signatures.join(needed, "node", "left_semi").select("first.key", "first.text_hash"), "first", most * 32)

        def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [(_name(one), one.tobytes()) for one in _sets_of(batch.column(0), size)]
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in zip(*sets)], ["node", "shingles"])

        docs = likely(self.docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("text")), F.xxhash64("k", F.xxhash64("text")),
                      first.select(F.xxhash64("key", "text_hash").alias("hash")))
        chosen = docs.join(first, docs["k"].eqNullSafe(first["key"]) & (F.xxhash64("text") == first["text_hash"]))  # a semi join would be moved before the map of bits
        sets = stored(chosen.select("text").mapInArrow(shingled, "node binary, shingles binary").dropDuplicates(["node"]), "sets")
        dropped(first)
        return sets

    def mixed(self) -> DataFrame:
        """(bucket, node, component) of buckets of three or more whose members aren't all in one component; pairs have been tested."""
        labels = self.labels.select(F.col("id").alias("node"), "component")
        labelled = stored(self.members.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")), "labelled", self.n * 64)
        mixed = stored(labelled.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
                       .where("n > 2 AND low <> high").select("bucket"), "mixed", self.n * 64)
        found = stored(labelled.join(mixed, "bucket"), "mixed", self.n * 64)
        dropped(labelled, mixed)
        return found

    def stars(self) -> DataFrame:
        """Every member of a bucket with the bucket's smallest node: as many pairs as members, and copies of a text share the star."""
        return self.members.where("node <> star").select(F.col("node").alias("a"), F.col("star").alias("b"))

    def other_stars(self, mixed: DataFrame, draws: int) -> DataFrame:
        """Members of mixed buckets with other stars, some drawn for each bucket, of another component."""
        drawn = [F.min_by(F.struct("node", "component"), F.xxhash64("node", "bucket", F.lit(seed))) for seed in range(draws)]
        stars = mixed.groupBy("bucket").agg(F.array_distinct(F.array(*drawn)).alias("stars"))
        # written first: a join that shared the shuffle of the groups couldn't split a hot bucket
        self.rounds.append(stored(stars.select("bucket", F.explode("stars").alias("star")), "stars", mixed.count() * 64))
        return (mixed.join(self.rounds[-1], "bucket").where("component <> star.component")
                .select(F.col("node").alias("a"), F.col("star.node").alias("b")))

    def link_rest(self, mixed: DataFrame) -> None:
        """Find what still joins components in mixed buckets, from the whole sets of their members.

        Buckets with the same largest component are one group. Its members outside that component are compared with all its members,
        block by block: a row for each pair of blocks, and of the links found in it only those that join components further come out.
        """
        percent = self.similarity.percent
        most = mixed.count() * 64
        sizes = mixed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        largest = stored(sizes.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("largest")), "largest", most)
        members = stored(mixed.join(largest, "bucket").select("largest", "node", "component").distinct(), "members", most)
        n = members.count()
        sets = self.sets(members.select("node").distinct(), n)
        rows = stored(members.join(sets, "node"), "rows")
        # rows are dealt to blocks of about BLOCK shingles, for each side; pairs of blocks are rows before they meet their sets
        size = F.octet_length("shingles") / (8 * BLOCK)
        sized = rows.groupBy("largest").agg(F.ceil(F.sum(size)).cast("long").alias("blocks"),
                                            F.ceil(F.sum(F.when(F.col("component") != F.col("largest"), size))).cast("long").alias("others"))
        total = stored(sized.where("others > 0"), "blocks", n * 64)

        def numbers(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

        def blocks(some: DataFrame, count: str, side: str) -> DataFrame:
            dealt = some.join(total, "largest").withColumn(side, F.pmod(F.xxhash64("node"), F.col(count)))
            return stored(dealt.groupBy("largest", side).agg(F.collect_list(F.struct("node", "component", "shingles")).alias(f"{side}_sets")), side)

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(len(batch)):
                    links = _joining(batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), percent)
                    if links:
                        yield pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*links)], ["a", "b"])

        met = stored(total.select("largest", "blocks", numbers("others").alias("fewer")).select("largest", "fewer", numbers("blocks").alias("more"))
                     .repartition("largest", "fewer", "more"), "pairs")
        fewer, more = blocks(rows.where("component <> largest"), "others", "fewer"), blocks(rows, "blocks", "more")
        pairs = met.join(fewer, ["largest", "fewer"]).join(more, ["largest", "more"])
        found = pairs.select("fewer_sets", "more_sets").mapInArrow(compared, "a binary, b binary")
        links = stored(found.distinct(), "tested")
        dropped(largest, members, sets, rows, total, met, fewer, more)
        self.join(links)
        dropped(links)


def link_documents(docs: DataFrame, similarity: Similarity = Similarity(), text: str = "text", key: str = "doc_id",
                   draws: int = 2) -> DataFrame:
    """(key, text_hash, n_shingles, component_id, kept) of every row.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Rows are linked if their shingle sets are similar enough; the
    component is named by its smallest key, and `kept` tells the rows that have it. Texts without words, null ones too, have no
    shingles, are linked with nothing and kept. Equal sets are always linked; rows that repeat have equal results. Null keys never name
    a component that has others. Shingles compare as 64-bit hashes.

    Candidates share a band of their signatures. Bucket by bucket they are tested against one member, then, where a bucket still holds
    several components, against `draws` drawn ones; what is then left of different components is compared on whole sets in blocks, so
    that no bucket's pairs are all listed and none that could join components is left out.
    """
    return _link_documents(docs, similarity, text, key, draws)[0]


def _link_documents(docs: DataFrame, similarity: Similarity, text: str, key: str, draws: int) -> tuple[DataFrame, list[DataFrame]]:
    """What `link_documents` returns, and the stored tables that it is read from."""
    signed = stored(set_signatures(docs, similarity, text, key), "signed")
    graph = _Graph(docs, signed, similarity, text, key)
    graph.test(graph.stars(), graph.n)
    mixed = graph.mixed()
    left = mixed.count()
    if left and draws:
        graph.test(graph.other_stars(mixed, draws), left * draws)
        dropped(mixed)
        mixed = graph.mixed()
        left = mixed.count()
    if left:
        graph.link_rest(mixed)
    first = graph.nodes.select("node", F.col("first.key").alias("first"))
    labels = graph.labels.select(F.col("id").alias("node"), "component")
    named = first.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = stored(named.join(smallest, "component").select("node", "component_id"), "components")
    dropped(mixed, *graph.tables())
    joined = signed.select("key", "text_hash", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    linked = joined.select(F.col("key").alias(key), "text_hash", "n_shingles", component.alias("component_id"),
                           F.col("key").eqNullSafe(component).alias("kept"))
    return linked, [signed, of_node]


def deduplicate(docs: DataFrame, similarity: Similarity = Similarity(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay when each component keeps its smallest key; of rows equal in every column one stays."""
    found, tables = _link_documents(docs, similarity, text, key, draws=2)
    linked = stored(found, "linked")
    dropped(*tables)
    marks = stored(linked.groupBy(F.col(key).alias("__k"), F.col("text_hash").alias("__hash"), (~F.col("kept")).alias("__gone"))
                   .agg(F.count("*").alias("__n")).where("__gone OR __n > 1").drop("__n"), "marks")
    dropped(linked)
    # most rows stay, and only those that the marks may mean are compared with them: the texts of the others aren't shuffled
    value, hashes = F.xxhash64(docs[key].cast("long"), F.xxhash64(docs[text])), marks.select(F.xxhash64("__k", "__hash").alias("hash"))
    some = likely(docs, value, hashes)
    same = some[key].cast("long").eqNullSafe(F.col("__k")) & (F.xxhash64(some[text]) == F.col("__hash"))
    marked = some.join(marks, same, "left")  # an anti join would be moved before the map of bits
    kept = unlikely(docs, value, hashes).union(marked.where("__gone IS NULL").select(*docs.columns))
    if marks.where("NOT __gone").isEmpty():
        return kept
    return kept.union(marked.where("NOT __gone").select(*docs.columns).dropDuplicates())
