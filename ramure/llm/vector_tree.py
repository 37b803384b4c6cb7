"""Approximate nearest neighbours by a tree of k-means clusters: the nearest branches first, as many leaves as a measured recall needs."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ramure.llm.common import stored

#: Bytes (as 32-bit floats) of the rows that the tree is fitted on, and at most so many rows; branches of a node, rows wanted in a leaf.
SAMPLE_BYTES, SAMPLE_ROWS, BRANCHES, LEAF_ROWS = 32_000_000, 100_000, 16, 500
#: Rows whose exact neighbours are found to set the number of leaves, and the share of those that has to be found.
CALIBRATION, RECALL = 200, 0.95
#: Leaves that a query visits before it knows a bound.
FIRST = 4
#: Rows and queries that are compared at once; leaves with more are split.
BLOCK, CHUNK = 16_384, 4_096


@dataclass(frozen=True)
class Tree:
    """Nodes by number, the root first: centres, and the numbers of a node's children (none for leaves)."""

    centers: np.ndarray
    children: tuple[tuple[int, ...], ...]

    @property
    def leaves(self) -> list[int]:
        return [node for node, below in enumerate(self.children) if not below]

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to all centres, but for the square of the vector itself."""
        return (self.centers**2).sum(axis=1) - 2 * vectors @ self.centers.T

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest child from the root down."""
        nodes = np.zeros(len(vectors), np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            below = np.array(self.children[node])
            if not len(below) or not len(rows):
                nodes[rows] = node
                continue
            centers = self.centers[below]
            nearest = ((centers**2).sum(axis=1) - 2 * vectors[rows] @ centers.T).argmin(axis=1)
            waiting += [(int(child), rows[nearest == at]) for at, child in enumerate(below)]
        return nodes

    def visits(self, distances: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a search reaches them: down the nearest children, the branches passed by kept in a priority queue."""
        queue: list[tuple[float, int]] = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                below = sorted((float(distances[child]), child) for child in self.children[node])
                node = below[0][1]
                for branch in below[1:]:
                    heapq.heappush(queue, branch)
            yield node


def _clusters(points: np.ndarray, wanted: int, draw: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The cluster of each point, by Lloyd's rounds from drawn points."""
    centers = points[draw.choice(len(points), wanted, replace=False)]
    own = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        own = ((centers**2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=len(centers))
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return own


def fit_tree(sample: np.ndarray, rows: int, leaf_rows: int = LEAF_ROWS, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """Split the sample until a leaf stands for about `leaf_rows` of all `rows`, or holds fewer than 16 points or equal ones alone."""
    draw = np.random.default_rng(seed)
    centers: list[np.ndarray] = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])]
    children: list[tuple[int, ...]] = [()]
    waiting = [(0, np.arange(len(sample)))]
    share = rows / max(len(sample), 1)
    while waiting:
        node, points = waiting.pop()
        wanted = min(branches, int(np.ceil(len(points) * share / leaf_rows)), len(points) // 8)
        if wanted < 2:
            continue
        own = _clusters(sample[points], wanted, draw)
        parts = [points[own == at] for at in range(wanted)]
        parts = [part for part in parts if len(part)]
        if len(parts) < 2:
            continue
        children[node] = tuple(range(len(centers), len(centers) + len(parts)))
        for part in parts:
            waiting.append((len(centers), part))
            centers.append(sample[part].mean(axis=0))
            children.append(())
    return Tree(np.array(centers, np.float64), tuple(children))


def _vectors(column: pa.Array | pa.ChunkedArray, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size).astype(np.float64)


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, count: int,
            bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the query, index of the row, distance) of each query's nearest rows but its own, ties to the smaller id.

    With `bounds` rows that are farther from a query than its bound are left out.

    A product of matrices finds what may be among them; distances are then taken from the differences themselves.
    """
    squares = (rows**2).sum(axis=1)
    found = []
    for low in range(0, len(queries), 256):
        part = queries[low:low + 256]
        own = (part**2).sum(axis=1)
        rough = own[:, None] + squares - 2 * part @ rows.T
        beyond = ~np.isfinite(rough).all(axis=1)  # squares too large for a double: every row is measured itself
        slack = 1e-9 * (own + squares.max(initial=0))
        rough[query_ids[low:low + 256, None] == row_ids] = np.inf
        least = min(count, len(rows)) - 1
        limit = np.partition(rough, least, axis=1)[:, least] + slack if least >= 0 else np.zeros(len(part))
        for at in range(len(part)):
            near = np.flatnonzero(((rough[at] <= limit[at]) | beyond[at]) & (row_ids != query_ids[low + at]))
            distance = np.sqrt(((rows[near] - part[at]) ** 2).sum(axis=1))
            best = np.lexsort((row_ids[near], distance))[:count]
            if bounds is not None:
                best = best[distance[best] <= bounds[low + at]]
            found.append((np.full(len(best), low + at), near[best], distance[best]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & whole & F.exists(vector, lambda x: x != 0)


@dataclass(frozen=True)
class Index:
    """All usable rows with their leaf: (leaf, place, vec_id, vector); `counts` has the rows of each leaf that has any."""

    tree: Tree
    rows: DataFrame
    counts: dict[int, int]
    size: int
    kind: str
    leaves: int  # how many a search visits


def build_index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = 10, recall: float = RECALL,
                leaf_rows: int = LEAF_ROWS) -> Index | None:
    """Fit the tree on a bounded sample, give every row its leaf, and measure how many leaves a search has to visit.

    Vectors that are null, empty, zero or hold a null, NaN or infinity, and rows without an id, take no part, nor do vectors of another
    length than the most frequent one. None if nothing is left. The sample are rows with small hashes of id and vector; the number of
    leaves is the least that finds the share `recall` of the exact `count` neighbours of `CALIBRATION` of them among all rows.
    """
    single = isinstance(vectors.schema[vector].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    usable = vectors.select(vectors[key].cast("long").alias("vec_id"), vectors[vector].cast("array<float>" if single else "array<double>").alias("v"))
    usable = usable.where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    sizes = usable.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return None
    size, rows = sizes["size"], sizes["count"]
    usable = usable.where(F.size("v") == size)
    most = min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * size))
    hashed = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 31))
    drawn = usable.where(hashed <= int(min(1.0, most / rows) * (1 << 31))).limit(2 * most).select("vec_id", "v").toArrow()
    sample = np.array(drawn.column("v").combine_chunks().flatten(), np.float64).reshape(-1, size)
    sample_ids = np.array(drawn.column("vec_id"), np.int64)
    order = np.lexsort((sample[:, 0], sample_ids))
    sample, sample_ids = sample[order], sample_ids[order]
    tree = fit_tree(sample, rows, leaf_rows)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            values = np.asarray(batch.column(1).flatten()).astype(kind).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([
                pa.array(tree.assign(values.astype(np.float64))), pa.array(np.arange(place, place + len(values))), batch.column(0),
                pa.array([one.tobytes() for one in values], pa.binary())], ["leaf", "place", "vec_id", "vector"])
            place += len(values)

    indexed = stored(usable.mapInArrow(placed, "leaf long, place long, vec_id long, vector binary"), "vectors")
    counts = {row["leaf"]: row["count"] for row in indexed.groupBy("leaf").count().collect()}
    tested = np.random.default_rng(11).permutation(len(sample))[:CALIBRATION]
    leaves = _calibrated(indexed, tree, sample[tested], sample_ids[tested], count, recall, size, kind)
    return Index(tree, indexed, counts, size, kind, leaves)


def _calibrated(indexed: DataFrame, tree: Tree, queries: np.ndarray, ids: np.ndarray, count: int, recall: float, size: int, kind: str) -> int:
    """The least number of leaves that holds so large a share of the exact neighbours of some queries, found among all rows."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_ids, leaves = np.asarray(batch.column("vec_id")), np.asarray(batch.column("leaf"))
            at, row, distance = nearest(queries, ids, _vectors(batch.column("vector"), kind, size), row_ids, count)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(row_ids[row]), pa.array(distance), pa.array(leaves[row])],
                                             ["query", "vec_id", "score", "leaf"])

    best = Window.partitionBy("query").orderBy("score", "vec_id")
    found = (indexed.select("leaf", "vec_id", "vector").mapInArrow(exact, "query long, vec_id long, score double, leaf long")
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count).select("query", "leaf").collect())
    distances = tree.distances(queries)
    order = [{leaf: at for at, leaf in enumerate(tree.visits(one), 1)} for one in distances]
    needed = sorted(order[row["query"]][row["leaf"]] for row in found)
    return needed[int(np.ceil(recall * len(needed))) - 1] if needed else 1


def search(index: Index, queries: DataFrame, count: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each of `queries` (vec_id, vector as in the index), nearest first.

    Distances are Euclidean, in double precision, ties go to the smaller id, rows with the query's own id are left out; rows that repeat an
    id are found as often as they are there. Every query visits `index.leaves` leaves, and more until they hold `count` others.

    Rows and queries meet by leaf, in blocks and chunks of bounded size: what is in a leaf with many rows or queries is dealt to many
    tasks, and leaves that no query visits aren't moved. The `FIRST` leaves of a query bound how far its neighbours can be; of the later
    ones only rows within that bound go on.
    """
    tree, counts, size, kind, leaves = index.tree, index.counts, index.size, index.kind, index.leaves

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                rows: list[tuple[int, bytes, int, int]] = []
                for id_, vector, distances in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                                  tree.distances(_vectors(part.column(1), kind, size))):
                    seen = 0
                    for number, leaf in enumerate(tree.visits(distances)):
                        if number >= leaves and seen > count:
                            break
                        if leaf in counts:
                            seen += counts[leaf]
                            rows.append((id_, vector, leaf, number))
                if rows:
                    ids, vectors, found, places = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(found, pa.int64()),
                                                      pa.array(places, pa.int64())], ["query_id", "query", "leaf", "place"])

    visits = stored(queries.select("vec_id", "vector").mapInArrow(visited, "query_id long, query binary, leaf long, place long"), "visits")
    spark = index.rows.sparkSession
    blocks = spark.createDataFrame([(leaf, -(-n // BLOCK)) for leaf, n in counts.items()], "leaf long, blocks long")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def numbers(total: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(total) - 1))

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, row_ids = np.asarray(left.column("query_id")), np.asarray(right.column("vec_id"))
        at, row, score = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) if not len(ids) or not len(row_ids) else nearest(
            _vectors(left.column("query"), kind, size), ids, _vectors(right.column("vector"), kind, size), row_ids, count,
            np.asarray(left.column("bound")))
        return pa.table({"query_id": ids[at], "vec_id": row_ids[row], "score": score})

    def met(some: DataFrame) -> DataFrame:
        # one row a leaf, and so bounded by the sample
        dealt = F.broadcast(stored(some.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks")).join(blocks, "leaf"), "leaves"))
        rows = (index.rows.join(dealt, "leaf").withColumn("block", F.pmod("place", F.col("blocks")))
                .select("leaf", "block", numbers("chunks").alias("chunk"), "vec_id", "vector"))
        asked = (some.join(dealt, "leaf").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")))
                 .select("leaf", numbers("blocks").alias("block"), "chunk", "query_id", "query", "bound"))
        keys = ("leaf", "block", "chunk")
        found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(compared, "query_id long, vec_id long, score double")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
        return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    near = stored(met(visits.where(F.col("place") < FIRST).withColumn("bound", F.lit(float("inf")))), "near")
    bounds = near.where(F.col("rank") == count).select("query_id", F.col("score").alias("bound"))
    later = visits.where(F.col("place") >= FIRST).join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    both = near.union(met(later)).drop("rank").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
    return both.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def neighbours(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", count: int = 10,
               recall: float = RECALL, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The `count` nearest other rows of every row for which `queries` holds, as `search` finds them in an index of all rows.

    Of query rows with one id the one with the smallest vector is searched. Other columns aren't read; an empty table gives no rows.
    """
    index = build_index(vectors, key, vector, count, recall, leaf_rows)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = index.rows.where(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return search(index, asked, count)
