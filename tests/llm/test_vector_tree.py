"""Neighbours against brute force: recall over clusters, whole results in small and awkward tables, copies, and blocks that are split."""

import numpy as np
import pytest

from ramure.llm import queries, vector_tree
from ramure.llm.common import table
from ramure.llm.vector_tree import build_index, fit_tree, nearest, neighbours


def brute(ids, vectors, asked, count=10):
    found = {}
    for at in np.flatnonzero(asked(ids)):
        distance = np.sqrt(((vectors - vectors[at]) ** 2).sum(axis=1))
        order = [row for row in np.lexsort((ids, distance)) if ids[row] != ids[at]][:count]
        found[int(ids[at])] = [(int(ids[row]), distance[row]) for row in order]
    return found


def grouped(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        rows = found.setdefault(row["query_id"], [])
        rows.append((row["vec_id"], row["score"]))
        assert row["rank"] == len(rows)
    return found


def test_recall_of_the_registered_query_on_all_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding").toArrow()
    ids, vectors = np.array(rows["vec_id"]), np.array(rows["embedding"].combine_chunks().flatten(), np.float64).reshape(len(rows), -1)
    exact, found = brute(ids, vectors, lambda i: i % 100 == 0), grouped(queries.op12_vector_tree(spark, folder))
    assert found.keys() == exact.keys() and all(len(one) == 10 for one in found.values())
    hits = [len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact]
    assert sum(hits) / (10 * len(hits)) >= 0.9
    for q, rows in found.items():
        assert [score for _, score in rows] == sorted(score for _, score in rows)
        at = {int(i): n for n, i in enumerate(ids)}
        np.testing.assert_allclose([s for _, s in rows], [np.linalg.norm(vectors[at[i]] - vectors[at[q]]) for i, _ in rows], rtol=1e-12)


def test_fewer_leaves_than_all_are_visited_and_recall_is_as_measured(spark):
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(40, 16)) * 4
    vectors = (centers[draw.integers(0, 40, 8000)] + draw.normal(size=(8000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    index = build_index(df)
    assert 1 <= index.leaves < len(index.tree.leaves) / 2 and sum(index.counts.values()) == 8000
    exact = brute(np.arange(8000), vectors.astype(np.float64), lambda i: i % 50 == 0)
    found = grouped(neighbours(df, vector_tree.F.col("vec_id") % 50 == 0))
    assert sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact) / (10 * len(exact)) >= 0.9


@pytest.mark.parametrize("sizes", [(16_384, 4_096), (7, 2)])
def test_copies_and_split_leaves_give_whole_results(spark, monkeypatch, sizes):
    monkeypatch.setattr(vector_tree, "BLOCK", sizes[0])
    monkeypatch.setattr(vector_tree, "CHUNK", sizes[1])
    draw = np.random.default_rng(5)
    vectors = np.concatenate([np.tile([1.0, 2.0, 3.0], (60, 1)), draw.normal(size=(60, 3))])
    ids = draw.permutation(120) + 2**60
    df = spark.createDataFrame([(int(i), v.tolist(), "own", 1) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, leaf string, rank int")
    found = grouped(neighbours(df, vector_tree.F.col("vec_id") % 3 == 0, recall=1.0, leaf_rows=20))
    exact = brute(ids, vectors, lambda i: i % 3 == 0)
    copies = {int(i) for i in ids[:60]}
    for q in exact:
        if q in copies:  # the smallest ids of equal vectors
            assert found[q] == exact[q]
    assert sum(found[q] == exact[q] for q in exact) >= 0.9 * len(exact)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, None), (7, []), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]),
            (100, [2.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (9, [None, 1.0]), (200, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = vector_tree.F.col("vec_id") % 100 == 0
    assert grouped(neighbours(df, asked)) == {0: [(1, 1.0), (1, 1.0), (100, 1.0)], 100: [(0, 1.0), (1, 2**.5), (1, 2**.5)]}
    assert neighbours(df.limit(0), asked).collect() == []
    assert neighbours(df.where("vec_id = 0"), asked).collect() == []
    huge = spark.createDataFrame([(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert grouped(neighbours(huge, asked))[0] == [(1, 1.0), (2, inf)]


def test_tree_and_exact_search():
    draw = np.random.default_rng(1)
    points = draw.normal(size=(500, 8))
    tree = fit_tree(points, 5000, leaf_rows=100)
    leaves = tree.assign(points)
    assert set(leaves) <= set(tree.leaves) and 20 < len(tree.leaves) < 120
    for row, distances in zip(points[:20], tree.distances(points[:20])):
        assert sorted(tree.visits(distances)) == sorted(tree.leaves)
        assert next(tree.visits(distances)) == tree.assign(row[None])[0]
    assert fit_tree(np.ones((300, 4)), 300, leaf_rows=10).leaves == [0]
    at, row, score = nearest(points[:3], np.arange(3), points, np.arange(500), 5)
    exact = brute(np.arange(500), points, lambda i: i < 3, 5)
    assert [(int(i), s) for i, s in zip(row, score)] == [pair for q in range(3) for pair in exact[q]]
