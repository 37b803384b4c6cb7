import random
from collections import Counter

import numpy as np
import pytest

from ramure.llm.common import components
from ramure.llm.near_dedup import Similarity, _alike, _joining, deduplicate, link_documents, shared_counts, shingle_set, signature


def shingles(text, size):
    words = (text or "").lower().encode().split()
    if not words:
        return set()
    return {tuple(words[at:at + size]) for at in range(max(1, len(words) - size + 1))}


def brute(rows, size, percent):
    """Sizes and components by comparing all sets."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    low = {}
    for n, (doc_id, _) in enumerate(rows):
        known = low.get(root(n))
        low[root(n)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return Counter((doc_id, len(sets[n]), low[root(n)], doc_id == low[root(n)]) for n, (doc_id, _) in enumerate(rows))


def found(docs, similarity):
    return Counter(tuple(row) for row in link_documents(docs, similarity).select("doc_id", "n_shingles", "component_id", "kept").collect())


def variants(seed, groups, copies, length, edits):
    """Groups of texts that each differ from a common one in a few words, so that some pairs of a group are just not alike enough."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{rng.randrange(10_000)}" for _ in range(length)]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(length)] = f"v{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("similarity, edits", [(Similarity(3, 85), 5), (Similarity(5, 80), 4)])
def test_components_equal_brute_force(make_docs, similarity, edits):
    rows = variants(1, 6, 30, 120, edits)
    links = brute(rows, similarity.shingle, similarity.percent)
    components_found = {component for _, _, component, _ in links}
    assert 6 < len(components_found) < 150  # groups fall apart, in part
    assert found(make_docs(rows), similarity) == links


def test_a_large_group_of_copies_and_near_copies(make_docs):
    rows = variants(2, 1, 400, 200, 6) + [(1000 + n, "exactly the same words in every one of these texts") for n in range(300)]
    assert found(make_docs(rows), Similarity(3, 85)) == brute(rows, 3, 85)


def test_awkward_rows(awkward):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    assert found(awkward, Similarity()) == brute(rows, 5, 80)
    kept = sorted((row["doc_id"] or 0) for row in deduplicate(awkward).collect())
    assert kept == [0, 1, 2, 3, 4, 5, 7, 8, 10]
    assert deduplicate(awkward).columns == awkward.columns
    assert deduplicate(awkward.limit(0)).count() == 0 and link_documents(awkward.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    left, right = (np.array(sorted(part), np.uint64) for part in (range(0, 900), range(100, 1000)))
    one, other = (signature(shingle_set(part * np.uint64(2654435761), 1), 400) for part in (left, right))
    assert abs((one == other).mean() - 0.8) < 0.08


def test_pruning_keeps_what_may_be_alike():
    similarity = Similarity(3, 85)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**32, (20_000, similarity.values), dtype=np.uint64).astype("<u4")
    for share, least, most in ((0.85, 0.9999, 1.0), (0.95, 1.0, 1.0), (0.5, 0.0, 0.1)):
        other = np.where(rng.random(base.shape) < share, base, base + np.uint32(1))
        assert least <= len(_alike(base, other, similarity.steps())) / len(base) <= most


def test_shared_counts_and_joining_links():
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(0, 12_000, rng.integers(0, 400)).astype(np.uint64)) for _ in range(n)] for n in (7, 9))
    assert shared_counts(left, right).tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert shared_counts([left[0]], [np.zeros(0, np.uint64)]).tolist() == [[0]]
    same = np.arange(50, dtype=np.uint64).tobytes()
    fewer = [{"node": bytes([n]), "component": bytes([n]), "shingles": same} for n in (1, 2)]
    more = [{"node": bytes([n]), "component": b"big", "shingles": same} for n in range(10, 40)]
    assert len(_joining(fewer, more, 85)) == 2  # of sixty links


def test_components_of_a_path_and_a_star(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 100 + n) for n in range(1, 60)] + [(300, 301), (300, 301), (302, 301)]
    labels = {row["id"]: row["component"] for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {n: 0 for n in range(41)} | {100 + n: 100 for n in range(60)} | {300: 300, 301: 300, 302: 300}


def test_texts_that_are_not_needed_are_left_where_they_are(spark):
    """All rows whose hash is looked for get through the map of bits, however few bits it has, and hardly any others."""
    from pyspark.sql import functions as F

    from ramure.llm import near_dedup

    rows = spark.range(20_000).withColumn("hash", F.xxhash64("id"))
    wanted = rows.where("id % 100 = 0").select("hash")
    found = {row["id"] for row in near_dedup.likely(rows.select("id"), F.xxhash64("id"), wanted).collect()}
    assert set(range(0, 20_000, 100)) <= found and len(found) < 1_500
    assert near_dedup.likely(rows.select("id"), F.xxhash64("id"), wanted.limit(0)).count() == 0


def test_links_found_later_join_components(spark):
    from ramure.llm.near_dedup import _Graph

    graph = object.__new__(_Graph)
    graph.labels = None
    for links in ([(b"a", b"b"), (b"c", b"d")], [], [(b"d", b"b"), (b"e", b"f"), (b"g", b"b")]):
        graph.join(spark.createDataFrame(links, "a binary, b binary"))
    found = {bytes(row["id"]): bytes(row["component"]) for row in graph.labels.collect()}
    assert found == {b"a": b"a", b"b": b"a", b"c": b"a", b"d": b"a", b"g": b"a", b"e": b"e", b"f": b"e"}


def test_small_tables_are_few_files_however_many_partitions_there_are(spark):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        labels = components(spark.createDataFrame([(n, n + 1) for n in range(0, 400, 2)], "a long, b long"))
        assert len(labels.inputFiles()) == 1
        assert {(row["id"], row["component"]) for row in labels.collect()} == {(n, n - n % 2) for n in range(400)}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_all_stars_are_drawn_in_one_round(make_docs, monkeypatch):
    from ramure.llm import near_dedup

    rounds, test = [], near_dedup._Graph.test

    def counted(self, *pairs):
        rounds.append(pairs)
        test(self, *pairs)

    monkeypatch.setattr(near_dedup._Graph, "test", counted)
    rows = variants(1, 3, 30, 120, 5)
    assert found(make_docs(rows), Similarity(3, 85)) == brute(rows, 3, 85)
    assert len(rounds) == 2


def test_texts_that_stay_are_not_joined_and_no_table_is_left_that_nothing_reads(make_docs, monkeypatch, tmp_path):
    """Rows marked, repeated, without a key and without a text are told apart as before."""
    from pathlib import Path

    from ramure.llm import common

    monkeypatch.setattr(common, "shared_folder", lambda spark, purpose: f"file://{tmp_path}/{purpose}-{common.uuid.uuid4().hex}")
    rows = [(n, f"text number {n} has words of its own, {n * n} of them and {n + 7} more") for n in range(60)]
    rows += [(100, rows[3][1]), (101, rows[4][1]), (101, "another text of the same key"), (5, rows[5][1]), (None, rows[6][1]), (None, "no key here"), (7, None), (7, None)]
    kept = deduplicate(make_docs(rows))
    expected = [(doc_id, text) for doc_id, text in dict.fromkeys(rows) if (doc_id, text) not in ((100, rows[3][1]), (101, rows[4][1]), (None, rows[6][1]))]
    assert sorted(map(str, ((row["doc_id"], row["text"]) for row in kept.collect()))) == sorted(map(str, expected))
    assert "LeftAnti" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert {folder.name.rpartition("-")[0] for folder in Path(tmp_path).iterdir()} == {"marks"}


def test_rows_are_either_likely_or_unlikely(spark):
    from pyspark.sql import functions as F

    from ramure.llm import near_dedup

    rows = spark.range(5_000).withColumn("hash", F.xxhash64("id"))
    wanted = rows.where("id % 50 = 0").select("hash")
    parts = [{row["id"] for row in part(rows.select("id"), F.xxhash64("id"), wanted).collect()} for part in (near_dedup.likely, near_dedup.unlikely)]
    assert not parts[0] & parts[1] and parts[0] | parts[1] == set(range(5_000))
    assert not parts[1] & set(range(0, 5_000, 50))
    assert near_dedup.unlikely(rows.select("id"), F.xxhash64("id"), wanted.limit(0)).count() == 5_000
