"""Trie nodes against a dictionary of all prefixes, with crowded nodes, copies, ties, nulls and empty tables."""

import random
from hashlib import sha256

import pytest

from ramure.llm import queries
from ramure.llm.prefix_trie import digested, joined_digests, prefix_trie, trie


def brute(conversations):
    """{path: node facts} of {conv_id: [(role, text), ...]}."""
    members = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    found = {}
    for path, convs in members.items():
        below = [other for other in members if other[:len(path)] == path]
        children = [other for other in below if len(other) == len(path) + 1]
        leaves = [one for one in below if not any(len(o) == len(one) + 1 and o[:len(one)] == one for o in below)]
        saved = sum((len(members[one]) - 1) * len(one[-1][1]) for one in below if one)
        ends = sorted(c for c in convs if len(conversations[c]) == len(path))
        found[path] = (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children), len(leaves), saved,
                       sha256(",".join(map(str, ends)).encode()).hexdigest())
    return sorted(found.values(), key=str)


def nodes_of(nodes, ends):
    rows = nodes.join(joined_digests(ends, "node", "conv_id"), "node", "left").collect()
    empty = sha256(b"").hexdigest()
    return sorted([(r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                    r["digest"] or empty) for r in rows], key=str)


@pytest.mark.parametrize("group", [1, 3, 1_000])
def test_nodes_equal_brute_force_however_groups_are_split(spark, group):
    draw = random.Random(7)
    conversations = {conv: [(draw.choice("ua"), draw.choice(["x", "yy", "é"])) for _ in range(draw.choice([1, 2, 5, 9]))] for conv in range(40)}
    conversations |= {100 + n: conversations[3] for n in range(5)}          # copies
    conversations |= {200 + n: [("s", "same")] * 6 + [("u", str(n))] for n in range(8)}  # a long shared beginning
    conversations[2**60 + 1] = [("s", "same")] * 30
    conversations[-5] = [("s", "same")] * 3
    rows = [(conv, turn, role, text, "own") for conv, turns in conversations.items() for turn, (role, text) in enumerate(turns)]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    assert nodes_of(*prefix_trie(table, group=group)) == brute(conversations)


def test_nulls_repeats_and_turnless_conversations(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (None, 1, "user", "nobody's"), (2, 5, None, None), (2, 6, "user", ""),
            (3, 1, "user", "a"), (3, 1, "user", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = {1: [("", ""), ("user", "")], 2: [("", ""), ("user", "")], 3: [("user", "a"), ("user", "a")]}
    assert nodes_of(*prefix_trie(table)) == brute(expected)
    turnless = spark.createDataFrame([(1,), (2,), (3,), (9,)], "conv_id long")
    turns = digested(table).selectExpr("*", "0 AS part")
    assert nodes_of(*trie(turns, turnless)) == brute(expected | {9: []})
    assert nodes_of(*trie(turns.limit(0), turnless)) == brute({conv: [] for conv in (1, 2, 3, 9)})
    assert nodes_of(*prefix_trie(table.limit(0))) == []


def test_the_registered_query_rebuilds_conversations(spark, tmp_path):
    rows = [(conv, turn, "user" if turn % 2 == 0 else "assistant", f"{conv % 3}-{turn}") for conv in (100, 101, 150, 199, 205, 317) for turn in range(1 + conv % 9)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    from zlib import crc32
    own = {}
    for conv, _, role, text in rows:
        own.setdefault(conv, []).append((role, text))
    rebuilt = {conv: own.get(conv - conv % 100, [])[:crc32(str(conv).encode()) % 6] + turns[crc32(str(conv).encode()) % 6:] for conv, turns in own.items()}
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    found = sorted([tuple(r[n] for n in names) for r in queries.op11_prefix_trie(spark, str(tmp_path)).collect()], key=str)
    assert found == brute(rebuilt)
