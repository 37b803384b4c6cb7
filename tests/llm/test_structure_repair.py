"""Edits against a turn-by-turn search without matrices or grammar, ropes against strings, and awkward conversations."""

import random
import re
from hashlib import sha256

import pytest

from ramure.llm import queries
from ramure.llm.structure_repair import (
    INSERTIONS, Matrices, Rope, compressed, digests, learn_grammar, repair_structure, symbol, times,
)


def cheapest(turns):
    """(cost, audit, kept turns) by trying all edits turn by turn; turns are (role, text, fault)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def offered(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, kept) in list(ways.items()):
                for role in follow[state]:
                    if role in names:
                        offered(ways, role, (cost + 5, audit + "I", [*kept, (names[role], "")]))
        return ways

    ways = {"": (0, "", [])}
    for role, text, fault in turns:
        after = {}
        for state, (cost, audit, kept) in inserted(ways).items():
            offered(after, state, (cost + 2, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if role[:1] and role[:1] in follow[state]:
                offered(after, role[0], (cost + more, audit + "K", [*kept, (role, text)]))
            for other in follow[state]:
                if other in names:
                    offered(after, other, (cost + more + 1, audit + "R", [*kept, (names[other], text)]))
        ways = after
    inserted(ways)
    return min(ways[state] for state in ("", "a") if state in ways)


def faults_of(turns):
    seen, found = set(), []
    for role, text in turns:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def expected(turns):
    judged = faults_of([(role, text) for _, role, text in turns])
    cost, audit, kept = cheapest(judged)
    numbers = [turn for turn, _, _ in turns if turn is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [one[0][:1] + two[0][:1] for one, two in zip(judged, judged[1:])]
    count = [sum(fault == name for *_, fault in judged) for name in ("blank", "duplicate", "truncated")]
    digest = sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
    return gaps, *count, sum(pair not in ("su", "ua", "au") for pair in pairs), cost, audit, digest


def reported(spark, conversations, extra_ids=()):
    rows = [(conv, turn, role, text, "own") for conv, turns in conversations.items() for turn, role, text in turns]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, content string")
    ids = spark.createDataFrame([(conv,) for conv in (*conversations, *extra_ids)], "conv_id long")
    reports, turns = repair_structure(table, ids)
    found = reports.join(digests(turns), "conv_id", "left").collect()
    return {row["conv_id"]: (*(row[name] for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")),
                             row["digest"] or sha256(b"").hexdigest()) for row in found}


def test_edits_equal_a_search_without_matrices(spark):
    draw = random.Random(5)
    texts = ["One.", "Two!", "three", "", " \n", "four? ", "Five.\n", "six"]
    conversations = {}
    for conv in range(150):
        long = draw.choice([0, 1, 2, 5, 12])
        conversations[conv] = [(turn, draw.choice(["user", "assistant", "system", "tool", "", "User"]), draw.choice(texts) + (str(turn) if draw.random() < .4 else ""))
                               for turn in sorted(draw.sample(range(30), long))]
    conversations[2**60 + 3] = [(turn, draw.choice(["user", "assistant"]), f"{turn}{draw.choice(['.', ''])}") for turn in range(500)]
    found = reported(spark, conversations)
    assert found == {conv: expected(turns) for conv, turns in conversations.items()}


def test_awkward_rows(spark):
    found = reported(spark, {1: [(3, "assistant", "Yes."), (None, "user", "Hi.")], 4: [(None, "user", "Hi."), (None, "assistant", "Yes.")], 2: [(7, "user", "Hi."), (7, "user", "Hi.")],
                             3: [(4, "assistant", "A " * 50_000 + "end.")]}, extra_ids=(9,))
    assert found[1][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert found[4][:7] == (0, 0, 0, 0, 0, 2, "RR")  # a tie goes by role
    assert found[2][:7] == (0, 0, 1, 0, 1, 4, "DD")
    assert found[3][:7] == (0, 0, 0, 0, 0, 2, "D")
    assert found[9] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    reports, turns = repair_structure(empty)
    assert reports.count() == turns.count() == 0
    nulls = spark.createDataFrame([(None, 1, "user", "x"), (1, 1, None, None), (1, 2, "user", None)], empty.schema)
    reports, turns = repair_structure(nulls)
    assert [tuple(row) for row in reports.collect()] == [(1, 0, 2, 0, 0, 1, 4, "DD")] and turns.count() == 0


def test_grammar_expands_to_the_sequences_and_gives_equal_matrices(spark):
    draw = random.Random(3)
    sequences = [bytes(draw.choices(range(9), k=draw.choice([0, 1, 3, 40]))) for _ in range(60)] + [bytes([3]) * 101, bytes([3, 5]) * 50]
    rounds = learn_grammar(spark.createDataFrame([(one,) for one in sequences], "symbols binary"))
    rules = {new: (a, b) for some in rounds for a, b, new in some}
    assert len(rules) > 20 and len(rounds) > 2

    def expanded(number):
        return [number] if number < 9 else [one for side in rules[number] for one in expanded(side)]

    shorter = compressed(sequences, rounds)
    assert [[one for number in some for one in expanded(int(number))] for some in shorter] == [list(one) for one in sequences]
    assert len(shorter[-2]) < 10
    with_rules, without = Matrices(rounds), Matrices([])
    for one, some in zip(sequences, shorter):
        assert with_rules.repair(some.tolist()) == without.repair(one)


def test_ropes_order_as_strings():
    draw = random.Random(1)
    for _ in range(300):
        texts = []
        ropes = []
        for _ in range(2):
            parts = ["".join(draw.choices("DIK", k=draw.choice([0, 1, 5, 30]))) for _ in range(draw.choice([1, 4]))]
            texts.append("".join(parts))
            rope = Rope("")
            for part in parts:
                rope = rope + Rope(part)
            ropes.append(rope)
        assert [str(one) for one in ropes] == texts
        assert (ropes[0] < ropes[1]) == (texts[0] < texts[1])
    shared = Rope("KD" * 8)
    for _ in range(40):
        shared = shared + shared  # 2 ** 44 characters
    assert shared + Rope("D") < shared + Rope("K") and not shared + Rope("K") < shared + Rope("D")


def test_products_are_associative():
    one, two, three = (Matrices([])[number] for number in (symbol("u", False, True), symbol("a", False, False), symbol("", True, False)))
    left, right = times(times(one, two), three), times(one, times(two, three))
    plain = lambda matrix: [[entry and (entry[0], str(entry[1])) for entry in row] for row in matrix]
    assert plain(left) == plain(right)
    assert plain(times(INSERTIONS, INSERTIONS)) == plain(INSERTIONS)


@pytest.mark.parametrize("fate", [0, 1, 2, 3, 4])
def test_the_registered_query_damages_by_hash(spark, tmp_path, fate):
    from zlib import crc32

    rows = [(conv, turn, "assistant" if turn % 2 else "user", f"No {turn}. Yes! {conv}.") for conv in range(40) for turn in range(6)]
    rows = [row for row in rows if crc32(f"{row[0]}:{row[1]}".encode()) % 20 in (fate, 9, 10)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    damaged = {}
    for conv, turn, role, text in rows:
        turns = damaged.setdefault(conv, [])
        drawn = crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        turns += [(turn, "user" if drawn == 4 else role, text)] * (0 if drawn == 0 else 2 if drawn == 3 else 1)
    found = {row["conv_id"]: (row["gaps"], row["blank"], row["duplicate"], row["truncated"], row["illegal"], row["cost"], row["audit"], row["repaired_sha256"])
             for row in queries.op13_structure_repair(spark, str(tmp_path)).collect()}
    assert found == {conv: expected(turns) for conv, turns in damaged.items()}
