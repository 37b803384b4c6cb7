"""Secrets in whole texts: all rules in one minimised automaton, spans by each rule's own automaton where it fired."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Secrets of a kind: a match is `head` and one or more of `body`, as long as can be; with fewer than `least` of `body` it is dropped."""

    kind: str
    head: str
    body: str
    least: int


# The base kinds, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                   r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 6),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
)
# Published prefixes of further credentials.
MORE_RULES = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 16),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", r"[A-Za-z0-9+/=\x0A\x0D]", 16),
)
RULES = BASE_RULES + MORE_RULES


class _Nfa:
    """Thompson's construction for the part of regular expressions that rules use: classes, escapes, groups, | and ? * + {n} {n,m}."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.edge: list[tuple[frozenset[int], int] | None] = []

    def node(self) -> int:
        self.empty.append([])
        self.edge.append(None)
        return len(self.empty) - 1

    def add(self, tree: tuple) -> tuple[int, int]:
        kind = tree[0]
        start, end = self.node(), self.node()
        if kind == "bytes":
            self.edge[start] = (tree[1], end)
        elif kind == "all":
            at = start
            for part in tree[1]:
                first, last = self.add(part)
                self.empty[at].append(first)
                at = last
            self.empty[at].append(end)
        elif kind == "any":
            for part in tree[1]:
                first, last = self.add(part)
                self.empty[start].append(first)
                self.empty[last].append(end)
        else:  # repeat
            _, part, least, most = tree
            at = start
            for _ in range(least):
                first, last = self.add(part)
                self.empty[at].append(first)
                at = last
            if most is None:
                first, last = self.add(part)
                self.empty[at] += [first, end]
                self.empty[last] += [first, end]
            else:
                for _ in range(most - least):
                    first, last = self.add(part)
                    self.empty[at] += [first, end]
                    at = last
                self.empty[at].append(end)
        return start, end

    def closed(self, nodes: set[int]) -> frozenset[int]:
        found, todo = set(nodes), list(nodes)
        while todo:
            for after in self.empty[todo.pop()]:
                if after not in found:
                    found.add(after)
                    todo.append(after)
        return frozenset(found)


def parse(pattern: str) -> tuple:
    """The tree of a pattern over bytes."""
    at = 0

    def escape() -> int:
        nonlocal at
        at += 1
        if pattern[at] == "x":
            at += 3
            return int(pattern[at - 2:at], 16)
        at += 1
        return ord(pattern[at - 1])

    def symbol() -> int:
        nonlocal at
        if pattern[at] == "\\":
            return escape()
        at += 1
        return ord(pattern[at - 1])

    def one() -> tuple:
        nonlocal at
        if pattern[at] == "(":
            at += 1
            tree = choice()
            at += 1
            return tree
        if pattern[at] != "[":
            return ("bytes", frozenset({symbol()}))
        at += 1
        negated = pattern[at] == "^"
        at += negated
        inside: set[int] = set()
        while pattern[at] != "]":
            low = symbol()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                inside.update(range(low, symbol() + 1))
            else:
                inside.add(low)
        at += 1
        return ("bytes", frozenset(set(range(256)) - inside if negated else inside))

    def repeated() -> tuple:
        nonlocal at
        tree = one()
        while at < len(pattern) and pattern[at] in "?*+{":
            sign = pattern[at]
            if sign == "{":
                close = pattern.index("}", at)
                low, comma, high = pattern[at + 1:close].partition(",")
                bounds = (int(low), int(high) if high else None if comma else int(low))
                at = close
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            at += 1
            tree = ("repeat", tree, *bounds)
        return tree

    def choice() -> tuple:
        nonlocal at
        options = []
        while True:
            parts = []
            while at < len(pattern) and pattern[at] not in "|)":
                parts.append(repeated())
            options.append(("all", parts))
            if at >= len(pattern) or pattern[at] == ")":
                return ("any", options)
            at += 1

    tree = choice()
    if at < len(pattern):
        raise ValueError(f"{pattern!r} can't be read from {at} on")
    return tree


@dataclass(frozen=True)
class Automaton:
    """A minimal deterministic automaton: `moves[state, byte]`, `fired[state]` (bit k: pattern k ends here), start 0."""

    moves: np.ndarray
    fired: np.ndarray

    def rows(self) -> list:
        """The arrays as linked rows: entry `byte` of a row is the next row, entry 256 what has fired."""
        rows: list[list] = [[] for _ in range(len(self.moves))]
        for row, moves, fired in zip(rows, self.moves.tolist(), self.fired.tolist()):
            row += [rows[state] for state in moves]
            row.append(fired)
        return rows[0]


def compiled(patterns: tuple[str, ...], anywhere: bool) -> Automaton:
    """Subset construction of all patterns together, then minimisation; `anywhere` lets matches begin at every byte."""
    nfa = _Nfa()
    spans = [nfa.add(parse(pattern)) for pattern in patterns]
    begin = nfa.closed({first for first, _ in spans})
    ends = {last: 1 << k for k, (_, last) in enumerate(spans)}
    number = {begin: 0}
    todo, moves, fired = [begin], [], []
    while todo:
        nodes = todo.pop(0)
        fired.append(sum({ends[node] for node in nodes if node in ends}))
        reached: list[set[int]] = [set() for _ in range(256)]
        for node in nodes:
            if nfa.edge[node]:
                inside, after = nfa.edge[node]
                for byte in inside:
                    reached[byte].add(after)
        row, seen = [], {}
        for targets in reached:
            small = frozenset(targets)
            if small not in seen:
                after = nfa.closed(targets) | (begin if anywhere else frozenset())
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                seen[small] = number[after]
            row.append(seen[small])
        moves.append(row)
    return minimised(np.array(moves, np.int32), np.array(fired, np.int64))


def minimised(moves: np.ndarray, fired: np.ndarray) -> Automaton:
    """Merge states that no continuation tells apart, by refining the partition until it is stable."""
    block = np.unique(fired, return_inverse=True)[1].ravel()
    while True:
        refined = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    _, first = np.unique(block, return_index=True)
    by_place = np.argsort(np.where(np.arange(len(first)) == block[0], -1, first))  # the start becomes state 0
    order, place = np.argsort(by_place), first[by_place]
    return Automaton(order[block[moves[place]]].astype(np.int32), fired[place])


class _Spans:
    """Leftmost matches of one rule, found again only in texts where the rule has fired."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.match = compiled((rule.head + rule.body + "+",), anywhere=False)
        self.head = compiled((rule.head,), anywhere=False).rows() if rule.head else None
        dead = self._dead(self.match)
        self.first = self.match.moves[0] != dead
        self.start = self.match.rows()

    @staticmethod
    def _dead(automaton: Automaton) -> int:
        stuck = (automaton.moves == np.arange(len(automaton.moves))[:, None]).all(axis=1) & (automaton.fired == 0)
        return int(np.flatnonzero(stuck)[0]) if stuck.any() else -1

    @staticmethod
    def longest(row: list, data: bytes, at: int) -> int:
        """End of the longest match from `at`, -1 for none."""
        end = at if row[256] else -1
        for byte in memoryview(data)[at:]:
            after = row[byte]
            if after[256]:
                end = at + 1
            elif after[byte] is after and after[0] is after and after[255] is after:
                break
            row, at = after, at + 1
        return end

    def __call__(self, data: bytes) -> Iterator[tuple[int, int]]:
        starts = np.flatnonzero(self.first[np.frombuffer(data, np.uint8)])
        done = 0
        for start in starts.tolist():
            if start < done:
                continue
            end = self.longest(self.start, data, start)
            if end < 0:
                continue
            done = end
            head = self.longest(self.head, data, start) if self.head else start
            if end - head >= self.rule.least:
                yield start, end


class Scanner:
    """Finds the spans of all rules in a text, reading every byte once."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        # a rule fires on its head and the first of its body; without a head the body must be long enough
        fires = tuple(rule.head + rule.body if rule.head else f"{rule.body}{{{rule.least}}}" for rule in rules)
        self.automaton = compiled(fires, anywhere=True)
        self.start = self.automaton.rows()
        self.spans = [_Spans(rule) for rule in rules]

    def fired(self, data: bytes) -> int:
        """Bits of the rules that fire anywhere, in one pass of the combined automaton."""
        row, found = self.start, 0
        for byte in data:
            row = row[byte]
            if row[256]:
                found |= row[256]
        return found

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, in order."""
        data = text.encode()
        fired = self.fired(data)
        found = [(start, k, end) for k, spans in enumerate(self.spans) if fired >> k & 1 for start, end in spans(data)]
        found.sort()
        if found and len(data) != len(text):
            edges = sorted({edge for start, _, end in found for edge in (start, end)})
            place, last, count = {}, 0, 0
            for edge in edges:
                count += len(data[last:edge].decode())
                place[edge] = count
                last = edge
            found = [(place[start], k, place[end]) for start, k, end in found]
        return found


@cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`docs` with a column `secrets`: an array of (kind, start, end) in code points, end exclusive, by start and then rule.

    Of one kind spans are the leftmost ones that don't overlap; matches too short are dropped after they have been taken, so nothing
    inside them counts. Null texts are read as empty and have no secrets; an existing column `secrets` is replaced, all others stay.
    One narrow stage: texts go to Python in batches and only spans come back.
    """
    kinds = [rule.kind for rule in rules]

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner(rules)
        for batch in texts:
            yield pd.Series([[{"kind": kinds[k], "start": start, "end": end} for start, k, end in scan(value or "")]
                             for value in batch], dtype=object)

    return docs.withColumn("secrets", spans(docs[text]))


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret replaced by `mark`; overlapping spans are one. Texts without secrets, null ones too, stay as they are."""

    @F.pandas_udf("string")
    def redacted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner(rules)
        for batch in texts:
            yield pd.Series([value if value is None else _without(value, scan(value), mark) for value in batch], dtype=object)

    return docs.withColumn(text, redacted(docs[text]))


def _without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, done = [], 0
    for start, _, end in spans:
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])
