"""Counts of word pieces by greedy longest match, in time linear in the text."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ramure.llm.common import slices

#: Words whose counts are kept in a worker; all are dropped when there are more.
KNOWN_WORDS = 300_000


class PieceAutomaton:
    """A trie of pieces with failure links that count the pieces popped on the way.

    `initial` pieces begin a word, `inner` ones continue it. A node stands for the longest part of the rest of the word that is read
    but not yet cut. When no edge fits, the failure link cuts the longest pieces off the front of the node's string; how many those
    are was counted when the automaton was built, so no piece is built while scanning.

    Nodes: 0 is the start of a word, 1 the start of the rest after a piece. A word that can't be cut counts as one unknown token.
    """

    def __init__(self, initial: Iterable[bytes], inner: Iterable[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]
        self.whole: list[bool] = [False, False]
        order: list[tuple[int, int, int]] = []
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    below = self.edges[node].get(byte)
                    if below is None:
                        below = self.edges[node][byte] = len(self.edges)
                        self.edges.append({})
                        self.whole.append(False)
                        order.append((node, byte, below))
                    node = below
                if piece:
                    self.whole[node] = True
        size = len(self.edges)
        self.fail, self.popped = [-1] * size, [0] * size
        depth = [0] * size
        for node, _, below in order:
            depth[below] = depth[node] + 1
        for node, byte, below in sorted(order, key=lambda edge: depth[edge[2]]):
            if self.whole[below]:
                self.fail[below], self.popped[below] = 1, 1
                continue
            at, count = self.fail[node], self.popped[node]
            while at >= 0 and byte not in self.edges[at]:
                count += self.popped[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[below], self.popped[below] = self.edges[at][byte], count
        #: Per node the pieces that what it holds is cut into at the end of a word; -1 if it can't be cut.
        self.ending = [self._ending(node) for node in range(size)]

    def _ending(self, node: int) -> int:
        count = 0
        while node > 1:
            if self.fail[node] < 0:
                return -1
            count += self.popped[node]
            node = self.fail[node]
        return count

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 for a word that can't be cut, 0 for the empty one."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = count = 0
        for byte in word:
            below = edges[node].get(byte)
            while below is None:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                below = edges[node].get(byte)
            node = below
        rest = self.ending[node]
        return 1 if rest < 0 else count + rest


def byte_level_pieces(path: str, space: str = "Ġ") -> tuple[list[bytes], list[bytes]]:
    """Pieces of a byte-level vocabulary file: those with the sign for a space begin a word, the others continue it.

    The sign itself is kept as a space at the front, so the bare sign is a piece too and every word can be cut.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(byte): byte for byte in printable}
    rest = [byte for byte in range(256) if byte not in printable]
    table.update((chr(256 + n), byte) for n, byte in enumerate(rest))
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    initial, inner = [], []
    for piece in vocabulary:
        if all(sign in table for sign in piece):
            (initial if piece.startswith(space) else inner).append(bytes(table[sign] for sign in piece))
    return initial, inner


class _Counts(dict):
    def __init__(self, automaton: PieceAutomaton, front: bytes):
        super().__init__()
        self.automaton, self.front = automaton, front

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        count = self[word] = self.automaton.count(self.front + word)
        return count


_MADE: dict[str, _Counts] = {}


def _counts(path: str) -> _Counts:
    if path not in _MADE:
        _MADE[path] = _Counts(PieceAutomaton(*byte_level_pieces(path)), b" ")
    return _MADE[path]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row the words of the whole text and the pieces that greedy longest match cuts them into.

    Words are runs of anything but ASCII white space. `vocabulary` is the path of a byte-level vocabulary file that every executor
    has. Null and blank texts have no words and no pieces; repeated rows are counted each; other columns are not read.
    Returns `key`, n_words, n_tokens, longest (pieces of the word with the most). One narrow stage, no shuffle.
    """
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in slices(batches, 1):
            rows = []
            for value in batch.column(1).to_pylist():
                words = value.encode().split() if value else ()
                pieces = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
                rows.append((len(words), int(pieces.sum()), int(pieces.max(initial=0))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(column, pa.int64()) for column in zip(*rows))],
                                             ["key", "n_words", "n_tokens", "longest"])

    kind = docs.schema[key].dataType.simpleString()
    return source.mapInArrow(counted, f"key {kind}, n_words long, n_tokens long, longest long").withColumnRenamed("key", key)
