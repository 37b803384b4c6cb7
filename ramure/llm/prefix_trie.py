"""The trie of conversations that begin alike, built by peeling: from the deepest turn up, the last turn is stripped and nodes regrouped."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ramure.llm.common import stored

#: Conversations below one node that a task peels by itself; nodes with more are split at deeper turns.
GROUP = 1_000
#: Name of the root; a node's name is a 128-bit hash of its parent's and of its last turn.
ROOT = bytes(16)
#: Characters of one piece of a list that is hashed in order.
PIECE = 64_000

_CHAIN = "conv_id long, depth long, node binary, parent binary, size long, last boolean"
_PEELED = ("node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
           "saved_tokens long, path array<binary>, sizes array<long>")


def digested(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, content, size): a 128-bit hash of role and text, and the text's code points; null ones are read as empty.

    Rows without a conversation's id belong to none and are left out.
    """
    role_, text_ = F.coalesce(turns[role].cast("string"), F.lit("")), F.coalesce(turns[text].cast("string"), F.lit(""))
    content = F.unhex(F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)))
    return turns.where(turns[conv].isNotNull()).select(
        turns[conv].cast("long").alias("conv_id"), turns[turn].cast("long").alias("turn"), content.alias("content"),
        F.length(text_).cast("long").alias("size"))


def share_starts(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Rebuild conversations so that they begin alike: (conv_id, part, turn, content, size) from `digested` turns.

    Conversation c takes the first h turns of c - c % every, h = crc32(c) % most, and then its own after its first h.
    """
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "content")
    numbered = stored(turns.withColumn("turn", F.row_number().over(order).cast("long")), "turns")
    shared = F.crc32(F.col("conv_id").cast("string")) % most
    first = F.col("conv_id") - F.col("conv_id") % every
    starts = (numbered.where((F.col("conv_id") == first) & (F.col("turn") < most))
              .select(F.col("conv_id").alias("first"), "turn", "content", "size"))
    ids = numbered.select("conv_id").distinct().select("conv_id", first.alias("first"), shared.alias("h"))
    begun = ids.join(starts, "first").where("turn <= h").select("conv_id", F.lit(0).alias("part"), "turn", "content", "size")
    own = numbered.where(F.col("turn") > shared).select("conv_id", F.lit(1).alias("part"), "turn", "content", "size")
    return begun.union(own)


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, one.type) for column, one in zip(zip(*rows), schema)], schema=schema)


_CHAIN_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                          ("size", pa.int64()), ("last", pa.bool_())])
_PEELED_ARROW = pa.schema([("node", pa.binary()), ("parent", pa.binary()),
                           *((name, pa.int64()) for name in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
                           ("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name the node of every turn; each conversation begins with a row without content, and its deepest row is marked."""
    from xxhash import xxh3_128_digest

    held: tuple | None = None
    for batch in batches:
        rows = []
        for conv, content, size in _columns(batch):
            if content is None:
                if held:
                    rows.append((*held, True))
                held = (conv, 0, ROOT, None, 0)
            else:
                if held[1]:
                    rows.append((*held, False))
                held = (conv, held[1] + 1, xxh3_128_digest(held[2] + content), held[2], size)
        if rows:
            yield _batch(rows, _CHAIN_ARROW)
    if held:
        yield _batch([(*held, True)], _CHAIN_ARROW)


def chain(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, size, last): a row for every turn; for a conversation without turns one of depth 0.

    The turns of a conversation stream through one task in order, a batch at a time.
    """
    begins = conversations.select("conv_id", F.lit(-1).alias("part"), F.lit(None).cast("long").alias("turn"),
                                  F.lit(None).cast("binary").alias("content"), F.lit(0).cast("long").alias("size"))
    ordered = (turns.select("conv_id", "part", "turn", "content", "size").union(begins).repartition("conv_id")
               .sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "content"))
    return ordered.select("conv_id", "content", "size").mapInArrow(_chained, _CHAIN)


@dataclass
class _Node:
    conv_id: int
    size: int
    parent: bytes | None
    n_convs: int = 0
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    children: list[tuple[bytes, "_Node"]] = field(default_factory=list)


class _Peel:
    """One group: conversations that share their first `k` turns, met from the deepest turn up.

    `alive` are the nodes of the depth at hand by name, `below` those of the depth under it by their smallest member: a member's row at
    this depth tells where its node goes when the last turn is stripped. Only two depths are held.
    """

    def __init__(self, k: int, rows: list[tuple]):
        self.k, self.rows, self.depth = k, rows, None
        self.alive: dict[bytes, _Node] = {}
        self.below: dict[int, tuple[bytes, _Node]] = {}
        self.path: list[bytes] = []
        self.sizes: list[int] = []

    def add(self, depth: int, node: bytes, parent: bytes, conv: int, size: int, ended: int) -> None:
        if depth != self.depth:
            self.close()
            self.depth = depth
        if depth < self.k:  # above the group's own node only the way of its smallest member counts
            if conv == self.top.conv_id:
                self.path.append(parent)
                self.sizes.append(size)
            return
        child = self.below.pop(conv, None)
        if child is None and not ended:
            return
        found = self.alive.get(node)
        if found is None:
            found = self.alive[node] = _Node(conv, size, parent)
        found.conv_id = min(found.conv_id, conv)
        if child is None:
            found.n_convs += ended
        else:
            name, one = child
            found.n_convs += one.n_convs
            found.n_children += 1
            found.n_leaves += one.n_leaves
            found.saved += one.saved
            found.children.append((name, one))

    def close(self) -> None:
        """The nodes of this depth are whole: their children go out, and they wait to be stripped."""
        if self.depth is None or self.depth < self.k:
            return
        for name, one in self.alive.items():
            for child, below in one.children:
                self.rows.append((child, below.parent, self.depth + 1, below.conv_id, one.conv_id, below.n_convs, below.n_children,
                                  below.n_leaves, below.saved, None, None))
            one.children = []
            if self.depth > self.k:
                one.n_leaves = one.n_leaves or 1
                one.saved += (one.n_convs - 1) * one.size
                self.below[one.conv_id] = (name, one)
            else:
                self.name, self.top = name, one
                self.path, self.sizes = [one.parent], [one.size]
        self.alive = {}

    def end(self) -> None:
        self.close()
        one = self.top
        self.rows.append((self.name, one.parent, self.k, one.conv_id, None, one.n_convs, one.n_children, one.n_leaves, one.saved,
                          self.path, self.sizes))


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    at, peel = None, None
    for batch in batches:
        for group, k, depth, node, parent, conv, size, ended in _columns(batch):
            if (group, k) != at:
                if peel:
                    peel.end()
                at, peel = (group, k), _Peel(k, rows)
            peel.add(depth, node, parent, conv, size, ended)
        if rows:
            yield _batch(rows, _PEELED_ARROW)
            rows.clear()
    if peel:
        peel.end()
        yield _batch(rows, _PEELED_ARROW)


def _routes(rows: DataFrame, ends: DataFrame, group: int) -> list[DataFrame]:
    """(conv_id, grp, k): the depth at which each conversation is handed to a task, so that none gets more than `group` of them.

    Depths double while a node still has too many; a conversation that ends above goes with its own last node.
    """
    found = []
    waiting, k = ends.where("turns > 0").select("conv_id", "turns", "node"), 1
    while True:
        ended = waiting.where(F.col("turns") < k).select("conv_id", F.col("node").alias("grp"), F.col("turns").alias("k"))
        here = rows.where(F.col("depth") == k).select("conv_id", F.col("node").alias("grp"))
        placed = stored(waiting.join(here, "conv_id").select("conv_id", "turns", "node", "grp"), "placed")
        crowded = stored(placed.groupBy("grp").count().where(F.col("count") > group).select("grp"), "crowded")
        found += [ended, placed.join(crowded, "grp", "left_anti").select("conv_id", "grp", F.lit(k).cast("long").alias("k"))]
        if crowded.isEmpty():
            return found
        waiting, k = placed.join(crowded, "grp", "left_semi").select("conv_id", "turns", "node"), 2 * k


def _merged(survivors: DataFrame) -> DataFrame:
    """Nodes of one depth from newly ended conversations and what has been stripped to it."""
    whole = survivors.groupBy("node").agg(
        F.any_value("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        *(F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.any_value("path").alias("path"), F.any_value("sizes").alias("sizes"))
    return whole.withColumns({"n_leaves": F.greatest("n_leaves", F.lit(1)),
                              "saved_tokens": F.expr("saved_tokens + (n_convs - 1) * sizes[0]")})


def trie(turns: DataFrame, conversations: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie and where each conversation ends.

    `turns` (conv_id, part, turn, content, size) are `digested` ones, ordered by part, turn (null first) and content; `conversations`
    (conv_id) are all members, those without turns too. Nodes: (node, parent, depth, conv_id, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens) with `node` a 128-bit name, `conv_id` the smallest member, `saved_tokens` the code points of last texts that
    need to be kept once instead of once a member, over the subtree. Ends: (conv_id, node). No conversation, no node.

    Equal conversations count as one with a weight. Tasks peel the subtrees of nodes with at most `group` different conversations; what
    they leave at the top is merged and stripped depth by depth in Spark, with partial sums before each shuffle.
    """
    rows = stored(chain(turns, conversations), "chain")
    ends = stored(rows.where("last").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("turns"), F.count("*").alias("n")), "ends")
    routed = stored(reduce(DataFrame.union, _routes(rows, ends, group)), "routes")
    weighed = routed.join(ends.select("conv_id", "turns", "n"), "conv_id")
    dealt = (rows.join(weighed, "conv_id").select("grp", "k", "depth", "node", "parent", "conv_id", "size",
                                                  F.when(F.col("depth") == F.col("turns"), F.col("n")).otherwise(0).alias("ended"))
             .repartition("grp").sortWithinPartitions("grp", "k", F.desc("depth")))
    peeled = stored(dealt.mapInArrow(_peeled, _PEELED), "peeled")
    left = peeled.where("path IS NOT NULL")
    columns = left.columns
    empty_root = ends.where("turns = 0").select(
        "node", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id",
        F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), *(F.lit(0).cast("long").alias(name) for name in columns[6:9]),
        F.array().cast("array<binary>").alias("path"), F.array(F.lit(0).cast("long")).alias("sizes"))
    deepest = left.agg(F.max("depth")).first()[0] or 0
    found = [peeled.where("path IS NULL").drop("path", "sizes")]
    below: DataFrame | None = None
    for depth in range(deepest, -1, -1):
        some = left.where(F.col("depth") == depth) if depth else empty_root
        if below is not None:
            some = some.union(below.select(
                F.col("path")[0].alias("node"), F.get("path", F.lit(1)).alias("parent"), F.lit(depth).cast("long").alias("depth"), "conv_id",
                F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
                "saved_tokens", F.expr("slice(path, 2, size(path))").alias("path"),
                F.expr("if(size(sizes) > 1, slice(sizes, 2, size(sizes)), array(0L))").alias("sizes")))
        level = stored(_merged(some), f"level-{depth}")
        if below is not None:
            above = level.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
            found.append(below.join(above, "parent").select("node", "parent", F.lit(depth + 1).cast("long").alias("depth"), "conv_id",
                                                            "parent_conv_id", *columns[5:9]))
        below = level
    found.append(below.select("node", "parent", F.lit(0).cast("long").alias("depth"), "conv_id", F.lit(None).cast("long").alias("parent_conv_id"),
                              *columns[5:9]))
    return reduce(DataFrame.union, found), rows.where("last").select("conv_id", "node")


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """`trie` of a table with a row for every turn.

    Turns go by `turn` (null first); turns that tie, by a hash of role and text, so rows that repeat stay and count as turns. Null roles
    and texts are read as empty, rows without a conversation's id are left out, other columns aren't read, an empty table has no node.
    """
    turns = stored(digested(conversations, conv, turn, role, text), "digested")
    return trie(turns.withColumn("part", F.lit(0)), turns.select("conv_id").distinct(), group)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, first, held, length = None, 0, [], 0
    for batch in batches:
        rows = []
        for group, value in _columns(batch):
            if held and (group != at or length > PIECE):
                rows.append((at, first, ",".join(held)))
                held, length = [], 0
            if not held:
                at, first = group, value
            held.append(str(value))
            length += len(held[-1]) + 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], ["grp", "first", "piece"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([one]) for one in (at, first, ",".join(held))], ["grp", "first", "piece"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, hashed = None, None
    for batch in batches:
        rows = []
        for group, piece in _columns(batch):
            if hashed is None or group != at:
                if hashed:
                    rows.append((at, hashed.hexdigest()))
                at, hashed = group, sha256()
            else:
                hashed.update(b",")
            hashed.update(piece.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], ["grp", "digest"])
    if hashed:
        yield pa.RecordBatch.from_arrays([pa.array([one]) for one in (at, hashed.hexdigest())], ["grp", "digest"])


def joined_digests(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, digest): SHA-256 of a group's numbers in ascending order, joined by commas.

    Ranges of (group, value) are sorted and joined into pieces, so a hot group is dealt to many tasks; then its pieces stream through
    one hash.
    """
    named = rows.select(F.col(group).alias("grp"), F.col(value).cast("long").alias("v"))
    pieces = (named.repartitionByRange("grp", "v").sortWithinPartitions("grp", "v").mapInArrow(_pieces, "grp binary, first long, piece string"))
    ordered = pieces.repartition("grp").sortWithinPartitions("grp", "first").select("grp", "piece")
    return ordered.mapInArrow(_hashed, "grp binary, digest string").select(F.col("grp").alias(group), "digest")
