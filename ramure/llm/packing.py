"""Documents packed whole into sequences of a fixed number of tokens: best fit first, then exchanges between underfull sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ramure.llm.common import crc, slices, stored
from ramure.llm.token_ids import encoder

#: Pieces that one task packs together, about.
GROUP = 8_192


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by falling length, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, place = capacity, len(bins)
            bins.append([])
        bins[place].append(item)
        left = room - length
        by_room[left].append(place)
        rooms |= 1 << left
    return bins


class Sums(NamedTuple):
    """What a bin can give or take back, as bits: bit n of `ones` and `twos` is set if an item, or two, have length n."""

    lengths: tuple[int, ...]
    ones: int
    twos: int
    mirrored: int  # twos from its highest bit down


def sums_of(sizes: Iterable[int]) -> Sums:
    ones = twos = 0
    for size in sizes:
        twos |= ones << size
        ones |= 1 << size
    lengths = tuple(n for n in range(ones.bit_length()) if ones >> n & 1)
    return Sums(lengths, ones, twos, int(f"{twos:b}"[::-1], 2))


def most(giving: Sums, taking: Sums, room: int) -> int:
    """The largest amount up to `room` that an exchange carries, 0 if there is none: all lengths and pairs are compared."""
    allowed = (2 << room) - 2
    found = giving.ones
    out = giving.ones | giving.twos
    for length in taking.lengths:
        found |= out >> length
    found &= allowed
    if taking.twos and not found >> room:
        top = taking.twos.bit_length() - 1
        for length in giving.lengths:
            found |= (taking.mirrored >> (top - length) if length <= top else taking.mirrored << (length - top)) & allowed
    return max(found.bit_length() - 1, 0)


def exchange(giving: Iterable[int], taking: Iterable[int], room: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """The exchange that carries most from one bin to another with so much `room`: (amount, lengths out, lengths back).

    One item moves, one is swapped for one, two for one, or one for two.
    """
    out, back = sorted(map(int, giving), reverse=True), sorted(map(int, taking), reverse=True)
    gives, takes = sums_of(out), sums_of(back)
    amount = most(gives, takes, room)

    def two(sizes: list[int], total: int) -> tuple[int, int]:
        return next((a, total - a) for a in sizes if 2 * a >= total and sizes.count(total - a) > (2 * a == total))

    if not amount:
        return 0, (), ()
    if gives.ones >> amount & 1:
        return amount, (amount,), ()
    for length in takes.lengths:
        if gives.ones >> (amount + length) & 1:
            return amount, (amount + length,), (length,)
    for length in takes.lengths:
        if gives.twos >> (amount + length) & 1:
            return amount, two(out, amount + length), (length,)
    length = next(length for length in gives.lengths if length > amount and takes.twos >> (length - amount) & 1)
    return amount, (length,), two(back, length - amount)


def improved(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search: exchanges between underfull bins that raise the sum of squared fills, until no pair of bins has one.

    Every underfull bin gives to fuller ones, the emptiest first, so every exchange of a positive amount raises that sum and the search
    ends. It also ends when no fewer bins are possible. Two bins that had no exchange are compared again once one has changed.
    """
    fills = [int(lengths[items].sum()) for items in bins]
    least = -(-sum(fills) // capacity)
    used = len(bins)
    sums = [sums_of(lengths[items].tolist()) if fill < capacity else None for items, fill in zip(bins, fills)]
    # when a bin last changed, and when it last had no exchange with any fuller one
    changed, tried, now = [0] * len(bins), [-1] * len(bins), 0

    def carry(source: int, target: int) -> bool:
        nonlocal now
        room = capacity - fills[target]
        if not room or not most(sums[source], sums[target], room):
            return False
        amount, out, back = exchange(lengths[bins[source]], lengths[bins[target]], room)
        for come, go, sizes in ((target, source, out), (source, target, back)):
            for size in sizes:
                item = next(item for item in bins[go] if lengths[item] == size)
                bins[go].remove(item)
                bins[come].append(item)
        now += 1
        for place, change in ((source, -amount), (target, amount)):
            fills[place] += change
            sums[place] = sums_of(lengths[bins[place]].tolist())
            changed[place] = now
        return True

    moved = True
    while moved and used > least:
        moved = False
        underfull = sorted((k for k in range(len(bins)) if 0 < fills[k] < capacity), key=fills.__getitem__)
        for at, source in enumerate(underfull):
            since = tried[source] if tried[source] >= changed[source] else -1
            for target in reversed(underfull[at + 1:]):
                if fills[source] and changed[target] > since and carry(source, target):
                    moved, since = True, -1
            if not fills[source]:
                used -= 1
            if moved:
                break
            tried[source] = now
    return [items for items in bins if items]


def packed(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by bin."""
    return improved(best_fit(lengths, capacity), lengths, capacity)


def cut_pieces(docs: DataFrame, path: str, spaced: bool, end_id: int, capacity: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Token pieces of every row: (row, key, piece, start, length, ids, ids_crc32).

    A document of more than `capacity` tokens, end id included, is cut into full pieces; the remainder is the first. `row` tells
    repeated keys apart. Null texts are read as empty and give the end id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, spaced)
        for batch in slices(batches, 2):
            every, ends = ids_of(batch.column(2))
            places, pieces, begins, lengths, contents, sums = [], [], [], [], [], []
            for place, (low, high) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                ids = np.append(every[low:high], end_id).astype("<u4")
                starts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)] if len(ids) > capacity else [0]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    places.append(place)
                    pieces.append(piece)
                    begins.append(start)
                    lengths.append(end - start)
                    contents.append(ids[start:end].tobytes())
                    sums.append(crc(ids[start:end]))
            at = pa.array(places, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(pieces, pa.int32()), pa.array(begins, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(contents, pa.binary()), pa.array(sums, pa.int64())],
                ["row", "key", "piece", "start", "length", "ids", "ids_crc32"])

    source = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].cast("long").alias("key"), docs[text].alias("text"))
    return source.mapInArrow(cut, "row long, key long, piece int, start long, length long, ids binary, ids_crc32 long")


def place(pieces: DataFrame, capacity: int, groups: int, mark: int) -> DataFrame:
    """(row, piece, length, sequence_id, offset, fill): pieces dealt evenly into `groups`, each packed by one task."""

    def packed_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["row", "piece"]).reset_index(drop=True)
        lengths = frame["length"].to_numpy()
        sequence, offset, fill = (np.zeros(len(frame), np.int64) for _ in range(3))
        for number, items in enumerate(packed(lengths, capacity)):
            sequence[items] = (mark << 58) + (int(key[0]) << 24) + number
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
            fill[items] = lengths[items].sum()
        return frame[["row", "piece", "length"]].assign(sequence_id=sequence, offset=offset, fill=fill)

    dealt = pieces.select("row", "piece", "length", F.pmod(F.xxhash64("row", "piece", F.lit(mark)), F.lit(groups)).alias("part"))
    return dealt.groupBy("part").applyInPandas(
        packed_group, "row long, piece int, length long, sequence_id long, offset long, fill long")


def pack_documents(docs: DataFrame, path: str, spaced: bool = True, end_id: int = 0, capacity: int = 2048, text: str = "text",
                   key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """Pack the token ids of all rows into sequences of at most `capacity`.

    Returns `key`, piece, start (ids of the document before the piece), length, ids (little-endian unsigned 32-bit), ids_crc32,
    sequence_id and offset (place in the sequence, without gaps from 0). Null texts are read as empty; rows without a key and
    repeated keys are packed like others; other columns aren't read; an empty table gives no rows.

    Only lengths are shuffled, by a hash, into groups of about `group` pieces, so no key can make one large; the emptier half of what
    groups leave is packed again with that of other groups. Everything else stays where it was encoded.
    """
    pieces = stored(cut_pieces(docs, path, spaced, end_id, capacity, text, key), "pieces")
    groups = max(1, -(-pieces.count() // group))
    first = stored(place(pieces, capacity, groups, 0), "places")
    rest = first.where(F.col("fill") * 2 < capacity)
    again = place(rest, capacity, max(1, groups // 64), 1)
    places = first.where(F.col("fill") * 2 >= capacity).union(again).select("row", "piece", "sequence_id", "offset")
    return (pieces.join(places, ["row", "piece"])
            .select(F.col("key").alias(key), "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"))
