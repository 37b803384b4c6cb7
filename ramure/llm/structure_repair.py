"""Conversations made to alternate user and assistant turns at the least cost, by matrices of a grammar that all conversations share.

Each conversation is a sequence of symbols (a turn's role and fault). Frequent neighbours become symbols of their own (Re-Pair), round by
round over all sequences; a symbol stands for a min-plus matrix between the states of the order of roles, and a rule's matrix is the product
of its two sides'. Entries hold the cost and the edits, as a rope that shares the sides' ropes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ramure.llm.common import stored

#: Rules of a grammar, and of one round; a sequence that is still longer after them is a product of more matrices.
RULES, ROUND = 4_096, 256

# States of the order of roles (nothing yet, after system, user, assistant), where a role leads, and costs.
STATES, ACCEPTED = 4, (0, 3)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
INITIALS = "sua"
#: Symbols: 0 for a turn that has to go, else by initial (others last) and whether it is truncated.
SYMBOLS = 9
#: White space of the contract; every other character makes a text not blank.
BLANK = r"[\x20\x09-\x0D]"


def symbol(initial: str, goes: bool, truncated: bool) -> int:
    return 0 if goes else 1 + 2 * (INITIALS.find(initial) if initial in INITIALS and initial else 3) + truncated


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with turns dropped, emptied, cut, repeated or given to the user, by CRC-32 of `conv_id:turn`.

    Null roles and texts become one space, and so do nulls in what is hashed; rows without a conversation's id are left out.
    """
    key = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    drawn = (conversations.where("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("fate"))
             .where("fate <> 0"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _content() -> Column:
    return F.unhex(F.md5("text"))


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, nth, fault) without the texts: blank, duplicate or truncated, the first that holds, else null.

    `nth` numbers the turns of a conversation that are equal in role and text, in the order of turns.
    """
    facts = rows.select("conv_id", "turn", "role", _content().alias("content"),
                        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                        (~F.col("text").rlike(rf"[.!?]{BLANK}*\z")).alias("cut"))
    order = Window.partitionBy("conv_id", "role", "content").orderBy(F.asc_nulls_first("turn"))
    fault = F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate").when(F.col("cut"), "truncated")
    return facts.withColumn("nth", F.row_number().over(order)).select("conv_id", "turn", "role", "content", "nth", fault.alias("fault"))


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


_SUMMARY = pa.schema([("conv_id", pa.int64()), ("symbols", pa.binary()), *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal"))])
_SUMMARY_SQL = "conv_id long, symbols binary, gaps long, blank long, duplicate long, truncated long, illegal long"


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the turns of a conversation, which come in order."""
    conv, symbols, faults, illegal, before, turns = None, bytearray(), {}, 0, None, None

    def row() -> tuple:
        first, last, distinct = turns or (0, -1, 0)
        return (conv, bytes(symbols), last - first + 1 - distinct, *(faults.get(name, 0) for name in ("blank", "duplicate", "truncated")), illegal)

    for batch in batches:
        rows = []
        for id_, turn, initial, fault in _columns(batch):
            if id_ != conv:
                if conv is not None:
                    rows.append(row())
                conv, symbols, faults, illegal, before, turns = id_, bytearray(), {}, 0, None, None
            if fault:
                faults[fault] = faults.get(fault, 0) + 1
            if before is not None and before + initial not in ("su", "ua", "au"):
                illegal += 1
            before = initial
            if turn is not None:
                turns = (turn, turn, 1) if turns is None else (turns[0], turn, turns[2] + (turn != turns[1]))
            symbols.append(symbol(initial, fault in ("blank", "duplicate"), fault == "truncated"))
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_SUMMARY.names, one)) for one in rows], _SUMMARY)
    if conv is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(_SUMMARY.names, row()))], _SUMMARY)


def summaries(faults: DataFrame) -> DataFrame:
    """(conv_id, symbols, gaps, blank, duplicate, truncated, illegal) of every conversation; a byte for each turn."""
    ordered = (faults.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "content", "nth")
               .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault"))
    return ordered.mapInArrow(_summarised, _SUMMARY_SQL)


Rounds = list[list[tuple[int, int, int]]]


def joined(sequences: list[bytes], kind: str) -> np.ndarray:
    """Sequences of symbols after one another, each followed by -1."""
    lengths = np.array([len(one) for one in sequences], np.int64) // np.dtype(kind).itemsize
    values = np.full(int(lengths.sum()) + len(sequences), -1, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    inside = np.ones(len(values), bool)
    inside[ends] = False
    values[inside] = np.frombuffer(b"".join(sequences), kind)
    return values


def _codes(values: np.ndarray) -> np.ndarray:
    """A number for each symbol and the next one, -1 where a sequence ends."""
    pairs = values[:-1] * (SYMBOLS + RULES) + values[1:]
    return np.where((values[:-1] < 0) | (values[1:] < 0), -1, pairs)


def replaced(values: np.ndarray, rules: list[tuple[int, int, int]]) -> np.ndarray:
    """Replace pairs by their symbols, from the left where a symbol is paired with itself."""
    if len(values) < 2 or not rules:
        return values
    pairs = np.array(sorted((a * (SYMBOLS + RULES) + b, new) for a, b, new in rules), np.int64)
    codes = _codes(values)
    at = np.minimum(np.searchsorted(pairs[:, 0], codes), len(pairs) - 1)
    hits = np.flatnonzero(pairs[at, 0] == codes)
    if not len(hits):
        return values
    begins = np.flatnonzero(np.diff(hits, prepend=-2) != 1)  # runs of hits: one symbol repeated
    offset = np.arange(len(hits)) - np.repeat(begins, np.diff(begins, append=len(hits)))
    hits = hits[offset % 2 == 0]
    values = values.copy()
    values[hits] = pairs[at[hits], 1]
    return np.delete(values, hits + 1)


def _split(values: np.ndarray) -> list[np.ndarray]:
    return [one[:-1] for one in np.split(values, np.flatnonzero(values < 0) + 1)[:-1]]


def compressed(sequences: list[bytes], rounds: Rounds, kind: str = "u1") -> list[np.ndarray]:
    """Sequences with the rules of all rounds applied in turn."""
    values = joined(sequences, kind)
    for rules in rounds:
        values = replaced(values, rules)
    return _split(values)


def _apart(pairs: list[tuple[int, int]], first: int) -> list[tuple[int, int, int]]:
    """Rules for the most frequent pairs that can't overlap: no symbol ends one and begins another."""
    begins: set[int] = set()
    ends: set[int] = set()
    rules = []
    for a, b in pairs:
        if a in ends or b in begins or a == b and (a in begins or b in ends) or any(x == y for x, y, _ in rules if x in (a, b)):
            continue
        begins.add(a)
        ends.add(b)
        rules.append((a, b, first + len(rules)))
    return rules


def learn_grammar(sequences: DataFrame) -> Rounds:
    """Re-Pair over all different sequences of a column `symbols` (a byte a symbol), rounds of rules until no pair occurs twice.

    A round counts neighbours in each task, adds the counts up in Spark and turns the most frequent pairs that can't overlap into symbols.
    The driver sees `ROUND` pairs a round.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(joined(batch.column(0).to_pylist(), "<u2"))
            pairs, counts = np.unique(codes[codes >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    def shorter(rules: list[tuple[int, int, int]], kind: str):
        def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left = _split(replaced(joined(batch.column(0).to_pylist(), kind), rules))
                yield pa.RecordBatch.from_arrays([pa.array([one.astype("<u2").tobytes() for one in left if len(one) > 1], pa.binary())], ["symbols"])
        return applied

    rounds: Rounds = []
    left = stored(sequences.select("symbols").distinct().mapInArrow(shorter([], "u1"), "symbols binary"), "sequences")
    known = SYMBOLS
    while known < SYMBOLS + RULES:
        counts = (left.mapInArrow(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
                  .orderBy(F.desc("n"), "pair").limit(min(ROUND, SYMBOLS + RULES - known)).collect())
        rules = _apart([divmod(row["pair"], SYMBOLS + RULES) for row in counts], known)
        if not rules:
            break
        rounds.append(rules)
        known += len(rules)
        left = stored(left.mapInArrow(shorter(rules, "<u2"), "symbols binary"), "sequences")
    return rounds


_PRIME, _BASE = (1 << 61) - 1, 911_382_323


class Rope:
    """A text that shares its parts: short ones are kept as they are, longer ones by their two halves, all with a hash."""

    __slots__ = ("length", "hash", "text", "left", "right")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.length, self.hash = len(text), 0
            for character in text:
                self.hash = (self.hash * _BASE + ord(character)) % _PRIME
        else:
            self.length = left.length + right.length
            self.hash = (left.hash * pow(_BASE, right.length, _PRIME) + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.length or not other.length:
            return self if self.length else other
        if self.text is not None and other.text is not None and self.length + other.length <= 16:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __lt__(self, other: Rope) -> bool:
        """In the order of characters; parts with equal hashes are passed over as a whole."""
        left, right = [self], [other]
        while left and right:
            one, two = left.pop(), right.pop()
            if one is two or one.length == two.length and one.hash == two.hash:
                continue
            if one.text is not None and two.text is not None:
                size = min(one.length, two.length)
                if one.text[:size] != two.text[:size]:
                    return one.text < two.text
                if one.length > size:
                    left.append(Rope(one.text[size:]))
                elif two.length > size:
                    right.append(Rope(two.text[size:]))
            elif one.text is None and (two.text is not None or one.length >= two.length):
                left += [one.right, one.left]
                right.append(two)
            else:
                right += [two.right, two.left]
                left.append(one)
        return not left and bool(right)

    def __str__(self) -> str:
        parts, waiting = [], [self]
        while waiting:
            one = waiting.pop()
            if one.text is not None:
                parts.append(one.text)
            else:
                waiting += [one.right, one.left]
        return "".join(parts)


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def _better(one: Entry, two: Entry) -> Entry:
    if one is None or two is None:
        return one or two
    if one[0] != two[0]:
        return min(one, two, key=lambda entry: entry[0])
    return two if two[1] < one[1] else one


def times(left: Matrix, right: Matrix) -> Matrix:
    """Min-plus product: costs add up, edits are joined, the cheapest way counts, of equal ones the first in the order of characters.

    Ways of equal cost between two states over the same turns are never one the beginning of another, as only insertions add letters and
    each costs something; so the first stays the first whatever is joined to it.
    """
    found: Matrix = [[None] * STATES for _ in left]
    for i, row in enumerate(left):
        for j in range(STATES):
            ways = [(row[k][0] + right[k][j][0], k) for k in range(STATES) if row[k] and right[k][j]]
            if ways:
                cost = min(ways)[0]
                best: Entry = None
                for total, k in ways:
                    if total == cost:
                        best = _better(best, (cost, row[k][1] + right[k][j][1]))
                found[i][j] = best
    return found


def _insertions() -> Matrix:
    """The cheapest insertions between any two states."""
    found: Matrix = [[(0, Rope("")) if i == j else None for j in range(STATES)] for i in range(STATES)]
    for count in range(1, STATES):
        for i in range(STATES):
            at = i
            for _ in range(count):
                at = next(NEXT[at][role] for role in "ua" if role in NEXT[at])
            if found[i][at] is None:
                found[i][at] = (INSERT * count, Rope("I" * count))
    return found


INSERTIONS = _insertions()


def _turn(number: int) -> Matrix:
    """The edits of one turn, with insertions before it."""
    found: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        found[i][i] = (DELETE, Rope("D"))
        if number:
            kind, more = divmod(number - 1, 2)
            rerole = next(role for role in "ua" if role in NEXT[i])
            options = [(REROLE, "R", rerole), *([(0, "K", INITIALS[kind])] if kind < 3 else [])]
            for cost, letter, role in options:
                if role in NEXT[i]:
                    to = NEXT[i][role]
                    found[i][to] = _better(found[i][to], (cost + more * TRUNCATED, Rope(letter)))
    return times(INSERTIONS, found)


class Matrices:
    """Matrices of turns, and of the rules met, each made once from its two sides."""

    def __init__(self, rounds: Rounds):
        self.rules = {new: (a, b) for rules in rounds for a, b, new in rules}
        self.known = {number: _turn(number) for number in range(SYMBOLS)}

    def __getitem__(self, number: int) -> Matrix:
        if number not in self.known:
            waiting = [number]
            while waiting:
                a, b = self.rules[waiting[-1]]
                needed = [one for one in (a, b) if one not in self.known]
                if needed:
                    waiting += needed
                else:
                    self.known[waiting.pop()] = times(self.known[a], self.known[b])
        return self.known[number]

    def repair(self, numbers: Iterator[int]) -> tuple[int, str]:
        """The least cost and its edits for a sequence of symbols."""
        way: Matrix = [[(0, Rope("")), *[None] * (STATES - 1)]]
        for number in numbers:
            way = times(way, self[number])
        ends = times(way, INSERTIONS)[0]
        best: Entry = None
        for state in ACCEPTED:
            best = _better(best, ends[state])
        return best[0], str(best[1])


def with_edits(summarised: DataFrame, rounds: Rounds) -> DataFrame:
    """Add `cost` and `audit`: the cheapest edits of each conversation as their initials."""
    schema = pa.schema([*_SUMMARY, ("cost", pa.int64()), ("audit", pa.string())])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = Matrices(rounds)
        for batch in batches:
            symbols = batch.column(1).to_pylist()
            different = list(dict.fromkeys(symbols))
            edits = {one: matrices.repair(numbers.tolist()) for one, numbers in zip(different, compressed(different, rounds))}
            both = [edits[one] for one in symbols]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([one for one, _ in both], pa.int64()),
                                              pa.array([one for _, one in both], pa.string())], schema=schema)

    return summarised.mapInArrow(repaired, _SUMMARY_SQL + ", cost long, audit string")


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, at, state, position = "", 0, 0, 0
    for batch in batches:
        rows = []

        def put(conv: int, role: str, text: str, edit: str) -> None:
            nonlocal state, position
            state = NEXT[state][role[0]]
            rows.append((conv, position, role, text, edit))
            position += 1

        def insert(conv: int) -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put(conv, NAMES[next(role for role in "ua" if role in NEXT[state])], "", "I")
                at += 1

        for conv, edits, role, text in _columns(batch):
            if edits is not None:
                audit, at, state, position = edits, 0, 0, 0
                insert(conv)
                continue
            edit = audit[at]
            at += 1
            if edit == "K":
                put(conv, role, text, edit)
            elif edit == "R":
                put(conv, NAMES[next(one for one in "ua" if one in NEXT[state])], text, edit)
            insert(conv)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, one.type) for column, one in zip(zip(*rows), _REPAIRED)], schema=_REPAIRED)


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit) of what `edits` (conv_id, audit) leave of `rows`, each conversation's in order in one task.

    The audit is a row of its own before the turns, so it isn't repeated with them, and both stream by.
    """
    none = F.lit(None).cast("string")
    audits = edits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"),
                          F.lit(None).cast("binary").alias("content"), "audit")
    turns = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", _content().alias("content"), none.alias("audit"))
    ordered = (audits.union(turns).repartition("conv_id")
               .sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "content"))
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(_edited, "conv_id long, position long, role string, text string, edit string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, hashed = None, None
    for batch in batches:
        rows = []
        for id_, role, text in _columns(batch):
            if id_ != conv:
                if hashed:
                    rows.append((conv, hashed.hexdigest()))
                conv, hashed = id_, sha256()
            else:
                hashed.update(b"\n")
            hashed.update(f"{role}:{text}".encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], ["conv_id", "digest"])
    if hashed:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([hashed.hexdigest()])], ["conv_id", "digest"])


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, digest): SHA-256 of `role:text` lines of `repaired_turns`, read in the order in which it gives them."""
    return repaired.select("conv_id", "role", "text").mapInArrow(_digested, "conv_id long, digest string")


def repair_structure(rows: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Reports of conversations and their repaired turns.

    `rows` has conv_id, turn, role and text; other columns aren't read. Turns go by `turn` (null first), ties by role and a hash of the
    text; rows that repeat are duplicates. Null roles and texts count as one space; rows without a conversation's id are left out. A turn
    is blank, a duplicate of an earlier one or truncated, whichever comes first. The edits leave roles that begin `(s?(ua)+)?`: keep 0,
    rerole to user or assistant 1, delete 2 (blank and duplicate turns always), insert an empty user or assistant turn 5; a truncated turn
    that stays adds 5. Of the cheapest edits the ones whose initials come first are taken.

    Reports: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), of `conversations` (conv_id) without rows too, with zeros
    and no edits. Repaired turns: as `repaired_turns`. An empty table has neither.
    """
    rows = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    summarised = stored(summaries(with_faults(rows)), "summaries")
    edits = stored(with_edits(summarised, learn_grammar(summarised)), "edits")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    reports = edits.select("conv_id", *numbers, "audit")
    if conversations is not None:
        reports = (conversations.select("conv_id").distinct().join(reports, "conv_id", "left")
                   .select("conv_id", *(F.coalesce(name, F.lit(0)).alias(name) for name in numbers), F.coalesce("audit", F.lit("")).alias("audit")))
    return reports, repaired_turns(rows, edits)
