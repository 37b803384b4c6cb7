import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ramure.llm.packing import best_fit, exchange, improved, pack_documents, packed

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_every_item_once_and_no_bin_too_full(lengths):
    lengths = np.array(lengths, np.int64)
    first, bins = best_fit(lengths, 20), packed(lengths, 20)
    assert sorted(item for items in bins for item in items) == list(range(len(lengths)))
    assert all(0 < lengths[items].sum() <= 20 for items in bins)
    assert -(-lengths.sum() // 20) <= len(bins) <= len(first)


def test_exchanges_empty_a_bin():
    lengths = np.array([6, 3, 6, 3, 7, 5])  # capacity 10: best would be 7+3, 6+3, 6, 5 -> three bins can't hold 30 but four can hold it
    bins = improved([[0], [1, 2], [3, 4], [5]], lengths, 15)
    assert len(bins) == 2 and all(lengths[items].sum() == 15 for items in bins)


def test_kinds_of_exchanges():
    one = np.array
    assert exchange(one([4]), one([9]), 5) == (4, (4,), ())
    assert exchange(one([7]), one([5]), 3) == (2, (7,), (5,))
    assert exchange(one([3, 4]), one([5]), 2) == (2, (4, 3), (5,))
    assert exchange(one([9]), one([4, 3]), 2) == (2, (9,), (4, 3))
    assert exchange(one([9]), one([20]), 2)[0] == 0


def test_pairs_of_short_items_in_a_long_bin():
    assert exchange(np.array([100] * 48 + [4, 3]), np.array([5]), 2) == (2, (4, 3), (5,))
    assert exchange(np.array([9]), np.array([100] * 48 + [4, 3]), 2) == (2, (9,), (4, 3))


def test_a_bin_after_eight_others_is_emptied():
    sizes = [[52]] * 8 + [[4] * 15] + [[96]] * 15
    lengths = np.array([size for items in sizes for size in items])
    numbers = iter(range(len(lengths)))
    bins = improved([[next(numbers) for _ in items] for items in sizes], lengths, 100)
    assert len(bins) == 23 and sorted(item for items in bins for item in items) == list(range(len(lengths)))


def carried(giving, taking, room):
    """The largest amount of any exchange, all of them tried."""
    one = lambda sizes: set(sizes)
    two = lambda sizes: {a + b for a, b in itertools.combinations(sizes, 2)}
    amounts = (one(giving) | {a - b for a in one(giving) | two(giving) for b in one(taking)} | {a - b for a in one(giving) for b in two(taking)})
    return max((amount for amount in amounts if 0 < amount <= room), default=0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=8), st.lists(st.integers(1, 60), min_size=1, max_size=8), st.integers(1, 60))
def test_exchange_carries_most(giving, taking, room):
    amount, out, back = exchange(np.array(giving), np.array(taking), room)
    assert amount == carried(giving, taking, room) == sum(out) - sum(back)
    assert not Counter(out) - Counter(giving) and not Counter(back) - Counter(taking)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(15, 60), min_size=20, max_size=80))
def test_search_ends_when_no_pair_of_bins_has_an_exchange(sizes):
    lengths = np.array(sizes, np.int64)
    bins = [lengths[items].tolist() for items in packed(lengths, 100)]
    under = sorted((items for items in bins if sum(items) < 100), key=sum)
    assert len(bins) == -(-sum(sizes) // 100) or not any(
        carried(source, target, 100 - sum(target)) for source, target in itertools.combinations(under, 2))


def check(rows, docs, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    whole = Tokenizer.from_file(PATH)
    for doc_id, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n, row in enumerate(sorted(pieces[doc_id], key=lambda row: row["piece"])):
            assert (row["piece"], row["start"]) == (n, at) and (row["length"] == capacity or n == 0)
            part = ids[at:at + row["length"]].tobytes()
            assert bytes(row["ids"]) == part and row["ids_crc32"] == zlib.crc32(part)
            at += row["length"]
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_in_several_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(docs, PATH, capacity=512, group=50).collect()
    used = check(rows, [(row["doc_id"], row["text"]) for row in docs.collect()], 512)
    assert used <= -(-sum(row["length"] for row in rows) // 512) + 16  # one for each group at most


def test_awkward_rows(awkward):
    rows = pack_documents(awkward, PATH).collect()
    texts = {row["doc_id"]: row["text"] for row in awkward.collect()}
    single = [row for row in rows if row["doc_id"] != 5]
    check(rows=[row for row in rows if row["doc_id"] != 5 or row in rows], docs=[(i, t) for i, t in texts.items() if i not in (5,)], capacity=2048)
    assert sum(row["doc_id"] == 5 for row in rows) == 2 and len(single) > 9
    assert {row["length"] for row in rows if row["doc_id"] == 1} == {1}
    assert pack_documents(awkward.limit(0), PATH).count() == 0
