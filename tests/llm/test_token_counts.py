import json

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from ramure.llm.token_counts import PieceAutomaton, byte_level_pieces, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word, initial, inner):
    at = count = 0
    while at < len(word):
        pieces = initial if at == 0 else inner
        end = next((end for end in range(len(word), at, -1) if word[at:end] in pieces), None)
        if end is None:
            return 1
        at, count = end, count + 1
    return count


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=5), max_size=8), st.sets(st.text("ab", min_size=1, max_size=5), max_size=8),
       st.lists(st.text("abc", max_size=12), max_size=8))
def test_counts_equal_greedy_search(initial, inner, words):
    initial, inner = ({piece.encode() for piece in pieces} for pieces in (initial, inner))
    automaton = PieceAutomaton(initial, inner)
    for word in words:
        assert automaton.count(word.encode()) == greedy(word.encode(), initial, inner)


def test_counts_equal_the_librarys_word_pieces(spark):
    """The vocabulary as word pieces of the tokenizers library, whose greedy search builds every piece."""
    with open(PATH, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    vocab = {(piece if piece.startswith("Ġ") else f"##{piece}"): number for number, piece in enumerate(pieces)}
    model = Tokenizer(models.WordPiece({**vocab, "[UNK]": len(vocab)}, unk_token="[UNK]", max_input_chars_per_word=10_000))
    signs = json.loads(Tokenizer.from_file(PATH).to_str())  # noqa: F841  the file is one the library reads
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in printable]
    sign = {byte: chr(byte) for byte in printable} | {byte: chr(256 + n) for n, byte in enumerate(rest)}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counted = {row["doc_id"]: row["n_tokens"] for row in count_tokens(docs, PATH).collect()}
    for row in docs.collect():
        words = ["Ġ" + "".join(sign[byte] for byte in word) for word in row["text"].encode().split()]
        assert counted[row["doc_id"]] == sum(len(model.encode(word).ids) for word in words)


def test_every_byte_can_be_cut():
    automaton = PieceAutomaton(*byte_level_pieces(PATH))
    assert all(1 <= automaton.count(b" " + bytes([byte])) <= 2 for byte in range(256))


def test_awkward_rows(awkward):
    rows = count_tokens(awkward, PATH).collect()
    assert len(rows) == 11
    counts = {row["doc_id"]: (row["n_words"], row["n_tokens"]) for row in rows}
    assert counts[1] == counts[2] == counts[3] == (0, 0)
    assert counts[5] == (1, 1) and counts[4][0] == 28_000 and counts[8][0] == 4
    assert count_tokens(awkward.limit(0), PATH).count() == 0
