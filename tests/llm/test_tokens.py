import random

import pytest
from tokenizers import Tokenizer

from fareloom.llm.queries import TOKENIZERS
from fareloom.llm.tokens import EncodedText, PrefixTable, encode, encode_corpus, vocabulary

PATH = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
ALPHABET = ["a", "b", "'", "l", "s", " ", "  ", "\n", "\x1c", "\x85", " ", "é", "é", "한", "😀", "1", "²", "Ⅷ", "the", "ing", "ab" * 40, "\r\n", "\t", "aaaa", " " * 36, "<|endoftext|>", "𐍈", "­", "\x00"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def texts(count, longest=60, seed=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, longest))) for _ in range(count)]


def test_same_ids_as_the_library(library):
    v = vocabulary(PATH)
    some = texts(3000)
    for text, other in zip(some, library.encode_batch(some, add_special_tokens=False), strict=True):
        assert encode(v, text) == other.ids


def test_very_long_pieces(library):
    v = vocabulary(PATH)
    for text in ("a" * 30_000, "한" * 5_000, "=" * 20_000, "x1" * 10_000, " " * 9_999):
        assert encode(v, text) == library.encode(text, add_special_tokens=False).ids


def test_ids_decode_to_the_text():
    v = vocabulary(PATH)
    bytes_of = {i: b for b, i in v.ids.items()}
    for text in texts(300, seed=3):
        assert b"".join(bytes_of[i] for i in encode(v, text)) == text.encode()


def test_appended_and_cut_tables_are_those_of_the_whole():
    v = vocabulary(PATH)
    rnd = random.Random(1)
    for _ in range(300):
        data = bytes(rnd.choices(b"abcdeing the", k=rnd.randint(1, 40)))
        at = rnd.randint(0, len(data))
        grown = PrefixTable(v, data[:at])
        grown.append(data[at:])
        assert grown.last == PrefixTable(v, data).last
        grown.cut(at)
        assert grown.ids() == PrefixTable(v, data[:at]).ids()


def test_edits_encode_only_what_they_touch():
    v = vocabulary(PATH)
    rnd = random.Random(2)
    for text in texts(500, seed=5):
        state = EncodedText(v, text)
        for _ in range(4):
            at = rnd.randint(0, len(state.text))
            state.edit(at, rnd.randint(0, 5), "".join(rnd.choices(ALPHABET, k=rnd.randint(0, 3))))
            assert state.ids() == encode(v, state.text)
    long = EncodedText(v, "one two three " * 2000)
    assert long.edit(13_000, 3, "xyz") < 10
    long.append(" and more")
    assert long.ids() == encode(v, long.text)


def test_nulls_empty_repeated_and_extra_columns(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (3, "", "y"), (None, "<|endoftext|>", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = [(r.doc_id, r.ids) for r in encode_corpus(df, "doc_id", "text", PATH).collect()]
    v = vocabulary(PATH)
    assert sorted(got, key=str) == sorted([(a, encode(v, t)) for a, t, _ in rows], key=str)
    assert encode(v, "<|endoftext|>") != [50256]
    assert encode_corpus(df.limit(0), "doc_id", "text", PATH).count() == 0
