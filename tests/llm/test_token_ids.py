"""Ids merged by tiktoken against the library of the file."""

import random
from array import array
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from factloom.llm import token_ids
from factloom.llm.bpe import load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return token_ids.Encoder(token_ids.alike(PATH))


def by_library(texts):
    return [array("I", e.ids).tobytes() for e in load(PATH).encode_batch_fast(texts, add_special_tokens=False)]


def test_mixed_pieces(encoder):
    chance = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "a", "Bc", "é", "1", "²", "_", "!", "\x1c", " ", "　", "\u0085", "ll", "<|endoftext|>"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 14))) for _ in range(5_000)]
    assert encoder.encode(pa.array(texts)) == by_library(texts)
    assert encoder.encode(pa.array([None, ""])) == [b"", b""]


def test_random_letters_of_all_scripts(encoder):
    chance = random.Random(8)
    ranges = [(32, 127), (32, 592), (880, 1424), (1424, 2304), (8192, 8304), (12288, 12544), (19968, 20480), (44032, 44200), (127744, 128512), (0, 0x2FFFF)]
    texts = []
    for _ in range(6_000):
        low, high = chance.choice(ranges)
        text = (chr(chance.choice((chance.randrange(low, high), chance.randrange(32, 127)))) for _ in range(chance.randint(1, 40)))
        texts.append("".join(c for c in text if not 0xD800 <= ord(c) < 0xE000))
    assert encoder.encode(pa.array(texts)) == by_library(texts)


def test_every_character_between_letters_digits_and_blanks(encoder):
    every = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}a 1{c}1 {c} \n{c}'s" for c in every[k : k + 16]) for k in range(0, len(every), 16)]
    assert encoder.encode(pa.array(texts)) == by_library(texts)


def test_random_letters_that_merge_in_many_ways(encoder):
    chance = random.Random(9)
    texts = ["".join(chance.choice(letters) for _ in range(chance.randint(1, 60))) for letters in ("ab", "aeinrst", "the an", "=-", "0123", "  \n") for _ in range(1_500)]
    assert encoder.encode(pa.array(texts)) == by_library(texts)


def test_every_string_of_the_file_is_made_by_its_own_merge_or_left_out(encoder):
    library = load(PATH)
    for made, token in list(encoder.shown.ranks.items())[::7]:
        try:
            text = made.decode()
        except UnicodeDecodeError:
            continue
        if len(library.pre_tokenizer.pre_tokenize_str(text)) == 1:
            assert library.encode(text, add_special_tokens=False).ids == [token]


def test_a_string_that_its_merges_do_not_end_in_is_left_out():
    letters = {c: ord(c) for c in "abc"}
    vocab = {"a": 0, "b": 1, "c": 2, "bc": 3, "ab": 4, "abc": 5}
    found = token_ids.reached(vocab, [("b", "c"), ("a", "b"), ("ab", "c")], letters)
    assert found == {b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"ab": 4}  # abc: a, bc
    with pytest.raises(ValueError):
        token_ids.reached(vocab, [("a", "b"), ("b", "c")], letters)


def test_long_stretches_are_left_to_the_library(encoder):
    texts = ["a" * 300_000, " " * 1_200_000 + "x", " \n" * 600_000, "\n" * 5_000 + "x y", "word " * 60_000, "日" * 3_000, "x " + "ab" * 1_500]
    assert encoder.left(pa.array(texts)).tolist() == [True, True, True, True, False, True, True]
    assert encoder.encode(pa.array(texts)) == by_library(texts)


def test_given_documents(encoder):
    path = Path("/root/testdata/sf0.01/documents.parquet")
    if not path.exists():
        pytest.skip("tables are not here")
    texts = pq.read_table(path, columns=["text"]).column("text").combine_chunks().fill_null("")
    assert encoder.encode(texts) == by_library(texts.to_pylist())
