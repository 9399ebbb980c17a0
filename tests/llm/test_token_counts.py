"""Counts against the library, text by text."""

import random

import public_tokenizers

from factloom.llm.bpe import load
from factloom.llm.token_counts import Counter, count_tokens, prove
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_proof():
    library, proof = load(PATH), prove(PATH)
    some = random.Random(9).sample(sorted(proof.single), 2_000)
    assert all(len(library.encode(s, add_special_tokens=False).ids) == 1 for s in some)
    assert len(proof.single) > 45_000
    assert "<|endoftext|>" not in proof.single


def test_counts_are_the_library_s():
    chance = random.Random(10)
    parts = [" ", "  ", "\n\n", "\t", ".", "'s", "'LL", "word", "Bc", "é", "12", "²", "_", "\x1c", "<|endoftext|>", "日本", "\U000e0001", "՘", "\U0001f600", "׳"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 14))) for _ in range(3_000)]
    counter, library = Counter(PATH, prove(PATH)), load(PATH)
    assert counter.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_odd_rows(documents):
    library = load(PATH)
    rows = count_tokens(documents(ODD_TEXTS, extra=True), PATH).collect()
    want = sorted((str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in ODD_TEXTS)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == want
    assert count_tokens(documents([]), PATH).count() == 0
