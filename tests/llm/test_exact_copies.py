"""The Golomb code as a round trip, and groups of equal texts against a plain grouping."""

import hashlib
import random
import re

import numpy as np
import pytest

from factloom.llm import exact_copies as ec
from tests.llm.conftest import ODD_TEXTS


def test_code_is_a_round_trip_and_short():
    chance = np.random.default_rng(1)
    for bits, n in [(1, 1), (1, 2), (8, 256), (12, 1), (20, 1_000), (40, 5_000), (62, 300), (30, 0)]:
        values = np.unique(chance.integers(0, 1 << bits, n)) if n < 1 << bits else np.arange(1 << bits)
        code = ec.coded(values, 1 << bits)
        assert np.array_equal(ec.decoded(code, len(values)), values)
        if n >= 1_000:
            assert 8 * len(code) / len(values) < np.log2((1 << bits) / len(values)) + 2.2


def plain(docs):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    groups = {}
    for (doc_id, _), text in zip(docs, texts, strict=True):
        groups.setdefault(text, []).append(doc_id)
    return sorted(
        (str(doc_id), str(min((i for i in groups[t] if i is not None), default=None)), len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
        for (doc_id, _), t in zip(docs, texts, strict=True)
    )


def check(rows, docs):
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in rows)
    assert got == plain(docs)
    kept = [r for r in rows if r["kept"]]
    assert len({r["text_sha256"] for r in kept}) == len(kept) == len({r["text_sha256"] for r in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def made(n, seed=2):
    chance = random.Random(seed)
    texts = ["".join(chance.choice(["a", "b", " ", "  ", "\t", "\n\x0b", "é", "\xa0"]) for _ in range(chance.randint(0, 6))) for _ in range(n)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(n + k, "one hot text") for k in range(n)]
    chance.shuffle(docs)
    return docs


def test_groups(documents):
    docs = made(900)
    check(ec.exact_copies(documents(docs, extra=True)).collect(), docs)


@pytest.mark.parametrize("words", [3, 1])
def test_small_blocks_many_owners_and_rounds_give_the_same(documents, monkeypatch, words):
    docs = made(300, seed=3)
    monkeypatch.setattr(ec, "BLOCK", 40)
    monkeypatch.setattr(ec, "OWNED", 16)
    monkeypatch.setattr(ec, "SPARE", 0)  # many suspects by chance
    monkeypatch.setattr(ec, "FLAGGED_WORDS", words)
    check(ec.exact_copies(documents(docs)).collect(), docs)


def test_only_texts_with_copies_are_suspects(spark, documents):
    docs = [(k, f"text {k}") for k in range(400)] + [(1_000 + k, "twice") for k in range(2)]
    rows = documents(docs).selectExpr("doc_id AS place", "xxhash64(text) AS hash")
    found = {r["place"] for r in ec.suspects(ec.messages(rows, 40, 3)).collect()}
    assert found == {1_000, 1_001}


def test_odd_rows(documents):
    docs = [*ODD_TEXTS, (None, "a row  without\tid"), (None, "alone, no id"), (12, "a row without id")]
    check(ec.exact_copies(documents(docs, extra=True)).collect(), docs)
    without = [r for r in ec.exact_copies(documents([(None, "x"), (None, "x"), (1, None)])).collect() if r["doc_id"] is None]
    assert [r["keep_id"] for r in without] == [None, None] and sorted(r["kept"] for r in without) == [False, True]
    assert ec.exact_copies(documents([])).count() == 0
