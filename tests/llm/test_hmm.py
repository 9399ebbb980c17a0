"""Likelihoods against the sum over all state paths, counts against brute force, odd rows."""

import math
import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factloom.llm import hmm
from factloom.llm.hmm import Model, Recursion, Vocabulary, score, sequences
from factloom.llm.text import words_of
from tests.llm.conftest import ODD_TEXTS


def some_model(chance, states=3, classes=4):
    def rows(*shape):
        out = chance.random(shape) + 0.05
        return out / out.sum(-1, keepdims=True)

    return Model(rows(states), rows(states, states), rows(states, classes).T)


def test_recursion_against_all_paths():
    chance = np.random.default_rng(16)
    model = some_model(chance)
    texts = [chance.integers(0, 4, n).astype(np.int32) for n in (4, 1, 6, 3)]
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    recursion = Recursion(model, np.concatenate(texts), starts, lengths, True)
    got, expected = recursion.likelihoods(), recursion.expected()
    start, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for text, value in zip(texts, got, strict=True):
        paths = {}
        for path in product(range(3), repeat=len(text)):
            p = model.start[path[0]]
            for k, s in enumerate(path):
                p *= (model.step[path[k - 1], s] if k else 1) * model.emit[text[k], s]
            paths[path] = p
        total = sum(paths.values())
        assert math.isclose(value, math.log10(total))
        for path, p in paths.items():
            start[path[0]] += p / total
            for k, s in enumerate(path):
                emit[text[k], s] += p / total
                if k:
                    step[path[k - 1], s] += p / total
    assert np.allclose(expected.start, start) and np.allclose(expected.step, step) and np.allclose(expected.emit, emit)


def test_long_texts_do_not_vanish():
    model = some_model(np.random.default_rng(17))
    found = Recursion(model, np.zeros(50_000, np.int32), np.array([0]), np.array([50_000]), False).likelihoods()
    assert np.isfinite(found).all() and found[0] < -1_000


def test_sequences():
    vocab = Vocabulary(pa.array(["a", "b"]), np.array([3, 2]), 2, np.zeros(0), np.zeros(0), 1, 5, 2)
    classes, starts, lengths = sequences(words_of(pa.array(["A b", None, "zz"])), vocab)
    assert starts.tolist() == [0, 3, 4] and lengths.tolist() == [3, 1, 2]
    assert classes[:4].tolist() == [0, 1, vocab.end, vocab.end] and 2 <= classes[4] < vocab.end


@pytest.mark.parametrize("held", [131_072, 3])
def test_counts_and_scores(documents, monkeypatch, held):
    """Also where most words are in the distributed table alone."""
    monkeypatch.setattr(hmm, "HELD", held)
    chance = random.Random(18)
    texts = [(k, " ".join(chance.choice(["The", "a", "River", "été", "x" + str(chance.randint(0, 300))]) for _ in range(chance.randint(0, 40)))) for k in range(150)]
    docs = documents(texts, extra=True)
    got = {r["doc_id"]: r for r in score(docs, F.col("doc_id") % 5 != 0).collect()}
    taught = [t.lower().split() for k, t in texts if k % 5]
    counts = Counter(w for t in taught for w in t)
    n, v = sum(counts.values()) + len(taught), len(counts) + 1
    for k, text in texts:
        tokens, row = text.lower().split(), got[k]
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens) + math.log10((len(taught) + 1) / (n + v + 1))
        assert math.isclose(row["base_score"], want, rel_tol=1e-9)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens) + 1, sum(w in counts for w in tokens) + 1, n)
        assert math.isfinite(row["score"]) and row["score"] < 0


def test_states_help_on_held_out_texts(documents):
    chance = random.Random(19)
    sides = [["the", "river", "winter", "cold"], ["der", "fluss", "kalt", "schnee"]]
    texts = [(k, " ".join(chance.choice(sides[k % 2]) for _ in range(40))) for k in range(200)]
    rows = [r for r in score(documents(texts), F.col("doc_id") % 7 != 2).collect() if r["doc_id"] % 7 == 2]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 5 * len(rows)


def test_odd_rows(documents):
    rows = score(documents(ODD_TEXTS, extra=True), F.lit(True)).collect()
    assert len(rows) == len(ODD_TEXTS)
    want = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for k, t in ODD_TEXTS}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    nothing = score(documents(ODD_TEXTS), F.lit(False)).collect()
    assert {(r["base_score"], r["score"], r["n_known"], r["train_tokens"]) for r in nothing} == {(0.0, 0.0, 0, 0)}
    assert score(documents([]), F.lit(True)).count() == 0
