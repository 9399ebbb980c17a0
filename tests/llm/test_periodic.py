"""Runs against every start and period of small texts; transforms; collapsed texts; planted echoes."""

import random
import zlib

import numpy as np
import pytest

from factloom.llm import periodic
from tests.llm.conftest import ODD_TEXTS


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                low, high = i, j + q
                part = words[low:high]
                least = not any(part[: len(part) - d] == part[d:] for d in range(1, q))
                if high - low >= max(6, 4 * q) and least:
                    found.append((low, high - low, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(chance):
    """Words with planted runs of all sizes, some of them interrupted or inside each other."""
    out = []
    for _ in range(chance.randint(0, 5)):
        part = [chance.choice("abcdefg"[: chance.randint(1, 7)]) for _ in range(chance.choice([1, 2, 3, 5, 9, 17, 40]))]
        part = part * chance.choice([1, 1, 3, 4, 5, 9])
        if chance.random() < 0.3:
            part[chance.randrange(len(part))] = "x"
        out += (part + [chance.choice("abcxyz")] * chance.randint(0, 2)) * chance.choice([1, 1, 4])
    return out[: chance.randint(0, 900)]


def test_transform_is_a_round_trip_and_convolves():
    chance = np.random.default_rng(3)
    for size in (1, 2, 8, 64):
        a, b = (chance.integers(0, periodic.PRIME, (3, size)).astype(np.uint64) for _ in range(2))
        assert np.array_equal(periodic.restored(periodic.transformed(a)), a)
        product = periodic.restored(periodic.transformed(a) * periodic.transformed(b) % np.uint64(periodic.PRIME))
        want = [[sum(int(a[r, i]) * int(b[r, (k - i) % size]) for i in range(size)) % periodic.PRIME for k in range(size)] for r in range(3)]
        assert product.tolist() == want


def test_matches_are_all_places_of_a_block():
    codes = np.random.default_rng(4).integers(0, 2, 300)
    for size in (1, 2, 4, 8):
        starts = np.arange(0, len(codes) - size + 1, size)
        got = set(zip(*(x.tolist() for x in periodic.matches(codes, starts, size)), strict=True))
        want = {(b, d) for b in starts.tolist() for d in range(size, 2 * size) if b + d + size <= len(codes) and np.array_equal(codes[b : b + size], codes[b + d : b + d + size])}
        assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_all_runs(seed):
    chance = random.Random(seed)
    for _ in range(150):
        words = some_words(chance)
        codes = np.array([ord(w) for w in words], np.int64)
        assert periodic.runs(codes) == plain_runs(words)


def test_texts_taken_together(documents):
    chance = random.Random(9)
    docs = [(k, chance.choice([" ", "\n", " \t"]).join(some_words(chance))) for k in range(200)] + [(1_000 + k, "a b c " * 20) for k in range(50)]
    rows = {r["doc_id"]: r for r in periodic.periodic_runs(documents(docs, extra=True)).collect()}
    assert len(rows) == len(docs)
    for k, text in docs:
        words = plain_words(text)
        want = plain_runs(words)
        assert [tuple(r) for r in rows[k]["runs"]] == want
        assert rows[k]["n_words"] == len(words) and rows[k]["collapsed"] == collapsed(words, want)


def test_long_periods():
    chance = np.random.default_rng(5)
    part = chance.integers(0, 9, 5_003)
    codes = np.concatenate([chance.integers(0, 9, 777), np.tile(part, 4), part[:100], [99], np.tile([1, 2], 3_000)])
    assert periodic.runs(codes) == [(777, 20_112, 5_003), (777 + 20_113, 6_000, 2)]


def test_odd_rows(documents):
    rows = periodic.periodic_runs(documents(ODD_TEXTS, extra=True)).collect()
    got = sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows)
    words = [(k, plain_words(t)) for k, t in ODD_TEXTS]
    long = [(0, 42_000, 7)]
    found = [long if k == 8 else plain_runs(w) for k, w in words]
    assert got == sorted((str(k), f, collapsed(w, f)) for (k, w), f in zip(words, found, strict=True))
    assert periodic.periodic_runs(documents([])).count() == 0


def test_echoes(documents):
    chance = random.Random(11)
    docs = [(k, "  ".join(chance.choice("abcdefgh") for _ in range(chance.randint(0, 60)))) for k in range(-50, 400)] + [(None, "a  b"), (500, None)]
    changed = 0
    for row in periodic.echoed(documents(docs, extra=True)).collect():
        text = dict(docs)[row["doc_id"]]
        h, words = zlib.crc32(str(row["doc_id"]).encode()), plain_words(text)
        if row["doc_id"] is None or h % 10 or not words:
            assert row["text"] == text
            continue
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert row["text"].split(" ") == [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        changed += 1
    assert changed > 20
