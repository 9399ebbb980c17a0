"""Exact round trips of packed pieces, and the subset sums behind the plan."""

import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa

from factloom.llm.bpe import load
from factloom.llm.packing import fullest, pack, padded, plan
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_fullest_is_the_best_multiset():
    chance = random.Random(5)
    for _ in range(60):
        stock = {chance.randint(1, 30): chance.randint(1, 3) for _ in range(chance.randint(1, 4))}
        room = chance.randint(0, 60)
        found = fullest(stock, room)
        assert all(0 < k <= stock[n] for n, k in found.items())
        sums = [sum(n * k for n, k in zip(stock, ks, strict=True)) for ks in product(*(range(c + 1) for c in stock.values()))]
        assert sum(n * k for n, k in found.items()) == max(s for s in sums if s <= room)


def test_plan_uses_everything_once():
    chance = random.Random(6)
    stock = {n: chance.randint(1, 10**9) for n in chance.sample(range(1, 1024), 300)}
    patterns = plan(stock)
    used = dict.fromkeys(stock, 0)
    for pattern, times in patterns:
        assert sum(n * k for n, k in pattern.items()) <= 1024 and times > 0
        for n, k in pattern.items():
            used[n] += k * times
    assert used == stock
    assert len(patterns) < 20 * 1024


def check(rows, docs):
    library = load(PATH)
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in docs]
    checks = sorted(zlib.crc32(np.array(i, dtype="<u4").tobytes()) for i in ids if len(i) <= 1024)
    assert checks == sorted(r["ids_crc32"] for r in rows if r["start"] == 0 and r["length"] == r["doc_tokens"])
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    assert sum(1 for r in rows if r["start"] == 0) == len(docs)
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return windows


def test_round_trip(documents):
    chance = random.Random(7)
    docs = [(k, " ".join(chance.choice(["the", "river", "was", "cold."]) for _ in range(chance.randint(0, 1500)))) for k in range(150)]
    windows = check(pack(documents(docs), PATH).collect(), docs)
    spare = sum(padded(n) - n for n in (sum(length for _, length in w) for w in windows.values()))
    assert spare <= 0.05 * sum(r for w in windows.values() for _, r in w)


def test_odd_rows(documents):
    check(pack(documents(ODD_TEXTS, extra=True), PATH).collect(), ODD_TEXTS)
    assert pack(documents([]), PATH).count() == 0
    assert pack(documents([(1, None)]), PATH).count() == 1
