"""Fingerprints and components against brute force."""

import random
import re

import xxhash

from factloom.llm.components import components
from factloom.llm.simhash import BLOCK_BITS, fingerprint_of, links, near_duplicates, signed
from tests.llm.conftest import ODD_TEXTS


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint(spark):
    chance = random.Random(1)
    for _ in range(60):
        text = " ".join(chance.choice(["The", "a", "ÉTÉ", "ok.", "No", "x"]) for _ in range(chance.randint(0, 12)))
        words = "".join(c.lower() if c < "\x80" else c for c in text).split()
        assert fingerprint_of([w.encode() for w in words]) == plain_fingerprint(text)


def test_blocks_cover_the_fingerprint():
    assert sum(BLOCK_BITS) == (1 << 64) - 1


def test_links_have_the_components_of_all_pairs(spark):
    chance = random.Random(2)
    fps = set()
    for _ in range(40):
        base = chance.getrandbits(64)
        fps.add(base)
        for _ in range(chance.randint(0, 8)):  # chains and dense groups
            for bit in chance.sample(range(64), chance.randint(1, 5)):
                base ^= 1 << bit
            fps.add(base)
    centre = chance.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    values = sorted(map(signed, fps))
    table = spark.createDataFrame([(f, chance.randint(1, 3), f) for f in values], "fp long, copies long, first_id long")
    got = {r["node"]: r["component"] for r in components(links(table)).collect()}
    want = plain_components(values, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 3)
    assert {v: got.get(v, v) for v in values} == want


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(k, k + 1) for k in range(40)]
    hub = [(100, 100 + k) for k in range(1, 50)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, documents):
    rows = near_duplicates(documents(ODD_TEXTS, extra=True)).collect()
    assert len(rows) == len(ODD_TEXTS)
    by_id = {r["doc_id"]: r for r in rows}
    for doc_id, text in ODD_TEXTS:
        assert by_id[doc_id]["fingerprint"] == f"{plain_fingerprint(text):016x}"
    assert {by_id[k]["component_id"] for k in (1, 2, 3)} == {1}
    assert {by_id[k]["component_id"] for k in (6, 7)} == {6}
    assert by_id[None]["component_id"] is None
    assert near_duplicates(documents([])).count() == 0
