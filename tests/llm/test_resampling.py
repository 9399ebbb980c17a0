"""Bucket counts, weights and draws against a plain version over every text."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from factloom.llm.resampling import bucket_counts, resample
from tests.llm.conftest import ODD_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, longest, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, longest, buckets, percent, min_words):
    s = Counter(b for _, t in docs for b in features(t, longest, buckets))
    t = Counter(b for x in target for b in features(x, longest, buckets))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = features(text, longest, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=str)


def got(rows):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows), key=str)


def made(n, seed):
    chance = random.Random(seed)
    lines = [" ".join(chance.choice(["The", "river", "was", "cold.", "naïve", "x-ray", "99", "日本", "_"]) for _ in range(chance.randint(0, 7))) for _ in range(30)]
    return [(k, chance.choice(["\n", "\n\n", "\r\n"]).join(chance.choice(lines) for _ in range(chance.randint(0, 9)))) for k in range(n)]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_against_a_plain_version(spark, documents, longest):
    docs, target = made(400, 21), [t for _, t in made(20, 22)] + ["The river was cold", None]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    rows = resample(documents(docs, extra=True), bench, longest=longest, buckets=97, percent=30).collect()
    assert got(rows) == plain(docs, target, longest, 97, 30, 20)


def test_counts_of_lines_are_counts_of_texts(spark, documents):
    docs = made(200, 23) + [(1_000 + k, "one hot line\nand one more") for k in range(500)]
    for longest in (1, 4):
        want = Counter(b for _, t in docs for b in features(t, longest, 10_000))
        assert {r["bucket"]: r["n"] for r in bucket_counts(documents(docs), longest).collect()} == want


def test_odd_rows(spark, documents):
    bench = spark.createDataFrame([("many words follow",), (None,)], "text string")
    rows = resample(documents(ODD_TEXTS, extra=True), bench, percent=100, min_words=1).collect()
    want = plain(ODD_TEXTS, ["many words follow", None], 1, 10_000, 100, 1)
    assert got(rows) == want
    assert resample(documents([]), bench).count() == 0
    assert {r["weight"] for r in resample(documents([(1, "a b")]), bench.limit(0)).collect()} == {plain([(1, "a b")], [], 1, 10_000, 10, 20)[0][2]}
