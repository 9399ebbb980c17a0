"""The queries op12 and op13 over whole given tables, against plain versions."""

import hashlib
import zlib

import numpy as np

from factloom.llm.queries import QUERIES
from tests.llm.test_periodic import collapsed, plain_words
from tests.llm.test_resampling import plain

SF = "/root/testdata/sf0.001"


def test_op12(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = QUERIES["op12_resampling"](spark, SF).collect()
    assert sorted((tuple(r) for r in rows), key=str) == plain(docs, bench, 1, 10_000, 10, 20)


def all_runs(words):
    codes, found = np.unique(np.array(words, object), return_inverse=True)[1] if words else np.zeros(0, int), []
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for low, high in zip(edges[::2].tolist(), (edges[1::2] + q).tolist(), strict=True):
            part = codes[low:high]
            if high - low >= max(6, 4 * q) and not any(np.array_equal(part[:-d], part[d:]) for d in range(1, q)):
                found.append((low, high - low, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_op13(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows) > 5
    for r in rows:
        words = plain_words(docs[r["doc_id"]])
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = all_runs(words)
        best = min(found, key=lambda f: (-f[1], f[0], f[2]), default=None)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(found), *want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
