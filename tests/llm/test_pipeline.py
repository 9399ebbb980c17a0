"""The pipeline's stages, each on its own input, against plain versions; the registered queries."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from factloom.llm.bpe import load
from factloom.llm.queries import ORACLES, QUERIES
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_names():
    assert list(STAGES) == ["language", "near_copies", "benchmark", "secrets", "packing"]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_language_stage_drops_what_has_no_language(spark, given):
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34 !", None, None, 7)], given.schema)
    kept = STAGES["language"](spark, given.unionByName(odd), SF)
    assert kept.columns == given.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in given.collect()}


def test_near_copies_stage_keeps_one_of_each_group(spark, given):
    rows = given.collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    linked = plain_components(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 3)
    kept = STAGES["near_copies"](spark, given, SF)
    assert kept.columns == given.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in linked.items() if k == v)


def test_near_copies_stage_with_missing_and_repeated_ids(spark, given):
    def text(k):
        return " ".join(random.Random(k).choices([f"{a}{b}" for a in "bdfgk" for b in "aeiou"], k=60))

    ids = [(None, 1), (None, 1), (None, 2), (5, 3), (5, 3), (4, 4), (5, 4), (None, 5), (9, 5), (7, 6), (7, 7)]
    docs = spark.createDataFrame([(k, text(t), "en", f"row {n}", 0) for n, (k, t) in enumerate(ids)], given.schema).coalesce(1)
    kept = STAGES["near_copies"](spark, docs, SF)
    assert kept.columns == given.columns
    got = {(r["doc_id"], r["text"], r["source"]) for r in kept.collect()}
    first = [(0, None, 1), (2, None, 2), (3, 5, 3), (5, 4, 4), (8, 9, 5), (9, 7, 6), (10, 7, 7)]
    assert got == {(k, text(t), f"row {n}") for n, k, t in first}
    assert kept.count() == len(first)


def test_benchmark_stage_decides_about_rows_without_id(spark, given):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = spark.createDataFrame([(None, item, "en", "s", 0), (None, "clean words", "en", "s", 0), (3, item, "en", "s", 0), (3, "others", "en", "s", 0), (4, None, "en", "s", 0)], given.schema)
    kept = STAGES["benchmark"](spark, docs, SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, "clean words"), (3, "others"), (4, "")]


def test_benchmark_stage_drops_what_holds_a_passage(spark, given):
    def plain(text):
        return " ".join(re.findall(r"\w+", text.lower()))

    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in given.collect() if any(i in plain(r["text"]) for i in items)}
    kept = {r["doc_id"] for r in STAGES["benchmark"](spark, given, SF).collect()}
    everything = {r["doc_id"] for r in given.collect()}
    assert held and kept == everything - held


def test_secrets_stage_masks_and_keeps_all(spark, given):
    secret = re.compile(r'(?<=token = ")[0-9a-fA-F]{40}(?=")', re.I)
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    rows = STAGES["secrets"](spark, given, SF)
    assert rows.schema == given.schema or rows.columns == given.columns
    got = {r["doc_id"]: r for r in rows.collect()}
    assert set(got) == set(texts)
    for k, text in texts.items():
        assert got[k]["n_chars"] == len(got[k]["text"])
        if not re.search("token", text, re.I):
            assert got[k]["text"] == text
        assert not secret.search(got[k]["text"])


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = {r["doc_id"] for r in rows}
    assert whole < set(docs)
    library = load(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id in random.Random(1).sample(sorted(k for k in whole if "token" not in docs[k].lower()), 20):
        ids = np.array([*library.encode(docs[doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == doc_id)
        assert [p[2] for p in pieces] == [zlib.crc32(ids[a : a + n].tobytes()) for a, n, _ in pieces]
        assert sum(p[1] for p in pieces) == len(ids)


def test_empty_table(spark, given):
    docs = given.limit(0)
    for stage in STAGES.values():
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
