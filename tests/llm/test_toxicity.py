"""Non-negative PU learning: what it learns, its gradient's sign, and odd rows."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from factloom.llm.toxicity import OFTEN, PLACES, Model, fit, score, train, word_places
from tests.llm.conftest import ODD_TEXTS

CLEAN = ["river", "winter", "table", "paper", "garden", "letter", "music", "window"]
RUDE = ["grobian", "lumpenhund", "schuft"]


def made(n, seed):
    chance = random.Random(seed)
    rows = []
    for k in range(n):
        toxic = int(k % 5 == 0)
        words = [chance.choice(CLEAN) for _ in range(chance.randint(5, 40))]
        if toxic:
            words += chance.sample(RUDE, 2)
        chance.shuffle(words)
        rows.append((k, " ".join(words).capitalize() + ".", toxic))
    return rows


def test_held_out_texts(spark, documents):
    rows = made(600, 12)
    docs = documents([r[:2] for r in rows], extra=True)
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows if r[0] % 2 == 0], "doc_id long, quality int, toxic int")
    model = train(docs, labels, F.col("doc_id") % 3 != 1)
    got = {r["doc_id"]: r for r in score(docs, model).collect()}
    wrong = [k for k, _, toxic in rows if got[k]["predicted"] != toxic]
    assert len(wrong) < 6
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_places_count_words_and_what_is_there_often():
    one, rows, n = word_places(pa.array(["abc Abc, x", None, "abc " * OFTEN]))
    assert n == 3 and rows.tolist() == [0, 0, 2, 2]
    assert (one[:2] < PLACES).all() and one[3] == one[2] + PLACES


def test_risk_stays_non_negative():
    """Toxic texts are told apart, and the estimate of the clean risk is not driven below zero."""
    toxic, unlabelled = [np.array([1])] * 50, [np.array([1])] * 15 + [np.array([2])] * 35
    model = fit(toxic, unlabelled, 0.3)
    at = {k: model.bias + model.weights[k] for k in (1, 2)}
    clean = 0.3 * np.logaddexp(0, at[1]) + 0.7 * np.logaddexp(0, at[2]) - 0.3 * np.logaddexp(0, at[1])
    assert at[1] > 1 and at[2] < -1 and clean >= 0


def test_odd_rows(spark, documents):
    docs = documents(ODD_TEXTS, extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(1, 0, 1), (6, 0, 0), (None, 0, 1), (7, 0, None)], none.schema)):
        rows = score(docs, train(docs, labels, F.lit(True))).collect()
        assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    labels = spark.createDataFrame([(6, 0, 1), (6, 0, 1), (8, 0, 0), (4, 0, 0)], none.schema)
    rows = score(docs, train(docs, labels, F.lit(True))).collect()
    assert {r["doc_id"]: r["score"] for r in rows}[6] > {r["doc_id"]: r["score"] for r in rows}[8]
    empty = documents([])
    assert score(empty, train(empty, labels, F.lit(True))).count() == 0
    assert Model(np.zeros(2 * PLACES), 0.0).scores(pa.array([None, ""])).tolist() == [0.5, 0.5]
