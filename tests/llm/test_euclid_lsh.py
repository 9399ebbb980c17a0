"""Links, counts and components against all pairs."""

import math

import numpy as np

from factloom.llm.euclid_lsh import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    ids = [r[0] for r in rows]
    usable = [bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.float64(np.float32(v)) / np.linalg.norm(np.float64(np.float32(v))) if u else None for (_, v), u in zip(rows, usable, strict=True)]
    n = len(rows)
    near = [[i != j and usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9 for j in range(n)] for i in range(n)]
    least = list(range(n))
    label = [ids[i] for i in range(n)]
    for _ in least:
        label = [min([label[i], *(label[j] for j in range(n) if near[i][j])]) for i in range(n)]
    return {ids[i]: (sum(near[i]), label[i]) for i in range(n)}


def made(seed, groups, each, size=32, spread=0.05):
    chance = np.random.default_rng(seed)
    centres = chance.standard_normal((groups, size))
    vectors = [(c + spread * np.sqrt(size) * 0.2 * chance.standard_normal(size)).astype(np.float32).tolist() for c in centres for _ in range(each)]
    return list(enumerate(vectors))


def test_against_all_pairs(spark):
    rows = made(1, 12, 6) + [(1000 + k, v) for k, v in made(2, 20, 1)]
    rows += [(2000 + k, rows[0][1]) for k in range(30)]  # equal copies
    want = plain(rows)
    for block in (512, 8):  # one block a bucket, and buckets of several blocks
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(5), block=block).collect()}
        assert got == want


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, None])]
    rows += [(8, [float("inf"), 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e30, 0.0]), (11, [1e-30, 0.0]), (2, [2.0, 0.1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).selectExpr("*", "1 AS same", "2 AS number", "3 AS keys", "4 AS n_links")
    got = near_vectors(df).collect()
    assert len(got) == len(rows)
    by_id = {r["vec_id"]: r for r in got}
    assert all(by_id[k]["n_links"] == 4 and by_id[k]["component_id"] == 1 for k in (1, 2, 10, 11))
    assert all((by_id[k]["n_links"], by_id[k]["component_id"], by_id[k]["kept"]) == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9))
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = near_vectors(spark.createDataFrame([(None, [1.0], 0)], SCHEMA)).first()
    assert (alone["n_links"], alone["component_id"], alone["kept"]) == (0, None, False)
