"""Two-time lookups against every version of the key, on times of all grains and overlapping versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from factloom.operators.bitemporal import bt_asof, interval_nodes, point_nodes

D = dt.datetime(2024, 1, 1)


def test_a_point_lies_in_one_node_of_its_intervals(spark):
    rows = spark.createDataFrame([(a, b) for a in range(17) for b in range(a, 18)], "a long, b long").withColumn("nodes", interval_nodes(F.col("a"), F.col("b"), 5))
    points = {r["p"]: {tuple(n) for n in r["nodes"]} for r in spark.range(18).select(F.col("id").alias("p"), point_nodes(F.col("id"), 5).alias("nodes")).collect()}
    for r in rows.collect():
        nodes = {tuple(n) for n in r["nodes"]}
        assert len(nodes) == len(r["nodes"]) <= 10
        for p, mine in points.items():
            assert len(mine & nodes) == (r["a"] <= p < r["b"])


def believed(versions, key, valid_at, known_at):
    held = [v for v in versions if v[0] == key and v[4] <= known_at and (v[5] is None or known_at < v[5]) and v[2] <= valid_at]
    best = max(held, key=lambda v: (v[2], v[4], v[1]), default=None)
    return best if best and (best[3] is None or best[3] > valid_at) else None


@pytest.mark.parametrize(("grain", "pieces"), [(dt.timedelta(days=1), 2_000), (dt.timedelta(seconds=7), 2_000), (dt.timedelta(microseconds=13), 5)])
def test_against_every_version(spark, grain, pieces):
    chance = random.Random(str(grain))
    at = lambda low=0: D + grain * chance.randint(low, 60)

    def stop(start):
        return None if chance.random() < 0.3 else start + grain * chance.randint(0, 30)

    versions = []
    for n in range(150):
        valid, recorded = at(), at()
        versions.append((chance.choice("aab"), f"v{n}", valid, stop(valid), recorded, stop(recorded), n))
    # Between the grain of the recorded times too, and before and after all of them.
    asked = [(n, chance.choice("aabc"), at(-20), at(-20) + grain / 2 * chance.randint(0, 1)) for n in range(250)]
    odd = [(900, None, D, D), (901, "a", None, D), (902, "a", D, None), (903, "a", D + grain * 10, D + grain * 10_000), (903, "a", D + grain * 10, D + grain * 10_000)]
    kind = "k string, version_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, recorded_from timestamp_ntz, recorded_to timestamp_ntz, v int"
    table = spark.createDataFrame([*versions, (None, "x", D, None, D, None, 1), ("a", "y", None, None, D, None, 1), ("a", "z", D, None, None, None, 1)], kind)
    requests = spark.createDataFrame(asked + odd, "id int, k string, valid_at timestamp_ntz, known_at timestamp_ntz")
    found = bt_asof(requests, table, ["k"], ["v", "version_id"], ["version_id"], rows_per_piece=pieces)
    got = sorted((r["id"], r["version_v"], r["version_version_id"]) for r in found.collect())
    want = []
    for n, key, valid_at, known_at in asked + odd:
        best = None if None in (key, valid_at, known_at) else believed(versions, key, valid_at, known_at)
        want.append((n, best[6], best[1]) if best else (n, None, None))
    assert got == sorted(want, key=str) or sorted(map(str, got)) == sorted(map(str, want))
    assert sum(w[1] is not None for w in want) > 40


def test_empty_tables_and_no_range_join(spark, capsys):
    kind = "k int, version_id int, valid_from timestamp_ntz, valid_to timestamp_ntz, recorded_from timestamp_ntz, recorded_to timestamp_ntz"
    requests = spark.createDataFrame([(1, D, D)], "k int, valid_at timestamp_ntz, known_at timestamp_ntz")
    none = bt_asof(requests, spark.createDataFrame([], kind), ["k"], [], ["version_id"])
    assert [tuple(r) for r in none.collect()] == [(1, D, D, None)]
    one = spark.createDataFrame([(1, 1, D, None, D, None)], kind)
    assert bt_asof(requests.limit(0), one, ["k"], [], ["version_id"]).count() == 0
    found = bt_asof(requests, one, ["k"], [], ["version_id"])
    assert found.first()["version_valid_from"] == D
    capsys.readouterr()
    found.explain()
    assert "NestedLoop" not in capsys.readouterr().out
