"""Cutting a hot key into pieces must never change a result."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.operators.temporal import bt_correct
from factloom.plans import sequence
from factloom.plans.sequence import carried_forward, in_pieces, measure, numbered, with_neighbour

PIECE_SIZES = [1, 7, 50, 10_000]


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows have one key; times repeat, and one lies far off."""
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(600):
        key = 0 if i % 2 else rng.randrange(1, 40)
        at = base + dt.timedelta(minutes=rng.randrange(0, 3000))
        data.append((key if i % 31 else None, at, i, rng.choice([None, i])))
    data.append((0, dt.datetime(2030, 1, 1), 9999, None))
    data.append((0, None, 10000, 5))
    return spark.createDataFrame(data, "k int, at timestamp_ntz, id int, v int").cache()


def as_set(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", PIECE_SIZES)
@pytest.mark.parametrize("previous", [False, True])
def test_neighbour(rows, size, previous):
    shift = F.lag if previous else F.lead
    w = Window.partitionBy("k").orderBy("at", "id")
    want = rows.withColumn("n_id", shift("id").over(w)).withColumn("n_v", shift("v").over(w))
    got = with_neighbour(
        rows, ["k"], ["at", "id"], {"n_id": "id", "n_v": "v"}, previous=previous, rows_per_piece=size
    )
    assert as_set(got) == as_set(want)


@pytest.mark.parametrize("size", PIECE_SIZES)
def test_carried_forward(rows, size):
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert as_set(carried_forward(rows, ["k"], ["at", "id"], "v", rows_per_piece=size)) == as_set(want)


@pytest.mark.parametrize("size", PIECE_SIZES)
def test_numbered(rows, size):
    w = Window.partitionBy("k").orderBy("at", "id")
    want = rows.withColumn("n", F.row_number().over(w).cast("long"))
    assert as_set(numbered(rows, ["k"], ["at", "id"], "n", rows_per_piece=size)) == as_set(want)


@pytest.mark.parametrize("kind", ["timestamp", "date", "long", "double"])
def test_other_order_types(rows, kind):
    place = F.unix_micros(F.col("at").cast("timestamp"))
    at = place.cast(kind) if kind in ("long", "double") else F.col("at").cast(kind)
    typed = rows.withColumn("at", at)
    w = Window.partitionBy("k").orderBy("at", "id")
    want = typed.withColumn("n", F.lead("id").over(w))
    got = with_neighbour(typed, ["k"], ["at", "id"], {"n": "id"}, rows_per_piece=20)
    assert as_set(got) == as_set(want)


def test_hot_key_is_cut_and_others_are_not(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN 0 ELSE id END AS k", "id AS at")
    cuts = measure(rows, ["k"], "at", 100)
    assert cuts.hot is not None
    pieces = in_pieces(rows, ["k"], "at", cuts)
    sizes = pieces.filter("k = 0").groupBy("_piece").count().collect()
    assert len(sizes) == 9
    assert max(r["count"] for r in sizes) <= 110
    assert pieces.filter("k <> 0 AND (_piece <> 0 OR _pieces IS NOT NULL)").isEmpty()


def test_no_hot_key_means_a_plain_window(spark):
    rows = spark.range(100).selectExpr("id % 10 AS k", "id AS at")
    cuts = measure(rows, ["k"], "at", 10)
    pieces = in_pieces(rows, ["k"], "at", cuts)
    assert cuts.hot is None and pieces.filter("_piece <> 0").isEmpty()


def test_outliers_and_busy_periods_do_not_fill_one_piece(spark):
    busy = "CASE WHEN id = 0 THEN -1e15 WHEN id = 1 THEN 1e15 WHEN id < 9000 THEN id / 1e6 ELSE id END"
    rows = spark.range(10_000).selectExpr("1 AS k", f"CAST({busy} AS DOUBLE) AS at", "id")
    pieces = in_pieces(rows, ["k"], "at", measure(rows, ["k"], "at", 500))
    assert max(r["count"] for r in pieces.groupBy("_piece").count().collect()) < 1200
    got = with_neighbour(rows, ["k"], ["at", "id"], {"n": "id"}, rows_per_piece=500)
    want = rows.withColumn("n", F.lead("id").over(Window.partitionBy("k").orderBy("at", "id")))
    assert as_set(got) == as_set(want)


def test_many_hot_keys(spark):
    rows = spark.range(1000).selectExpr("id % 10 AS k", "id AS at")
    want = rows.withColumn("n", F.lead("at").over(Window.partitionBy("k").orderBy("at")))
    assert as_set(with_neighbour(rows, ["k"], ["at"], {"n": "at"}, rows_per_piece=7)) == as_set(want)


def test_keys_are_counted_one_by_one_only_in_full_buckets(spark, monkeypatch):
    counted, plainly = [], sequence.hot_keys

    def watched(df, *rest):
        counted.append({r["k"] for r in df.select("k").distinct().collect()})
        return plainly(df, *rest)

    monkeypatch.setattr(sequence, "hot_keys", watched)
    even = spark.range(3000).selectExpr("id % 1000 AS k", "id AS at")
    assert measure(even, ["k"], "at", 1000).hot is None and not counted
    uneven = even.unionByName(spark.range(2000).selectExpr("CAST(IF(id % 2 = 0, 5, NULL) AS LONG) AS k", "id AS at"))
    assert {r["k"] for r in measure(uneven, ["k"], "at", 900).hot.collect()} == {5, None}
    assert len(counted) == 1 and {5, None} <= counted[0] and len(counted[0]) < 20


@pytest.mark.parametrize("buckets", [1, 16_384])
@pytest.mark.parametrize("size", PIECE_SIZES)
def test_corrections_whatever_the_pieces(spark, monkeypatch, size, buckets):
    """One key with most rows, NULL keys, repeated rows; keys without a correction stay as they are."""
    monkeypatch.setattr(sequence, "KEY_BUCKETS", buckets)
    rng = random.Random(9)
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    held = [(rng.choice([1, 1, 1, 2, 3, None]), at(rng.randrange(2)), i, at(rng.randrange(80)), None, None) for i in range(150)]
    fixes = [(rng.choice([1, 1, 1, 2, 4, None]), at(rng.randrange(2)), i, at(rng.randrange(80)), "typo") for i in range(200, 350)]
    kind = "k int, valid_from timestamp_ntz, v int, recorded_from timestamp_ntz"
    df = spark.createDataFrame(held, f"{kind}, recorded_to timestamp_ntz, reason string")
    got = bt_correct(df, spark.createDataFrame([*fixes, *fixes[:40]], f"{kind}, reason string"), ["k"], rows_per_piece=size)

    named = {f[:2] for f in fixes}
    want = [h for h in held if h[0] is None or h[:2] not in named]
    for key in named:
        first = {}
        for r in sorted(f for f in fixes if f[:2] == key):
            first.setdefault(r[3], (*r[:4], r[4]))
        for r in sorted((h for h in held if h[:2] == key and key[0] is not None), reverse=True):
            first[r[3]] = (*r[:4], None)
        starts = sorted(first)
        want += [(*first[s][:4], after, first[s][4]) for s, after in zip(starts, [*starts[1:], None])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
