import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import temporal

D = dt.datetime


@pytest.fixture(scope="module")
def current(spark):
    rows = [
        ("a", "A1", D(2020, 1, 1), D(2021, 1, 1), "old", D(2020, 1, 1)),
        ("a", "A2", D(2021, 1, 1), None, "old", D(2021, 1, 1)),
        ("b", "B1", D(2020, 1, 1), D(2020, 6, 1), "old", D(2020, 1, 1)),
        ("b", "B2", D(2021, 1, 1), None, "old", D(2021, 1, 1)),
        ("c", "C1", D(2020, 1, 1), None, "old", D(2020, 1, 1)),
    ]
    return spark.createDataFrame(
        rows, "id string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz, cls string, updated_at timestamp_ntz"
    )


def apply(spark, current, changes, **kw):
    rows = spark.createDataFrame(changes, "id string, name string, valid_from timestamp_ntz")
    out = temporal.scd2_apply(current, rows, ["id"], now="2024-01-01", defaults={"cls": "slow"}, **kw)
    return {(r["id"], r["name"]): r for r in out.collect()}


@pytest.mark.parametrize("size", [1, 1000])
def test_close_and_open(spark, current, size):
    out = apply(spark, current, [("a", "A3", D(2022, 1, 1)), ("new", "N1", D(2022, 1, 1))], rows_per_piece=size)
    assert len(out) == 7
    assert out["a", "A2"]["valid_to"] == D(2022, 1, 1)
    assert out["a", "A2"]["updated_at"] == D(2024, 1, 1)
    assert out["a", "A3"]["valid_to"] is None and out["a", "A3"]["cls"] == "slow"
    assert out["a", "A1"]["updated_at"] == D(2020, 1, 1)
    assert out["new", "N1"]["valid_to"] is None
    assert out["c", "C1"]["updated_at"] == D(2020, 1, 1)


def test_late_change_keeps_gaps_and_never_runs_backwards(spark, current):
    out = apply(spark, current, [("a", "late", D(2020, 6, 1)), ("b", "late", D(2020, 3, 1))])
    assert out["a", "A1"]["valid_to"] == D(2020, 6, 1)
    assert out["a", "late"]["valid_to"] == D(2021, 1, 1)
    assert out["b", "B1"]["valid_to"] == D(2020, 3, 1)
    assert all(r["valid_to"] is None or r["valid_to"] > r["valid_from"] for r in out.values())


def test_untouched_gap_stays(spark, current):
    out = apply(spark, current, [("b", "B3", D(2022, 1, 1))])
    assert out["b", "B1"]["valid_to"] == D(2020, 6, 1)


def test_replay_changes_nothing(spark, current):
    out = apply(spark, current, [("a", "again", D(2021, 1, 1)), ("c", "again", D(2020, 1, 1))])
    assert set(out) == {("a", "A1"), ("a", "A2"), ("b", "B1"), ("b", "B2"), ("c", "C1")}


def test_one_open_version_per_key(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), i, D(2024, 1, 1) + dt.timedelta(hours=rng.randrange(200))) for i in range(200)]
    first = spark.createDataFrame(rows[:80], "id int, name int, valid_from timestamp_ntz")
    first = first.groupBy("id", "valid_from").agg(F.min("name").alias("name"))
    current = temporal.open_ended(first, ["id"], "valid_from", "valid_to")
    changes = spark.createDataFrame(rows[80:], "id int, name int, valid_from timestamp_ntz")
    out = temporal.scd2_apply(current, changes, ["id"], rows_per_piece=10)
    assert out.filter("valid_to IS NULL").groupBy("id").count().filter("count <> 1").isEmpty()
    # At any moment at most one version of a key holds.
    for hour in (0, 50, 120, 300):
        at = D(2024, 1, 1) + dt.timedelta(hours=hour)
        assert temporal.as_of(out, at).groupBy("id").count().filter("count > 1").isEmpty()


def test_interval_ends_are_half_open(current):
    assert {r["name"] for r in temporal.as_of(current, "2021-01-01", {"id": ["a"]}).collect()} == {"A2"}
    assert {r["name"] for r in temporal.as_of(current, "2020-12-31 23:59:59", {"id": ["a"]}).collect()} == {"A1"}
    assert temporal.as_of(current, "2020-06-01", {"id": ["b"]}).isEmpty()


def test_bitemporal(spark):
    rows = [
        ("k", "v1", D(2024, 1, 1), None, D(2024, 1, 1), D(2024, 3, 20)),
        ("k", "v2", D(2024, 1, 1), None, D(2024, 3, 20), None),
        ("k", "v0", D(2023, 1, 1), D(2024, 1, 1), D(2023, 1, 1), None),
    ]
    df = spark.createDataFrame(
        rows,
        "canonical_id string, version_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, "
        "recorded_from timestamp_ntz, recorded_to timestamp_ntz",
    )
    names = lambda x: sorted(r["version_id"] for r in x.collect())
    assert names(temporal.bt_current(df)) == ["v2"]
    assert names(temporal.bt_valid_at(df, "2023-06-01")) == ["v0"]
    assert names(temporal.bt_as_believed(df, "2024-02-01", "2024-03-15")) == ["v1"]
    assert names(temporal.bt_as_believed(df, "2024-02-01", "2024-03-20")) == ["v2"]


def test_correction(spark):
    rows = [("k", D(2024, 1, 1), 10.0, D(2024, 1, 5), None, None), ("k", D(2024, 2, 1), 20.0, D(2024, 2, 5), None, None)]
    schema = (
        "canonical_id string, valid_from timestamp_ntz, value double, recorded_from timestamp_ntz, "
        "recorded_to timestamp_ntz, correction_reason string"
    )
    df = spark.createDataFrame(rows, schema)
    fix = spark.createDataFrame([("k", D(2024, 1, 1), 11.0, D(2024, 3, 1), None, "typo")], schema).drop("recorded_to")
    out = {(r["valid_from"], r["value"]): r for r in temporal.bt_correct(df, fix, ["canonical_id"]).collect()}
    assert out[D(2024, 1, 1), 10.0]["recorded_to"] == D(2024, 3, 1)
    assert out[D(2024, 1, 1), 11.0]["recorded_to"] is None
    assert out[D(2024, 1, 1), 11.0]["correction_reason"] == "typo"
    assert out[D(2024, 2, 1), 20.0]["recorded_to"] is None


@pytest.mark.parametrize("size", [5, 1000])
def test_asof_join_with_a_hot_key(spark, size):
    rng = random.Random(4)
    start = D(2024, 1, 1)
    facts, events = [], []
    for key in range(4):
        at = start + dt.timedelta(hours=5)
        for i in range(60 if key == 0 else 3):
            end = at + dt.timedelta(hours=rng.randrange(1, 9))
            facts.append((key, at, None if (key, i) in ((0, 59), (1, 2)) else end, f"{key}-{i}"))
            at = end + dt.timedelta(hours=rng.choice([0, 0, 3]))
        events += [(key, i, start + dt.timedelta(hours=rng.randrange(0, 400))) for i in range(90 if key == 0 else 5)]
    f = spark.createDataFrame(facts, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    e = spark.createDataFrame(events, "k int, id int, ts timestamp_ntz")
    got = temporal.asof_join(e, f, ["k"], "ts", ["id"], ["name"], rows_per_piece=size)
    for r in got.collect():
        hits = [n for k, a, b, n in facts if k == r["k"] and a <= r["ts"] and (b is None or b > r["ts"])]
        assert r["fact_name"] == (hits[0] if hits else None)
    assert got.count() == len(events)


def test_snapshots_keep_only_changes(spark):
    rows = [("x", dt.date(2024, 1, d), v, w) for d, v, w in [(1, "a", 1), (2, "a", 1), (3, None, 1), (4, None, 1), (5, "a", 2)]]
    df = spark.createDataFrame(rows, "id string, snapshot_date date, v string, w int")
    out = temporal.snapshots_to_scd2(df, ["id"], ["v", "w"]).orderBy("valid_from").collect()
    assert [(r["v"], r["w"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in out] == [
        ("a", 1, 1, 3),
        (None, 1, 3, 5),
        ("a", 2, 5, None),
    ]


def test_event_store_issues(spark):
    at = D(2024, 1, 1)
    rows = [("e1", "s", 1, at, at), ("e2", "s", 2, at, at), ("e2", "s", 5, at, at), ("e4", "s", 5, at, D(2023, 1, 1))]
    df = spark.createDataFrame(
        rows, "event_id string, stream_id string, sequence_no long, occurred_at timestamp_ntz, recorded_at timestamp_ntz"
    )
    got = {(r["issue"], r["stream_id"], r["sequence_no"], r["event_id"]) for r in temporal.event_store_issues(df).collect()}
    assert got == {
        ("DUPLICATE_EVENT_ID", None, None, "e2"),
        ("DUPLICATE_SEQUENCE", "s", 5, None),
        ("GAP_AFTER", "s", 2, None),
        ("RECORDED_BEFORE_OCCURRED", "s", 5, "e4"),
    }


def test_event_state_as_recorded(spark):
    rows = [("s", 1, "open", "{}", D(2024, 1, 1), D(2024, 1, 1)), ("s", 2, "shut", "{}", D(2024, 1, 2), D(2024, 1, 9))]
    df = spark.createDataFrame(
        rows,
        "stream_id string, sequence_no long, event_type string, event_data string, occurred_at timestamp_ntz, recorded_at timestamp_ntz",
    )
    assert temporal.event_state(df).first()["event_type"] == "shut"
    assert temporal.event_state(df, "2024-01-05").first()["event_type"] == "open"


def test_refused_changes_are_those_that_say_something_else(spark):
    kind = "id int, valid_from string, v int, valid_to string"
    current = spark.createDataFrame([(1, "2024-01-01", 5, None), (2, "2024-01-01", 7, None)], kind)
    changes = spark.createDataFrame(
        [(1, "2024-01-01", 5), (1, "2024-01-01", 6), (1, "2024-02-01", 9), (1, "2024-02-01", 8), (1, "2024-02-01", 8), (3, "2024-01-01", None)],
        "id int, valid_from string, v int",
    )
    got = {tuple(r) for r in temporal.refused_changes(current, changes, ["id"]).collect()}
    assert got == {(1, "2024-01-01", 6, "HELD_START"), (1, "2024-02-01", 9, "SAME_START")}


def test_complete_snapshots_close_keys_that_are_gone(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("b", 1, 5), ("b", 2, 5), ("a", 3, 5), ("b", 3, 6)], "id string, snapshot_date int, v int"
    )
    got = {tuple(r) for r in temporal.snapshots_to_scd2(df, ["id"], ["v"], complete=True).collect()}
    assert got == {("a", 1, 5, 2), ("a", 3, 5, None), ("b", 1, 5, 3), ("b", 3, 6, None)}
