"""Steps whose cost has to grow with the input and not with pairs, and that send no table to the driver."""

import random

from pyspark.sql import functions as F

from factloom.operators import access, bitemporal
from factloom.operators.access import column_access_matrix, visible_counts
from factloom.operators.bitemporal import bt_asof
from factloom.operators.governance import lineage_trace
from factloom.operators.graph import validate_extractions


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_the_matrix_of_columns_comes_out_of_its_join(spark):
    sens = [("t", "a", "INTERNAL", ["x", "y", None]), ("t", "a", "INTERNAL", ["z"]), ("t", "b", "PUBLIC", ["x"]), ("t", "c", "SECRET", None), (None, "d", "SECRET", ["y"])]
    grants = [(1, "x"), (1, "y"), (1, "x"), (2, "z"), (3, None), (None, "y"), (4, "w")]
    got = column_access_matrix(
        spark.createDataFrame(sens, "table_name string, column_name string, classification string, access_roles array<string>"),
        spark.createDataFrame(grants, "user_id int, role string"),
    )
    want = [(1, "t", "a"), (1, None, "d"), (2, "t", "a"), (None, "t", "a"), (None, None, "d")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    operators = got._jdf.queryExecution().optimizedPlan().toString()
    assert operators.index("Join") < operators.index("Aggregate")


def test_only_users_of_several_profiles_meet_combinations(spark, monkeypatch):
    met = []
    plainly = access._user_combinations

    def watched(df, users):
        met.extend(r["user_id"] for r in users.collect())
        return plainly(df, users)

    monkeypatch.setattr(access, "_user_combinations", watched)
    chance = random.Random(5)
    roles = [None, [], ["s"], ["s", "f"], ["f", None, "f"]]
    rows = [(chance.choice([None, 0, 1, 2]), chance.choice([None, "A", "B"]), chance.choice(roles)) for _ in range(300)]
    users = [(u, t, r) for u, (t, r) in enumerate([("A", "s"), ("B", None), (None, "f"), (None, None), ("C", "x"), ("A", "f")])]
    users += [(2, "B", "s"), (0, "A", "s"), (None, "A", "s")]
    got = visible_counts(
        spark.createDataFrame(rows, "assigned_manager_id int, territory_code string, visibility_roles array<string>"),
        spark.createDataFrame(users, "user_id int, territory string, role string"),
    ).collect()

    def sees(user, row):
        same = [u for u in users if u[0] == user and user is not None]
        return any(u == row[0] or (t is not None and t == row[1]) or (r is not None and r in (row[2] or [])) for u, t, r in same)

    assert sorted(map(tuple, got), key=str) == sorted([(u, sum(sees(u, row) for row in rows)) for u, _, _ in users], key=str)
    assert set(met) == {2}


def test_entities_are_not_sent_to_the_driver(spark):
    entities = spark.createDataFrame([(1, "a", "Event")], "reply_id int, id string, type string")
    links = spark.createDataFrame([(1, "a", "involves", "a", 0.9), (1, "a", "involves", "b", 0.9)], "reply_id int, subject_id string, predicate string, object_id string, confidence double")
    checked = validate_extractions(entities, links)[1]
    assert "Broadcast" not in plan(checked)
    assert sorted(r["problem"] or "" for r in checked.collect()) == ["", "UNKNOWN_OBJECT"]


def test_lineage_is_not_sent_to_the_driver(spark):
    names = "target_table string, target_column string, source_table string, source_column string, transform_type string, transform_pipeline string, pipeline_version string, source_system string"
    lineage = spark.createDataFrame([("t", f"c{k}", "t", f"c{k + 1}", "copy", "p", "1", None) for k in range(4)], names)
    traced = lineage_trace(lineage, direction="down")
    assert "Broadcast" not in plan(traced)
    assert traced.count() == 4 + 3 + 2 + 1


def test_requests_of_small_keys_need_no_nodes(spark, monkeypatch):
    chance = random.Random(8)
    day = lambda n: f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"
    versions = []
    for n in range(120):
        low, known = chance.randrange(100), chance.randrange(100)
        versions.append((chance.randrange(6), n, day(low), chance.choice([None, day(low + 30)]), day(known), chance.choice([None, day(known + 40)])))
    versions.append((None, 900, day(1), None, day(1), None))
    times = ("valid_from", "valid_to", "recorded_from", "recorded_to")
    versions = spark.createDataFrame(versions, "k int, id int, valid_from string, valid_to string, recorded_from string, recorded_to string")
    versions = versions.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})
    asked = [(chance.randrange(7), day(chance.randrange(140)), day(chance.randrange(140))) for _ in range(150)] + [(None, day(3), day(3)), (1, None, day(3))]
    asked = spark.createDataFrame(asked, "k int, valid_at string, known_at string")
    asked = asked.select("k", *[F.col(t).cast("timestamp_ntz").alias(t) for t in ("valid_at", "known_at")])
    by_nodes = bt_asof(asked, versions, ["k"], ["id"], ["id"], rows_per_piece=1).collect()

    def never(*_, **__):
        raise AssertionError("nodes")

    monkeypatch.setattr(bitemporal, "carried_forward", never)
    by_pairs = bt_asof(asked, versions, ["k"], ["id"], ["id"]).collect()
    assert sorted(map(str, by_pairs)) == sorted(map(str, by_nodes)) and any(r["version_id"] is not None for r in by_pairs)
