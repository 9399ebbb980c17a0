import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from factloom.operators import publishing
from factloom.operators.breaker import BreakerConfig, breaker_states, latest_states
from factloom.operators.temporal import open_ended
from factloom.sources.surface import current_version, publish_version, read_current, write_surface
from factloom.streaming import changes, stateful

D = dt.datetime


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, p string")
    write_surface(df, path, ["p"])
    write_surface(spark.createDataFrame([(9, "b")], "id int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "id", "p") == [(1, "a"), (9, "b")]


def test_a_version_is_seen_when_it_is_complete(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_current(spark, root) is None
    publish_version(spark.createDataFrame([(1, "old")], "id int, version string"), root, 1)
    with pytest.raises(Exception, match="lost"):
        publish_version(spark.range(1).select(F.raise_error(F.lit("lost")).cast("int").alias("id"), F.lit("new").alias("version")), root, 2)
    assert rows(read_current(spark, root), "id", "version") == [(1, "old")]
    publish_version(spark.createDataFrame([(1, "new")], "id int, version string"), root, 2)
    assert rows(read_current(spark, root), "id", "version") == [(1, "new")] and current_version(spark, root) == 2


def test_gate(spark, tmp_path):
    root = str(tmp_path / "g")
    spec = {"id": "c", "version": "1", "schema": {"columns": [{"name": "k", "nullable": False}]}}
    good = lambda n: spark.createDataFrame([(n,)], "k int")
    bad = spark.createDataFrame([(None,)], "k int")
    config = BreakerConfig(passes_to_close=2)
    start = D(2024, 1, 1)

    def run(df, minutes):
        r = publishing.gated_write(df, spec, root, start + dt.timedelta(minutes=minutes), config).first()
        return r["state"], r["published"], publishing.current_surface(spark, root).first()["k"]

    assert run(good(1), 0) == ("closed", True, 1)
    assert run(bad, 10) == ("open", False, 1)
    assert run(good(2), 20) == ("open", False, 1)
    assert run(good(3), 70) == ("open", False, 1)
    assert run(good(4), 71) == ("half_open", True, 4)
    assert run(good(5), 72) == ("closed", True, 5)


def message(table, entity, version, **rest):
    return json.dumps({"table": table, "entity_id": entity, "source_record": {"updated_at": version, **rest}})


def prepare(batch):
    name = F.get_json_object("source_record", "$.name")
    vector = F.when(name.isNotNull(), F.array(F.length(name).cast("double"), F.lit(1.0)))
    return batch.withColumn("text", name).withColumn("embedding", vector)


def test_parse(spark):
    bodies = [message("t", "1", "2024-01-01"), "{oops", '{"table": "t"}', '{"table": "t", "entity_id": "2"}', None, "[]"]
    parsed = changes.parse_changes(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert [r["problem"] for r in parsed.collect()][:4] == [None, "MALFORMED", "NO_KEY", "NO_RECORD"]
    good, dead = changes.split_changes(parsed)
    assert good.count() == 1 and dead.count() == 5


def test_index_stream(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [message("t", "1", "2024-01-01", name="first"), message("t", "2", "2024-01-05", name="keep"), "{bad"],
        # Redelivered, older than what is indexed, and a real change.
        [message("t", "1", "2024-01-01", name="first"), message("t", "2", "2024-01-02", name="an old one"), message("t", "3", "x", name="n"), message("t", "4", "9", name="nine")],
        [message("t", "1", "2024-01-09", name="a much longer text"), message("t", "1", "2024-01-08", name="between"), message("t", "4", "10", name="ten"), message("t", "6", "1")],
    ]
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("body string").option("maxFilesPerTrigger", 1).json(source)
    for batch in batches:
        spark.createDataFrame([(b,) for b in batch], "body string").coalesce(1).write.mode("append").json(source)
        changes.index_stream(stream, root, str(tmp_path / "cp"), prepare, threshold=0.9999999).awaitTermination()
    want = [("t#1", "a much longer text", "2024-01-09"), ("t#2", "keep", "2024-01-05"), ("t#4", "ten", "10")]
    index = changes.read_index(spark, f"{root}/index")
    assert rows(index, "id", "text", "source_version") == want
    counts = spark.read.parquet(f"{root}/outcomes").agg(F.sum("succeeded"), F.sum("failed")).first()
    assert tuple(counts) == (8, 3)
    assert rows(spark.read.parquet(f"{root}/dead"), "problem") == [("BAD_VERSION",), ("MALFORMED",), ("NO_EMBEDDING",)]
    # A batch that is written again has no second effect, nor has compaction.
    changes.compact_index(spark, f"{root}/index")
    assert rows(changes.read_index(spark, f"{root}/index"), "id", "text", "source_version") == want
    assert len(list((tmp_path / "out" / "index").glob("run=*/batch=*"))) == 1
    # A new checkpoint adds to what is there.
    other = str(tmp_path / "other")
    (tmp_path / "other").mkdir()
    spark.createDataFrame([(message("t", "5", "2024-02-01", name="five"),)], "body string").write.mode("append").json(other)
    again = spark.readStream.schema("body string").json(other)
    changes.index_stream(again, root, str(tmp_path / "new"), prepare).awaitTermination()
    assert rows(changes.read_index(spark, f"{root}/index"), "id", "text", "source_version") == [*want, ("t#5", "five", "2024-02-01")]


def test_redelivery_filter(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [(1, D(2024, 1, 1, 0, 0)), (1, D(2024, 1, 1, 0, 1)), (2, D(2024, 1, 1, 0, 2))]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz")
    df.write.parquet(source)
    unique = changes.without_redelivery(spark.readStream.schema(df.schema).parquet(source), ["id"], "ts")
    query = unique.writeStream.format("memory").queryName("unique_ids").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("unique_ids"), "id") == [(1,), (2,)]


def folder_stream(spark, path, schema):
    path.mkdir(exist_ok=True)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def add(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def all_rows(df):
    return sorted(map(str, df.collect()))


def test_scd2_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path / "out")
    data = [(k, D(2024, 1, 1) + dt.timedelta(days=(k * 7 + i * 11) % 60), i) for k in range(6) for i in range(9)]
    df = spark.createDataFrame(data, "k int, valid_from timestamp_ntz, v int")
    stream = folder_stream(spark, tmp_path / "in", df.schema)
    for third in range(3):
        add(df.filter(F.col("v") % 3 == third), tmp_path / "in")
    stateful.scd2_stream(stream, root, str(tmp_path / "cp")).awaitTermination()
    want = open_ended(df, ["k"], "valid_from", "valid_to")
    assert all_rows(stateful.read_versions(spark, root, ["k"], rows_per_piece=5)) == all_rows(want)
    assert stateful.read_refused(spark, root, ["k"]).count() == 0


def test_scd2_stream_loses_no_change(spark, tmp_path):
    """Conflicts in a batch and between batches, repeats, late changes, NULLs, a replayed batch, a new checkpoint."""
    root, schema = str(tmp_path / "out"), "k int, valid_from timestamp_ntz, v int"
    assert stateful.read_versions(spark, root, ["k"]) is None and stateful.read_refused(spark, root, ["k"]) is None
    day = lambda n: D(2024, 1, n)
    first = [(1, day(5), 20), (1, day(5), 10), (2, day(1), 7), (2, day(1), 7), (None, day(1), 1), (3, None, 3)]
    second = [(1, day(5), 5), (1, day(2), 1), (2, day(1), 7), (2, day(9), None), (None, day(1), 2)]
    third = [(1, day(5), 10), (2, day(9), 8), (4, day(1), 4), (2, day(1), None)]
    stream = folder_stream(spark, tmp_path / "in", schema)
    for batch in (first, second):
        add(spark.createDataFrame(batch, schema), tmp_path / "in")
        stateful.scd2_stream(stream, root, str(tmp_path / "cp")).awaitTermination()
    other = folder_stream(spark, tmp_path / "other", schema)
    add(spark.createDataFrame(third, schema), tmp_path / "other")
    stateful.scd2_stream(other, root, str(tmp_path / "new")).awaitTermination()

    def check():
        versions = {(r["k"], r["valid_from"], r["v"], r["valid_to"]) for r in stateful.read_versions(spark, root, ["k"]).collect()}
        assert versions == {
            (1, day(2), 1, day(5)), (1, day(5), 10, None), (2, day(1), 7, day(9)), (2, day(9), None, None),
            (None, day(1), 1, None), (3, None, 3, None), (4, day(1), 4, None),
        }
        refused = {(r["k"], r["valid_from"], r["v"], r["reason"]) for r in stateful.read_refused(spark, root, ["k"]).collect()}
        assert refused == {
            (1, day(5), 20, "SAME_START"), (1, day(5), 5, "HELD_START"), (None, day(1), 2, "HELD_START"),
            (2, day(9), 8, "HELD_START"), (2, day(1), None, "HELD_START"),
        }
        kept = {v[:3] for v in versions} | {r[:3] for r in refused}
        assert kept == {*first, *second, *third}

    check()
    stateful.compact_versions(spark, root)
    assert len(list((tmp_path / "out").glob("run=*/batch=*"))) == 1
    check()


def test_breaker_stream_over_batches_and_checkpoints(spark, tmp_path):
    schema = "contract_id int, run_id int, at timestamp_ntz, ok boolean"
    data = [(c, n, D(2024, 1, 1) + dt.timedelta(minutes=17 * n), (n * 7 + c) % 5 != 0) for c in range(3) for n in range(40)]
    df, root = spark.createDataFrame(data, schema), str(tmp_path / "out")
    config = BreakerConfig(passes_to_close=2)
    for name, low, high in (("a", 0, 12), ("a", 12, 20), ("b", 20, 33), ("b", 33, 40)):
        stream = folder_stream(spark, tmp_path / name, schema)
        add(df.filter(F.col("run_id").between(low, high - 1)), tmp_path / name)
        stateful.breaker_stream(stream, root, str(tmp_path / f"cp-{name}"), config).awaitTermination()
    want = breaker_states(df, config)
    got = spark.read.parquet(f"{root}/states").drop("run", "batch")
    assert all_rows(got.select(*want.columns)) == all_rows(want)
    last = stateful.read_latest_states(spark, root)
    assert all_rows(last.select(*latest_states(want).columns)) == all_rows(latest_states(want))
