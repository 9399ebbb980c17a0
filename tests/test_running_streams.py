"""Windows and last-seen state over several batches, restarts and new checkpoints."""

import datetime as dt
import json
import random

import numpy as np
from pyspark.sql import functions as F

from factloom.streaming import changes, seen, windows
from tests.test_storage_streams import add, all_rows, folder_stream

D = dt.datetime(2024, 1, 1)
EVENTS = "id int, kind string, at timestamp, succeeded boolean, n int"


def made(chance, count, low, high):
    return [(chance.randint(0, 10**6), chance.choice("ab"), D + dt.timedelta(seconds=chance.randint(low, high)), chance.choice([True, True, False, None]), k) for k in range(count)]


def test_windows_and_late_rows_add_up(spark, tmp_path):
    chance, root = random.Random(1), str(tmp_path / "out")
    batches = [made(chance, 60, 0, 9_000), made(chance, 60, 5_000, 20_000) + [(1, "a", None, True, 0)], made(chance, 60, 0, 30_000), made(chance, 60, 25_000, 40_000)]
    stream = folder_stream(spark, tmp_path / "in", EVENTS)
    timed = folder_stream(spark, tmp_path / "native", EVENTS).withWatermark("at", "30 minutes").groupBy(F.window("at", "1 hour"), "kind")
    timed = timed.agg(F.count("*").alias("n"), F.count(F.when(~F.coalesce("succeeded", F.lit(False)), 1)).alias("f")).select("window.start", "kind", "n", "f")
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, EVENTS)
        if number == 3:  # the last one comes with a new checkpoint
            stream = folder_stream(spark, tmp_path / "more", EVENTS)
        add(df, tmp_path / ("more" if number == 3 else "in"))
        add(df, tmp_path / "native")
        progress = str(tmp_path / ("new" if number == 3 else "cp"))
        windows.failure_rate_stream(stream, root, progress, "at", ["kind"], 3_600, 1_800).awaitTermination()
        sink = timed.writeStream.format("parquet").option("path", str(tmp_path / "own")).option("checkpointLocation", str(tmp_path / "cp-own"))
        sink.trigger(availableNow=True).start().awaitTermination()
    want, late, mark = {}, [], None
    for batch in batches:
        for row in batch:
            start = None if row[2] is None else row[2].replace(minute=0, second=0)
            if start is None or (mark is not None and start + dt.timedelta(hours=1) <= mark):
                late.append(row)
                continue
            old = want.get((start, row[1]), (0, 0))
            want[start, row[1]] = (old[0] + 1, old[1] + (not row[3]))
        mark = max([r[2] for r in batch if r[2]] + ([mark + dt.timedelta(minutes=30)] if mark else [])) - dt.timedelta(minutes=30)
    found = windows.read_failure_rates(spark, root, ["kind"], 3_600, 1_800).collect()
    assert {(r["window_start"], r["kind"]): (r["attempts"], r["failures"]) for r in found} == want
    assert all(r["closed"] == (r["window_start"] + dt.timedelta(hours=1) <= mark) and r["breach"] == (r["failures"] > 0) for r in found)
    left = windows.read_late(spark, root)
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, late))
    assert len(late) > 5 and sum(r["attempts"] for r in found) + left.count() == sum(map(len, batches))
    # Spark's own windows over the same batches, for those that its watermark closes.
    own = {(r["start"], r["kind"]): (r["n"], r["f"]) for r in spark.read.parquet(str(tmp_path / "own")).collect()}
    assert len(own) > 8 and own == {k: v for k, v in want.items() if k[0] + dt.timedelta(hours=1) <= mark}


def test_a_replayed_batch_counts_once_and_freshness(spark, tmp_path, monkeypatch):
    root, kind = str(tmp_path / "out"), "seen timestamp_ntz, changed timestamp_ntz"
    minute = dt.timedelta(minutes=1)
    rows = [(D + n * minute, D + n * minute - lag * minute) for n, lag in ((0, 10), (5, 50), (59, 30), (61, 100))] + [(D, None)]
    stream = folder_stream(spark, tmp_path / "in", kind)
    add(spark.createDataFrame(rows, kind), tmp_path / "in")
    assert windows.read_freshness(spark, root) is None and windows.read_late(spark, root) is None
    whole, fails = windows.append_delta, [True]

    def breaks(df, path, run, number):
        whole(df, path, run, number)
        if path.endswith("windows") and fails.pop():
            raise RuntimeError("lost")

    monkeypatch.setattr(windows, "append_delta", breaks)
    for _ in range(2):
        fails.append(len(fails) == 1)
        try:
            windows.freshness_stream(stream, root, str(tmp_path / "cp"), "changed", "seen", 40).awaitTermination()
        except Exception as error:  # noqa: BLE001
            assert "lost" in str(error)
    got = [tuple(r) for r in windows.read_freshness(spark, root).orderBy("window_start").collect()]
    assert got == [(D, 4, 22.5, 1, 25.0, False), (D + 60 * minute, 1, 100.0, 1, 100.0, False)]


def message(entity, version, text):
    return json.dumps({"table": "t", "entity_id": entity, "source_record": {"updated_at": version, "name": text}})


def prepare(batch):
    name = F.get_json_object("source_record", "$.name")
    return batch.withColumn("text", name).withColumn("embedding", F.transform(F.split(name, ""), lambda c: F.ascii(c).cast("double")))


def fold(batches, threshold):
    state, out = {}, []
    for batch in batches:
        newest = {}
        for entity, version, text in batch:
            newest[entity] = max(newest.get(entity, (-1, "")), (version, text))
        for entity, (version, text) in newest.items():
            vector = np.array([ord(c) for c in text], float)
            if entity not in state:
                state[entity] = [version, text, vector]
                out.append((entity, str(version), text))
                continue
            old = state[entity]
            if version < old[0]:
                continue
            old[0] = version
            near = len(vector) == len(old[2]) and vector @ old[2] / np.sqrt(vector @ vector) / np.sqrt(old[2] @ old[2])
            if text != old[1] and not (near and near >= threshold):
                old[1:] = [text, vector]
                out.append((entity, str(version), text))
    return sorted(out)


def test_last_seen_over_batches_and_restarts(spark, tmp_path):
    chance, root = random.Random(3), str(tmp_path / "out")
    batches = [[(chance.choice("abcde"), v, chance.choice(["one", "two", "twp", "xyz", "longer"])) for v in chance.sample(range(31), 8)] for _ in range(7)]
    stream = folder_stream(spark, tmp_path / "in", "body string")
    for number, batch in enumerate(batches):
        add(spark.createDataFrame([(message(e, v, t),) for e, v, t in batch] + [("{bad",)], "body string"), tmp_path / "in")
        if number % 3 == 0 or number == 6:
            seen.seen_stream(stream, root, str(tmp_path / "cp"), prepare, threshold=0.999).awaitTermination()
    got = sorted((r["entity_id"], r["source_version"], r["text"]) for r in spark.read.parquet(f"{root}/index").collect())
    assert got == fold(batches, 0.999) and len(got) < sum(map(len, batches)) / 2
    newest = {r["id"]: r["text"] for r in changes.read_index(spark, f"{root}/index").collect()}
    assert set(newest) == {f"t#{e}" for b in batches for e, _, _ in b}


def test_state_expires(spark, tmp_path):
    root = str(tmp_path / "out")
    stream = folder_stream(spark, tmp_path / "in", "body string")

    def run(version, text, expire):
        add(spark.createDataFrame([(message("a", version, text),)], "body string"), tmp_path / "in")
        seen.seen_stream(stream, root, str(tmp_path / "cp"), prepare, expire_s=expire).awaitTermination()
        return spark.read.parquet(f"{root}/index").count()

    assert [run(1, "one", 3_600), run(2, "one", 3_600), run(1, "three", 3_600)] == [1, 1, 1]
    import time

    time.sleep(2.5)
    assert run(3, "one", 1) == 2
    assert all_rows(changes.read_index(spark, f"{root}/index").select("source_version")) == ["Row(source_version='3')"]
