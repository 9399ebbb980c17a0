"""The breaker against a plain replay of its rules, whole and in pieces."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from factloom.operators.breaker import BreakerConfig, breaker_states, latest_states
from factloom.streaming.stateful import breaker_stream

BASE = dt.datetime(2024, 1, 1)


def plain(series, config):
    """The rules one result at a time, written without the library."""
    state, failures, passes, last = "closed", 0, 0, None
    out = []
    for run, at, ok in series:
        if state == "open" and at - last > dt.timedelta(minutes=config.recovery_minutes):
            state, passes = "half_open", 0
        allowed = state != "open"
        told = False
        if ok:
            if state == "closed":
                failures = 0
            elif state == "half_open":
                passes += 1
                if passes >= config.passes_to_close:
                    state = "closed"
        else:
            failures += 1
            last = at
            if failures >= config.failure_threshold:
                state, told = "open", True
        out.append((run, state, failures, passes, allowed, told))
    return out


def make(seed, keys, n, failing):
    rng = random.Random(seed)
    data = {}
    for key in range(keys):
        at, rows = BASE, []
        for i in range(n if key else n * 4):
            at += dt.timedelta(minutes=rng.choice([0, 1, 5, 20, 59, 60, 61, 200]))
            rows.append((i, at, rng.random() > failing))
        data[key] = rows
    return data


def frame(spark, data):
    rows = [(k, run, at, ok) for k, series in data.items() for run, at, ok in series]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "contract_id long, run_id long, at timestamp_ntz, ok boolean")


def collect(df):
    names = ["run_id", "state", "failure_count", "pass_count", "allowed", "notified"]
    out = {}
    for r in df.orderBy("contract_id", "at", "run_id").collect():
        out.setdefault(r["contract_id"], []).append(tuple(r[n] for n in names))
    return out


CONFIGS = [BreakerConfig(), BreakerConfig(2, 30, 2), BreakerConfig(3, 60, 1), BreakerConfig(2, 0, 4)]


@pytest.mark.parametrize(
    ("config", "size"), [*[(c, 9) for c in CONFIGS], (CONFIGS[0], 100_000), (CONFIGS[1], 100_000)]
)
def test_states(spark, config, size):
    """Contracts with few, some and many failures, one of them with far more results."""
    data = {
        10 * i + k: series
        for i, failing in enumerate((0.05, 0.3, 0.7))
        for k, series in make(7 + i, 3, 40, failing).items()
    }
    want = {k: plain(s, config) for k, s in data.items()}
    assert collect(breaker_states(frame(spark, data), config, rows_per_piece=size)) == want


def test_alternating_results_have_no_common_state(spark):
    """Two failures in a row open it; alternating results leave open and closed series apart."""
    config = BreakerConfig(2, 60, 2)
    series = [(i, BASE + dt.timedelta(minutes=i), i % 2 == 0) for i in range(200)]
    opened = [(i, BASE + dt.timedelta(minutes=i), i > 1 and i % 2 == 1) for i in range(200)]
    data = {1: series, 2: opened}
    want = {k: plain(s, config) for k, s in data.items()}
    for size in (10, 100_000):
        assert collect(breaker_states(frame(spark, data), config, rows_per_piece=size)) == want


@pytest.mark.parametrize("size", [9, 100_000])
def test_start_from_stored_states(spark, size):
    data = make(11, 4, 60, 0.2)
    config = BreakerConfig(1, 60, 3)
    first = {k: s[: len(s) // 2] for k, s in data.items()}
    second = {k: s[len(s) // 2 :] for k, s in data.items()}
    stored = latest_states(breaker_states(frame(spark, first), config, rows_per_piece=size))
    got = collect(breaker_states(frame(spark, second), config, stored, rows_per_piece=size))
    assert got == {k: plain(s, config)[len(first[k]) :] for k, s in data.items()}


def test_stream_equals_batch(spark, tmp_path):
    data = make(3, 3, 60, 0.25)
    rows = frame(spark, data)
    source = str(tmp_path / "in")
    # Three files in time order, one per micro-batch.
    cuts = [BASE, BASE + dt.timedelta(days=1), BASE + dt.timedelta(days=4), BASE + dt.timedelta(days=400)]
    for low, high in zip(cuts, cuts[1:]):
        part = rows.filter((F.col("at") >= low) & (F.col("at") < high))
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    root = str(tmp_path / "out")
    breaker_stream(stream, root, str(tmp_path / "cp"), rows_per_piece=20).awaitTermination()
    assert collect(spark.read.parquet(f"{root}/states")) == collect(breaker_states(rows))
