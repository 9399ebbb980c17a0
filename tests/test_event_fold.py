"""Attributes folded over events against a plain fold."""

import datetime as dt
import json
import random

from factloom.operators.temporal import event_attributes, event_fold

D = dt.datetime(2024, 1, 1)
KIND = "event_id int, stream_id string, sequence_no long, event_type string, event_data string, occurred_at timestamp_ntz, recorded_at timestamp_ntz"


def test_against_a_plain_fold(spark):
    chance, rows = random.Random(5), []
    for n in range(300):
        data = {chance.choice("abc"): chance.choice([None, n, f"é{n}", {"x": n}, [n]]) for _ in range(chance.randint(0, 2))}
        body = chance.choice([None, "{oops", "[1]", "7"]) if n % 19 == 0 else json.dumps(data, separators=(",", ":"))
        rows.append((n, chance.choice(["s", "t", None]), chance.randint(0, 40), "k", body, D, D + dt.timedelta(minutes=chance.randint(0, 100))))
    rows.append((900, "none", 1, "k", '{"a": null}', D, D))
    df = spark.createDataFrame(rows, KIND)
    for until in (None, D + dt.timedelta(minutes=50)):
        want = {}
        for e, stream, seq, _, body, _, recorded in sorted(rows, key=lambda r: (r[2], r[0])):
            if until is not None and recorded > until:
                continue
            state = want.setdefault(stream, {})
            data = json.loads(body) if body and body.startswith("{") and body != "{oops" else {}
            for key, value in data.items():
                state[key] = None if value is None else value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)
        got = {r["stream_id"]: r["state"] for r in event_fold(df, until).collect()}
        assert got == {s: {k: v for k, v in state.items() if v is not None} for s, state in want.items()}
        assert list(got["s"]) == sorted(got["s"])


def test_ties_and_no_rows(spark):
    rows = [(2, "s", 1, "k", '{"a": "late id"}', D, D), (1, "s", 1, "k", '{"a": "early id", "b": 1}', D, D), (1, "s", 1, "k", '{"b": 2}', D, D)]
    df = spark.createDataFrame(rows, KIND)
    assert {(r["attribute"], r["value"], r["sequence_no"]) for r in event_attributes(df).collect()} == {("a", "late id", 1), ("b", "2", 1)}
    assert event_fold(df.limit(0)).count() == 0
