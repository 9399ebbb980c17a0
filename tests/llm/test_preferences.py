"""Preference pairs against plain Python, and a golden rendering."""

import random

from factloom.llm.preferences import answered_elsewhere, format_pairs


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS pair_id", "2 AS n", "3 AS turns", "4 AS answer")


def test_golden(spark):
    turns = table(spark, [(1, 0, "user", "Hi"), (1, 1, "assistant", "Hello"), (1, 2, "user", "Bye"), (2, 0, "user", "Yo"), (2, 1, "assistant", "No")])
    rows = {r["pair_id"]: r for r in format_pairs(answered_elsewhere(turns)).collect()}
    first = rows[1]
    assert first["prompt"] == "<|user|>\nHi<|end|>\n"
    assert first["chosen"] == "<|assistant|>\nHello<|end|>\n<|user|>\nBye<|end|>\n"
    assert first["rejected"] == "<|assistant|>\nNo<|end|>\n<|user|>\nBye<|end|>\n"
    assert [tuple(s) for s in first["chosen_spans"]] == [(14, 27)]
    assert first["chosen"][14:27] == "Hello<|end|>\n"
    assert rows[2]["rejected"] == "" and rows[2]["n_prompt_turns"] == 1  # no conversation 3 lends an answer


def test_against_plain(spark):
    chance = random.Random(11)
    held, rows = {}, []
    for conv in range(60):
        own = [(chance.choice(["user", "assistant", "system", None]), chance.choice(["a", "bb", "", None, "é" * 3])) for _ in range(chance.randint(1, 7))]
        held[conv] = [(r or "", t or "") for r, t in own]
        rows += [(conv, k, r, t) for k, (r, t) in enumerate(own)]
    chance.shuffle(rows)
    got = {r["pair_id"]: r for r in format_pairs(answered_elsewhere(table(spark, rows))).collect()}
    assert len(got) == 60

    def last(turns):
        return max((k for k, t in enumerate(turns) if t[0] == "assistant"), default=None)

    def shown(turns):
        return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)

    for conv, a in held.items():
        b, at = list(a), last(a)
        if at is not None:
            other = held.get(conv + 1, [])
            lent = last(other)
            b[at : at + 1] = [] if lent is None else [other[lent]]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        row = got[conv]
        assert (row["n_prompt_turns"], row["prompt"], row["chosen"], row["rejected"]) == (n, shown(a[:n]), shown(a[n:]), shown(b[n:]))
        assert row["tied"] == (a == b)
        assert "".join(row["rejected"][s["begin"] : s["end"]] for s in row["rejected_spans"]) == "".join(f"{t}<|end|>\n" for r, t in b[n:] if r == "assistant")


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 5, None, None), (3, 0, "assistant", "x" * 200_000)]
    got = {r["pair_id"]: r for r in format_pairs(answered_elsewhere(table(spark, rows))).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["n_prompt_turns"] == 3 and got[1]["tied"]
    assert got[2]["prompt"] == "<||>\n<|end|>\n"
    assert len(got[3]["chosen"]) > 200_000
    assert format_pairs(answered_elsewhere(table(spark, []))).count() == 0
    none = spark.createDataFrame([(1, None, None)], "pair_id long, chosen_turns array<struct<role: string, text: string>>, rejected_turns array<struct<role: string, text: string>>")
    assert format_pairs(none).first()["tied"]
