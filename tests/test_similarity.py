"""Near-equal records against all pairs, and the weekly rate."""

import random
import re

import pytest
from pyspark.sql import functions as F

from factloom.operators import similarity

WORDS = [f"{a}{b}" for a in "bdfgklmn" for b in "aeiou"]


def made(chance, count):
    texts = [" ".join(chance.choices(WORDS, k=chance.choice([1, 2, 3, 6, 12, 30]))) for _ in range(count // 3)]
    while len(texts) < count:
        words = chance.choice(texts).split()
        for _ in range(chance.randint(0, 3)):
            words[chance.randrange(len(words))] = chance.choice(WORDS + ["new", "Words"])
        texts.append(" ".join(words).replace("ba", "BA") + chance.choice(["", ".", " ba"]))
    return texts


def plain(texts):
    return {k: frozenset(re.findall(r"[^\W_]+", (t or "").lower())) for k, t in texts}


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize(("threshold", "long"), [(0.9, 200), (0.7, 200), (0.6, 8), (1.0, 200), (0.75, 0)])
def test_pairs_are_all_pairs(spark, monkeypatch, threshold, long):
    monkeypatch.setattr(similarity, "LONG", long)
    texts = list(enumerate(made(random.Random(str(threshold)), 240)))
    df = spark.createDataFrame(texts, "id long, text string")
    sets = similarity.distinct_sets(df.withColumn("tokens", similarity.tokens_of(F.col("text"))), "id", "tokens")
    first = {}
    for k, s in plain(texts).items():
        first.setdefault(s, k)
    ids = sorted((k, s) for s, k in first.items() if s)
    want = {(a, b, len(s & t)) for i, (a, s) in enumerate(ids) for b, t in ids[i + 1 :] if jaccard(s, t) >= threshold - 1e-12}
    found = similarity.near_sets(sets, threshold).collect()
    assert {(r["low"], r["high"], r["overlap"]) for r in found} == want and len(found) == len(want)
    assert threshold == 1 or len(want) > 10


def test_rows(spark):
    texts = [(1, "a b c d e f g h i j"), (2, "J i h g f e d c b a"), (3, "a b c d e f g h i j k"), (4, None), (5, "..."), (6, "other"), (None, "other"), (6, "other")]
    df = spark.createDataFrame(texts, "id long, text string")
    got = sorted((r["id"], r["first_equal"], r["first_near"]) for r in similarity.near_duplicates(df, "id", "text").collect())
    assert got == [(1, 1, 3), (2, 1, 3), (3, 3, 1), (4, 4, None), (5, 4, None), (6, 6, None), (6, 6, None)]
    assert similarity.near_duplicates(df.limit(0), "id", "text").count() == 0
    with pytest.raises(ValueError, match="over 0.5"):
        similarity.near_sets(df.select(F.col("id").alias("set_id")), 0.5)


def test_unrelated_records_are_seldom_compared(spark):
    """Unrelated records of ten words out of 2,000: pairs of rare words are seldom shared."""
    def candidates(count):
        chance = random.Random(count)
        rows = [(k, [f"w{chance.randrange(2_000)}" for _ in range(10)]) for k in range(count)]
        sets = similarity.distinct_sets(spark.createDataFrame(rows, "id long, tokens array<string>"), "id", "tokens")
        keys = sets.select("set_id", F.inline(similarity._keys(F.col("size"), F.col("tokens"), 0.8)))
        return keys.groupBy("kind", "key").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] / count

    assert candidates(2_000) < 0.1 and candidates(8_000) < 0.4


def test_rate(spark):
    rows = [(k, f"{'a b c d e f g h i' if k % 3 else 'z' + str(k)} {'j' if k % 2 else 'J'}", f"2024-01-{1 + k:02}") for k in range(20)]
    df = spark.createDataFrame(rows, "id long, text string, day string").withColumn("at", F.col("day").cast("timestamp_ntz"))
    got = [(str(r["week"]), r["rows"], r["repeats"], r["breach"]) for r in similarity.near_duplicate_rate(df, "id", "text", "at").orderBy("week").collect()]
    assert got == [("2024-01-01", 7, 3, False), ("2024-01-08", 7, 5, True), ("2024-01-15", 6, 4, False)]


def test_sketches_differ_no_more_than_sets(spark):
    chance = random.Random(6)
    sets = [set(chance.sample(range(3000), chance.choice([1, 20, 300]))) for _ in range(30)]
    sets += [s ^ {chance.randrange(3000)} for s in sets]
    each = spark.createDataFrame([(k, len(s), f"w{t}") for k, s in enumerate(sets) for t in s], "set_id int, size int, token string")
    bits = {r["set_id"]: r["sketch"] for r in similarity._sketches(each).collect()}
    for a in bits:
        for b in bits:
            apart = sum(bin((x ^ y) % 2**64).count("1") for x, y in zip(bits[a], bits[b]))
            different = len(sets[a] ^ sets[b])
            assert apart <= different and apart >= min(different, 500) * 0.5


def test_any_tokens(spark):
    """Tokens that hold what packing puts between tokens, empty ones and NULL."""
    chance = random.Random(11)
    kinds = ["a\nb", "a", "b", "\\", "\\n", "\\g", "\n", "", None, "m", "g", "n", *[f"w{k}" for k in range(12)]]
    chosen = {}
    for k in range(150):
        chosen.setdefault(frozenset(chance.sample(kinds, chance.choice([3, 9, 18, 20, 21]))), k)
    sets = spark.createDataFrame([(k, list(s), len(s)) for s, k in chosen.items()], "set_id long, tokens array<string>, size int")
    ids = sorted((k, s) for s, k in chosen.items())
    want = {(a, b, len(s & t)) for i, (a, s) in enumerate(ids) for b, t in ids[i + 1 :] if jaccard(s, t) >= 0.7 - 1e-12}
    assert {(r["low"], r["high"], r["overlap"]) for r in similarity.near_sets(sets, 0.7).collect()} == want and want


@pytest.mark.parametrize("buckets", [1, 1 << 18])
def test_least_near_of_many(spark, monkeypatch, buckets):
    """Whatever the order of tokens; keys that repeat with one text and with several, copies, candidates in several rounds."""
    monkeypatch.setattr(similarity, "ASKED", 2)
    monkeypatch.setattr(similarity, "BUCKETS", buckets)
    chance = random.Random(8)
    texts = made(chance, 120) + [" ".join(chance.sample(WORDS[:14], 13)) for _ in range(40)]
    rows = [(chance.randrange(150), t) for t in texts] + [(k, t) for k, t in enumerate(texts[:10])]
    got = similarity.near_duplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text", 0.8).collect()
    sets = [(k, frozenset(t.lower().replace(".", "").split())) for k, t in rows]
    want = []
    for k, s in sets:
        near = [j for j, t in sets if t != s and s and t and jaccard(s, t) >= 0.8 - 1e-12 and j == min(i for i, u in sets if u == t)]
        want.append((k, min(j for j, t in sets if t == s), min(near, default=None)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and sum(w[2] is not None for w in want) > 30


def test_a_group_of_near_sets_does_not_fetch_all_its_pairs(spark, monkeypatch):
    """Of 60 sets that are all near each other, ten with nothing near: 1,770 pairs may be near, 60 times ASKED are looked at."""
    asked = []
    plainly = similarity._checked

    def watched(pairs, sets, threshold):
        asked.append(pairs.count())
        return plainly(pairs, sets, threshold)

    monkeypatch.setattr(similarity, "_checked", watched)
    common = " ".join(f"w{k}" for k in range(80))
    texts = [(k, f"{common} x{k}") for k in range(60)] + [(100 + k, f"y{k} z{k}") for k in range(10)]
    got = {r["id"]: r["first_near"] for r in similarity.near_duplicates(spark.createDataFrame(texts, "id long, text string"), "id", "text").collect()}
    assert got == {0: 1} | {k: 0 for k in range(1, 60)} | {100 + k: None for k in range(10)}
    assert 59 <= sum(asked) <= 60 * similarity.ASKED


def test_tokens_are_not_shuffled_to_be_ordered(spark, monkeypatch):
    """The table of texts and that of the first tokens are written without an exchange."""
    plans = []
    plain_written = similarity.written

    def watched(df, *args, **kwargs):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return plain_written(df, *args, **kwargs)

    monkeypatch.setattr(similarity, "written", watched)
    texts = [(k, f"{k % 50} {k % 7} a b c d e f g h") for k in range(300)]
    assert similarity.near_duplicates(spark.createDataFrame(texts, "id long, text string"), "id", "text").count() == 300
    assert all("Exchange" not in text for columns, text in plans if "packed" in columns or "first" in columns)
    assert sum("first" in columns for columns, _ in plans) == 1
