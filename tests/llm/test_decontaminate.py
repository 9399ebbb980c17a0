"""Spaced seeds against brute force, with words replaced, and odd rows."""

import random
from itertools import combinations

import numpy as np
import pytest

from factloom.llm.decontaminate import MASKS, contaminated, stretch
from tests.llm.conftest import ODD_TEXTS


@pytest.fixture
def bench(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def test_masks_find_thirteen_words_with_any_two_replaced():
    for gone in combinations(range(13), 2):
        assert any(
            all(used == "0" or at + k not in gone for k, used in enumerate(mask))
            for mask in MASKS
            for at in range(13 - len(mask) + 1)
        )


def words(chance, n):
    return ["".join(chance.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


def test_passages_with_replaced_words(documents, bench):
    chance = random.Random(8)
    items = [(k, words(chance, chance.randint(15, 50))) for k in range(30)]
    docs, planted = [], set()
    for k in range(120):
        text = words(chance, chance.randint(0, 60))
        if k % 2:
            item, passage = items[k % 30]
            passage = list(passage)
            for at in chance.sample(range(len(passage)), len(passage) // 8):
                passage[at] = "zzz"
            cut = chance.randint(0, len(text))
            text[cut:cut] = [w.upper() + chance.choice(["", ",", "."]) for w in passage]
            planted.add((k, item))
        elif k % 4 == 0:  # fewer words than count as an overlap
            text += items[k % 30][1][:8]
        docs.append((k, " ".join(text)))
    rows = contaminated(documents(docs), bench([(k, " ".join(w)) for k, w in items])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == planted
    assert all(9 <= r["n_equal"] <= r["n_words"] <= r["item_words"] + 1 and r["n_equal"] >= 0.8 * r["n_words"] for r in rows)


def plain_stretch(same):
    windows = [(a, b) for a in range(len(same)) for b in range(a + 1, len(same) + 1)]
    held = [(a, b - a, sum(same[a:b])) for a, b in windows if sum(same[a:b]) >= 0.8 * (b - a)]
    return max(held, key=lambda w: (w[2], -w[1], -w[0]), default=None)


def replaced(chance, n, share):
    gone = set(chance.sample(range(n), round(n * share)))
    return [k not in gone for k in range(n)]


def test_stretch_is_the_best_of_all_windows():
    chance = random.Random(21)
    assert stretch(np.zeros(5, dtype=bool)) is None
    for _ in range(300):
        same = replaced(chance, chance.randint(1, 60), chance.choice([0.1, 0.15, 0.2, 0.25, 0.5]))
        assert stretch(np.array(same)) == plain_stretch(same)


def test_no_text_with_a_hit_is_lost_when_a_fifth_of_the_words_is_replaced(documents, bench):
    chance = random.Random(22)
    docs, items, held = [], [], set()
    for k in range(240):
        item = words(chance, 40)
        same = replaced(chance, 40, chance.choice([0.15, 0.2, 0.25]))
        seeded = any(
            all(same[at + j] for j, used in enumerate(mask) if used == "1") for mask in MASKS for at in range(40 - len(mask) + 1)
        )
        best = plain_stretch(same)
        if seeded and best and best[2] >= 10:
            held.add((k, k, best[1], best[2]))
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(w if s else "zzz" for w, s in zip(item, same, strict=True))))
    found = contaminated(documents(docs), bench(items)).collect()
    assert len(held) > 200
    assert {(r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in found} == held


def test_where_the_stretch_lies(documents, bench):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = contaminated(documents([(1, f"before this {passage} and after")]), bench([(5, passage)])).collect()
    assert [tuple(r) for r in rows] == [(1, 5, 2, 0, 14, 14, 14)]


def test_odd_rows(documents, bench):
    text = "Same words stand here and here again. " * 3
    items = bench([(1, text), (2, None), (3, ""), (4, "one two"), (5, "many words follow each other without end " * 3), (None, text), (1, text)])
    found = contaminated(documents(ODD_TEXTS, extra=True), items.selectExpr("*", "1 AS hash", "2 AS words")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(6, 1), (7, 1), (8, 5)}
    assert len(found) == 3
    assert contaminated(documents([]), items).count() == 0
    assert contaminated(documents(ODD_TEXTS), bench([])).count() == 0
