"""Cross-parsing against a plain parser, and the defined answers for odd texts."""

import random

from factloom.llm.language import automaton, identify, learn_languages, phrases
from tests.llm.conftest import ODD_TEXTS


def plain_phrases(word, text):
    pieces = at = 0
    while at < len(word):
        size = 1
        while at + size <= len(word) and word[at : at + size] in text:
            size += 1
        at += max(size - 1, 1)
        pieces += 1
    return pieces


def test_phrases():
    chance = random.Random(3)
    for _ in range(30):
        text = "".join(chance.choice("abcé ") for _ in range(chance.randint(1, 60)))
        words = ["".join(chance.choice("abcdé ") for _ in range(chance.randint(1, 20))) for _ in range(30)]
        got = phrases(words, *automaton(text).table())
        assert got.tolist() == [plain_phrases(w, text) for w in words]


ENGLISH = "the weather in the north was cold and the river had frozen over before the winter"
GERMAN = "das wetter im norden war kalt und der fluss war schon vor dem winter zugefroren"


def test_languages_are_told_apart(documents):
    rows = [(k, t, lang) for k in range(0, 40, 2) for t, lang in ((ENGLISH, "en"), (GERMAN, "de"))]
    models = learn_languages(documents([(k, *r[1:]) for k, r in enumerate(rows)]))
    tests = documents([(1, "Der Winter war kalt!"), (2, "The river was cold."), (3, "12 34"), (4, None), (5, "")], extra=True)
    got = {r["doc"]["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(tests, models).collect()}
    assert got[1][0] == "de" and got[2][0] == "en"
    assert all(0 < got[k][1] <= 1 for k in (1, 2))
    assert all(got[k] == ("und", 0.0) for k in (3, 4, 5))


def test_odd_rows(documents):
    models = learn_languages(documents([(1, ENGLISH, "en"), (2, GERMAN, None), (3, None, "de"), (4, "12", "fr")]))
    assert list(models) == ["en"]
    rows = identify(documents(ODD_TEXTS, extra=True), models).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert {r["lang_pred"] for r in rows} == {"en", "und"}
    assert learn_languages(documents([])) == {}
    assert {r["lang_pred"] for r in identify(documents(ODD_TEXTS), {}).collect()} == {"und"}
    assert identify(documents([]), models).count() == 0
