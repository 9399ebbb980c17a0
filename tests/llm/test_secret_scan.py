"""Candidates against a plain search, the forest on held-out findings, masking, odd rows."""

import random
import re

from factloom.llm.secret_scan import MASK, candidates, cut_out, dictionary, features, planted_quality, scan, without_secrets
from tests.llm.conftest import ODD_TEXTS

RUN = re.compile(r"(?<![A-Za-z0-9+/_.@-])[A-Za-z0-9+/_.@-]{12,}(?![A-Za-z0-9+/_.@-])={0,2}")
WORDS = "the river was cold and a winter came over north table paper garden".split()


def hexes(chance, n=40):
    return "".join(chance.choice("0123456789abcdef") for _ in range(n))


def made(chance, k):
    words = [chance.choice(WORDS) for _ in range(chance.randint(3, 30))]
    secret = None
    if k % 3 == 0:
        secret = hexes(chance)
        words.insert(chance.randint(0, len(words)), f'{chance.choice(["token", "api_key", "secret"])} = "{secret}"')
    if k % 2 == 0:
        false = [f"{chance.randint(10**15, 10**16)}", f"10.20.{chance.randint(1, 200)}.{chance.randint(100, 200)}", f"jo.{k:03}@mail7.example.com", f"winter-table-paper-{k:03}"]
        words.insert(chance.randint(0, len(words)), chance.choice(false))
    return " ".join(words), secret


def test_candidates(documents):
    chance = random.Random(13)
    docs = [(k, made(chance, k)[0]) for k in range(60)]
    docs.append((99, "é" * 30 + " abc123def456==x a1" + "b" * 30 + "'a1b2c3d4e5f6'a1b2c3d4e5f6 word-without-digits-in-it"))
    got = {(r["doc_id"], r["start"], r["candidate"], r["before"], r["after"]) for r in candidates(documents(docs)).collect()}
    want = set()
    for k, text in docs:
        found = [m for m in RUN.finditer(text) if re.search("[0-9]", m.group())]
        ends = [0, *(m.end() for m in found)]
        starts = [*(m.start() for m in found), len(text)]
        for n, m in enumerate(found):
            want.add((k, m.start(), m.group(), text[max(ends[n], m.start() - 48) : m.start()], text[m.end() : min(starts[n + 1], m.end() + 24)]))
    assert got == want


def test_names_with_digits_and_values_without(documents):
    secret = hexes(random.Random(3))
    texts = [
        f'AWS_S3_SECRET_KEY = "{secret}"',
        f'api_key_v2_prod="{secret}"',
        'so password = "correct-horse-battery-staple" it is',
        '{"passwd": "hunter two"}',
        "export DB_PASSWORD=open-sesame; run",
        "no name = 'plain words here'",
        f"token='{secret} and more' é",
    ]
    found = features(candidates(documents(list(enumerate(texts)))), []).collect()
    got = {(r["doc_id"], r["candidate"]): r for r in found}
    assert len(got) == len(found)
    values = {0: secret, 1: secret, 2: "correct-horse-battery-staple", 3: "hunter two", 4: "open-sesame", 6: f"{secret} and more"}
    assert set(got) == {*values.items(), (0, "AWS_S3_SECRET_KEY"), (1, "api_key_v2_prod=")}
    for k, value in values.items():
        row, at = got[k, value], texts[k].index(value)
        assert row["start"] == at
        assert row["left"] == texts[k][max(0, at - 48) : at] and row["right"] == texts[k][at + len(value) :][:24]
        assert (row["key_before"], row["key_near"], row["assigned"], row["quoted"]) == (1, 1, 1, k != 4)


def test_dictionary_counts_all_documents(documents):
    """Of 6,000 documents a small language has 60: each of its words is in 0.5 % of all."""
    small, large = [f"klein{c}" for c in "abcdefgh"], [f"{a}{b}{c}" for a in "klmnp" for b in "aeiou" for c in "rstvz"] * 10
    chance = random.Random(16)
    docs = [(k, " ".join(small[j] for j in range(8) if (k // 100 + j) % 2) if k % 100 == 0 else " ".join(chance.sample(large, 40))) for k in range(6_000)]
    docs += [(6_000, "onlyonce"), (6_001, None)]
    # 6,002 * 0.005 = 30.01 documents; small words are in 30, so a share below that takes them.
    words = {r["word"] for r in dictionary(documents(docs), 0.004).collect()}
    assert words == {*small, *large}
    found = candidates(documents([(1, "kleina-kleinb-onlyonce-12345 x")]))
    row = features(found, dictionary(documents(docs), 0.004)).first()
    assert row["covered"] == 12 / len(row["candidate"])


def test_forest_on_texts_it_did_not_see(spark, documents):
    chance = random.Random(14)
    texts = [(k, *made(chance, k)) for k in range(200)]
    docs = documents([(k, t) for k, t, _ in texts], extra=True)
    found = candidates(docs).collect()
    secrets = {k: s for k, _, s in texts}
    labelled = spark.createDataFrame([(r["doc_id"], r["start"], int(r["candidate"] == secrets[r["doc_id"]])) for r in found if r["doc_id"] % 2], "doc_id long, start int, label int")
    rows = scan(docs, labelled=labelled).collect()
    assert len(rows) == len(found)
    wrong = [r for r in rows if r["doc_id"] % 2 == 0 and r["is_secret"] != (r["candidate"] == secrets[r["doc_id"]])]
    assert len(wrong) <= 0.02 * len(rows)


def test_planted_findings_teach_where_no_labels_are_given_and_texts_are_masked(documents):
    chance = random.Random(15)
    texts = [(k, *made(chance, k)) for k in range(90)]
    docs = documents([(k, t) for k, t, _ in texts] + [(None, "no id"), (500, None)], extra=True)
    masked = without_secrets(docs)
    assert masked.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert len(got) == 92 and got[None] == "no id" and got[500] is None
    for k, text, secret in texts:
        assert got[k] == (text.replace(secret, MASK) if secret else text)


def test_only_found_places_change(spark, documents):
    """Short values, values that come again elsewhere, rows that repeat an id or have none."""
    chance = random.Random(17)
    shorts = ['api_key = "x" and next x-ray text', 'pwd = "cold" on a cold day', 'token="é1" é1 \U0001f600é1', 'secret: "a", password: "b" ab']
    long = [made(chance, 3 * k)[0] for k in range(30)]
    same = hexes(chance)
    repeated = [(7, f'token = "{same}" and {same} again'), (7, f"{same} in another row"), (None, f'api_key = "{same}"'), (None, f"only {same} here")]
    docs = [*enumerate(shorts, 100), *enumerate(long, 200), *repeated]
    table = documents(docs, extra=True)
    numbered = [(k, i, t) for k, (i, t) in enumerate(docs)]
    rows = spark.createDataFrame(numbered, "row long, doc_id long, text string")
    found = {(r["row"], r["start"], r["length"]) for r in scan(rows, keys=("doc_id", "row")).collect() if r["is_secret"]}
    want = []
    for k, _, text in numbered:
        at, out = 0, ""
        for _, start, length in sorted(f for f in found if f[0] == k):
            if start >= at:
                out += text[at:start] + MASK
            at = max(at, start + length)
        want.append((numbered[k][1], out + text[at:]))
    got = [(r["doc_id"], r["text"]) for r in without_secrets(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(MASK in t for _, t in got) >= 30


def test_masks_by_place(spark):
    rows = spark.createDataFrame(
        [("abcdefgh", [(1, 2), (4, 1)]), ("é\U0001f600xyz", [(1, 1), (4, 1)]), ("overlap here", [(0, 5), (3, 4), (8, 4)]), ("none", []), ("", [])],
        "text string, spans array<struct<start: int, length: int>>",
    )
    got = [r[0] for r in rows.select(cut_out(rows["text"], rows["spans"], "#")).collect()]
    assert got == ["a#d#fgh", "é#xy#", "# #", "none", ""]


def test_odd_rows(documents):
    docs = documents([*ODD_TEXTS, (20, "a1" * 40_000), (21, 'token = "0123456789abcdef0123"')], extra=True)
    rows = scan(docs).collect()
    assert {r["doc_id"]: (r["start"], r["length"]) for r in rows} == {20: (0, 80_000), 21: (9, 20)}
    assert {r["doc_id"]: r["is_secret"] for r in rows}[21]
    assert scan(documents([])).count() == 0
    assert features(candidates(documents([])), []).count() == 0


def test_precision_and_recall_by_form(documents):
    """On planted findings that the forest did not learn from: all forms of both labels, in texts of several kinds."""
    chance = random.Random(19)
    docs = documents([(k, made(chance, k)[0]) for k in range(400)])
    rows = planted_quality(docs).collect()
    found = {(r["form"], r["label"]): (r["findings"], r["flagged"]) for r in rows}
    print(sorted(found.items(), key=str))
    secret = {f: v for (f, y), v in found.items() if y == 1}
    false = [v for (_, y), v in found.items() if y == 0]
    assert len(secret) == 12
    for form, (n, flagged) in secret.items():
        assert n >= 20 and flagged >= 0.9 * n, form
    caught, wrong = sum(f for _, f in secret.values()), sum(f for _, f in false)
    assert caught / (caught + wrong) >= 0.9
    assert wrong <= 0.05 * sum(n for n, _ in false)
