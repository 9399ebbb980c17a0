import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang, source) as a table like ``documents``; ``extra`` adds clashing columns."""

    def make(rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3, "doc_id")
        if extra:
            names = "score fp component_id fingerprint start length part words hits candidate path checks row word n known logs learns toxic doc found pieces"
            df = df.selectExpr("*", *[f"'x' AS {c}" for c in names.split()])
        return df

    return make


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "one two"),
    (6, "Same words stand here and here again. " * 3),
    (7, "Same words stand here and here again. " * 3),
    (7, "Same words stand here and here again. " * 3),
    (None, "a row without id"),
    (8, "many words follow each other without end " * 6_000),
    (9, "x" * 70_000),
    (10, "123 456, !!!    "),
    (11, "日本語のテキスト と ½² \U0001f600"),
]
