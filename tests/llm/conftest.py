import random

import pytest

#: Columns that operators make themselves, to clash with.
EXTRA = "n_words long, kept boolean, spans string, cls long, key long, words string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def row(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None if text is None else len(text), 7, True, "x", 1, 2, "w")


def edge_rows():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    base = " ".join(rng.choice(vocabulary) for _ in range(120))
    near = base.split()
    near[60] = "changed"
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = [
        row(1, base), row(2, base), row(3, " ".join(near)), row(4, None), row(5, ""), row(6, " \t\n\x0b\f\r "), row(7, "one"), row(8, "one"), row(9, "one two"),
        row(10, "before " + passage + " after the end"), row(11, passage, None, None), row(12, "x" * 20_000), row(13, "a b " * 6000), row(14, "İıßé 日本語 \U0001f600   nbsp here"),
        row(15, "mail a.b@c.example.com or 10.0.0.1 and +1 (705) 555-7016, 4111 1111 1111 1111"), row(None, base), row(None, None), row(1, base), row(16, "same line\nsame line\nother\n\nsame line"),
    ]
    return rows + [row(100 + k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))), rng.choice(["en", "de", None]), rng.choice(["s0", "s1", None])) for k in range(40)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1, 0) for i in range(1, 12)] + [(i, i % 2, 1 - i % 2) for i in range(100, 140)] + [(100, None, None), (None, 1, 1), (999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def words(text):
    return (text or "").encode().split()
