"""Collocations against a plain count of everything."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from quern.llm import collocations
from quern.llm.queries import op12_collocations
from tests.llm.conftest import edge_rows


def plain(rows, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        best = []
        for p, a in f.items():
            if len(p) > 1 and a >= 10:
                score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                longer = [c for q, c in f.items() if len(q) == 3 and c >= 10 and len(p) == 2 and p in (q[:2], q[1:])]
                if not any(100 * c >= 50 * a for c in longer):
                    best.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n, -score) for k, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def made(rng, n):
    common = [f"w{k}" for k in range(12)] + ["é", "ß\x1c", "W3"]
    fixed = ["alpha beta gamma", "one Two", "x\ty", "delta epsilon"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(common) for _ in range(rng.randrange(40))]
        text = "".join(p + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ", " ", " "]) for p in parts)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([text, text, text, None, ""])))
    return rows


@pytest.mark.parametrize("top", [3, 25, 2000])
@pytest.mark.parametrize("piece,held", [(4 << 20, 1_000_000), (20, 60)])
def test_mined_phrases_equal_a_count_of_all(spark, monkeypatch, top, piece, held):
    monkeypatch.setattr(collocations, "PIECE", piece)
    monkeypatch.setattr(collocations, "HELD", held)
    rows = made(random.Random(top), 400)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, text string, rank int, phrase string, n long")
    assert sorted(map(tuple, collocations.mine(df, top=top).collect())) == plain(rows, top)


def test_a_full_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CELLS", 64)
    rows = made(random.Random(5), 200)
    got = collocations.mine(spark.createDataFrame(rows, "lang string, text string"), top=5)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5)


def test_stretches_hold_each_phrase_once(monkeypatch):
    rng = random.Random(6)
    for _ in range(500):
        monkeypatch.setattr(collocations, "PIECE", rng.choice([1, 4, 9]))
        text = "".join(rng.choice(["a", "bb", "cccccccccc", " ", " ", "\n"]) for _ in range(rng.randrange(60))).encode()
        for n in (1, 2, 3):
            def phrases(part):
                return Counter(tuple(w[i : i + n]) for w in (p.split() for p in part.split(b"\n")) for i in range(len(w) - n + 1))

            assert sum((phrases(p) for p in collocations.stretches(text, n)), Counter()) == phrases(text), (text, n)


def test_edge_cases(edge, empty):
    rows = [(r[2], r[1]) for r in edge_rows()]
    assert sorted(map(tuple, collocations.mine(edge).collect())) == plain(rows, 2000)
    assert collocations.mine(empty).count() == 0


def test_query_equals_its_sql(spark, data):
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
        found = c.sql(collocations.ORACLE)
        got = op12_collocations(spark, data)
        assert found.columns == got.columns
        assert sorted(found.fetchall()) == sorted(map(tuple, got.collect()))
