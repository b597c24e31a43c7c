"""Vector codes against a plain version in whole Python numbers."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from quern.llm import vector_codes
from quern.llm.queries import op11_vector_codes


def plain(rows, rounds=vector_codes.ROUNDS):
    kept = [(i, [math.floor(x * 4096) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // 8
    books = [[v[p * width : (p + 1) * width] for _, v, _ in kept[:16]] for p in range(8)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width : (p + 1) * width], entry, strict=True)), k) for k, entry in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(v, p)[1] for p in range(8)] for _, v, _ in kept]
        for p in range(8):
            for k in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), at in zip(kept, found, strict=True) if at[p] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for i, v, label in kept:
        found = [nearest(v, p) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    by_label = {}
    for *_, error, label in out:
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, code, error, label in out), key=repr)


def made(rng, n, scale=1.0):
    centres = [[rng.gauss(0, scale) for _ in range(16)] for _ in range(5)]
    rows = [(k, [float(np.float32(x + rng.gauss(0, scale / 9))) for x in rng.choice(centres)], rng.choice([0, 1, None])) for k in range(n)]
    return rows


@pytest.mark.parametrize("n,scale", [(3, 1.0), (120, 1.0), (60, 1e30)])
def test_codes_equal_the_plain_version(spark, n, scale):
    rows = made(random.Random(n), n, scale)
    rows += [rows[0], (rows[1][0], rows[2][1], None), (None, rows[2][1], 1), (500, None, 1), (501, [*rows[0][1][:15], None], 1), (502, [*rows[0][1][:15], math.inf], 1), (503, [math.nan] * 16, None)]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], "vec_id long, embedding array<float>, label int, code int, id string")
    got = sorted((tuple(r) for r in vector_codes.encode(df).collect()), key=repr)
    expected = plain(rows)
    if scale > 1:  # errors pass 64 bits and are null; codes and codebooks are exact
        assert [(r[0], r[1], r[4]) for r in got] == [(r[0], r[1], r[4]) for r in expected]
        assert {r[2] for r in got} == {None}
    else:
        assert got == expected


def test_the_nearest_entry_is_exact_from_any_radius():
    rng = np.random.default_rng(7)
    for n in (1, 2, 16, 64):
        entries, x = rng.integers(-6, 7, (n, 3)), rng.integers(-9, 10, (500, 3))
        far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        for radius in (1, 3, 40):
            index, best = vector_codes.Sliced(entries).nearest(x, radius)
            assert (index == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
            box = vector_codes.Sliced(entries).box(x, np.full(len(x), radius))
            inside = (np.abs(x[:, None] - entries[None]) <= radius).all(axis=2)
            assert [[int(b) >> k & 1 for k in range(n)] for b in box] == inside.astype(int).tolist()


def test_other_widths_and_empty_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vector_codes.encode(spark.createDataFrame([], kind)).count() == 0
    odd = vector_codes.encode(spark.createDataFrame([(1, [1.0] * 8, 0), (2, [1.0] * 9, 0), (3, [], None)], kind)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in odd if r.vec_id == 1) == [(1, "00" * 8, 0)]
    assert all(r.code is None and r.error is None for r in odd if r.vec_id > 1) and len(odd) == 3
    assert [r.code for r in vector_codes.encode(spark.createDataFrame([(1, [1.0] * 9, 0)], kind)).collect()] == [None]


def test_query_equals_its_sql(spark, data):
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
        found = c.sql(vector_codes.ORACLE)
        got = op11_vector_codes(spark, data)
        assert found.columns == got.columns
        assert sorted(found.fetchall()) == sorted(map(tuple, got.collect()))
