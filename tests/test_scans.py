"""Vector links, the duplicate scan, entity shapes and JSON trees against plain versions that look at every pair, value or step."""

import hashlib
import json
import pathlib
import random
import re
import unicodedata

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import hashing, jsons, text
from quern.operators import duplicates, scanning, similarity
from quern.plans import catalog, scans  # noqa: F401  scans adds its queries to the catalogue
from quern.sources import tables


def clustered(rng, n, width=6):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for k in range(n):
        v = [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]
        rows.append((k, v))
    rows += [(n, rows[0][1]), (n + 1, [2 * x for x in rows[1][1]]), (n + 2, [-x for x in rows[2][1]]), (n + 3, [0.0] * width), (n + 4, None), (n + 5, []), (n + 6, [1.0, None]), (n + 7, [1.0, float("nan")]), (n + 8, [1.0, 1.0]), (n + 9, [1.0, 1.01]), (n + 10, [1e200, 1e200])]
    return rows


@pytest.mark.parametrize("threshold", [0.99, 0.9, 0.3, -0.5])
@pytest.mark.parametrize("pivots,block", [(512, 512), (20, 3), (1, 7)])
def test_vector_links_equal_all_pairs(spark, threshold, pivots, block):
    rows = clustered(random.Random(7), 60)
    units = {i: np.array(v) / np.abs(v).max() for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    units = {i: v / np.linalg.norm(v) for i, v in units.items()}
    members, links = similarity.vector_links(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", threshold, pivots, block)
    cls = {r.id: r.cls for r in members.collect()}
    assert set(cls) == set(units)
    own = sorted(set(cls.values()))
    expected = {(a, b): float(units[a] @ units[b]) for a in own for b in own if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold}
    got = [(r.a, r.b, r.similarity) for r in links.collect()]
    assert len(got) == len(expected) and {(a, b) for a, b, _ in got} == set(expected)
    assert all(abs(s - expected[a, b]) < 1e-12 for a, b, s in got)
    assert all(abs(units[i] @ units[c]) > 1 - 1e-12 for i, c in cls.items())


def test_vector_links_of_nothing(spark):
    members, links = similarity.vector_links(spark.createDataFrame([], "id long, v array<float>"), "id", "v", 0.5)
    assert members.count() == links.count() == 0


def plain_scan(candidates, references, vectors, threshold):
    def sure(x, y):
        same = lambda f: f(x) is not None and f(x) == f(y)
        words = lambda r: (" ".join(re.findall(r"\w+", (r["query"] or "").lower())), tuple(sorted(r["fingerprints"])))
        return same(lambda r: r["query"] or "") or same(words) or same(lambda r: (r["dataset"], r["example"]) if r["dataset"] and r["example"] else None)

    state = {k: [False, 0, 0] for k in range(len(candidates))}
    counters = [0, 0, 0]
    for i, x in enumerate(candidates):
        for j, y in [*((j, candidates[j]) for j in range(i + 1, len(candidates))), *((None, y) for y in references)]:
            ends = [i] if j is None else [i, j]
            certain = sure(x, y)
            u, v = vectors.get((False, x["id"])), vectors.get((j is None, y["id"]))
            scored = not certain and u is not None and v is not None
            found = certain or scored and u @ v >= threshold
            counters = [counters[0] + 1, counters[1] + scored, counters[2] + found]
            for k in ends:
                state[k] = [state[k][0] or found, state[k][1] + (not certain), state[k][2] + scored]
    return sorted((candidates[k]["id"], *map(int, s)) for k, s in state.items()), counters


@pytest.mark.parametrize("seed", range(4))
def test_the_scan_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    kind = "id long, query string, fingerprints array<string>, dataset string, example string"

    def made(n, start):
        return [{"id": start + k, "query": rng.choice(["a b", "A  b", "a b c", "x", "", None, f"q{rng.randrange(5)}"]), "fingerprints": rng.choice([[], ["f"], ["f", "g"], ["g", "f"]]), "dataset": rng.choice(["d", None]), "example": rng.choice(["1", "2", "3", None])} for k in range(n)]

    candidates, references = made(14, 0), made(9, 0 if seed % 2 else 50)  # ids of both sides may clash
    directions = [np.array(v) / np.linalg.norm(v) for v in ([1, 0, 0], [1, 0.1, 0], [0, 1, 0], [0, 1, 0.3], [0.5, 0.5, 0.7])]
    vectors = {(side, r["id"]): rng.choice(directions) for side, rows in ((False, candidates), (True, references)) for r in rows if rng.random() < 0.8}
    tagged = spark.createDataFrame([(f"{int(s)}:{i}", v.tolist()) for (s, i), v in vectors.items()], "id string, v array<double>")
    members, links = similarity.vector_links(tagged, "id", "v", 0.95)
    side = lambda s: members.where(F.col("id").startswith(f"{s}:")).select(F.split_part("id", F.lit(":"), F.lit(2)).cast("long").alias("id"), "cls")
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], kind)
    state, counters = scanning.scan(scanning.signatures(frame(candidates), frame(references), side(0), side(1)), links)
    expected, totals = plain_scan(candidates, references, vectors, 0.95)
    assert sorted((r.id, int(r.duplicate), r.comparisons_required, r.comparisons_evaluated) for r in state.collect()) == expected
    assert list(counters.first()) == totals


def test_the_scan_of_nothing_and_without_scores(spark):
    none = spark.createDataFrame([], "id long, query string, fingerprints array<string>, dataset string, example string")
    state, counters = scanning.scan(scanning.signatures(none, none))
    assert state.count() == 0 and list(counters.first()) == [0, 0, 0]
    one = spark.createDataFrame([(1, "a", [], None, None)], none.schema)
    state, counters = scanning.scan(scanning.signatures(one, none), production=True)
    assert [tuple(r) for r in state.collect()] == [(1, False, 0, 0, "passed")] and list(counters.first()) == [0, 0, 0]


def plain_shape(value, entities):
    """The rule word for word: every value is replaced everywhere, longest first."""
    fold = lambda x: unicodedata.normalize("NFKC", x).casefold().replace("i̇", "i")
    value = fold(value)
    for source, mark in sorted(((fold(v), f" <{k}> ") for k, vs in entities.items() for v in vs), key=lambda p: -len(p[0])):
        value = value.replace(source, mark) if source else value
    return " ".join(re.findall(r"\w+", value))


def test_entity_shapes_equal_replacement_one_by_one():
    rng = random.Random(3)
    letters = "abcİ<>é ﬁ"
    for _ in range(400):
        entities = {kind: ["".join(rng.choice(letters) for _ in range(rng.randrange(5))) for _ in range(rng.randrange(5))] for kind in ("a", "bc", "city")}
        own = text.Shapes(entities)
        for _ in range(10):
            value = "".join(rng.choice(letters) for _ in range(rng.randrange(20)))
            assert own.of(value) == plain_shape(value, entities), (value, entities)


def test_thousands_of_entities_decide_verdicts(spark):
    entities = {"city": [f"city number {k}" for k in range(5000)], "day": ["Monday", "Tuesday"]}
    rows = [(1, "Rain in City Number 17 on Monday?"), (2, "rain in city number 4999 on tuesday"), (3, "Rain on Monday"), (4, None)]
    records = spark.createDataFrame([(i, q, ["f"], None, None) for i, q in rows], "id long, query string, fingerprints array<string>, dataset string, example string")
    got = {r.id: (r.shape_of, r.decision) for r in duplicates.verdicts(records, entities=entities).collect()}
    assert got == {1: (None, "needs_semantic_review"), 2: (1, "possible_duplicate"), 3: (None, "needs_semantic_review"), 4: (None, "needs_semantic_review")}
    hashed = records.select(hashing.shape_hash(F.col("query"), entities)).first()[0]
    assert hashed == hashlib.sha256(b"rain in city on day").hexdigest()
    assert records.select(text.normalized_nfkc(F.lit("कि ＡＢ"))).first()[0] == plain_shape("कि ＡＢ", {})


def plain_leaves(value, path="$"):
    if isinstance(value, dict) and value:
        for k, v in value.items():
            yield from plain_leaves(v, path + (f".{k}" if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", k) else f"[{json.dumps(k, ensure_ascii=False)}]"))
    elif isinstance(value, list) and value:
        for k, v in enumerate(value):
            yield from plain_leaves(v, f"{path}[{k}]")
    else:
        yield path, value


def made_tree(rng, depth):
    kind = rng.randrange(7) if depth else rng.randrange(4)
    if kind < 4:
        return [rng.choice(["mock data", "plain", "", 'q"uote', "çok sentetik veri"]), rng.randrange(9), None, True][kind]
    if kind == 4:
        return [made_tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b_1", "with space", 'q"', "ü", "a.b", ""]): made_tree(rng, depth - 1) for _ in range(rng.randrange(4))}


def test_leaves_and_paths_equal_a_walk(spark):
    rng = random.Random(9)
    trees = [made_tree(rng, 5) for _ in range(80)] + [{"x": [[[[[{"deep": ["mock"]}]]]]]}]
    df = spark.createDataFrame([(k, json.dumps(t, ensure_ascii=False)) for k, t in enumerate(trees)] + [(900, None), (901, "{broken")], "id long, tree string")
    found = sorted((r.id, r.path, repr(r.value if r.kind == "string" else json.loads(r.value))) for r in jsons.leaves(df, ["id"], "tree").collect())
    assert found == sorted((k, p, repr(v)) for k, t in enumerate(trees) for p, v in plain_leaves(t))
    marked = {(r.id, r.path) for r in jsons.markers_within(df, ["id"], "tree").collect()}
    assert marked == {(k, p) for k, t in enumerate(trees) for p, v in plain_leaves(t) if isinstance(v, str) and ("mock" in v or "sentetik" in v)}


def test_values_by_keys_and_places(spark):
    tree = {"a": [1, {"b c": [None, "x", {'q"': 2.5}]}], "": "e"}
    df = spark.createDataFrame([(json.dumps(tree),)], "t string")
    at = lambda *path: df.select(jsons.value_at(F.col("t"), path)).first()[0]
    assert (at("a", 0), at("a", 1, "b c", 1), at("a", -1, "b c", -1, 'q"'), at(""), at("a", 1, "b c", 0)) == ("1", '"x"', "2.5", '"e"', "null")
    assert at("a", 7) is at("a", -7) is at("z") is at("a", "b") is at("", 0) is None
    assert json.loads(at()) == tree


def test_vectors_are_stored_once_and_not_for_each_cell(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    known = set(tables.made)
    similarity.vector_links(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 0.35)[1].count()
    kept = sum(p.stat().st_size for path in set(tables.made) - known for p in pathlib.Path(path.removeprefix("file:")).glob("*.parquet"))
    assert kept < 10 * 3000 * 16 * 8  # a vector that meets everything was sent to a cell a pivot before


@pytest.mark.parametrize("sent,cells", [(0, 2), (0, 1 << 14), (200_000, 1)])
def test_counters_are_the_same_whatever_is_sent(spark, monkeypatch, sent, cells):
    monkeypatch.setattr(scanning, "SENT", sent)
    monkeypatch.setattr(scanning, "CELLS", cells)
    test_the_scan_equals_all_pairs(spark, 1)


@pytest.mark.parametrize("block", [512, 3])
def test_vector_pairs_hold_copies_and_exact_thresholds(spark, block):
    rng = random.Random(3)
    base = [([rng.gauss(0, 1) for _ in range(5)]) for _ in range(9)]
    rows = [(k, rng.choice(base)) for k in range(40)] + [(40, [2 * x for x in base[0]]), (40, base[1]), (41, base[2]), (41, base[2]), (None, base[0]), (42, None), (43, [0.0] * 5)]
    rows += [(50, [1.0, 0.0, 0.0, 0.0, 0.0]), (51, [7.0, 18.0, 5.0, 1.0, 1.0]), (52, [3e200, 0.0, 0.0, 0.0, 0.0]), (53, [7.0, 18.0, 5.0, 1.0, 1.001])]
    cosine = lambda x, y: sum(a * b for a, b in zip(x, y, strict=True)) / (sum(a * a for a in x) * sum(b * b for b in y)) ** 0.5
    own = [(i, [x / max(map(abs, v)) for x in v] if max(map(abs, v)) > 1e99 else v) for i, v in rows if i is not None and v and any(v)]
    expected = sorted((i, j, round(cosine(u, v), 9)) for i, u in own for j, v in own if i < j and cosine(u, v) >= 0.35)
    got = similarity.vector_pairs(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 0.35, block=block)
    assert sorted((r.a, r.b, round(r.similarity, 9)) for r in got.collect()) == expected
    assert {(50, 51), (51, 52)} <= {(a, b) for a, b, _ in expected} and not {(50, 53), (52, 53)} & {(a, b) for a, b, _ in expected}


def test_the_query_of_vector_links_equals_its_sql_where_vectors_repeat(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 8)).astype(np.float32)
    spark.createDataFrame([(k, x[k % 30].tolist()) for k in range(90)], "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = duck.sql(catalog.ORACLE["vector_links"]).fetchall()
    got = [(r.a, r.b, r.similarity) for r in catalog.QUERIES["vector_links"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(expected) and {(k, k + 30) for k in range(60)} <= {(a, b) for a, b, _ in got}
