import json
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.operators.quality import argument_signature
from quern.functions import hashing, jsons, text, vectors
from quern.operators import duplicates, numbering, reporting, series, state


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(f(F.col("v"))).collect()]


def test_normalization(spark):
    assert column(spark, ["İSTANBUL", "  MERHABA, dünya! ", None, "½ x_y"], text.normalized) == ["istanbul", "merhaba dünya", "", "½ x_y"]
    assert column(spark, ["ﬁ Straße İ", None], text.normalized_nfkc) == ["fi strasse i", None]
    assert column(spark, ["Şanlıurfa ", "İzmir"], text.place) == ["sanliurfa", "izmir"]


def test_markers(spark):
    got = column(spark, ["SİMÜLASYON", "mock_data", "_mock_", "fixture_id", "mocks", "fully-simulated", None], text.markers)
    assert got == [["simülasyon"], ["mock"], ["mock"], ["fixture_id"], [], ["fully-simulated"], []]


def test_numbers_and_scripts(spark):
    assert column(spark, ["a 1.5 b-2 x3 -4,0", None], text.numbers) == [["1,5", "-2", "-4,0"], []] or column(spark, ["a 1.5 x3 -4,0"], text.numbers) == [["1,5", "-4,0"]]
    assert column(spark, ["abc çé µ", "при", None], text.foreign_letters) == [0, 3, 0]


def test_ids_and_samples(spark):
    assert column(spark, [1, 999_999, 0, 1_000_000], lambda v: hashing.record_id(F.lit("ot"), v), "long") == ["tctr_ot_000001", "tctr_ot_999999", None, None]
    assert abs(column(spark, ["tctr_ot_000001"], hashing.sample_share)[0] - 0.3135878853155951) < 1e-15
    assert column(spark, ["tctr_ot_000001", "tctr_tr_000001", "tctr_ot_000000", None], lambda v: hashing.valid_record_id(v, F.lit("original_turkish"))) == [True, False, False, False]


def test_json_values(spark):
    df = spark.createDataFrame([('{"a":3,"b":1}', '{"b":1,"a":3.0}', True), ("[1,2]", "[2,1]", False), (None, None, True)], "a string, b string, same boolean")
    assert all(r[0] == r[1] for r in df.select(jsons.same_value(df.a, df.b), "same").collect())
    assert column(spark, ["1", "1.5", "true", '"x"', "[]", "{}", "null"], jsons.type_name) == ["integer", "number", "boolean", "string", "array", "object", "null"]
    assert column(spark, ['{"b":[1, 2.50],"a":null}', "{bad", None], jsons.canonical_json) == ['{"a":null,"b":[1,2.5]}', None, None]


def test_fingerprint(spark):
    schemas = [{"type": "object", "required": ["a", "b"], "description": "x"}, {"required": ["b", "a"], "type": "object"}, {"type": "object", "required": ["a"]}]
    a, b, c = column(spark, list(map(json.dumps, schemas)), jsons.schema_fingerprint)
    assert a == b != c


@pytest.mark.parametrize(
    ("schema", "value", "codes"),
    [
        ({"type": "object", "properties": {"n": {"type": "integer"}}, "required": ["n"], "additionalProperties": False}, {"n": 3.0}, []),
        ({"type": "object", "properties": {"n": {"type": "integer"}}, "required": ["n"], "additionalProperties": False}, {"m": 1}, ["REQUIRED", "ADDITIONAL"]),
        ({"type": "integer"}, True, ["TYPE"]),
        ({"enum": [1, "a"]}, True, ["ENUM"]),
        ({"type": "array", "uniqueItems": True}, [1, True], []),
        ({"type": "array", "uniqueItems": True, "minItems": 3}, [1, 1], ["INVALID"]),
        ({"format": "date"}, "2024-02-30", ["FORMAT"]),
        ({"anyOf": [{"type": "string"}, {"type": "null"}]}, 4, ["INVALID"]),
        ({"oneOf": [{"minimum": 1}, {"maximum": 3}]}, 2, ["INVALID"]),
        ({"if": {"minimum": 5}, "then": {"maximum": 6}}, 9, ["INVALID"]),
        ({"not": {"type": "string"}, "const": 2}, 2, []),
    ],
)
def test_schema_violations(schema, value, codes):
    assert [c for c, _ in jsons.violations(schema, value)] == codes


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(vectors.cosine(df.a, df.b)).collect()]
    assert abs(got[0] - 0.5**0.5) < 1e-12 and got[1:] == [None, None]
    sets = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "a array<string>, b array<string>")
    assert [r[0] for r in sets.select(vectors.jaccard(sets.a, sets.b)).collect()] == [1 / 3, 1.0]


def test_pair_decision(spark):
    df = spark.createDataFrame([(True, False, None), (False, False, 0.95), (False, False, 0.1), (False, None, None), (False, True, None)], "exact boolean, source boolean, score double")
    got = [r[0] for r in df.select(duplicates.pair_decision(df.exact, df.source, F.lit(False), F.lit(False), df.score)).collect()]
    assert got == ["duplicate", "possible_duplicate", "distinct", "needs_semantic_review", "duplicate"]


def test_evaluation(spark):
    cases = [(True, True, True, True, True, True), (True, False, True, True, True, True), (False, True, True, True, True, True), (True, True, True, False, True, True)]
    df = spark.createDataFrame(cases, "d boolean, t boolean, s boolean, v boolean, f boolean, ok boolean")
    got = [(r.total, r.exact, r.errors.split(",")[0]) for r in reporting.evaluated(df, df.d, df.t, df.s, df.v, df.f, df.ok).collect()]
    assert got == [(5, 1, ""), (2, 0, "TOOL_SELECTION_OR_ORDER_INCORRECT"), (0, 0, "DECISION_INCORRECT"), (4, 0, "ARGUMENT_VALUES_INCORRECT")]


def test_numbering_over_stretches(spark):
    df = spark.createDataFrame([(i * 7, "ab"[i % 2]) for i in range(100)], "k long, g string")
    got = numbering.numbered(df, "k", ["g"]).toPandas().sort_values("k")
    assert all(list(part.number) == list(range(1, 51)) for _, part in got.groupby("g"))
    plan = numbering.shard_plan(df, "k", 30).orderBy("shard").collect()
    assert [(r["first"], r["last"], r["rows"]) for r in plan] == [(0, 30, 30), (30, 60, 30), (60, 90, 30), (90, 100, 10)]


def test_series(spark):
    from decimal import Decimal

    rows = [("USD", "2026-04-01", Decimal("44.4738")), ("USD", "2026-04-03", Decimal("46.6586")), ("EUR", "2026-04-01", Decimal("50.0000"))]
    df = spark.createDataFrame(rows, "k string, d string, v decimal(18,4)").withColumn("d", F.to_date("d"))
    got = {r.k: r for r in series.change(df, "k", "d", "v").collect()}
    assert got["USD"].change == Decimal("2.1848") and got["USD"].change_percent == Decimal("4.91") and got["EUR"].change is None
    assert [str(r.day) for r in series.missing_days(df, "k", "d").collect()] == ["2026-04-02"]
    found = series.looked_up(df.select("k").distinct(), df.where("k = 'USD'").select("k", "v"), ["k"]).collect()
    assert {r.k: r.status for r in found} == {"USD": "snapshot_error", "EUR": "lookup_error"}


def test_booking(spark):
    asked = [(1, "a", "d", "09:00", "10:00", 2, True), (2, "a", "d", "09:30", "10:30", 2, True), (3, "a", "d", "10:00", "11:00", 9, True), (4, "a", "d", "10:00", "10:00", 1, True), (5, "b", "d", "10:00", "11:00", 1, True), (6, "a", "d", "10:00", "11:00", 1, False), (7, "a", "d", "10:00", "11:00", 1, True)]
    df = spark.createDataFrame(asked, "request long, room_id string, date string, start_time string, end_time string, attendee_count int, confirmed boolean")
    got = {r.request: (r.status, r.conflict_with) for r in state.book(df, spark.createDataFrame([("a", 4)], "room_id string, capacity int")).collect()}
    assert got == {1: ("confirmed", None), 2: ("conflict", 1), 3: ("capacity_exceeded", None), 4: ("invalid_time_range", None), 5: ("unknown_room", None), 6: ("confirmation_required", None), 7: ("confirmed", None)}


def test_quick_schema_test_agrees_with_the_whole_one():
    values = [None, True, 0, 3, 45, 46, 2.0, 2.5, float("nan"), float("inf"), 10**400, "", "x", [], [1], {}, {"a": 1}, {"a": 1, "b": "x"}, {"a": True, "b": 2.0}, {"a": 50}, {"c": None}, {"a": 1, "b": float("nan")}]
    part = {"type": "integer", "maximum": 45}
    schemas = [True, {}, part, {"type": ["number", "null"]}, {"title": "t"}, {"type": "object", "properties": {"a": part, "b": {}}, "required": ["a"], "additionalProperties": False}, {"properties": {"a": {"minimum": 1}}, "required": ["b"]}]
    for schema in schemas:
        own = jsons.Schema(schema)
        assert own.quick is not None and not any(own.quick(v) and own.issues(v) for v in values)
        assert own.quick(45 if schema != schemas[5] else {"a": 45})
    assert all(jsons.Schema(x).quick is None for x in (False, {"pattern": "a"}, {"type": "odd"}, {"properties": {"a": {"enum": [1]}}}, {"additionalProperties": {}}))


def test_texts_are_changed_in_stretches(monkeypatch):
    """A batch of any size takes Python's memory for a stretch of its texts."""
    monkeypatch.setattr(text, "STRETCH", 20_000)
    texts = [None, "", *("of the word " * 100 for _ in range(4_000))]
    tracemalloc.start()
    got = text.in_stretches(pa.array(texts), str.upper)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [x and x.upper() for x in texts] and most < 1_000_000
    assert text.in_stretches(pa.array([], pa.string()), str.upper).to_pylist() == []
    assert text.in_stretches(pa.array(["a" * 30_000, None]), str.upper).to_pylist() == ["A" * 30_000, None]


def test_argument_signatures_read_their_json_once(spark):
    odd = [None, "", "{}", "[]", "1", '{"a":1', '{"b":[1],"a":{"x":[]},"c":null}', '[{"a":1}]', '{"a":1.5,"b":true,"c":"s"}', '{"a":tru}']
    out = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, a string").select("i", argument_signature(F.col("a")).alias("s"))
    assert [r.s for r in out.orderBy("i").collect()] == [None, None, "", None, None, None, "a:object,b:array,c:null", None, "a:number,b:boolean,c:string", None]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
