"""Benchmarks, manifests, loose tools, schemas and tables: what each refuses, and awkward rows."""

import json

import pytest
from pyspark.sql import functions as F

from quern.functions import jsons
from quern.operators import duplicates, lifecycle, numbering, reporting, series
from quern.sources import foreign, records, snapshots, tables

GOLD = f"id long, category string, tags array<string>, decision string, calls {reporting.CALLS}, missing array<string>"
PREDICTED = f"id long, decision string, calls {reporting.CALLS}, response string, missing array<string>, flow_valid boolean, execution_status string"


def benchmark(spark, gold, predicted, passed=()):
    registry = spark.createDataFrame([("f", '{"type":"object","properties":{"x":{"type":"integer","maximum":9}},"required":["x"],"additionalProperties":false}')], "name string, parameters string")
    judged = spark.createDataFrame([(i, True) for i in passed], "id long, passed boolean")
    return reporting.run_benchmark(spark.createDataFrame(gold, GOLD), spark.createDataFrame(predicted, PREDICTED), registry, judged)


def test_benchmark_refuses_what_it_cannot_judge(spark):
    row, answer = (1, "c", [], "direct_answer", [], None), (1, "direct_answer", [], "yes", None, None, None)
    for gold, predicted, word in (([row, row], [answer], "gold"), ([row], [answer, answer], "predictions"), ([row], [(2, *answer[1:])], "unknown")):
        with pytest.raises(ValueError, match=f"BENCHMARK_REFUSED.*{word}"):
            benchmark(spark, gold, predicted)


def test_benchmark_criteria(spark):
    call = lambda x, name="f": (name, json.dumps(x))
    cases = [
        (("tool_call", [call({"x": 1})], []), ("tool_call", [call({"x": 1})], None, True), "", 5),
        (("tool_call", [call({"x": 1})], []), ("tool_call", [call({"x": 2})], None, True), "ARGUMENT_VALUES_INCORRECT", 4),
        (("tool_call", [call({"x": 1})], []), ("tool_call", [call({"x": "1"})], None, True), "ARGUMENT_NAMES_OR_TYPES_INCORRECT,ARGUMENT_VALUES_INCORRECT,PREDICTION_SCHEMA_INVALID", 3),
        (("tool_call", [call({"x": 10})], []), ("tool_call", [call({"x": 10})], None, None), "PREDICTION_SCHEMA_INVALID", 5),
        (("tool_call", [call({"x": 1}), call({"x": 2})], []), ("tool_call", [call({"x": 2}), call({"x": 1})], None, True), "ARGUMENT_VALUES_INCORRECT", 4),
        (("tool_call", [call({"x": 1}), call({"x": 2})], ["parallel_tool"]), ("tool_call", [call({"x": 2}), call({"x": 1})], None, True), "", 5),
        (("tool_call", [call({"x": 1})], []), ("tool_call", [call({"x": 1})], "said", True), "FLOW_OR_FINAL_BEHAVIOR_INCORRECT", 4),
        (("tool_call", [call({"x": 1})], []), ("tool_call", [call({"x": 1}, "g")], None, True), "TOOL_SELECTION_OR_ORDER_INCORRECT,ARGUMENT_NAMES_OR_TYPES_INCORRECT,ARGUMENT_VALUES_INCORRECT,PREDICTION_SCHEMA_INVALID", 2),
        (("direct_answer", [], []), ("direct_answer", [], "yes", None), "", 5),
        (("direct_answer", [], []), ("direct_answer", [], " ", None), "FLOW_OR_FINAL_BEHAVIOR_INCORRECT", 4),
        (("direct_answer", [], []), ("cannot_answer", [], "yes", None), "DECISION_INCORRECT,TOOL_SELECTION_OR_ORDER_INCORRECT,ARGUMENT_NAMES_OR_TYPES_INCORRECT,ARGUMENT_VALUES_INCORRECT,FLOW_OR_FINAL_BEHAVIOR_INCORRECT", 0),
    ]
    gold = [(i, "c", tags, decision, calls, None) for i, ((decision, calls, tags), *_) in enumerate(cases)] + [(99, "c", [], "direct_answer", [], None)]
    predicted = [(i, decision, calls, response, None, flow, None) for i, (_, (decision, calls, response, flow), *_) in enumerate(cases)]
    got = {r.id: r for r in benchmark(spark, gold, predicted, range(len(cases))).collect()}
    assert [(i, got[i].errors, got[i].total) for i, (*_, errors, total) in enumerate(cases) if (got[i].errors, got[i].total) != (errors, total)] == []
    assert got[99].missing_prediction and got[99].total == 0 and got[99].schema_valid == 1


def test_manifest_problems(spark):
    rows = spark.range(1, 26).select((F.col("id") * 1000).alias("k"), F.col("id").cast("string").alias("line"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"))
    plan = lambda df, size=10: lifecycle.job_manifest(df, "k", "line", size, {"kind": F.col("kind")})
    found = lambda other: {(r.shard, r.problem) for r in lifecycle.manifest_problems(plan(rows), other).collect()}
    assert [(r.start, r.end) for r in plan(rows).orderBy("shard").collect()] == [(0, 10), (10, 20), (20, 25)]
    assert json.loads(plan(rows).where("shard = 2").first().distributions) == {"kind": {"labels": ["a", "b"], "counts": [2, 3]}}
    assert found(plan(rows)) == set()
    assert found(plan(rows.withColumn("line", F.when(F.col("k") == 3000, "x").otherwise(F.col("line"))))) == {(0, "changed")}
    assert found(plan(rows.withColumn("kind", F.when(F.col("k") == 13000, "c").otherwise(F.col("kind"))))) == {(1, "relabelled")}
    assert found(plan(rows.where("k <= 20000"))) == {(2, "gone")}
    assert found(plan(rows.where("k <> 25000"))) == {(2, "moved")}


def test_numbers_of_sparse_tied_and_null_groups(spark):
    rows = [(g, v) for g in ("x", None, "y") for v in (-(10**15), 3, 3, 4, 10**17)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = numbering.numbered(df, "v", ["g"]).collect()
    for g in ("x", None, "y"):
        own = sorted((r.number, r.v) for r in got if r.g == g)
        assert [n for n, _ in own] == [1, 2, 3, 4, 5] and [v for _, v in own] == sorted(v for k, v in rows if k == g)
    assert numbering.numbered(df.limit(0), "v").count() == 0


def test_cosine_search_on_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 1.0]), (5, [1.0, 0.0, 0.0]), (6, []), (100, [1.0, 0.1]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "i long, v array<float>")
    got = {(r.a, r.b): r.similarity for r in duplicates.cosine_search(df, "i", "v", 0.9, block=2).collect()}
    assert set(got) == {(0, 1), (0, 100), (100, 0), (100, 1)} and abs(got[0, 1] - 1) < 1e-12


def test_verdicts_name_the_earliest(spark):
    rows = [(1, "Hello world", [], None, None), (2, "hello,  WORLD", [], "d", "1"), (3, "Hello world", ["s"], "d", None), (4, "other", [], "d", "1"), (5, "hello world", ["s"], None, "1")]
    df = spark.createDataFrame(rows, "id long, query string, fingerprints array<string>, dataset string, example string")
    got = {r.id: tuple(r)[1:] for r in duplicates.verdicts(df).collect()}
    assert got == {1: (None, None, None, None, "needs_semantic_review"), 2: (None, 1, 1, None, "duplicate"), 3: (1, 1, None, None, "duplicate"), 4: (None, None, None, 2, "duplicate"), 5: (None, 1, 3, None, "duplicate")}


def test_covered(spark):
    df = spark.createDataFrame([("a", "2024-01-02", "9"), ("a", "2024-01-05", "10"), ("b", "2024-01-09", "1")], "k string, d string, r string").withColumn("d", F.to_date("d"))
    asked = spark.createDataFrame([("a", "2024-01-02", "2024-01-09"), ("a", "2024-01-01", "2024-01-03"), ("a", "2024-01-05", "2024-01-03"), ("a", "2024-01-03", "2024-01-04")], "k string, start string, end string")
    got = {(str(r.start), str(r.end)): (r.status, r.rows, r.release_id) for r in series.covered(asked.select("k", F.to_date("start").alias("start"), F.to_date("end").alias("end")), df, "k", "d", "r").collect()}
    assert got == {("2024-01-02", "2024-01-09"): ("covered", 2, "9-10"), ("2024-01-01", "2024-01-03"): ("coverage_error", 0, None), ("2024-01-05", "2024-01-03"): ("range_error", 0, None), ("2024-01-03", "2024-01-04"): ("covered", 0, None)}


def test_schema_keywords():
    v = lambda schema, value: [c for c, _ in jsons.violations(schema, value)]
    tree = {"$defs": {"n": {"type": "object", "properties": {"next": {"$ref": "#/$defs/n"}, "v": {"type": "integer"}}}}, "$ref": "#/$defs/n"}
    assert jsons.violations(tree, {"v": 1, "next": {"next": {"v": "x"}}}) == [("TYPE", "$.next.next.v")]
    for schema, good, bad in (
        ({"multipleOf": 0.1}, 0.3, 0.35), ({"minProperties": 1, "maxProperties": 2}, {"a": 1}, {}), ({"patternProperties": {"^s": {"type": "string"}}, "additionalProperties": False}, {"s": "x"}, {"s": 1}), ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, ["a", 1], ["a", "b"]),
        ({"dependentRequired": {"a": ["b"]}}, {"b": 1}, {"a": 1}), ({"exclusiveMaximum": 3}, 2, 3), ({"contains": {"const": 1}, "maxContains": 1}, [1, 2], [1, 1]), ({"format": "email"}, "a@b", "ab"), ({"format": "ipv4"}, "1.2.3.4", "1.2.3.400"), ({"format": "uuid"}, "123e4567-e89b-12d3-a456-426614174000", "x"), ({"propertyNames": {"maxLength": 1}}, {"a": 1}, {"ab": 1}),
    ):
        assert v(schema, good) == [] and v(schema, bad), schema


def test_loose_tools(spark):
    raw = ['{"name":"f"}', '{"name":3}', '"{\\"name\\":\\"f\\",\\"parameters\\":\\"{}\\"}"', "x", None, '{"name":"f","parameters":[1]}', '{"name":"f","parameters":{"a":{"type":["int","null"]},"b":{"type":"bool","required":false}}}']
    got = [r[0] and json.loads(r[0]) for r in spark.createDataFrame([(x,) for x in raw], "t string").select(foreign.tool("t")).collect()]
    empty = {"name": "f", "description": "", "parameters": {"type": "object", "properties": {}, "required": [], "additionalProperties": False}}
    assert got[:6] == [empty, None, empty, None, None, None]
    assert got[6]["parameters"]["properties"] == {"a": {"type": ["integer", "null"]}, "b": {"type": "boolean"}}
    calls = ['{"name":"f","arguments":{"a":1}}', '{"name":"f","arguments":"{\\"a\\":1}"}', '{"name":"f","arguments":[]}', '{"arguments":{}}']
    told = [r[0] and json.loads(r[0]) for r in spark.createDataFrame([(x,) for x in calls], "t string").select(foreign.call("t")).collect()]
    assert told == [{"name": "f", "arguments": {"a": 1}}] * 2 + [None, None]


def test_tables_are_dealt_and_deleted(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    for deal in (tables.dealt, tables.bucketed):
        t = deal(df, "x", "t")
        plan = t.groupBy("x").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and t.count() == 100
        name = tables.made[-1]
        tables.forget(spark, [name])
        assert not spark.catalog.tableExists(name)
    d = tables.durable(df, "d")
    tables.release(d)
    with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
        spark.read.parquet(d.durable_path).count()


def test_record_files(spark, tmp_path):
    for name, text in {"accepted/a.jsonl": '{"id":"1"}\n', "staging/deep/b.json": "{}", "other/c.jsonl": "{}", "lines/d.jsonl": '{"id":"2"}\n\n{"id":"3"}', "bad/e.jsonl": '{"id":"4"}\n[1]', "bad/Registry.JSONL": "{}"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    assert {(r.name, r.state) for r in records.by_state(spark, str(tmp_path)).collect()} == {("a.jsonl", "accepted"), ("b.json", "staging")}
    assert [r.name for r in records.line_files(spark, str(tmp_path / "lines")).collect()] == ["d.jsonl"]
    for folder, word in (("bad", "Registry.JSONL"), ("staging", "b.json")):
        with pytest.raises(ValueError, match=f"RECORDS_REFUSED.*{word}"):
            records.line_files(spark, str(tmp_path / folder))
    assert sorted(r.id for r in records.load(spark, str(tmp_path / "lines"), "id STRING").collect()) == ["2", "3"]
    with pytest.raises(ValueError, match="RECORDS_REFUSED.*e.jsonl:2"):
        records.load(spark, str(tmp_path / "bad"), "id STRING")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, None), ("a", 2, "x")], "z string, a int, m string")
    assert records.write(df, str(tmp_path / "out")) == 2
    assert {r.value for r in spark.read.text(str(tmp_path / "out")).collect()} == {'{"a":1,"m":null,"z":"b"}', '{"a":2,"m":"x","z":"a"}'}
    with pytest.raises(Exception, match="(?i)exists"):
        records.write(df, str(tmp_path / "out"))
    records.write_run_log(df, str(tmp_path), "model-1", "run_2")
    assert spark.read.json(str(tmp_path / "model-1" / "run_2")).count() == 2
    with pytest.raises(ValueError, match="RUN_LOG_REFUSED"):
        records.write_run_log(df, str(tmp_path), "../x", "r")
    assert snapshots.write_csv(df, str(tmp_path / "csv"), ["z"]) == 2
    with pytest.raises(ValueError, match="SNAPSHOT_REFUSED: repeated key b"):
        snapshots.write_csv(df.union(df.where("z = 'b'")), str(tmp_path / "csv2"), ["z"])
