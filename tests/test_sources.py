"""Lines over file splits, rows of foreign datasets, localization, parts of jobs, intermediate tables, versions and broken schemas."""

import copy
import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import jsons, versions
from quern.operators import lifecycle, quality
from quern.plans import scans
from quern.sources import foreign, records, tables


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_are_numbered_over_splits(spark, small_splits, tmp_path):
    rng = random.Random(1)
    expected = []
    for name in ("a.jsonl", "b.jsonl"):
        lines = [rng.choice(["", "  ", json.dumps({"k": k, "é": "x" * rng.randrange(60)})]) for k in range(300)]
        (tmp_path / name).write_bytes("".join(x + rng.choice(["\n", "\r\n"]) for x in lines[:-1]).encode() + lines[-1].encode())
        expected += [(name, k, x) for k, x in enumerate(lines, 1) if x.strip()]
    (tmp_path / "other.txt").write_text("no")
    found = records.read_lines(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    text = spark.read.option("pathGlobFilter", "*.jsonl").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 4  # files were cut


def test_rows_of_lists_and_objects(spark, tmp_path):
    (tmp_path / "b.json").write_text('[{"a":1},[2],{"a":3}]')
    (tmp_path / "A.json").write_text('{"a": 4}')
    (tmp_path / "c.jsonl").write_text('\n{"a":5}\n')
    got = {(r.file, r.number): r.raw.replace(" ", "") for r in records.read_rows(spark, str(tmp_path)).collect()}
    assert got == {("b.json", 1): '{"a":1}', ("b.json", 2): "[2]", ("b.json", 3): '{"a":3}', ("A.json", 1): '{"a":4}', ("c.jsonl", 2): '{"a":5}'}
    assert [(r.place, r.name) for r in records.record_files(spark, str(tmp_path)).orderBy("place").collect()] == [(1, "A.json"), (2, "b.json"), (3, "c.jsonl")]
    with pytest.raises(Exception, match="(?i)path.*not.*exist"):
        records.record_files(spark, str(tmp_path / "none"))


TOOL = {"name": "f", "description": "does", "parameters": {"type": "dict", "properties": {"a": {"type": "int"}, "b": 3}, "required": ["a"]}}
STRICT = {"name": "f", "description": "does", "parameters": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "string"}}, "required": ["a"], "additionalProperties": False}}
GOOD = {
    "when2call_test": {"uuid": "u1", "correct_answer": "direct", "question": "q?", "tools": json.dumps([TOOL]), "answers": {"direct": "so"}},
    "call": {"uuid": "u2", "correct_answer": "tool_call", "question": "q", "answers": {"tool_call": '{"name":"f","arguments":"{}"}'}},
    "ask": {"source_id": 7, "correct_answer": "request_for_info", "question": "q", "answers": {"request_for_info": "which?"}, "held_out_param": "a"},
    "vague": {"correct_answer": "request_for_info", "question": "q", "answers": {"request_for_info": "which?"}},
    "when2call_train_pref": {"messages": [{"role": "user", "content": "a"}, {"role": "user", "content": "b"}], "chosen_response": {"role": "assistant", "content": "c"}, "rejected_response": {}, "tools": [TOOL]},
    "when2call_train_sft": {"messages": [{"role": "assistant", "content": "x"}, {"role": "user", "content": "b"}, {"role": "assistant", "content": " "}]},
}
BAD = {
    "FORMAT": {"question": "q"},
    "DECISION": {"correct_answer": "maybe", "question": "q", "answers": {}},
    "QUERY": {"correct_answer": "direct", "question": " ", "answers": {"direct": "so"}},
    "TOOLS": {"correct_answer": "direct", "question": "q", "answers": {"direct": "so"}, "tools": [{"name": "f", "parameters": []}]},
    "CALLS": {"correct_answer": "tool_call", "question": "q", "answers": {"tool_call": None}},
    "RESPONSE": {"correct_answer": "cannot_answer", "question": "q", "answers": {"direct": "so"}},
    "ROW": [1],
}


def test_rows_become_work_items(spark, tmp_path):
    lines = [*map(json.dumps, GOOD.values()), *map(json.dumps, BAD.values())]
    rows = spark.createDataFrame([("s.jsonl", k, x) for k, x in enumerate(lines, 1)], "file string, number long, raw string")
    items, issues = foreign.work_items(rows, "when2call", "test")
    assert sorted((r.number, r.code) for r in issues.collect()) == [(k, f"SOURCE_{code}_INVALID") for k, code in enumerate(BAD, len(GOOD) + 1)]
    got = {r.source.row_number: (r.source, json.loads(r.content), r.localization) for r in items.collect()}
    said = lambda k: (got[k][1]["query"], got[k][1]["decision"], got[k][1]["response"], got[k][1]["missing_parameters"], got[k][2].status)
    assert [said(k) for k in range(1, 7)] == [("q?", "direct_answer", "so", [], "pending"), ("q", "tool_call", None, [], "pending"), ("q", "request_information", "which?", ["a"], "pending"), ("q", "request_information", "which?", [], "needs_source_review"), ("b", None, "c", [], "needs_source_review"), ("b", None, None, [], "needs_source_review")]
    assert [got[k][0].example_id for k in range(1, 7)] == ["u1", "u2", "7", "row-000004", "row-000005", "row-000006"]
    assert [got[k][0].format for k in (1, 5, 6)] == ["when2call_test", "when2call_train_pref", "when2call_train_sft"]
    assert got[1][1]["tools"] == got[5][1]["tools"] == [STRICT] and got[2][1]["tool_calls"] == [{"name": "f", "arguments": {}}]
    assert got[1][0].raw_sha256 == hashlib.sha256(jsons.canonical(GOOD["when2call_test"]).encode()).hexdigest()
    machine = {k: v for k, v in got[1][1].items() if k not in ("query", "response")} | {"tools": [{"name": "f", "parameters": STRICT["parameters"]}]}
    assert got[1][2].machine_fingerprint == hashlib.sha256(jsons.canonical(machine).encode()).hexdigest()
    assert (got[1][0].license, list(got[1][0].license_chain), got[1][0].dataset) == ("cc-by-4.0", ["cc-by-4.0"], "nvidia/When2Call")


def test_an_import_is_whole_or_refused(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([{"id": 5, "query": "q", "tools": [TOOL], "answers": "[]"}, {"query": "q", "tools": "[]", "answers": []}]))
    got = foreign.import_source(spark, str(tmp_path), "xlam", "train", terms_accepted=True).collect()
    assert sorted(r.source.example_id for r in got) == ["5", "row-000002"] and {r.source.source_file for r in got} == {"x.json"}
    for split, source, accepted in ((" ", "xlam", True), ("s", "xlam", False), ("s", "else", True)):
        with pytest.raises(ValueError, match="SOURCE_REFUSED"):
            foreign.import_source(spark, str(tmp_path), source, split, accepted)
    (tmp_path / "y.jsonl").write_text('{"query":"q","tools":"[","answers":[]}\n')
    with pytest.raises(ValueError, match="y.jsonl:1 SOURCE_TOOLS_INVALID"):
        foreign.import_source(spark, str(tmp_path), "xlam", "s", True)


def test_localization_changes_words_alone(spark):
    raw = [json.dumps({"id": k, "query": "q", "tools": [TOOL], "answers": [{"name": "f", "arguments": {}}]}) for k in range(12)]
    items = foreign.work_items(spark.createDataFrame([("f", k, x) for k, x in enumerate(raw, 1)], "file string, number long, raw string"), "xlam", "s")[0]
    good = {"query": "soru", "actor_id": "p", "provider": "m", "provider_version": "2", "tool_descriptions": {"f": "yapar"}, "parameter_descriptions": {"f": {"a": "sayı", "b": "söz"}}}

    def changed(**more):
        return copy.deepcopy(good) | more

    patches = {0: [good], 1: [], 2: [good, good], 3: [changed(query=" ")], 4: [changed(tool_descriptions={"g": "x"})], 5: [changed(parameter_descriptions={"f": {"a": "x"}})], 6: [changed(response="r")], 7: [changed(actor_id=None)], 8: [changed(tool_descriptions=[])], 9: [changed(parameter_descriptions={"f": {"a": "x", "b": ""}})], 10: [changed(provider="")], 11: [good], "other": [good]}
    rows = [(json.dumps(p | {"source_example_id": str(k)}),) for k, ps in patches.items() for p in ps] + [(json.dumps(good),), ("{",)]
    done, issues = foreign.localized(items, spark.createDataFrame(rows, "raw string"), "T")
    got = {r.source.example_id: r for r in done.collect()}
    assert set(got) == {"0", "11"}
    content = json.loads(got["0"].localized_content)
    assert content["query"] == "soru" and content["tools"][0]["description"] == "yapar" and content["tools"][0]["parameters"]["properties"] == {"a": {"type": "integer", "description": "sayı"}, "b": {"type": "string", "description": "söz"}}
    assert (got["0"].localization.status, got["0"].localization.provider_version, got["0"].localization.applied_at) == ("localized_needs_review", "2", "T")
    names, blank, actor = "PATCH_NAMES_DIFFER", "PATCH_TEXT_BLANK", "PATCH_ACTOR_MISSING"
    assert sorted((str(r.source_example_id), r.code) for r in issues.collect()) == sorted([("1", "PATCH_MISSING"), ("2", "PATCH_REPEATED"), ("3", blank), ("4", names), ("5", names), ("6", names), ("7", actor), ("8", names), ("9", blank), ("10", actor), ("other", "PATCH_UNKNOWN"), ("None", "PATCH_WITHOUT_ID"), ("None", "PATCH_WITHOUT_ID")])
    moved = items.withColumn("localization", F.col("localization").withField("machine_fingerprint", F.lit("0")))
    kept, found = foreign.localized(moved.where("source.example_id = '0'"), spark.createDataFrame(rows[:1], "raw string"), "T")
    assert kept.count() == 0 and [r.code for r in found.collect()] == ["FINGERPRINT_MOVED"]


def test_loose_schemas_of_any_kind_fail_no_job(spark):
    odd = ['{"name":"f","parameters":{"type":["dict","null"],"properties":{}}}', '{"name":"f","parameters":{"properties":[1]}}', '{"name":"f","parameters":{"properties":{"a":null}}}', '{"name":"f","parameters":{"a":{"type":{"x":1}}}}', "[" * 100_000]
    got = [r[0] and json.loads(r[0])["parameters"] for r in spark.createDataFrame([(x,) for x in odd], "t string").select(foreign.tool("t")).collect()]
    assert got[0]["type"] == ["object", "null"] and got[1] is None and got[4] is None
    assert got[2]["properties"] == {"a": {"type": "string"}} and got[3]["properties"] == {"a": {"type": {"x": 1}}}


def test_broken_schemas_are_issues(spark):
    broken = ['{"type":"nothing"}', '{"$ref":"#/nowhere"}', '{"$ref":"#"}', '{"pattern":"("}', '{"required":3}', '{"properties":[]}', '{"multipleOf":0}', "3"]
    rows = [(s, "1" if "multiple" in s or s == "3" else '{"a":1}' if "prop" in s or "req" in s else '"x"') for s in broken]
    got = spark.createDataFrame(rows, "s string, v string").select("s", jsons.schema_issues("s", "v").alias("x")).collect()
    assert {r.s: [i.code for i in r.x] for r in got} == {s: ["INVALID_JSON_SCHEMA"] for s in broken}
    problems = {r.s: r.p for r in spark.createDataFrame([(s,) for s in [*broken, "{", '{"properties":{"a":{"type":"int"}},"$defs":{"x":{"items":[1]}}}', "{}", "true"]], "s string").select("s", jsons.schema_problems("s").alias("p")).collect()}
    assert problems['{"properties":{"a":{"type":"int"}},"$defs":{"x":{"items":[1]}}}'] == ["$.$defs.x.items", "$.properties.a.type"]
    assert problems["{"] == problems["3"] == ["$"] and problems["{}"] == problems["true"] == problems['{"$ref":"#"}'] == [] and problems['{"pattern":"("}'] == ["$.pattern"]


@pytest.mark.parametrize(
    "schema,good,bad",
    [
        ({"properties": {"a": {}}, "unevaluatedProperties": False}, {"a": 1}, {"b": 1}),
        ({"allOf": [{"properties": {"a": {}}}], "anyOf": [{"properties": {"b": {"type": "string"}}}, {"properties": {"c": {}}}], "unevaluatedProperties": {"type": "null"}}, {"a": 1, "b": "x", "c": 2, "d": None}, {"a": 1, "b": 1, "c": 2}),
        ({"if": {"required": ["k"], "properties": {"k": {"const": 1}}}, "then": {"properties": {"x": {}}}, "unevaluatedProperties": False}, {"k": 1, "x": 2}, {"k": 2, "x": 2}),
        ({"prefixItems": [{}], "contains": {"type": "string"}, "unevaluatedItems": False}, [1, "a"], [1, "a", 2]),
        ({"$ref": "#/$defs/base", "unevaluatedProperties": False, "$defs": {"base": {"properties": {"a": {}}}}}, {"a": 1}, {"z": 1}),
        ({"$id": "https://x.test/root", "items": {"$ref": "part#deep"}, "$defs": {"p": {"$id": "part", "$defs": {"d": {"$anchor": "deep", "type": "integer"}}}}}, [1], ["a"]),
        ({"$ref": "#tree", "$defs": {"t": {"$anchor": "tree", "properties": {"next": {"$ref": "#tree"}, "v": {"type": "integer"}}}}}, {"v": 1, "next": {"next": {"v": 2}}}, {"next": {"next": {"v": "x"}}}),
        ({"$ref": "#/$defs/a~1b/allOf/0", "$defs": {"a/b": {"allOf": [{"type": "null"}]}}}, None, 1),
        ({"enum": [1, [True]]}, 1.0, [1]),
        ({"uniqueItems": True}, [1, True, "1"], [1, 1.0]),
        ({"format": "ipv4"}, "1.2.3.4", "::1"),
        ({"format": "regex"}, "a+", "("),
    ],
)
def test_schemas_with_addresses_and_what_is_left(schema, good, bad):
    assert jsons.Schema(schema).problems == []
    assert jsons.violations(schema, good) == [] and jsons.violations(schema, bad) != []


def test_parts_survive_a_kill_and_assemble_in_order(spark, tmp_path):
    path, out = str(tmp_path / "parts"), str(tmp_path / "out")
    rows = spark.range(0, 1000, 1, 7).select(F.col("id").alias("index"), F.format_string("line %d", "id").alias("line"))
    assert lifecycle.write_parts(rows.where("index % 3 = 0"), path) == 334
    broken = rows.withColumn("line", F.when(F.col("index") == 997, F.raise_error(F.lit("killed"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="killed"):
        lifecycle.write_parts(broken, path)
    assert lifecycle.parts_at(spark, path).count() == 334  # nothing of the killed call is there
    with pytest.raises(ValueError, match="ASSEMBLY_REFUSED: 334 of 1000"):
        lifecycle.assemble(spark, path, 1000, out)
    assert lifecycle.write_parts(rows, path) == 666 and lifecycle.write_parts(rows, path) == 0
    with pytest.raises(ValueError, match="PART_DIFFERS: 5"):
        lifecycle.write_parts(spark.createDataFrame([(5, "else"), (6, "line 6")], "index long, line string"), path)
    with pytest.raises(ValueError, match="PART_REPEATED: 2000"):
        lifecycle.write_parts(spark.createDataFrame([(2000, "a"), (2000, "b")], "index long, line string"), path)
    digests = lifecycle.assemble(spark, path, 1000, out, 300)
    text = [x for f in sorted(tmp_path.joinpath("out").glob("part-*")) for x in f.read_text().splitlines()]
    assert text == [f"line {k}" for k in range(1000)]
    assert lifecycle.assemble(spark, path, 1000, out, 300).exceptAll(digests).count() == 0  # the same text is kept
    first = sorted(tmp_path.joinpath("out").glob("part-*"))[0]
    first.write_text(first.read_text().replace("line 1\n", "line one\n"))
    for crc in tmp_path.joinpath("out").glob(".part-*.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="ASSEMBLY_DIFFERS"):
        lifecycle.assemble(spark, path, 1000, out, 300)


def test_dealt_tables_lie_in_the_shared_folder(spark):
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    before = sorted(os.listdir(warehouse)) if os.path.isdir(warehouse) else []
    made = len(tables.made)
    for deal in (tables.dealt, tables.bucketed):
        assert deal(spark.range(50), "id", "t").count() == 50
    paths = [x for x in tables.made[made:] if "/" in x]
    assert (sorted(os.listdir(warehouse)) if os.path.isdir(warehouse) else []) == before
    assert len(paths) == 2 and all(p.startswith(tables.shared_dir(spark)) and os.path.isdir(p.removeprefix("file:")) for p in paths)
    tables.forget(spark, tables.made[made:])
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_versions_to_the_letter(spark):
    cases = {"1.0.0": True, "1.0.0-01": False, "1.0.0-a..b": False, "1.0.0+a..b": False, "1.0.0-0.1a.-": True, "1.0.0-a.0": True, "1.0.0-00a": True, "1.0.0-a.00": False, "01.0.0": False, "1.0.0+001.-": True, "1.0.0-": False, "1.0.0+": False, "1.0.0\n": False}
    got = spark.createDataFrame([(k,) for k in cases], "v string").select("v", versions.parsed(F.col("v")).isNotNull().alias("ok")).collect()
    assert {r.v: r.ok for r in got} == cases


def test_means_are_exact(spark):
    scores = [("m", k, "a", 1 if k < 17 else 0) for k in range(21)] + [("m", k, "b", 1) for k in range(21)] + [("n", 0, "a", -1), ("n", 1, "a", None)]
    got = {r.model: (r.samples, r["mean"]) for r in quality.model_summary(spark.createDataFrame(scores, "model string, id int, dimension string, score int")).collect()}
    assert got == {"m": (21, 0.9048), "n": (2, -1.0)}  # 0.8095 and 1: half of a ten-thousandth goes up


def test_items_are_patched_once_for_both_results(spark, data):
    plan = scans.localized_items(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "EvalPython" not in plan
