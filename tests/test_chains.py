"""Chains of calls, the quality run's gates and refusals, and sets that are published whole."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quern.functions import hashing
from quern.operators import calls, comparison, dataflow, plan_rules
from quern.sources import schemas

RECORD = f"id string, messages array<{schemas.MESSAGE}>, metadata struct<main_category:string,source_type:string,execution:struct<type:string>,review:struct<status:string>>"


def message(role, content=None, own=None, of=None):
    made = [{"id": i, "type": "function", "function": {"name": n, "arguments": json.dumps(a)}} for i, n, a in own] if own else None
    return {"role": role, "content": content, "tool_calls": made, "tool_call_id": of, "name": None}


def record(key, messages, kind="local", status="pending", source="original_turkish"):
    return (key, messages, {"main_category": "multi_turn", "source_type": source, "execution": {"type": kind}, "review": {"status": status}})


CHAIN = [
    message("assistant", own=[("a", "find", {"q": 1}), ("b", "book", {"room": 7.0, "none": None})]),
    message("tool", '{"room": 1}', of="a"), message("tool", '{"room": 7, "none": null}', of="a"), message("tool", "{}", of="b"),
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [record("one", CHAIN), record("open", CHAIN[:2]), record("odd", [*CHAIN, message("tool", "{", of="zz")]), record("null", None), record("none", [])]
    return spark.createDataFrame(rows, RECORD)


def test_call_results_take_the_last_result(records):
    got = {(r["id"], r["place"]): (r["call"], r["result"]) for r in calls.call_results(records).collect()}
    assert got[("one", 0)] == ("a", '{"room": 7, "none": null}') and got[("open", 1)] == ("b", None)
    assert {k for k, _ in got} == {"one", "open", "odd"}
    assert {(r["id"], r["problem"]) for r in calls.call_refusals(records).collect()} == {("open", "missing_tool_result"), ("odd", "invalid_tool_result")}


def test_transfers(spark, records):
    asked = [("one", 0, 1, "room", "room"), ("one", 0, 1, "none", "none"), ("one", 0, 1, "no", "room"), ("one", 0, 1, "room", "no"), ("one", 0, 1, "none", "room"), ("one", 1, 0, "room", "room"), ("one", 1, 2, "room", "room"), ("gone", 0, 1, "room", "room"), ("null", 0, 1, "room", "room")]
    declared = spark.createDataFrame(asked, "id string, source long, target long, result_key string, argument_key string")
    got = {(r["id"], r["source"], r["target"], r["result_key"], r["argument_key"]): r["failure"] for r in calls.transfers(records, declared).collect()}
    assert [got[x] for x in asked] == [None, None, "missing_result_key", "missing_argument", "transfer_mismatch", *["missing_call"] * 4]
    assert calls.transfers(records, declared.limit(0)).isEmpty()


def test_gates_and_counts(spark, records):
    more = spark.createDataFrame([record("safe", CHAIN, "sandbox"), record("real", CHAIN, "real_api")], RECORD)
    runs = [("one", "a", "passed", '{"none":null,"room":7.0}', False, "f1"), ("one", "b", "passed", "{}", None, "f2"), ("open", "a", "timeout", None, False, None), ("odd", "a", "passed", '{"room":8}', False, None), ("odd", "b", None, None, True, None), ("real", "a", "passed", '{"none":null,"room":7}', False, None), ("real", "b", "passed", "{}", False, None)]
    executions = spark.createDataFrame(runs, "id string, call string, status string, result string, raised boolean, fixture string")
    state = spark.createDataFrame([("one", "passed"), ("odd", "failed")], "id string, status string")
    seen = Observation()
    got = {r["id"]: r for r in dataflow.gated(records.unionByName(more), executions, state, state, observed=seen, n_references=2).collect()}
    status = {k: (r["execution"]["type"], r["execution"]["status"], r["validation"]["execution"]) for k, r in got.items()}
    assert status == {
        "one": ("local", "passed", "passed"), "open": ("local", "failed", "failed"), "odd": ("local", "failed", "failed"), "null": ("not_applicable", "not_called", "not_applicable"),
        "none": ("not_applicable", "not_called", "not_applicable"), "safe": ("sandbox", "not_called", "not_run"), "real": ("real_api", "not_called", "not_run"),
    }
    assert got["one"]["pending_gates"] == ["language"] and got["odd"]["automatic_failures"] == ["execution", "semantic", "duplicate"]
    assert got["one"]["execution"]["fixture_id"] is None and got["open"]["execution"]["error_code"] == "quality_execution_failed"
    assert seen.get == {"records_checked": 7, "reference_records": 2, "pairs_checked": 35, "duplicate_findings": 1, "records_with_automatic_failures": 2, "records_with_model_pass": 1, "records_pending_human_language_review": 7}
    free = {r["id"]: r["gate"] for r in calls.execution_state(more, calls.verified(more, executions), allowed=True).collect()}
    assert free == {"safe": "not_run", "real": "passed"}


def test_refusals(spark):
    own = spark.createDataFrame([record("a", []), record("a", []), record("b", [], status="accepted"), record("c", [], source="translated"), record(None, [])], RECORD)
    refs = spark.createDataFrame([record("b", [], status="accepted"), record("d", []), record("e", [], status="accepted")], RECORD)
    issues = spark.createDataFrame([("e",), ("z",)], "id string")
    found = dataflow.refusals(own, refs, issues)
    assert {(r["id"], r["problem"]) for r in found.collect()} == {("a", "duplicate_record_id"), ("b", "accepted_record"), ("b", "id_collision"), ("c", "paused_source_type"), ("d", "unaccepted_reference"), ("e", "invalid_record")}
    with pytest.raises(ValueError, match="a: duplicate_record_id"):
        dataflow.refuse(found)
    dataflow.refuse(found.limit(0))


def test_plan_rules_with_nulls(spark):
    schema = "id string, category string, tags array<string>, goal string, ending string, avoid array<string>, tools array<string>, calls array<struct<name:string,arguments:string>>, result string, execution_order string, behavior string, execution_type string"
    registry = spark.createDataFrame([("f", '{"type":"object"}', '{"type":"integer"}')], "name string, parameters string, output_schema string")
    rows = [
        ("bare", None, None, None, None, None, None, None, None, None, "tool_call", None),
        ("list", "multi_tool", ["parallel_tool"], "go", "a fixture", None, ["f"], [("f", "{}"), ("f", "{}")], "[1,\"x\",3]", "parallel", "tool_call", "local"),
        ("null", "single_tool", [], "go", None, None, ["f"], [("f", "[]")], "null", None, "tool_call", "local"),
    ]
    got = {(r["id"], r["code"], r["path"]) for r in plan_rules.plan_issues(spark.createDataFrame(rows, schema), registry).collect()}
    assert got == {("list", "BLUEPRINT_INTERNAL_MARKER", "$.expected_final_behavior"), ("list", "BLUEPRINT_RESULT_COUNT_MISMATCH", "$.expected_tool_result"), ("list", "RESULT_TYPE", "$.expected_tool_result[1]"), ("null", "ARG_TYPE", "$.expected_tool_calls[0].function.arguments")}


def test_published_whole_or_not(spark, tmp_path):
    rows = spark.createDataFrame([("b.jsonl", 1, "x"), ("a.jsonl", 2, "x"), ("a.jsonl", 3, "y"), ("c.json", None, None)], "file string, line long, id string")
    found = plan_rules.repeats(rows, "id", "DUPLICATE")
    assert [tuple(r) for r in found.collect()] == [("b.jsonl", 1, "DUPLICATE", "x first at a.jsonl:2")]
    with pytest.raises(ValueError, match="SET_REFUSED"):
        plan_rules.publish(rows, found, str(tmp_path / "set"))
    assert not (tmp_path / "set").exists() and spark.read.json(str(tmp_path / "set.issues")).count() == 1
    assert plan_rules.publish(rows, found.limit(0), str(tmp_path / "set")).count() == 4


def test_models_over_the_same_plans(spark):
    plans = spark.createDataFrame([("b", "turkey_native"), ("a", "original_turkish"), ("c", "original_turkish")], "id string, source_type string")
    made = spark.createDataFrame([("a", "m", None, {"t": 3}), ("b", "m", "broken", {"t": 9}), ("a", "x", None, {"t": 1})], "id string, model string, error string, usage map<string,bigint>")
    seen = spark.createDataFrame([("a", "m", None, "pass", {"s": 4.5, "r": 3.0}, {"t": 2}), ("b", "m", None, "pass", {"s": 1.0}, {"t": 2})], "id string, model string, error string, verdict string, scores map<string,double>, usage map<string,bigint>")
    found = comparison.entries(plans, ["m", "n"], made, seen)
    got = {(r.id, r.model): (r.record_id, r.status, r.error, r.judge_status) for r in found.collect()}
    assert got[("a", "m")] == ("tctr_ot_000001", "passed", None, "passed") and got[("b", "m")] == ("tctr_tn_000001", "failed", "broken", None) and got[("c", "n")] == ("tctr_ot_000002", "failed", "not_generated", None) and len(got) == 6
    one, two = comparison.summary(found).orderBy("model").collect()
    assert (one.total, one.generation_passed, one.passes, one.verdicts, one.generation_usage, one.judge_usage, one["mean"]) == (3, 1, 1, {"pass": 1}, {"t": 3}, {"t": 2}, 3.75)
    assert (two.generation_failed, two.verdicts, two.generation_usage, two["mean"]) == (3, {}, {}, None)
    assert comparison.summary(found.limit(0)).count() == 0 and [r.id for r in comparison.chosen(plans, ["c"]).collect()] == ["c"]
    with pytest.raises(ValueError, match="UNKNOWN_PLANS: y, z"):
        comparison.chosen(plans, ["z", "a", "y"])
    with pytest.raises(ValueError, match="SOURCE_NOT_COMPARED"):
        comparison.entries(plans.withColumn("source_type", F.lit("translated")), ["m"], made, seen)


def test_compared_plans_are_numbered_past_the_limit_of_ids(spark, monkeypatch):
    monkeypatch.setattr(hashing, "ID_LIMIT", 1)
    plans = spark.createDataFrame([(i, "original_turkish") for i in range(3)], "id long, source_type string")
    none = spark.createDataFrame([], "id long, model string, error string, verdict string, scores map<string,double>, usage map<string,bigint>")
    assert sorted(r.record_id for r in comparison.entries(plans, ["m"], none, none).collect()) == [f"tctr_ot_00000{i}" for i in (1, 2, 3)]
    assert spark.range(1).select(hashing.record_id(F.lit("ot"), F.lit(4_500_000), limited=False)).first()[0] == "tctr_ot_4500000"


def test_generations_and_judgments_are_not_broadcast(spark):
    plans = spark.createDataFrame([("a", "original_turkish")], "id string, source_type string")
    made = spark.createDataFrame([("a", "m", None, {"t": 3})], "id string, model string, error string, usage map<string,bigint>")
    seen = made.withColumns({"verdict": F.lit("pass"), "scores": F.create_map(F.lit("x"), F.lit(4.0))})
    found = comparison.entries(plans, ["m"], made, seen)
    assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("SortMergeJoin") >= 2


def test_rows_are_made_once_and_values_checked_in_one_pass(spark):
    rows = spark.createDataFrame([(1, "single_tool", "tool_call", ["f"], [("f", '{"a":1}'), ("f", '{"a":"x"}'), ("g", "{}"), (None, None)]), (2, None, None, None, None)], "id int, category string, decision string, exposed array<string>, calls array<struct<name:string,arguments:string>>")
    registry = spark.createDataFrame([("f", '{"type":"object","properties":{"a":{"type":"integer"}}}')], "name string, parameters string")
    found = plan_rules.benchmark_issues(rows, registry)
    at = "$.expected.tool_calls[{}].function.{}".format
    assert sorted((r["id"], r["code"], r["path"]) for r in found.collect()) == [
        (1, "ARG_TYPE", at(1, "arguments") + ".a"), (1, "EXPECTED_FUNCTION_NOT_EXPOSED", at(2, "name")), (1, "FUNCTION_NOT_IN_REGISTRY", at(2, "arguments")), (1, "FUNCTION_NOT_IN_REGISTRY", at(3, "arguments")),
        (2, "BENCHMARK_DECISION_INCONSISTENT", "$.expected.decision"),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and plan.count("ArrowEvalPython") == 1
