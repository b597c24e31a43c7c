import json

from pyspark.sql import functions as F

from quern.functions import versions
from quern.operators import drafts, quality


def one(spark, expr, **columns):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in columns.items()))
    return row.select(expr.alias("x")).first().x


def test_versions(spark):
    df = spark.createDataFrame([("0.1.0",), ("1.2.3-rc.1+b",), ("01.0.0",), (None,)], "v string")
    got = [r[0] and tuple(r[0]) for r in df.select(versions.parsed(df.v)).collect()]
    assert got == [(0, 1, 0, None, None), (1, 2, 3, "rc.1", "b"), None, None]
    assert [r[0] for r in df.select(versions.in_development(df.v)).collect()] == [True, False, False, False]
    ids = spark.createDataFrame([("tctr_ot_000007",), ("tctr_tr_000009",), ("x",)], "id string")
    assert ids.agg(versions.next_number(F.col("id"), "ot"), versions.next_number(F.col("id"), "tn")).first() == (8, 1)
    tools = spark.createDataFrame([("shop.add.v1", "1.0.0"), ("shop.add.v1", "2.0.0"), ("shop.add", "2.0.0"), ("shop.add.v0", "0.1.0"), ("shop_add_v1", "1.0.0"), ("Shop.add.v1", "1.0.0"), ("shop.add.v1", "x")], "t string, v string")
    assert [r[0] for r in tools.select(versions.major_matches(tools.t, tools.v)).collect()] == [True] + [False] * 6
    assert one(spark, versions.change_target(F.lit("tool_removed"))) == "tool_registry_version" and one(spark, versions.change_target(F.lit("x"))) is None


def test_addresses(spark):
    address = lambda base: one(spark, versions.address(F.lit(base), ["api.example.org"], {"b": F.lit(True), "a": F.lit("x y")}))
    assert address("https://api.example.org/v1") == "https://api.example.org/v1?a=x+y&b=true"
    assert address("http://api.example.org/v1") is None and address("https://u@api.example.org/") is None and address("https://other.org/") is None


def test_facts_and_fingerprints(spark):
    parameters = {"type": "object", "description": "p", "properties": {"x": {"description": "x"}}}
    content = {"query": "q", "response": "s", "tools": [{"description": "d", "name": "f", "parameters": parameters}], "calls": [{"arguments": {"description": "one"}}]}
    words = content | {"query": "r", "response": "t", "tools": [{"description": "e", "name": "f", "parameters": {"type": "object", "properties": {"x": {}}}}]}
    machine = content | {"calls": [{"arguments": {"description": "two"}}]}
    df = spark.createDataFrame([tuple(map(json.dumps, (content, words, machine)))], "a string, b string, c string")
    a, b, c = df.select(*(drafts.machine_fingerprint(df[x]) for x in "abc")).first()
    assert a == b != c
    result = {"city": "Bursa", "source": "s", "rows": [{"n": 1, "synthetic": True}, "fixture_9", "plain"], "note": "a mock value", "record_id": 3, "mockup": "fine"}
    facts = spark.createDataFrame([(json.dumps(result),), ('"a simulation"',), ("[]",)], "a string")
    told = [r[0] for r in facts.select(drafts.visible_facts(facts.a)).collect()]
    assert json.loads(told[0]) == {"city": "Bursa", "rows": [{"n": 1}, "plain"], "mockup": "fine"} and told[1:] == ["null", "[]"]


def test_plan_verdict(spark):
    rows = [
        (["a"], False, False, None, "tamam", "passed"), (["a"], True, False, "b", "c", "message_count"), (["a", " "], True, False, "b", "c", "message_count"), (["a", "b"], True, False, None, "c", "intermediate"), (["a"], False, False, "b", "c", "intermediate"),
        (["a", "b"], True, True, "no", "c", "clarification"), (["a", "b"], True, False, "no", "c", "passed"), (["a"], False, False, None, None, "final"), (["a"], False, False, None, "**x**", "markdown"), (["a"], False, False, None, "a `b", "markdown"),
        (["a"], False, False, None, "simülasyon", "marker"), (["при"], False, False, None, "c", "script"), (["5 μg"], False, False, None, "5 µg", "passed"), (["a"], False, False, None, "x </Think>", "think_tag"), (["a"], False, False, None, "2024-01-02T10:11", "timestamp"),
    ]
    df = spark.createDataFrame(rows, "u array<string>, m boolean, asks boolean, b string, f string, expected string")
    assert [tuple(r) for r in df.select(drafts.plan_verdict(df.u, df.m, df.asks, df.b, df.f), "expected").collect() if r[0] != r[1]] == []


def test_response_selection(spark):
    rows = [
        ("en", "{}", True, None, False, None, (None, "language")), ("tr", None, False, "x", False, None, (None, "nothing_verifiable")), ("tr", None, False, "x", True, None, (None, "adaptation_required")), ("tr", None, False, "x", True, "source_answer_adaptation", ("source_answer_adaptation", "human_verification")),
        ("tr", '{"a":3}', True, "it is 3", True, "source_answer_adaptation", ("source_answer_adaptation", None)), ("tr", '{"a":3}', True, "it is 4", True, "source_answer_adaptation", ("tool_result_regeneration", None)), ("tr", '{"a":3}', True, "it is 3", False, "source_answer_adaptation", (None, "answer_not_verified")), ("tr", '{"a":3}', True, None, None, None, ("tool_result_regeneration", None)),
    ]
    df = spark.createDataFrame([r[:6] for r in rows], "l string, r string, v boolean, a string, s boolean, m string")
    assert [tuple(x[0]) for x in df.select(drafts.response_selection(df.l, df.r, df.v, df.a, df.s, df.m)).collect()] == [r[6] for r in rows]


def test_messages(spark):
    call = "array<struct<name:string,arguments:string>>"
    rows = [(["q"], None, [("f", "{}"), ("g", "{}")], ["1", "2"], True, "end"), (["q"], None, [("f", "{}"), ("g", "{}")], ["1", "2"], False, "end"), (["q", "r"], "which?", [], [], False, "end")]
    df = spark.createDataFrame(rows, f"u array<string>, c string, calls {call}, results array<string>, s boolean, f string")
    got = [[m.role[0] for m in r[0]] for r in df.select(drafts.messages(df.u, df.c, df.calls, df.results, df.s, df.f)).collect()]
    assert got == [list("uatata"), list("uatta"), list("uaua")]


def test_judging(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    first = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "id string, passes boolean")
    second = spark.createDataFrame([("b", False)], "id string, passes boolean")
    got = {r.id: (r.escalated, r.status) for r in quality.judged(ids, first, second, 0.0, True).collect()}
    assert got == {"a": (False, "passed"), "b": (True, "failed"), "c": (True, "not_run"), "d": (False, "not_run")}


def test_recommendation(spark):
    fine = (0, 0, 4.5, 40)
    rows = [(40, True, fine, fine, "accepted", ""), (29, True, fine, fine, "insufficient_sample", "insufficient_sample"), (40, True, (None,) * 4, fine, "incomplete_model_pair", "incomplete_model_pair"), (40, False, fine, fine, "rejected", "no_judge"), (40, True, (1, 1, 3.9, 38), (0, 0, 4.2, 40), "rejected", "cheap_generation_failed,judge_failed,score_low,score_gap,not_all_passed,pass_gap"), (40, True, (0, 0, None, 40), fine, "rejected", "scores_incomplete")]
    side = "struct<generation_failed:int,judge_failed:int,mean:double,passes:int>"
    df = spark.createDataFrame(rows, f"n int, j boolean, a {side}, b {side}, status string, reasons string")
    as_dict = lambda c: {k: F.col(f"{c}.{k}") for k in ("generation_failed", "judge_failed", "mean", "passes")}
    got = df.select(quality.recommendation(df.n, df.j, as_dict("a"), as_dict("b")).alias("x"), "status", "reasons").collect()
    assert [(tuple(r.x), r.status, r.reasons) for r in got if tuple(r.x) != (r.status, r.reasons)] == []


def test_summaries(spark):
    scores = spark.createDataFrame([("m", 1, "x", 4), ("m", 2, "x", 5), ("m", 1, "y", 3)], "model string, id int, dimension string, score int")
    assert tuple(quality.model_summary(scores).select("mean", "samples").first()) == (3.75, 2)
    maps = spark.createDataFrame([({"prompt_tokens": 3, "completion_tokens": 4},)], "u map<string,long>")
    assert tuple(maps.select(quality.usage(maps.u)).first()[0]) == (3, 4, 7)
    calls = spark.createDataFrame([('{"b":1,"a":"x"}',), ('{"a":"y","b":2}',), ('{"a":1,"b":2}',)], "a string")
    s = [r[0] for r in calls.select(quality.argument_signature(calls.a)).collect()]
    assert s[0] == s[1] == "a:string,b:integer" and s[2] != s[0]
