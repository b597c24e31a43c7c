"""Records through readers, rules, execution, export and freezing; each rule is hit by one change to a valid record."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from quern.functions.jsons import canonical
from quern.operators import execution, lifecycle, validation
from quern.sources import foreign, records, schemas, snapshots
from quern.streaming import jobs

PARAMETERS = {"type": "object", "properties": {"grams": {"type": "number"}, "guests": {"type": "number"}, "mode": {"enum": ["fast", "slow"]}}, "required": ["grams", "guests"], "additionalProperties": False}
OUTPUT = {"type": "object", "properties": {"total": {"type": "number"}}, "required": ["total"]}
FUNCTIONS = {"kitchen_scale": lambda a: {"total": a["grams"] * a["guests"]}}
GATES = dict.fromkeys(schemas.GATES, "passed")


def valid():
    return {
        "schema_version": "0.1.0", "tool_registry_version": "0.1.0", "id": "tctr_ot_000001",
        "metadata": {"main_category": "single_tool", "secondary_tags": [], "source_type": "original_turkish", "domain": "kitchen", "difficulty": "easy", "final_response_method": "template", "provenance": {"license_chain": []}, "execution": {"type": "local", "status": "passed"}, "validation": dict(GATES), "review": {"status": "pending"}},
        "tools": [{"type": "function", "function": {"name": "kitchen_scale", "description": "scales", "parameters": PARAMETERS}}],
        "messages": [{"role": "user", "content": "250 gram 6 kişiye?"}, {"role": "assistant", "content": None, "tool_calls": [{"id": "c1", "type": "function", "function": {"name": "kitchen_scale", "arguments": {"grams": 250, "guests": 6}}}]}, {"role": "tool", "tool_call_id": "c1", "name": "kitchen_scale", "content": '{"total":1500}'}, {"role": "assistant", "content": "1500"}],
    }


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([("kitchen_scale", canonical(PARAMETERS), canonical(OUTPUT))], "name string, parameters string, output_schema string")


def args(**change):
    return lambda r: r["messages"][1]["tool_calls"][0]["function"].update(arguments=change)


MUTATIONS = {
    "": lambda r: None,
    "ARG_REQUIRED": args(grams=1),
    "ARG_TYPE": args(grams="x", guests=1),
    "ARG_UNSUPPORTED": args(grams=1, guests=2, more=3),
    "ARG_ENUM": args(grams=1, guests=2, mode="odd"),
    "FUNCTION_NOT_IN_REGISTRY": lambda r: r["messages"][1]["tool_calls"][0]["function"].update(name="other"),
    "FUNCTION_NOT_EXPOSED": lambda r: r.update(tools=[]),
    "UNMATCHED_TOOL_RESULT": lambda r: r["messages"][2].update(tool_call_id="c9"),
    "MISSING_TOOL_RESULT": lambda r: r["messages"][2].update(tool_call_id="c9"),
    "TOOL_RESULT_NAME_MISMATCH": lambda r: r["messages"][2].update(name="other"),
    "TOOL_RESULT_JSON_INVALID": lambda r: r["messages"][2].update(content="{x"),
    "RESULT_TYPE": lambda r: r["messages"][2].update(content='{"total":"x"}'),
    "VERSION_INVALID": lambda r: r.update(schema_version="1.0.0"),
    "ID_SOURCE_MISMATCH": lambda r: r.update(id="tctr_tr_000001"),
    "CATEGORY_PRIORITY_MISMATCH": lambda r: r["metadata"].update(main_category="multi_turn"),
    "NATURAL_TEXT_INTERNAL_MARKER": lambda r: r["messages"][3].update(content="bu bir simülasyon"),
    "CALLED_EXECUTION_INVALID": lambda r: r["metadata"]["execution"].update(type="not_applicable"),
    "FINAL_RESPONSE_METHOD_REQUIRED": lambda r: r["metadata"].pop("final_response_method"),
    "PARALLEL_STRUCTURE_INVALID": lambda r: r["metadata"].update(secondary_tags=["parallel_tool"]),
    "TOOL_ORDER_TAG_CONFLICT": lambda r: r["metadata"].update(secondary_tags=["parallel_tool", "sequential_tool"]),
    "NO_TOOL_CATEGORY_HAS_CALL": lambda r: r["metadata"].update(main_category="no_tool"),
    "EXPOSED_TOOL_SCHEMA_MISMATCH": lambda r: r["tools"][0]["function"].update(parameters={"type": "object"}),
    "REVIEW_ACCEPTED_BEFORE_VALIDATION": lambda r: (r["metadata"]["review"].update(status="accepted"), r["metadata"]["validation"].update(json="not_run")),
    "ACCEPTED_RECORD_INVALID": lambda r: (r["metadata"]["review"].update(status="accepted"), r["messages"][2].update(content="{x")),
}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    lines = []
    for code, change in MUTATIONS.items():
        r = copy.deepcopy(valid())
        change(r)
        r["metadata"]["provenance"]["source_split"] = code
        lines.append(json.dumps(r, ensure_ascii=False))
    (folder / "a.jsonl").write_text("\n".join([lines[0], "", "{broken", *lines[1:]]) + "\n")
    (folder / "b.json").write_text("[]")
    return str(folder)


def test_parse(spark, corpus):
    good, bad = records.parse(records.read_lines(spark, corpus), schemas.RECORD)
    assert good.count() == len(MUTATIONS) and [(r.code, r.line) for r in bad.collect()] == [("JSONL_RECORD_PARSE_ERROR", 3)]
    assert records.parse(records.read_documents(spark, corpus), schemas.RECORD)[1].first().code == "JSON_PARSE_ERROR"
    repeats = records.first_seen(good, "id", "file", "line").where("repeat").count()
    assert repeats == len(MUTATIONS) - 2


def test_rules(spark, corpus, registry):
    good = records.parse(records.read_lines(spark, corpus), schemas.RECORD)[0].withColumn("id2", F.col("id")).cache()
    codes = list(MUTATIONS)
    keyed = good.withColumn("mutation", F.col("metadata.provenance.source_split"))
    for code in codes:
        one = keyed.where(F.col("mutation") == code).drop("mutation")
        found = {r.code for r in validation.record_issues(one, registry).collect()} if code in ("", "ACCEPTED_RECORD_INVALID", "ARG_TYPE") else None
        if found is not None:
            assert found == set() if code == "" else code in found, (code, found)
    distinct = keyed.withColumn("id", F.when(F.col("mutation") == "ID_SOURCE_MISMATCH", F.col("id")).otherwise(F.concat(F.lit("tctr_ot_"), F.lpad((F.col("line")).cast("string"), 6, "0"))))
    issues = validation.record_issues(distinct.drop("mutation"), registry).join(distinct.select("id", "mutation"), "id").select("mutation", "code").distinct().collect()
    found = {}
    for r in issues:
        found.setdefault(r.mutation, set()).add(r.code)
    assert {c for c in codes if c and c not in found.get(c, set())} == set()
    assert found.get("", set()) == set()


def test_execution(spark, registry):
    calls = spark.createDataFrame([("r1", 0, "kitchen_scale", '{"grams":1,"guests":2}'), ("r1", 1, "kitchen_scale", '{"grams":1}'), ("r2", 0, "nope", "{}")], "id string, place int, name string, arguments string")
    out = execution.execute(calls, registry, FUNCTIONS).select("id", "place", "outcome.*").orderBy("id", "place").collect()
    assert [(r.status, r.result, r.error) for r in out] == [("passed", '{"total":2}', None), ("failed", None, "arguments_invalid"), ("failed", None, "function_not_in_registry")]
    fixtures = spark.createDataFrame([("kitchen_scale", '{"guests":2, "grams":1}', "3")], "function_name string, arguments string, result string")
    assert sorted(r.status for r in execution.from_fixtures(calls, fixtures).collect()) == ["failed", "failed", "passed"]
    statuses = execution.execute(calls, registry, FUNCTIONS).select("id", "place", F.col("outcome.status").alias("status"))
    assert {r.id: r.status for r in execution.record_status(statuses).collect()} == {"r1": "failed", "r2": "failed"}


def test_export_and_freeze(spark, corpus, registry, tmp_path):
    good = records.parse(records.read_lines(spark, corpus), schemas.RECORD)[0]
    accepted = good.where("metadata.provenance.source_split = ''").withColumn("metadata", F.col("metadata").withField("review.status", F.lit("accepted")))
    none = validation.record_issues(accepted, registry)
    assert lifecycle.export_accepted(accepted, none, str(tmp_path / "out"), ["id", "messages"]) == 1
    with pytest.raises(ValueError, match="EXPORT_BLOCKED"):
        lifecycle.export_accepted(accepted, accepted.select("id"), str(tmp_path / "no"))
    rows = spark.range(50).select("id", F.format_string("line %d", "id").alias("line"))
    manifest = lifecycle.freeze(rows, "passed", "id", "line", str(tmp_path / "frozen"), 20)
    assert [r.records for r in manifest.orderBy("shard").collect()] == [20, 20, 10]
    assert lifecycle.verify_freeze(str(tmp_path / "frozen"), spark, "id", "line", 20).count() == 0
    spark.createDataFrame([(99, "more")], "id long, line string").write.mode("append").parquet(str(tmp_path / "frozen/records"))
    assert lifecycle.verify_freeze(str(tmp_path / "frozen"), spark, "id", "line", 20).count() == 1
    with pytest.raises(ValueError, match="FREEZE_BLOCKED"):
        lifecycle.freeze(rows, "blocked", "id", "line", str(tmp_path / "x"))


def test_foreign_rows(spark):
    rows = spark.createDataFrame([(1, None, "q", '"[{\\"name\\":\\"f\\"}]"', '[{"name":"f","arguments":{}}]')], "line int, id string, query string, tools string, answers string")
    got = foreign.function_calls(rows, "train").first()
    assert (got.source_example_id, got.tools, got.state) == ("row-000001", '[{"name":"f"}]', "pending")
    message = "array<struct<role:string,content:string>>"
    choices = spark.createDataFrame([(1, "u", "q", "direct", None, None), (2, None, None, None, None, [("user", "a"), ("assistant", "b"), ("user", "c")]), (3, "v", "q", "request_for_info", None, None)], f"line int, uuid string, question string, correct_answer string, held_out_param string, messages {message}")
    got = {r.source_example_id: r for r in foreign.decisions(choices, "test").collect()}
    assert got["u"].decision == "direct_answer" and got["u"].state == "pending"
    assert (got["row-000002"].query, got["row-000002"].response, got["v"].state) == ("c", "b", "needs_source_review")


def test_snapshots(spark, tmp_path):
    (tmp_path / "p.csv").write_text("province,year,population\nAda,2023,5\nAda,2023,6\n")
    table = snapshots.read_csv(spark, str(tmp_path / "p.csv"), snapshots.POPULATION)
    assert snapshots.check_unique(table, "province", "year").count() == 1
    bulletin = '<Tarih_Date Tarih="03.02.2025" Bulten_No="2025/23"><Currency CurrencyCode="USD"><Unit>1</Unit><ForexBuying>35.81</ForexBuying><ForexSelling>35.9012</ForexSelling></Currency><Currency CurrencyCode="XDR"><Unit>1</Unit><ForexBuying>46.7</ForexBuying><ForexSelling/></Currency></Tarih_Date>'
    (tmp_path / "03022025.xml").write_text(bulletin)
    assert [(r.currency_code, str(r.forex_selling)) for r in snapshots.read_bulletins(spark, str(tmp_path / "03022025.xml")).collect()] == [("USD", "35.9012")]
    (tmp_path / "04022025.xml").write_text(bulletin)
    with pytest.raises(Exception, match="BULLETIN_DATE_MISMATCH"):
        snapshots.read_bulletins(spark, str(tmp_path / "04022025.xml")).collect()
    declared = spark.createDataFrame([("a", "0" * 64), ("b", "1" * 64)], "path string, sha256 string")
    files = spark.createDataFrame([("a", bytearray(b"x"))], "path string, content binary")
    assert {r.path: r.code for r in snapshots.check_digests(declared, files).collect()} == {"a": "SNAPSHOT_HASH_MISMATCH", "b": "SNAPSHOT_FILE_MISSING"}


def test_streaming_resumes(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rows = spark.range(10).withColumn("v", F.col("id") * 2)
    for k in range(2):
        rows.write.mode("append").parquet(source)
        jobs.process_available(spark, source, rows.schema, lambda df: df.where("v % 4 = 0"), target, state).awaitTermination(60)
        assert spark.read.parquet(target).count() == 5 * (k + 1)
    done = spark.range(4).toDF("index")
    assert lifecycle.run_job(spark.range(10).toDF("index"), done, lambda df: df).count() == 6
