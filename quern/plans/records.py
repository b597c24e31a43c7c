"""Queries on records, calls, jobs, drafts and reports that the given tables make up, and the SQL that gives the same rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import jsons, versions
from quern.operators import drafts, duplicates, lifecycle, quality, reporting, series, validation
from quern.plans.catalog import NORM, query, table
from quern.sources import foreign, schemas

#: Schemas of the functions that the benchmark's calls name; returned goods of kind R have none.
CALL_SCHEMA = '{"type":"object","properties":{"part":{"type":"integer"},"qty":{"type":"integer","maximum":45}},"required":["part","qty"],"additionalProperties":false}'
_ARGS = """'{{"part":' || l_partkey || ',"qty":' || {0} || {1} || '}}'"""


@query(f"""
WITH l AS (SELECT l_orderkey AS id, l_linenumber AS i, l_partkey, l_suppkey, CAST(l_quantity AS INT) AS q, 'ship_' || lower(l_returnflag) AS name FROM lineitem),
c AS (SELECT o_orderkey AS id, o_orderpriority AS category, o_orderkey % 3 = 0 AS par, CASE o_orderstatus WHEN 'F' THEN 'tool_call' WHEN 'O' THEN 'request_information' ELSE 'direct_answer' END AS decision,
  o_orderkey % 17 = 0 AS other, o_orderkey % 5 = 0 AS turned, o_orderkey % 7 = 0 AS more, o_orderkey % 11 = 0 AS noted, o_orderkey % 19 = 0 AS quoted FROM orders),
e AS (SELECT id, list(name ORDER BY i, l_partkey, l_suppkey, q) AS n, list(name || l_partkey || ':' || q ORDER BY i, l_partkey, l_suppkey, q) AS v,
  list(name || l_partkey || ':' || (q + CAST(more AS INT)) || CASE WHEN noted THEN 'n' ELSE '' END || CASE WHEN quoted THEN 's' ELSE '' END ORDER BY i, l_partkey, l_suppkey, q) AS w,
  bool_or(name = 'ship_r') AS unknown, max(q + CAST(more AS INT)) AS top FROM l JOIN c USING (id) GROUP BY id),
r AS (SELECT c.*, c.id % 13 = 0 AS missing, c.decision = 'tool_call' AND e.id IS NOT NULL AS calls, n, CASE WHEN turned THEN list_reverse(n) ELSE n END AS m, v, CASE WHEN turned THEN list_reverse(w) ELSE w END AS w, unknown, top FROM c LEFT JOIN e USING (id)),
s AS (SELECT *, NOT missing AND NOT other AS d, CASE WHEN NOT calls THEN true WHEN missing THEN false WHEN par THEN list_sort(n) = list_sort(m) ELSE n = m END AS names,
  CASE WHEN NOT calls THEN true WHEN missing THEN false WHEN par THEN list_sort(v) = list_sort(w) ELSE v = w END AS vals,
  NOT calls OR missing OR NOT (unknown OR noted OR quoted) AS shaped, NOT calls OR missing OR NOT (unknown OR noted OR quoted OR top > 45) AS valid FROM r),
t AS (SELECT *, d AND names AS t, CASE WHEN decision = 'tool_call' THEN calls AND id % 6 <> 0 WHEN decision = 'request_information' THEN id % 4 <> 0 AND id % 10 <> 0 ELSE id % 10 <> 0 END AS f FROM s)
SELECT id, category, CAST(d AS INT) AS decision_ok, CAST(t AS INT) AS tools_ok, CAST(t AND shaped AS INT) AS structure_ok, CAST(t AND vals AS INT) AS values_ok, CAST(d AND f AS INT) AS flow_ok, CAST(valid AS INT) AS schema_valid,
  CAST(d AND t AND shaped AND vals AND f AND valid AS INT) AS exact, missing AS missing_prediction, CASE WHEN missing OR id % 9 = 0 THEN NULL ELSE id % 9 <> 1 END AS executed FROM t""")
def benchmark_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as gold rows whose items are calls, and predictions that err in known ways."""
    c = F.col
    items = table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("id"), c("l_linenumber").alias("i"), "l_partkey", "l_suppkey", c("l_quantity").cast("int").alias("q"), F.concat(F.lit("ship_"), F.lower("l_returnflag")).alias("name"))
    call = lambda arguments: F.transform(F.array_sort(F.collect_list(F.struct("i", "l_partkey", "l_suppkey", "q", F.struct("name", arguments.alias("arguments")).alias("c")))), lambda s: s["c"])
    more, noted, quoted = (F.pmod("id", F.lit(k)) == 0 for k in (7, 11, 19))
    amount = c("q") + F.when(more, 1).otherwise(0)
    told = F.concat(F.lit('{"qty": '), F.when(quoted, F.concat(F.lit('"'), amount.cast("string"), F.lit('"'))).otherwise(amount.cast("string")), F.when(noted, F.lit(', "note": "x"')).otherwise(""), F.lit(', "part": '), c("l_partkey").cast("string"), F.lit("}"))
    lists = items.groupBy("id").agg(call(F.format_string('{"part":%d,"qty":%d}', "l_partkey", "q")).alias("calls"), call(told).alias("told"))
    decision = F.when(c("o_orderstatus") == "F", "tool_call").when(c("o_orderstatus") == "O", "request_information").otherwise("direct_answer")
    orders = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_orderpriority").alias("category"), decision.alias("decision")).join(lists, "id", "left")
    asks, acts = c("decision") == "request_information", c("decision") == "tool_call"
    empty = F.array().cast(reporting.CALLS)
    gold = orders.select("id", "category", F.when(F.pmod("id", F.lit(3)) == 0, F.array(F.lit("parallel_tool"))).otherwise(F.array().cast("array<string>")).alias("tags"), "decision", F.when(acts, F.coalesce("calls", empty)).otherwise(empty).alias("calls"), F.when(asks, F.array(F.lit("part"), F.lit("qty"))).alias("missing"))
    turned = F.when(F.pmod("id", F.lit(5)) == 0, F.reverse("told")).otherwise(c("told"))
    said = F.when(F.pmod("id", F.lit(17)) == 0, "cannot_answer").otherwise(c("decision"))
    named = F.when(F.pmod("id", F.lit(4)) == 0, F.array(F.lit("part"))).otherwise(F.array(F.lit("qty"), F.lit("part")))
    status = F.when(F.pmod("id", F.lit(9)) == 1, "failed").when(F.pmod("id", F.lit(9)) > 1, "passed")
    predictions = orders.where("id % 13 <> 0").select("id", said.alias("decision"), F.when(acts, F.coalesce(turned, empty)).otherwise(empty).alias("calls"), F.when(~acts, "here it is").alias("response"), F.when(asks, named).alias("missing"), (F.pmod("id", F.lit(6)) != 0).alias("flow_valid"), status.alias("execution_status"))
    registry = items.where("name <> 'ship_r'").select("name").distinct().withColumn("parameters", F.lit(CALL_SCHEMA))
    judged = orders.select("id", (F.pmod("id", F.lit(10)) != 0).alias("passed"))
    out = reporting.run_benchmark(gold, predictions, registry, judged)
    # The columns named decision and so on hold the criteria from here on.
    return out.select("id", "category", c("decision").alias("decision_ok"), c("tool_or_order").alias("tools_ok"), c("names_types").alias("structure_ok"), c("values").alias("values_ok"), c("flow").alias("flow_ok"), "schema_valid", "exact", "missing_prediction", "executed")


@query(f"""
WITH r AS (SELECT doc_id AS id, text, {NORM.format("text")} AS n, coalesce(lang, 'none') AS tool, source, n_chars % 50 AS example FROM documents WHERE text IS NOT NULL),
k AS (SELECT id, min(id) OVER (PARTITION BY text) AS e, min(id) OVER (PARTITION BY n) AS m, min(id) OVER (PARTITION BY n, tool) AS c, CASE WHEN source IS NOT NULL AND example IS NOT NULL THEN min(id) OVER (PARTITION BY source, example) END AS s FROM r),
f AS (SELECT id, nullif(e, id) AS exact_of, nullif(m, id) AS normalized_of, nullif(c, id) AS combined_of, nullif(s, id) AS source_of FROM k)
SELECT *, CASE WHEN exact_of IS NOT NULL OR combined_of IS NOT NULL OR source_of IS NOT NULL THEN 'duplicate' ELSE 'needs_semantic_review' END AS decision FROM f""")
def duplicate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records whose tool has their language in its schema, and whose source and length name an example."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    schema = F.concat(F.lit('{"title":"'), F.coalesce("source", F.lit("")), F.lit('","enum":["'), F.coalesce("lang", F.lit("none")), F.lit('"]}'))
    records = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("query"), F.array(jsons.schema_fingerprint(schema)).alias("fingerprints"), F.col("source").alias("dataset"), F.pmod("n_chars", F.lit(50)).alias("example"))
    return duplicates.verdicts(records)


@query("""WITH p AS (SELECT a.doc_id, a.source AS s1, b.source AS s2, a.n_chars % 4 AS x1, b.n_chars % 4 AS x2, a.lang AS l1, b.lang AS l2 FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, coalesce(s1 = s2 AND x1 = x2, false) AS same, concat_ws(',', CASE WHEN s1 = s2 THEN 'source_dataset' END, CASE WHEN x1 = x2 THEN 'source_example_id' END, CASE WHEN l1 = l2 THEN 'upstream_source' END) AS shared,
  concat_ws(',', CASE WHEN s1 <> s2 THEN 'source_dataset' END, CASE WHEN x1 <> x2 THEN 'source_example_id' END, CASE WHEN l1 <> l2 THEN 'upstream_source' END) AS conflicting FROM p""")
def provenance_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's origin against the next one's."""
    docs = table(spark, sf_dir, "documents")
    own = lambda p: docs.select((F.col("doc_id") - int(p == "b")).alias("doc_id"), F.col("source").alias(f"{p}_source_dataset"), F.pmod("n_chars", F.lit(4)).alias(f"{p}_source_example_id"), F.col("lang").alias(f"{p}_upstream_source"))
    side = lambda p: {f: F.col(f"{p}_{f}") for f in ("source_dataset", "source_example_id", "upstream_source")}
    return own("a").join(own("b"), "doc_id").select("doc_id", duplicates.same_source(side("a"), side("b")).alias("x")).select("doc_id", "x.*")


def _record() -> dict:
    parameters = {"type": "object", "properties": {"grams": {"type": "number"}, "guests": {"type": "number"}, "mode": {"enum": ["fast", "slow"]}}, "required": ["grams", "guests"], "additionalProperties": False}
    say = lambda role, content, **more: {"role": role, "content": content} | more
    call = {"id": "c1", "type": "function", "function": {"name": "kitchen_scale", "arguments": {"grams": 250, "guests": 6}}}
    return {
        "schema_version": "0.1.0", "tool_registry_version": "0.1.0", "id": "tctr_ot_@ID@",
        "metadata": {"main_category": "single_tool", "secondary_tags": [], "source_type": "original_turkish", "final_response_method": "template", "provenance": {}, "execution": {"type": "local", "status": "passed"}, "validation": dict.fromkeys(schemas.GATES, "passed"), "review": {"status": "pending"}},
        "tools": [{"type": "function", "function": {"name": "kitchen_scale", "description": "scales", "parameters": parameters}}],
        "messages": [say("user", "@TEXT@"), say("assistant", None, tool_calls=[call]), say("tool", '{"total":1500}', tool_call_id="c1", name="kitchen_scale"), say("assistant", "1500")],
    }


def _call(r: dict) -> dict:
    return r["messages"][1]["tool_calls"][0]["function"]


#: One change to a valid record for each rule, with every code that it calls for.
CHANGES = (
    ((), lambda r: None),
    (("ARG_REQUIRED",), lambda r: _call(r).update(arguments={"grams": 1})),
    (("ARG_TYPE",), lambda r: _call(r).update(arguments={"grams": "x", "guests": 1})),
    (("ARG_UNSUPPORTED",), lambda r: _call(r).update(arguments={"grams": 1, "guests": 2, "more": 3})),
    (("ARG_ENUM",), lambda r: _call(r).update(arguments={"grams": 1, "guests": 2, "mode": "odd"})),
    (("FUNCTION_NOT_EXPOSED",), lambda r: r.update(tools=[])),
    (("UNMATCHED_TOOL_RESULT", "MISSING_TOOL_RESULT"), lambda r: r["messages"][2].update(tool_call_id="c9")),
    (("TOOL_RESULT_NAME_MISMATCH",), lambda r: r["messages"][2].update(name="other")),
    (("TOOL_RESULT_JSON_INVALID",), lambda r: r["messages"][2].update(content="{x")),
    (("RESULT_TYPE",), lambda r: r["messages"][2].update(content='{"total":"x"}')),
    (("VERSION_INVALID",), lambda r: r.update(schema_version="1.0.0")),
    (("ID_SOURCE_MISMATCH",), lambda r: r["metadata"].update(source_type="translated")),
    (("CATEGORY_PRIORITY_MISMATCH",), lambda r: r["metadata"].update(main_category="multi_turn")),
    (("NATURAL_TEXT_INTERNAL_MARKER",), lambda r: r["messages"][3].update(content="a simulation")),
    (("CALLED_EXECUTION_INVALID",), lambda r: r["metadata"]["execution"].update(type="not_applicable")),
    (("FINAL_RESPONSE_METHOD_REQUIRED",), lambda r: r["metadata"].pop("final_response_method")),
    (("PARALLEL_STRUCTURE_INVALID",), lambda r: r["metadata"].update(secondary_tags=["parallel_tool"])),
    (("SEQUENTIAL_STRUCTURE_INVALID",), lambda r: r["metadata"].update(secondary_tags=["sequential_tool"])),
    (("EXPOSED_TOOL_SCHEMA_MISMATCH",), lambda r: r["tools"][0]["function"].update(parameters={"type": "object"})),
    (("REVIEW_ACCEPTED_BEFORE_VALIDATION", "ACCEPTED_RECORD_INVALID"), lambda r: (r["metadata"]["review"].update(status="accepted"), r["metadata"]["validation"].update(json="not_run"))),
)
_VARIANTS = []
for _k, (_codes, _change) in enumerate(CHANGES):
    _r = _record()
    _change(_r)
    _VARIANTS.append((_k, json.dumps(_r), list(_codes)))


def _built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each conversation, with its first user text and one of CHANGES by its id."""
    first = F.min(F.when((F.col("role") == "user") & F.col("text").isNotNull(), F.struct("turn", "text")))["text"]
    convs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.coalesce(first, F.lit("a question")).alias("text"))
    variants = F.broadcast(spark.createDataFrame([v[:2] for v in _VARIANTS], "k long, raw string"))  # a row a rule
    both = convs.join(variants, F.pmod("conv_id", F.lit(len(CHANGES))) == F.col("k"))
    quoted = F.get_json_object(F.to_json(F.struct(F.to_json(F.struct(F.translate("text", '"\\', "  ").alias("t"))).alias("j"))), "$.j")
    inner = F.substring(quoted, F.lit(7), F.length(quoted) - 8)
    raw = F.replace(F.replace("raw", F.lit("@ID@"), F.lpad((F.col("conv_id") + 1).cast("string"), 6, "0")), F.lit("@TEXT@"), inner)
    return both.select("conv_id", F.from_json(raw, schemas.RECORD).alias("r"))


@query(f"""WITH v AS (SELECT unnest(range({len(CHANGES)})) AS k, unnest({[list(c) for c, _ in CHANGES]}) AS codes), c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, unnest(codes) AS code FROM c JOIN v ON conv_id % {len(CHANGES)} = k""")
def record_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _built(spark, sf_dir).select("r.*", "conv_id")
    registry = spark.createDataFrame([("kitchen_scale", json.dumps(_record()["tools"][0]["function"]["parameters"]), '{"type":"object","properties":{"total":{"type":"number"}},"required":["total"]}')], "name string, parameters string, output_schema string")
    issues = validation.record_issues(built.drop("conv_id"), registry)
    return issues.select((F.split_part("id", F.lit("_"), F.lit(3)).cast("long") - 1).alias("conv_id"), "code")


@query(f"""WITH v AS (SELECT unnest(range({len(CHANGES)})) AS k, unnest({[list(c) for c, _ in CHANGES]}) AS codes), c AS (SELECT DISTINCT conv_id FROM conversations),
i AS (SELECT unnest(codes) AS code FROM c JOIN v ON conv_id % {len(CHANGES)} = k)
SELECT severity, count(*) AS n, false AS valid FROM (SELECT CASE WHEN code LIKE 'ARG%' THEN 'error' ELSE 'warning' END AS severity FROM i) GROUP BY severity""")
def issue_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of record_rules by severity; here broken arguments are errors."""
    issues = record_rules(spark, sf_dir).select(F.when(F.col("code").startswith("ARG"), "error").otherwise("warning").alias("severity"))
    return reporting.severity_counts(issues)


_TOOLS = "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'shop' ELSE lower(p_type) END AS domain, lower(p_type) || '.tool_' || (p_partkey - CAST(p_partkey % 40 = 1 AS INT)) || '.v' || (p_partkey % 3 + 1) AS tool_id, (p_size % 3 + 1) || '.' || p_size || '.0' AS tool_version, CASE WHEN p_partkey % 11 = 0 THEN 'x_' ELSE lower(p_type) || '_' END || (p_partkey - CAST(p_partkey % 50 = 1 AS INT)) AS name FROM part"


@query(f"""WITH t AS ({_TOOLS}) SELECT tool_id, unnest(list_filter([CASE WHEN p_partkey % 13 = 0 THEN 'DEFAULT_EXECUTION_NOT_SUPPORTED' END, CASE WHEN split_part(tool_id, '.v', 2) <> split_part(tool_version, '.', 1) THEN 'TOOL_MAJOR_MISMATCH' END,
  CASE WHEN domain <> split_part(tool_id, '.', 1) OR NOT starts_with(name, split_part(tool_id, '.', 1) || '_') THEN 'TOOL_DOMAIN_MISMATCH' END, CASE WHEN count(*) OVER (PARTITION BY tool_id) > 1 THEN 'DUPLICATE_TOOL_ID' END, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN 'DUPLICATE_FUNCTION_NAME' END], lambda x: x IS NOT NULL)) AS code FROM t""")
def registry_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tools of a registry."""
    key, kind = F.col("p_partkey"), F.lower("p_type")
    shifted = lambda n: (key - F.when(F.pmod(key, F.lit(n)) == 1, 1).otherwise(0)).cast("string")
    execution = F.struct(F.when(F.pmod(key, F.lit(13)) == 0, "http").otherwise("local").alias("default_type"), F.array(F.lit("local"), F.lit("fixture")).alias("supported_types"))
    registry = table(spark, sf_dir, "part").select(
        F.concat(kind, F.lit(".tool_"), shifted(40), F.lit(".v"), (F.pmod(key, F.lit(3)) + 1).cast("string")).alias("tool_id"),
        F.concat((F.pmod("p_size", F.lit(3)) + 1).cast("string"), F.lit("."), F.col("p_size").cast("string"), F.lit(".0")).alias("tool_version"),
        F.when(F.pmod(key, F.lit(7)) == 0, "shop").otherwise(kind).alias("domain"),
        F.struct(F.concat(F.when(F.pmod(key, F.lit(11)) == 0, "x_").otherwise(F.concat(kind, F.lit("_"))), shifted(50)).alias("name")).alias("function"),
        execution.alias("execution"),
    )
    return validation.registry_issues(registry)


@query("""WITH v AS (SELECT event_id, (event_id % 3) || '.' || (user_id % 12) || CASE WHEN event_id % 10 = 0 THEN '' ELSE '.' || (event_id % 5) END || CASE WHEN event_id % 4 = 0 THEN '-rc.' || (user_id % 3) ELSE '' END AS v,
  'shop.' || event_type || '.v' || (user_id % 3) AS t, ['tool_added', 'messages_incompatible', 'description_only', 'other'][event_id % 4 + 1] AS change FROM events)
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(split_part(v, '.', 1) AS BIGINT) END AS major, CASE WHEN event_id % 10 <> 0 THEN CAST(split_part(v, '.', 2) AS BIGINT) END AS minor, CASE WHEN event_id % 10 <> 0 AND event_id % 4 = 0 THEN split_part(v, '-', 2) END AS prerelease,
  event_id % 10 <> 0 AND event_id % 3 = 0 AS in_development, event_id % 10 <> 0 AND regexp_extract(t, 'v([0-9]+)$', 1) <> '0' AND regexp_extract(t, 'v([0-9]+)$', 1) = split_part(v, '.', 1) AS major_matches,
  CASE change WHEN 'tool_added' THEN 'tool_registry_version' WHEN 'messages_incompatible' THEN 'schema_version' WHEN 'description_only' THEN 'patch_only' END AS target FROM v""")
def version_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, user, text = F.col("event_id"), F.col("user_id"), lambda c: c.cast("string")
    v = F.concat(text(F.pmod(n, F.lit(3))), F.lit("."), text(F.pmod(user, F.lit(12))), F.when(F.pmod(n, F.lit(10)) == 0, "").otherwise(F.concat(F.lit("."), text(F.pmod(n, F.lit(5))))), F.when(F.pmod(n, F.lit(4)) == 0, F.concat(F.lit("-rc."), text(F.pmod(user, F.lit(3))))).otherwise(""))
    tool = F.concat(F.lit("shop."), F.col("event_type"), F.lit(".v"), text(F.pmod(user, F.lit(3))))
    change = F.element_at(F.array(*map(F.lit, ("tool_added", "messages_incompatible", "description_only", "other"))), (F.pmod(n, F.lit(4)) + 1).cast("int"))
    out = table(spark, sf_dir, "events").select("event_id", v.alias("v"), tool.alias("t"), change.alias("change"))
    p = versions.parsed(F.col("v"))
    return out.select("event_id", p["major"].alias("major"), p["minor"].alias("minor"), p["prerelease"].alias("prerelease"), versions.in_development(F.col("v")).alias("in_development"), versions.major_matches(F.col("t"), F.col("v")).alias("major_matches"), versions.change_target(F.col("change")).alias("target"))


_JOB = """p AS (SELECT o_orderkey, o_orderstatus AS s, o_custkey || ':' || o_orderstatus AS line, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders),
m AS (SELECT (n - 1) // 1000 AS shard, min(n - 1) AS start, max(n) AS "end", sha256(string_agg(sha256(line), chr(10) ORDER BY n)) AS digest FROM p GROUP BY 1),
d AS (SELECT shard, '{"status":{"labels":[' || string_agg('"' || s || '"', ',' ORDER BY s) || '],"counts":[' || string_agg(k::VARCHAR, ',' ORDER BY s) || ']}}' AS distributions FROM (SELECT (n - 1) // 1000 AS shard, s, count(*) AS k FROM p GROUP BY ALL) GROUP BY shard)"""


def _job(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orders.withColumn("line", F.concat_ws(":", F.col("o_custkey").cast("string"), "o_orderstatus"))


@query(f"WITH {_JOB} SELECT CAST(shard AS BIGINT) AS shard, CAST(start AS BIGINT) AS start, CAST(\"end\" AS BIGINT) AS \"end\", digest, distributions FROM m JOIN d USING (shard)")
def job_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.job_manifest(_job(spark, sf_dir), "o_orderkey", "line", 1000, {"status": F.col("o_orderstatus")})


@query(f"WITH {_JOB} SELECT DISTINCT CAST((n - 1) // 1000 AS BIGINT) AS shard, 'changed' AS problem FROM p WHERE o_orderkey % 2500 = 7")
def job_manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest against the same orders after the lines of some have changed."""
    job = _job(spark, sf_dir)
    later = job.withColumn("line", F.when(F.col("o_orderkey") % 2500 == 7, F.concat("line", F.lit("!"))).otherwise(F.col("line")))
    plan = lambda rows: lifecycle.job_manifest(rows, "o_orderkey", "line", 1000, {"status": F.col("o_orderstatus")})
    return lifecycle.manifest_problems(plan(job), plan(later))


@query(f"""WITH {_JOB}, k AS (SELECT (n - 1) // 1000 AS shard, count(*) AS rows, count_if((n - 1) // 1000 % 4 = 0 OR (n - 1) // 1000 % 4 = 1 AND n % 2 = 0 OR (n - 1) // 1000 % 4 = 2) AS processed, count_if((n - 1) // 1000 % 4 = 2 AND n % 100 = 0) AS failed FROM p GROUP BY 1)
SELECT CAST(shard AS BIGINT) AS shard, processed, processed - failed AS succeeded, failed, CASE WHEN processed = 0 THEN 'pending' WHEN processed < rows THEN 'running' WHEN failed > 0 THEN 'failed' ELSE 'completed' END AS status FROM k""")
def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress by shard from a checkpoint that holds all of some shards, half of others and none of the rest."""
    manifest = job_manifest(spark, sf_dir)
    placed = lifecycle.numbered(_job(spark, sf_dir), "o_orderkey").withColumn("shard", F.floor((F.col("number") - 1) / 1000))
    turn = F.pmod("shard", F.lit(4))
    done = placed.where((turn == 0) | (turn == 2) | (turn == 1) & (F.col("number") % 2 == 0)).select("shard", F.when((turn == 2) & (F.col("number") % 100 == 0), "timeout").alias("error"))
    return lifecycle.job_progress(manifest, done)


@query("""WITH r AS (SELECT d.doc_id, count(*) OVER (PARTITION BY text) > 1 AND text IS NOT NULL AS finding, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)), n AS (SELECT count(*) AS n FROM documents), b AS (SELECT count(*) AS b FROM benchmark)
SELECT CAST(n AS BIGINT) AS records_checked, CAST(b AS BIGINT) AS reference_records, CAST(n * (n - 1) // 2 + n * b AS BIGINT) AS pairs_checked, CAST(count_if(finding) AS BIGINT) AS duplicate_findings, CAST(count_if(finding OR coalesce(quality = 0, false)) AS BIGINT) AS records_with_automatic_failures,
  CAST(count_if(quality = 1) AS BIGINT) AS records_with_model_pass, CAST(count_if(toxic IS NULL) AS BIGINT) AS records_pending_human_language_review, count_if(finding OR coalesce(quality = 0, false)) = 0 AS passed FROM r, n, b GROUP BY n, b""")
def quality_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: labels of quality are the model's verdicts, those of toxicity stand for a person's look at the language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = duplicates.representatives(docs, F.sha2("text", 256), "doc_id").select(F.col("id").alias("doc_id"), F.lit(True).alias("found"))
    records = docs.select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left").join(groups, "doc_id", "left").withColumn("finding", F.coalesce("found", F.lit(False)))
    state = lambda c: F.when(c.isNull(), "not_run").when(c, "passed").otherwise("failed")
    gates = {"semantic": state(F.col("quality") == 1), "language": state(F.col("toxic") == 0), "duplicate": F.when(F.col("finding"), "failed").otherwise("not_run")}
    return lifecycle.quality_summary(records, gates, table(spark, sf_dir, "benchmark").count())


@query("SELECT l_orderkey AS id, 'duplicate_record_id' AS problem FROM lineitem GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT DISTINCT l_orderkey, 'accepted_record' FROM lineitem WHERE l_returnflag = 'A'")
def input_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as records by their order's id; returned ones of kind A count as accepted."""
    records = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.when(F.col("l_returnflag") == "A", "accepted").otherwise("draft").alias("status"))
    return lifecycle.input_problems(records)


@query("""WITH s AS (SELECT d.lang, d.source IN ('src0', 'src1', 'src2') AS strong, 2 + quality * 2 + (1 - toxic) AS score, quality = 1 AS pass, n_chars < 40 AS lost FROM labels JOIN documents d USING (doc_id)),
m AS (SELECT lang, strong, count(*) AS n, count_if(lost) AS f, round(avg(score), 4) AS mean, count_if(pass) AS p FROM s GROUP BY ALL),
g AS (SELECT lang, sum(n) AS size, max(CASE WHEN NOT strong THEN f END) AS cf, max(CASE WHEN strong THEN f END) AS sf, max(CASE WHEN NOT strong THEN mean END) AS cm, max(CASE WHEN strong THEN mean END) AS sm, max(CASE WHEN NOT strong THEN p END) AS cp, max(CASE WHEN strong THEN p END) AS sp FROM m GROUP BY lang),
r AS (SELECT *, array_to_string(list_filter([CASE WHEN cf > 0 THEN 'cheap_generation_failed' END, CASE WHEN sf > 0 THEN 'strong_generation_failed' END, CASE WHEN cm < 4.0 THEN 'score_low' END, CASE WHEN sm - cm > 0.15 THEN 'score_gap' END, CASE WHEN cp <> size THEN 'not_all_passed' END, CASE WHEN sp - cp > 1 THEN 'pass_gap' END], lambda x: x IS NOT NULL), ',') AS w FROM g)
SELECT lang, CASE WHEN size < 30 THEN 'insufficient_sample' WHEN cf IS NULL OR sf IS NULL THEN 'incomplete_model_pair' WHEN w = '' THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN size < 30 THEN 'insufficient_sample' WHEN cf IS NULL OR sf IS NULL THEN 'incomplete_model_pair' ELSE w END AS reasons FROM r""")
def model_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By language, three sources as the stronger model and the others as the cheaper one, judged by labels."""
    both = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    scored = both.select("lang", F.col("source").isin("src0", "src1", "src2").alias("strong"), (2 + F.col("quality") * 2 + (1 - F.col("toxic"))).alias("score"), (F.col("quality") == 1).alias("pass"), (F.col("n_chars") < 40).alias("lost"))
    models = scored.groupBy("lang", "strong").agg(F.count("*").alias("n"), F.count_if("lost").alias("generation_failed"), F.round(F.avg("score"), 4).alias("mean"), F.count_if("pass").alias("passes"))
    fields = ("generation_failed", "mean", "passes")
    pairs = models.groupBy("lang").agg(F.sum("n").alias("size"), *(F.max(F.when(F.col("strong") == s, F.col(f))).alias(f"{s}_{f}") for s in (False, True) for f in fields))
    side = lambda s: {f: F.col(f"{s}_{f}") for f in fields} | {"judge_failed": F.lit(0)}
    return pairs.select("lang", quality.recommendation(F.col("size"), F.lit(True), side(False), side(True)).alias("x")).select("lang", "x.*")


@query("""WITH u AS (SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'user' AND text IS NOT NULL) AS u, list(text ORDER BY turn) FILTER (WHERE role = 'assistant' AND text IS NOT NULL) AS a FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, conv_id % 2 = 0 AS multi, conv_id % 3 = 0 AS asks, CASE WHEN conv_id % 2 = 0 THEN coalesce(u, [])[1:2] ELSE coalesce(u, [])[1:1] END AS m, CASE WHEN conv_id % 10 = 1 THEN 'again?' WHEN conv_id % 2 = 0 AND conv_id % 14 <> 0 THEN CASE WHEN conv_id % 4 = 0 THEN 'which one?' ELSE 'go on' END END AS b,
  CASE conv_id % 9 WHEN 1 THEN ' ' WHEN 2 THEN 'так' WHEN 3 THEN '<THINK>' WHEN 4 THEN 'at 2024-05-01T10:00 it' WHEN 5 THEN 'a `b`' WHEN 6 THEN 'a mock' ELSE coalesce(a[-1], '') END AS f FROM u),
s AS (SELECT *, concat_ws(chr(10), array_to_string(m, chr(10)), b, f) AS t FROM p)
SELECT conv_id, CASE WHEN len(m) <> CASE WHEN multi THEN 2 ELSE 1 END OR len(list_filter(m, lambda x: trim(x, ' ') = '')) > 0 THEN 'message_count' WHEN multi AND b IS NULL OR NOT multi AND b IS NOT NULL THEN 'intermediate' WHEN multi AND asks AND NOT contains(b, '?') THEN 'clarification' WHEN trim(f, ' ') = '' THEN 'final'
  WHEN len(regexp_extract_all(t, '[\\p{L}]')) > len(regexp_extract_all(t, '[\\p{Latin}µμ]')) THEN 'script' WHEN contains(lower(t), '<think') OR contains(lower(t), '</think') THEN 'think_tag' WHEN regexp_matches(t, '\\b[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}') THEN 'timestamp' WHEN contains(t, '**') OR contains(t, '`') THEN 'markdown'
  WHEN regexp_matches(lower(t), '(^|[^\\p{L}\\p{N}])(mock|fully[ _-]simulated|(sentetik|synthetic|fixture|fikstur|fikstür|simulated|simulation|simulasyon|simülasyon|simule|simüle)[\\p{L}\\p{N}_]*)($|[^\\p{L}\\p{N}])') THEN 'marker' ELSE 'passed' END AS verdict FROM s""")
def plan_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as language plans, with faults put into some."""
    said = lambda role: F.transform(F.array_sort(F.collect_list(F.when((F.col("role") == role) & F.col("text").isNotNull(), F.struct("turn", "text")))), lambda x: x["text"])
    convs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(said("user").alias("u"), said("assistant").alias("a"))
    k = lambda n: F.pmod("conv_id", F.lit(n))
    between = F.when(k(10) == 1, "again?").when((k(2) == 0) & (k(14) != 0), F.when(k(4) == 0, "which one?").otherwise("go on"))
    final = F.coalesce(F.create_map(*(F.lit(x) for kv in enumerate((" ", "так", "<THINK>", "at 2024-05-01T10:00 it", "a `b`", "a mock"), 1) for x in kv))[k(9).cast("int")], F.get(F.reverse("a"), 0), F.lit(""))
    multi = k(2) == 0
    return convs.select("conv_id", drafts.plan_verdict(F.slice("u", F.lit(1), F.when(multi, 2).otherwise(1)), multi, k(3) == 0, between, final).alias("verdict"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '{"k":' || json_extract(props, '$.k') || ',"list":[1]}' ELSE '{"k":' || json_extract(props, '$.k') || ',"list":[1,{"name":"' || event_type || '"}]}' END AS facts,
  sha256('{"answer":{"k":' || json_extract(props, '$.k') || '},"tools":[{"name":"f","parameters":{"type":"object"}}]}') AS fingerprint FROM events""")
def draft_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a writer may see of results that hold internal keys and marked texts, and what a translation may not change."""
    k = F.variant_get(F.parse_json("props"), "$.k", "long").cast("string")
    extra = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"provenance":1}'))).otherwise(F.concat(F.lit('{"name":"'), F.col("event_type"), F.lit('","source_id":3}')))
    result = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"source":"x","k":'), k, F.lit(',"note":"a synthetic one","list":[1,"mock"]}'))).otherwise(F.concat(F.lit('{"is_synthetic":true,"list":[1,"fixture_3",'), extra, F.lit('],"k":'), k, F.lit("}")))
    content = F.concat(F.lit('{"query":"'), F.col("event_type"), F.lit('","tools":[{"name":"f","description":"d","parameters":{"type":"object","description":"e"}}],"answer":{"k":'), k, F.lit("}}"))
    return table(spark, sf_dir, "events").select("event_id", drafts.visible_facts(result).alias("facts"), drafts.machine_fingerprint(content).alias("fingerprint"))


@query("""WITH r AS (SELECT event_id, event_id % 7 <> 0 AS tr, CASE WHEN event_id % 4 <> 0 THEN value END AS v, event_id % 3 <> 0 AS ok, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'it is 99999' ELSE 'it is ' || json_extract(props, '$.k') END AS a, event_id % 2 = 0 AS sure, CASE WHEN event_id % 6 < 3 THEN 'source_answer_adaptation' END AS m FROM events),
s AS (SELECT *, v IS NOT NULL AND ok AS usable, a IS NOT NULL AND sure AS known, CASE WHEN event_id % 5 = 1 THEN 'tool_result_regeneration' ELSE coalesce(m, 'tool_result_regeneration') END AS wanted FROM r),
t AS (SELECT *, CASE WHEN NOT tr THEN 'language' WHEN NOT usable AND NOT known THEN 'nothing_verifiable' WHEN NOT usable AND m IS NULL THEN 'adaptation_required' WHEN NOT usable THEN 'human_verification' WHEN wanted = 'source_answer_adaptation' AND NOT known THEN 'answer_not_verified' END AS reason FROM s)
SELECT event_id, CASE WHEN reason IS NULL THEN wanted WHEN reason = 'human_verification' THEN 'source_answer_adaptation' END AS method, reason, event_id % 5 <> 1 AS grounded FROM t""")
def response_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each event's result would be told; some answers name a number that it lacks."""
    k = lambda n: F.pmod("event_id", F.lit(n))
    number = F.variant_get(F.parse_json("props"), "$.k", "long").cast("string")
    result = F.concat(F.lit('{"k":'), number, F.lit("}"))
    answer = F.when(k(5) == 0, None).when(k(5) == 1, "it is 99999").otherwise(F.concat(F.lit("it is "), number))
    chosen = drafts.response_selection(F.when(k(7) != 0, "tr").otherwise("en"), F.when(k(4) != 0, result), k(3) != 0, answer, k(2) == 0, F.when(k(6) < 3, "source_answer_adaptation"))
    return table(spark, sf_dir, "events").select("event_id", chosen.alias("x"), drafts.grounded(answer, F.lit(""), result).alias("grounded")).select("event_id", "x.*", "grounded")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0
  THEN '{"description":"","name":"f' || p_partkey || '","parameters":{"additionalProperties":false,"properties":{"a":{"type":"integer"},"b":{"maximum":' || p_size || ',"type":["number","null"]}},"required":["a"],"type":"object"}}'
  ELSE '{"description":"d","name":"f' || p_partkey || '","parameters":{"additionalProperties":false,"properties":{"a":{"type":"string"},"b":{"description":"' || p_size || '","type":"string"}},"required":["a"],"type":"object"}}' END AS tool,
  '{"arguments":{"a":' || p_size || '},"name":"f' || p_partkey || '"}' AS call FROM part""")
def normalized_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tools of parts in two loose dialects, one with a JSON schema of loose types, one a flat list of parameters, in one shape."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    schema = F.concat(F.lit('{"name":"f'), key, F.lit('","parameters":{"type":"dict","properties":{"a":{"type":"int"},"b":{"type":["float","null"],"maximum":'), size, F.lit('}},"required":["a"]}}'))
    flat = F.concat(F.lit('{"name":"f'), key, F.lit('","description":"d","parameters":"{\\"a\\":{\\"type\\":\\"str\\",\\"required\\":true},\\"b\\":'), size, F.lit('}"}'))
    call = F.concat(F.lit('{"arguments":"{\\"a\\": '), size, F.lit('}","name":"f'), key, F.lit('"}'))
    return table(spark, sf_dir, "part").select("p_partkey", foreign.tool(F.when(F.col("p_partkey") % 2 == 0, schema).otherwise(flat)).alias("tool"), foreign.call(call).alias("call"))


_DAYS = "d AS (SELECT event_type AS code, CAST(ts AS DATE) AS day, count(*) AS unit, max(user_id) || '/' || min(event_id) AS bulletin FROM events GROUP BY ALL)"


@query(f"""WITH {_DAYS}, c AS (SELECT min(day) AS lo, max(day) AS hi FROM d), r AS (SELECT code, unnest([0, 1, 2, 3]) AS k FROM (SELECT DISTINCT code FROM d)), q AS (SELECT code, k, CASE k WHEN 1 THEN lo - 3 WHEN 2 THEN hi ELSE lo END AS a, CASE k WHEN 1 THEN hi WHEN 2 THEN lo - CAST(lo = hi AS INT) WHEN 3 THEN lo ELSE hi END AS b, lo, hi FROM r, c),
x AS (SELECT q.code, q.k, CASE WHEN a > b THEN 'range_error' WHEN a < lo OR b > hi THEN 'coverage_error' ELSE 'covered' END AS status, arg_min(bulletin, day) AS f, arg_max(bulletin, day) AS l, count(day) AS rows FROM q LEFT JOIN d ON d.code = q.code AND day BETWEEN a AND b GROUP BY ALL)
SELECT code, CAST(k AS INT) AS k, status, CASE WHEN status = 'covered' THEN f || '-' || l END AS release_id, CASE WHEN status = 'covered' THEN rows ELSE 0 END AS rows FROM x""")
def covered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for ranges of days by event type, some of them turned around or beyond what is there."""
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("code"), F.to_date("ts").alias("day")).agg(F.concat_ws("/", F.max("user_id").cast("string"), F.min("event_id").cast("string")).alias("bulletin"))
    ends = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    asked = daily.select("code").distinct().select("code", F.explode(F.array(*map(F.lit, range(4)))).alias("k")).join(F.broadcast(ends))  # one row
    k, lo, hi = F.col("k"), F.col("lo"), F.col("hi")
    start = F.when(k == 1, F.date_sub(lo, 3)).when(k == 2, hi).otherwise(lo)
    end = F.when(k == 1, hi).when(k == 2, F.when(lo == hi, F.date_sub(lo, 1)).otherwise(lo)).when(k == 3, lo).otherwise(hi)
    found = series.covered(asked.select("code", "k", start.alias("start"), end.alias("end")), daily, "code", "day", "bulletin")
    return found.select("code", "k", "status", "release_id", "rows")


@query("""SELECT event_id, list_filter([CASE WHEN k < 10 OR k > 80 OR k % 3 <> 0 THEN 'INVALID:$.k' END, CASE WHEN event_id % 4 = 0 THEN 'ADDITIONAL:$.x_1' WHEN event_id % 4 = 1 THEN 'TYPE:$.s_1' END, CASE WHEN event_id % 5 = 0 AND event_id % 4 > 1 THEN 'INVALID:$' END, CASE WHEN event_id % 6 = 0 THEN 'TYPE:$.p[1]' END], lambda x: x IS NOT NULL).list_sort() AS issues FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def json_schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' properties against a schema with references, multiples, patterns of names, tuples and numbers of properties."""
    schema = '{"$defs":{"small":{"type":"integer","minimum":10,"maximum":80}},"type":"object","minProperties":3,"properties":{"k":{"allOf":[{"$ref":"#/$defs/small"}],"multipleOf":3},"p":{"prefixItems":[{"type":"integer"},{"type":"string"}]},"q":{}},"patternProperties":{"^s_":{"type":"string"}},"additionalProperties":false}'
    k = F.variant_get(F.parse_json("props"), "$.k", "long").cast("string")
    n = lambda m: F.pmod("event_id", F.lit(m))
    value = F.concat(F.lit('{"k":'), k, F.lit(',"p":[1,'), F.when(n(6) == 0, "2").otherwise('"b"'), F.lit("]"), F.when(n(5) == 0, "").otherwise(',"q":0'), F.when(n(4) == 0, ',"x_1":0').when(n(4) == 1, ',"s_1":0').otherwise(""), F.lit("}"))
    issues = F.array_sort(F.array_distinct(F.transform(jsons.schema_issues(F.lit(schema), value), lambda x: F.concat_ws(":", x["code"], x["path"]))))
    return table(spark, sf_dir, "events").select("event_id", issues.alias("issues"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN false ELSE NOT (verdict = 'pass' AND (quality + 3 < 4 OR toxic = 1)) END AS valid FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'revise' ELSE 'pass' END AS verdict FROM labels)""")
def judgment_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as judgments with a score and an issue; every fifth writes its score as a fraction."""
    score = F.when(F.pmod("doc_id", F.lit(5)) == 0, "4.5").otherwise((F.col("quality") + 3).cast("string"))
    severities = F.when(F.col("toxic") == 1, F.array(F.lit("major"))).otherwise(F.array(F.lit("minor")))
    verdict = F.when(F.pmod("doc_id", F.lit(3)) == 0, "revise").otherwise("pass")
    return table(spark, sf_dir, "labels").select("doc_id", reporting.judgment_valid(F.create_map(F.lit("overall"), score), verdict, severities, F.lit("iyi")).alias("valid"))


@query("""WITH b AS (SELECT lang, source, coalesce(n_chars // 2000, -1) AS size, doc_id % 40 <> 3 AS kept FROM documents) SELECT lang, CAST(count(*) AS BIGINT) AS plans, CAST(count(DISTINCT source) AS BIGINT) AS sources, CAST(count(DISTINCT size) AS BIGINT) AS sizes, count(DISTINCT source) = 1 AS one_source FROM b WHERE kept AND lang IS NOT NULL GROUP BY lang""")
def plan_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as plans, without those asked to be left out: what each language's plans are made of."""
    docs = table(spark, sf_dir, "documents").where("lang IS NOT NULL")
    left_out = docs.where("doc_id % 40 = 3").select("doc_id")
    chosen = docs.join(left_out, "doc_id", "left_anti").withColumn("size", F.coalesce(F.floor(F.col("n_chars") / 2000), F.lit(-1)))
    return chosen.groupBy("lang").agg(F.count("*").alias("plans"), F.count_distinct("source").alias("sources"), F.count_distinct("size").alias("sizes")).withColumn("one_source", F.col("sources") == 1)


@query("""SELECT conv_id, '{"id":' || conv_id || ',"roles":{"assistant":' || count_if(role = 'assistant') || ',"user":' || count_if(role = 'user') || '},"turns":' || count(*) || '}' AS line FROM conversations GROUP BY conv_id""")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as lines with sorted keys, as the writer of records has them."""
    role = lambda r: F.count_if(F.col("role") == r).cast("string")
    raw = F.concat(F.lit('{"turns": '), F.count("*").cast("string"), F.lit(', "roles": {"user": '), role("user"), F.lit(', "assistant": '), role("assistant"), F.lit('}, "id": '), F.first("conv_id").cast("string"), F.lit("}"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(raw.alias("raw")).select("conv_id", jsons.canonical_json("raw").alias("line"))
