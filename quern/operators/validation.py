"""Rules on conversation records: one pass builds each record's issues, and one explode lists them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import valid_record_id
from quern.functions.jsons import same_value, schema_issues, schema_problems, without_descriptions
from quern.functions.text import markers
from quern.functions.versions import major_matches
from quern.sources.schemas import GATES
from quern.sources.tables import durable

#: Tags, statuses whose results need no JSON, and decisions that each category allows.
EXEMPT, PARALLEL, SEQUENTIAL = "internal_marker_topic", "parallel_tool", "sequential_tool"
NO_RESULT = ("empty_result", "invalid_result", "failed", "timeout", "rate_limited")
NO_CALLS = ("no_tool", "missing_parameter")


def issue(code: str, when: Column, path: str = "$") -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(path).alias("path")))


def shaped(records: DataFrame) -> DataFrame:
    """records with what rules need: positions of calls, results and direct answers."""
    at = F.transform("messages", lambda m, i: F.struct(i.alias("i"), m.alias("m")))
    calls = F.flatten(F.transform("__at", lambda x: F.transform(F.coalesce(F.when(x["m"]["role"] == "assistant", x["m"]["tool_calls"]), F.expr("array()").cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>")), lambda c: F.struct(x["i"].alias("i"), c["id"].alias("id"), c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments")))))
    results = F.transform(F.filter("__at", lambda x: x["m"]["role"] == "tool"), lambda x: F.struct(x["i"].alias("i"), x["m"]["tool_call_id"].alias("id"), x["m"]["name"].alias("name"), x["m"]["content"].alias("content")))
    direct = F.transform(F.filter("__at", lambda x: (x["m"]["role"] == "assistant") & x["m"]["content"].isNotNull() & (F.coalesce(F.size(x["m"]["tool_calls"]), F.lit(0)) == 0)), lambda x: x["i"])
    out = records.withColumn("__at", at).withColumns({"__calls": calls, "__results": results, "__direct": direct})
    last = F.coalesce(F.array_max(F.transform("__results", lambda r: r["i"])), F.lit(-1))
    return out.withColumns({"__users": F.size(F.filter("messages", lambda m: m["role"] == "user")), "__groups": F.array_distinct(F.transform("__calls", lambda c: c["i"])), "__last": last}).withColumn("__final", (F.size("__results") > 0) & F.exists("__direct", lambda i: i > F.col("__last")))


def record_issues(records: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, code, path): every rule that a record breaks, the registry (name, parameters, output_schema) looked up once a name."""
    # Written once, so that the four looks at it agree on rows and don't shape them again.
    r = durable(shaped(records).withColumns({"__row": F.monotonically_increasing_id(), "__accepted": F.coalesce(F.col("metadata.review.status") == "accepted", F.lit(False))}), "shaped")
    c = F.col
    n = F.size("__calls")
    ids = lambda a: F.transform(a, lambda x: x["id"])
    tags, status, kind = c("metadata.secondary_tags"), c("metadata.execution.status"), c("metadata.execution.type")
    category = c("metadata.main_category")
    exposed = F.transform("tools", lambda t: t["function"]["name"])
    observed = F.when(n >= 2, "multi_tool").when(c("__users") > 1, "multi_turn").when(n == 1, "single_tool").when(category.isin(*NO_CALLS), category).otherwise("no_tool")
    unmatched = F.exists("__results", lambda x: ~F.exists("__calls", lambda y: (y["id"] == x["id"]) & (y["i"] < x["i"])))
    renamed = F.exists("__results", lambda x: F.exists("__calls", lambda y: (y["id"] == x["id"]) & (y["i"] < x["i"]) & (y["name"] != x["name"])))
    unanswered = F.size(F.array_except(ids("__calls"), ids("__results"))) > 0
    early = F.exists("__calls", lambda y: F.exists("__calls", lambda x: (x["i"] < y["i"]) & ~F.exists("__results", lambda z: (z["id"] == x["id"]) & (z["i"] < y["i"]))))
    spoken = F.array_join(F.transform(F.filter("messages", lambda m: m["role"].isin("user", "assistant")), lambda m: F.coalesce(m["content"], F.lit(""))), "\n")
    open_gates = F.array(*(c(f"metadata.validation.{g}") for g in GATES))
    method = c("metadata.final_response_method").isNotNull()
    par, seq = F.array_contains(tags, PARALLEL), F.array_contains(tags, SEQUENTIAL)
    accepted = c("metadata.review.status") == "accepted"
    semantic = [
        issue("VERSION_INVALID", (F.split_part("schema_version", F.lit("."), F.lit(1)) != "0") | (F.split_part("tool_registry_version", F.lit("."), F.lit(1)) != "0"), "$.schema_version"),
        issue("ID_SOURCE_MISMATCH", ~valid_record_id(c("id"), c("metadata.source_type")), "$.id"),
        issue("DUPLICATE_EXPOSED_FUNCTION", F.size(F.array_distinct(exposed)) < F.size(exposed), "$.tools"),
        issue("FUNCTION_NOT_EXPOSED", F.size(F.array_except(F.transform("__calls", lambda x: x["name"]), exposed)) > 0, "$.messages"),
        issue("NATURAL_TEXT_INTERNAL_MARKER", ~F.array_contains(tags, EXEMPT) & (F.size(markers(spoken)) > 0), "$.messages"),
        issue("DUPLICATE_TOOL_CALL_ID", F.size(F.array_distinct(ids("__calls"))) < n, "$.messages"),
        issue("DUPLICATE_TOOL_RESULT_ID", F.size(F.array_distinct(ids("__results"))) < F.size("__results"), "$.messages"),
        issue("UNMATCHED_TOOL_RESULT", unmatched, "$.messages"),
        issue("TOOL_RESULT_NAME_MISMATCH", renamed, "$.messages"),
        issue("TOOL_RESULT_JSON_INVALID", ~status.isin(*NO_RESULT) & F.exists("__results", lambda x: F.try_parse_json(x["content"]).isNull()), "$.messages"),
        issue("MISSING_TOOL_RESULT", (status == "passed") & unanswered, "$.messages"),
        issue("CATEGORY_PRIORITY_MISMATCH", category != observed, "$.metadata.main_category"),
        issue("TOOL_ORDER_TAG_CONFLICT", par & seq, "$.metadata.secondary_tags"),
        issue("PARALLEL_STRUCTURE_INVALID", par & ((F.size("__groups") != 1) | (n < 2)), "$.messages"),
        issue("SEQUENTIAL_STRUCTURE_INVALID", seq & ((F.size("__groups") < 2) | (F.size("__groups") != n)), "$.messages"),
        issue("SEQUENTIAL_ORDER_INVALID", seq & (F.size("__groups") >= 2) & (F.size("__groups") == n) & early, "$.messages"),
        issue("NO_CALL_EXECUTION_INVALID", (n == 0) & ((kind != "not_applicable") | (status != "not_called")), "$.metadata.execution"),
        issue("CALLED_EXECUTION_INVALID", (n > 0) & (kind == "not_applicable"), "$.metadata.execution"),
        issue("UNEXECUTED_RECORD_CLAIMS_VALIDATION", (n > 0) & (status == "not_called") & (c("metadata.validation.execution") != "not_run"), "$.metadata.validation.execution"),
        issue("FINAL_RESPONSE_METHOD_REQUIRED", (n > 0) & c("__final") & ~method, "$.metadata"),
        issue("FINAL_RESPONSE_METHOD_NOT_APPLICABLE", ((n == 0) | ~c("__final")) & method, "$.metadata.final_response_method"),
        issue("NO_TOOL_CATEGORY_HAS_CALL", category.isin(*NO_CALLS) & (n > 0), "$.messages"),
        issue("NO_TOOL_FINAL_BEHAVIOR_INVALID", category.isin(*NO_CALLS) & ~F.coalesce(F.array_max("__direct") == F.size("messages") - 1, F.lit(False)), "$.messages"),
        issue("REVIEW_ACCEPTED_BEFORE_VALIDATION", accepted & F.exists(open_gates, lambda g: g.isin("failed", "not_run")), "$.metadata.review"),
    ]
    own = r.select("__row", "id", "__accepted", F.explode(F.array_compact(F.array(*semantic))).alias("x")).select("__row", "id", "__accepted", "x.code", "x.path")
    every = own.unionByName(call_issues(r, registry)).unionByName(result_issues(r, registry)).unionByName(tool_issues(r, registry))
    late = every.where("__accepted").select("__row", "id").distinct().select("id", F.lit("ACCEPTED_RECORD_INVALID").alias("code"), F.lit("$.metadata.review").alias("path"))
    return every.select("id", "code", "path").unionByName(late)


#: What issues carry of their record: its row, as ids may repeat, and whether it was accepted.
OWN = ("__row", "id", "__accepted")


def call_issues(shaped_records: DataFrame, registry: DataFrame) -> DataFrame:
    """Arguments of calls against the schemas of their functions."""
    calls = shaped_records.select(*OWN, F.explode("__calls").alias("c")).select(*OWN, F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.i").alias("i"))
    met = calls.join(registry.select("name", "parameters"), "name", "left")
    base = F.format_string("$.messages[%d]", "i")
    unknown = met.where("parameters IS NULL").select(*OWN, F.lit("FUNCTION_NOT_IN_REGISTRY").alias("code"), base.alias("path"))
    code = F.when(F.col("x.code") == "ADDITIONAL", "ARG_UNSUPPORTED").when(F.col("x.code").isin("REQUIRED", "TYPE", "ENUM", "FORMAT"), F.concat(F.lit("ARG_"), "x.code")).otherwise("ARG_SCHEMA_INVALID")
    broken = met.where("parameters IS NOT NULL").select(*OWN, base.alias("base"), F.explode(schema_issues("parameters", "arguments")).alias("x"))
    return unknown.unionByName(broken.select(*OWN, code.alias("code"), F.concat("base", F.substring("x.path", 2, 1 << 20)).alias("path")))


def result_issues(shaped_records: DataFrame, registry: DataFrame) -> DataFrame:
    """Results against the output schemas of their functions, where the status promises one."""
    results = shaped_records.where(~F.col("metadata.execution.status").isin(*NO_RESULT)).select(*OWN, F.explode("__results").alias("r")).where(F.try_parse_json("r.content").isNotNull())
    met = results.select(*OWN, F.col("r.name").alias("name"), F.col("r.content").alias("content"), F.format_string("$.messages[%d]", "r.i").alias("base")).join(registry.select("name", "output_schema"), "name")
    code = F.when(F.col("x.code") == "ADDITIONAL", "RESULT_UNSUPPORTED").when(F.col("x.code").isin("REQUIRED", "TYPE", "ENUM", "FORMAT"), F.concat(F.lit("RESULT_"), "x.code")).otherwise("RESULT_SCHEMA_INVALID")
    return met.select(*OWN, "base", F.explode(schema_issues("output_schema", "content")).alias("x")).select(*OWN, code.alias("code"), F.concat("base", F.substring("x.path", 2, 1 << 20)).alias("path"))


def tool_issues(shaped_records: DataFrame, registry: DataFrame) -> DataFrame:
    """Exposed tools whose parameters differ from the registry's beyond descriptions, or that it lacks."""
    tools = shaped_records.select(*OWN, F.explode("tools").alias("t")).select(*OWN, F.col("t.function.name").alias("name"), F.col("t.function.parameters").alias("own"))
    met = tools.join(registry.select("name", "parameters"), "name", "left")
    code = F.when(F.col("parameters").isNull(), "FUNCTION_NOT_IN_REGISTRY").when(~same_value(without_descriptions("own"), without_descriptions("parameters")), "EXPOSED_TOOL_SCHEMA_MISMATCH")
    return met.select(*OWN, code.alias("code"), F.lit("$.tools").alias("path")).where("code IS NOT NULL")


def registry_issues(registry: DataFrame) -> DataFrame:
    """(tool_id, code): repeated ids and names, modes, versions and domains that don't fit, and schemas that are none."""
    twice = lambda key, code: registry.join(registry.groupBy(F.col(key).alias("__k")).count().where("count > 1"), F.col(key) == F.col("__k"), "left_semi").select("tool_id", F.lit(code).alias("code"))
    own = F.split_part("tool_id", F.lit("."), F.lit(1))
    broken = {
        "DEFAULT_EXECUTION_NOT_SUPPORTED": ~F.array_contains("execution.supported_types", F.col("execution.default_type")),
        "TOOL_MAJOR_MISMATCH": ~major_matches(F.col("tool_id"), F.col("tool_version")),
        "TOOL_DOMAIN_MISMATCH": (F.col("domain") != own) | ~F.col("function.name").startswith(F.concat(own, F.lit("_"))),
    }
    held = [c for c in ("function.parameters", "output_schema") if "." in c and "parameters" in registry.schema["function"].dataType.names or c in registry.columns]
    if held:
        broken["INVALID_JSON_SCHEMA"] = reduce(lambda a, b: a | b, (F.size(schema_problems(F.col(c))) > 0 for c in held))
    rules = F.array_compact(F.array(*(F.when(when, F.lit(code)) for code, when in broken.items())))
    return registry.select("tool_id", F.explode(rules).alias("code")).unionByName(twice("tool_id", "DUPLICATE_TOOL_ID")).unionByName(twice("function.name", "DUPLICATE_FUNCTION_NAME"))
