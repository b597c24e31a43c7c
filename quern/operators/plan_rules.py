"""Rules on plans, benchmark rows, raw records and the HTTP contracts of a registry, and sets that are published whole or not at all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.jsons import schema_issues, schema_issues_once
from quern.functions.text import markers
from quern.operators.validation import EXEMPT, PARALLEL, SEQUENTIAL
from quern.sources.tables import durable

#: Decisions that each category allows.
DECISIONS = {
    "single_tool": ("tool_call",), "multi_tool": ("tool_call",), "no_tool": ("direct_answer", "cannot_answer"),
    "missing_parameter": ("request_information",), "multi_turn": ("tool_call", "direct_answer", "request_information", "cannot_answer"),
}
#: Codes of a record schema's issues; all others are SCHEMA_INVALID.
SCHEMA_CODES = {"REQUIRED": "SCHEMA_REQUIRED", "ENUM": "SCHEMA_ENUM", "CONST": "SCHEMA_CONST", "PATTERN": "SCHEMA_PATTERN", "TYPE": "SCHEMA_TYPE", "ADDITIONAL": "SCHEMA_ADDITIONAL_PROPERTY"}
#: Characters of a registry that is sent to every task; a larger one is joined by a shuffle, with the same rows.
SENT = 64_000_000
CALLS = "array<struct<name:string,arguments:string>>"


def near(registry: DataFrame) -> DataFrame:
    """registry as a side of a join: broadcast if its text is at most SENT characters."""
    size = registry.agg(F.sum(sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in registry.columns), F.lit(0)))).first()[0]
    return F.broadcast(registry) if (size or 0) <= SENT else registry


#: What a row asks for: an issue that is sure (code), a name that the registry should have (TOOL), or a value against a schema of its function (ARG, RESULT).
FACT = "array<struct<kind:string,code:string,name:string,value:string,path:string>>"


def fact(kind: str, path: Column, name: Column | None = None, value: Column | None = None, code: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(kind).alias("kind"), *((none if x is None else x).alias(k) for k, x in (("code", code), ("name", name), ("value", value))), path.alias("path"))


def checked(facts: DataFrame, registry: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """(id, code, path) of facts (id, facts) against a registry (name and the columns that schemas names for ARG and RESULT).

    All facts of all rows go through one join and one look at schemas, so rows are made once. A function that the registry
    lacks is an issue for its arguments and as a tool, not for its result; a null schema allows all. Lists are opened by
    explode_outer(): for explode(), Spark asks before it whether they are empty, and makes them once more for that.
    """
    known = durable(registry.select("name", *schemas.values(), F.lit(True).alias("__known")).dropDuplicates(["name"]), "registry")
    met = facts.select("id", F.explode_outer("facts").alias("f")).where("f IS NOT NULL").select("id", "f.*").join(near(known), "name", "left")
    schema = reduce(lambda x, kv: x.when(F.col("kind") == kv[0], F.col(kv[1])), schemas.items(), F.when(F.lit(False), None))
    found = met.select("id", "kind", "code", "path", F.when(F.col("kind").isin("ARG", "TOOL") & F.col("__known").isNull(), "FUNCTION_NOT_IN_REGISTRY").alias("unknown"), schema.alias("schema"), "value")
    found = found.select("id", "kind", "path", F.coalesce("code", "unknown").alias("code"), F.col("schema").isNotNull().alias("has"), schema_issues_once("schema", "value").alias("issues"))
    found = found.select("id", "kind", "path", "code", F.explode_outer(F.when(F.col("code").isNull() & F.col("has"), F.col("issues"))).alias("x")).where("code IS NOT NULL OR x IS NOT NULL")
    code = F.when(F.col("x.code") == "ADDITIONAL", "_UNSUPPORTED").when(F.col("x.code").isin("REQUIRED", "TYPE", "ENUM", "FORMAT"), F.concat(F.lit("_"), "x.code")).otherwise("_SCHEMA_INVALID")
    return found.select("id", F.coalesce("code", F.concat("kind", code)).alias("code"), F.concat("path", F.coalesce(F.expr("substring(x.path, 2)"), F.lit(""))).alias("path"))


def benchmark_issues(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, code, path) of benchmark rows (id, category, decision, exposed, calls of name and arguments) against a registry (name, parameters).

    BENCHMARK_DECISION_INCONSISTENT where the category doesn't allow the decision, EXPECTED_FUNCTION_NOT_EXPOSED for
    each call of a function that the row doesn't expose, and the issues of each call's arguments. Null lists are empty;
    a row whose category is null or unknown allows no decision. Repeated rows are told each.
    """
    allowed = F.array_contains(F.coalesce(F.create_map(*(x for k, v in DECISIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))[F.col("category")], F.array().cast("array<string>")), F.coalesce("decision", F.lit("")))
    odd = F.when(F.coalesce(allowed, F.lit(False)), F.array().cast(FACT)).otherwise(F.array(fact("OWN", F.lit("$.expected.decision"), code=F.lit("BENCHMARK_DECISION_INCONSISTENT"))))
    at = lambda i, rest: F.concat(F.lit("$.expected.tool_calls["), i.cast("string"), F.lit(f"].function.{rest}"))
    calls = F.coalesce("calls", F.array().cast(CALLS))
    exposed = F.coalesce("exposed", F.array().cast("array<string>"))
    hidden = F.transform(F.filter(F.transform(calls, lambda x, i: F.struct(x["name"].alias("name"), i.alias("i"))), lambda x: ~F.array_contains(exposed, x["name"])), lambda x: fact("OWN", at(x["i"], "name"), code=F.lit("EXPECTED_FUNCTION_NOT_EXPOSED")))
    given = F.transform(calls, lambda x, i: fact("ARG", at(i, "arguments"), x["name"], x["arguments"]))
    return checked(rows.select("id", F.concat(odd, hidden, given).alias("facts")), registry, {"ARG": "parameters"})


def plan_issues(plans: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, code, path) of plans against a registry (name, parameters, output_schema).

    A plan has id, category, tags, goal, ending, avoid (texts), tools, calls (name, arguments), result (JSON or null),
    execution_order, behavior and execution_type. Its texts may not name the machinery unless it is about that; its tools are
    in the registry, its calls among its tools and true to their schemas, as is the result: one for a single call, a list
    with one for each of several. Order and tags agree for several tools, and what is no call is executed by nothing.
    Null lists are empty, null texts name nothing; repeated rows are told each.
    """
    c, none = F.col, F.array().cast("array<string>")
    tags, tools, n = F.coalesce("tags", none), F.coalesce("tools", none), F.coalesce(F.size("calls"), F.lit(0))
    n = F.greatest(n, F.lit(0))
    plans = plans.withColumn("__result", F.try_parse_json("result")).withColumns({"__kind": F.schema_of_variant("__result"), "__listed": F.try_variant_get("__result", "$", "array<variant>")})
    calls, listed, empty = F.coalesce("calls", F.array().cast(CALLS)), c("__listed"), F.array().cast(FACT)
    sure = lambda code, path: fact("OWN", path, code=F.lit(code))
    at = lambda before, i, after="]": F.concat(F.lit(before), i.cast("string"), F.lit(after))
    texts = F.concat(F.array(F.struct(F.lit("$.user_goal").alias("path"), c("goal").alias("text")), F.struct(F.lit("$.expected_final_behavior").alias("path"), c("ending").alias("text"))), F.transform(F.coalesce("avoid", none), lambda t, i: F.struct(at("$.must_avoid[", i).alias("path"), t.alias("text"))))
    leaks = F.when(~F.array_contains(tags, EXEMPT), F.transform(F.filter(texts, lambda t: F.size(markers(F.coalesce(t["text"], F.lit("")))) > 0), lambda t: sure("BLUEPRINT_INTERNAL_MARKER", t["path"]))).otherwise(empty)
    missing = F.transform(F.filter(F.transform(calls, lambda x, i: F.struct(x["name"].alias("name"), i.alias("i"))), lambda x: ~F.array_contains(tools, x["name"])), lambda x: sure("EXPECTED_FUNCTION_NOT_AVAILABLE", at("$.expected_tool_calls[", x["i"], "].function.name")))
    is_list = F.coalesce(c("__kind").startswith("ARRAY"), F.lit(False))
    order, kind = F.coalesce("execution_order", F.lit("")), F.coalesce("execution_type", F.lit(""))
    odd = ((order == "parallel") != F.array_contains(tags, PARALLEL)) | ((order == "sequential") != F.array_contains(tags, SEQUENTIAL))
    rest = F.array_compact(F.array(*(F.when(bad, sure(code, F.lit(path))) for code, bad, path in (
        ("BLUEPRINT_RESULT_COUNT_MISMATCH", (n > 1) & is_list & (F.size(listed) != n), "$.expected_tool_result"),
        ("BLUEPRINT_ORDER_TAG_MISMATCH", (c("category") == "multi_tool") & odd, "$.execution_order"),
        ("BLUEPRINT_NO_CALL_EXECUTION_INVALID", (F.coalesce("behavior", F.lit("")) != "tool_call") & (kind != "not_applicable"), "$.metadata.intended_execution_type"),
    ))))
    named = F.transform(tools, lambda x, i: fact("TOOL", at("$.available_tools[", i), x))
    given = F.transform(calls, lambda x, i: fact("ARG", at("$.expected_tool_calls[", i, "].function.arguments"), x["name"], x["arguments"]))
    single = F.when((n == 1) & F.coalesce(c("__kind") != "VOID", F.lit(False)), F.array(fact("RESULT", F.lit("$.expected_tool_result"), c("calls")[0]["name"], c("result"))))
    pairs = F.arrays_zip(F.transform("calls", lambda x: x["name"]).alias("name"), F.transform(listed, lambda v: F.coalesce(F.to_json(v), F.lit("null"))).alias("value"))
    several = F.when((n > 1) & is_list, F.transform(F.slice(pairs, F.lit(1), F.least(n, F.size(listed))), lambda p, i: fact("RESULT", at("$.expected_tool_result[", i), p["name"], p["value"])))
    facts = F.concat(leaks, missing, rest, named, given, F.coalesce(single, several, empty))
    return checked(plans.select("id", facts.alias("facts")), registry, {"ARG": "parameters", "RESULT": "output_schema"})


def raw_schema_issues(raw: DataFrame, schema: str) -> DataFrame:
    """(id, code, path) of raw records (id, raw) against a JSON schema, under the codes of record schemas; a record that is no JSON is SCHEMA_INVALID."""
    found = raw.select("id", F.explode(schema_issues(F.lit(schema), F.col("raw"))).alias("x"))
    codes = F.create_map(*(F.lit(x) for kv in SCHEMA_CODES.items() for x in kv))
    return found.select("id", F.coalesce(codes[F.col("x.code")], F.lit("SCHEMA_INVALID")).alias("code"), F.col("x.path").alias("path"))


def http_issues(registry: DataFrame) -> DataFrame:
    """(tool_id, code): HTTP contracts that don't fit their tools.

    registry has tool_id, parameters (a JSON schema), supported_types, http (null or a struct of auth_type, env_var,
    header, prefix and query_map), credentials (names of variables) and side_effects. Nulls in lists count as none.
    """
    c = F.col
    none = F.array().cast("array<string>")
    real, http = F.coalesce(F.array_contains("supported_types", "real_api"), F.lit(False)), c("http").isNotNull()
    said = lambda name: F.coalesce(c(f"http.{name}"), F.lit("")) != ""
    open_, secret = c("http.auth_type") == "none", F.coalesce(c("http.auth_type") != "none", F.lit(True))
    whole = said("env_var") & said("header")
    wanted = F.coalesce(F.map_keys(F.from_json(F.to_json(F.try_variant_get(F.try_parse_json("parameters"), "$.properties", "variant")), "map<string,variant>")), none)
    mapped = F.coalesce(F.map_keys("http.query_map"), none)
    rules = {
        "REAL_API_HTTP_REQUIRED": real & ~http,
        "UNUSED_HTTP_CONTRACT": ~real & http,
        "HTTP_AUTH_INVALID": http & F.when(open_, c("http.env_var").isNotNull() | c("http.header").isNotNull() | said("prefix")).otherwise(~whole),
        "HTTP_CREDENTIAL_UNDECLARED": http & secret & whole & ~F.array_contains(F.coalesce("credentials", none), F.coalesce("http.env_var", F.lit(""))),
        "HTTP_QUERY_MAP_INCOMPLETE": http & (F.array_sort(mapped) != F.array_sort(wanted)),
        "REAL_API_SIDE_EFFECT_FORBIDDEN": http & F.coalesce("side_effects", F.lit(False)),
    }
    return registry.select("tool_id", F.explode(F.array_compact(F.array(*(F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in rules.items())))).alias("code"))


def repeats(rows: DataFrame, key: str, code: str) -> DataFrame:
    """(file, line, code, message): rows (file, line, key) whose key an earlier place, by file and line, has; the message tells where it was first."""
    place = F.struct("file", "line")
    first = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(place).alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    later = rows.join(first, F.col(key) == F.col("__key")).where(place > F.col("__first"))
    return later.select("file", "line", F.lit(code).alias("code"), F.concat(F.col(key).cast("string"), F.lit(" first at "), "__first.file", F.coalesce(F.concat(F.lit(":"), F.col("__first.line").cast("string")), F.lit(""))).alias("message"))


def publish(rows: DataFrame, issues: DataFrame, path: str) -> DataFrame:
    """rows, written as a set at path and read again; with any issue nothing is written but the issues, all of them, beside it at path.issues.

    Issues are looked at first, so a set is there only if it is whole and clean: Spark moves a job's files when all are
    written. An existing set is refused.
    """
    if not issues.isEmpty():
        issues.write.mode("overwrite").json(f"{path}.issues")
        raise ValueError(f"SET_REFUSED: issues at {path}.issues")
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
