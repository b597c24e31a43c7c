"""Chains of calls within a record: each call with its actual result, results that feed later arguments, and results against those of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.jsons import same_value

_CALLS = "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"

#: Kinds of execution that need someone's leave, and the error of a record whose calls don't hold.
GUARDED, REAL_API, FAILED_CODE = ("sandbox", "real_api"), "real_api", "quality_execution_failed"


def _calls() -> Column:
    """A record's calls in order: each with the content of the last result that names it, and whether there is one."""
    own = F.flatten(F.transform("messages", lambda m: F.coalesce(F.when(m["role"] == "assistant", m["tool_calls"]), F.array().cast(_CALLS))))
    results = F.filter("messages", lambda m: m["role"] == "tool")
    named = lambda c: F.filter(results, lambda r: r["tool_call_id"] == c["id"])
    return F.transform(own, lambda c: F.struct(c["id"].alias("call"), c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments"), (F.size(named(c)) > 0).alias("answered"), F.try_element_at(named(c), F.lit(-1))["content"].alias("result")))


def _each(records: DataFrame) -> DataFrame:
    """(id, place, c) of all calls. The outer form, as for the plain one Spark asks first whether there are any, and makes all calls again for that."""
    return records.select("id", F.posexplode_outer(_calls()).alias("place", "c")).where("place IS NOT NULL")


def call_refusals(records: DataFrame) -> DataFrame:
    """(id, problem): records (id, messages) that can't say what their calls gave.

    invalid_tool_result where a result's content is no JSON, whichever call it names; else missing_tool_result where a
    call has no result. A record whose messages are null or empty has no calls and no problem; repeated rows are told each.
    """
    results = F.filter("messages", lambda m: m["role"] == "tool")
    invalid = F.exists(results, lambda r: F.try_parse_json(r["content"]).isNull())
    missing = F.exists(_calls(), lambda c: ~c["answered"])
    problem = F.when(invalid, "invalid_tool_result").when(missing, "missing_tool_result")
    return records.select("id", problem.alias("problem")).where("problem IS NOT NULL")


def call_results(records: DataFrame) -> DataFrame:
    """(id, place, call, name, arguments, result): calls of records (id, messages) with what they gave, by place from 0.

    Where results name a call twice, the last one counts. A call without a result has a null; call_refusals() tells
    which records may be used. All is within a row: nothing is shuffled.
    """
    return _each(records).select("id", F.col("place").cast("long").alias("place"), "c.call", "c.name", "c.arguments", "c.result")


def transfers(records: DataFrame, declared: DataFrame) -> DataFrame:
    """(id, source, target, result_key, argument_key, failure) of declared (the first five): where a result should be a later call's argument.

    source and target are places of calls in records (id, messages). failure is null for a transfer that holds, else the
    first of missing_call (a place without a call, or one that doesn't come later), missing_result_key, missing_argument
    and transfer_mismatch; values are compared as JSON. A declaration for an id without a record is missing_call; records
    with repeated ids answer each. Calls travel within their record, so there is one join, by id.
    """
    own = records.select("id", _calls().alias("__calls"))
    met = declared.select("id", "source", "target", "result_key", "argument_key").join(own, "id", "left")
    at = lambda place: F.get("__calls", F.col(place).cast("int"))
    fields = lambda text: F.from_json(text, "map<string,variant>")
    ready = met.select("id", "source", "target", "result_key", "argument_key", (at("source").isNotNull() & at("target").isNotNull() & (F.col("source") < F.col("target"))).alias("__there"), fields(at("source")["result"]).alias("__from"), fields(at("target")["arguments"]).alias("__to"))
    has = lambda m, key: F.coalesce(F.map_contains_key(m, F.col(key)), F.lit(False))
    value = lambda m, key: F.coalesce(F.to_json(F.try_element_at(m, F.col(key))), F.lit("null"))
    failure = (
        F.when(~F.coalesce("__there", F.lit(False)), "missing_call")
        .when(~has("__from", "result_key"), "missing_result_key")
        .when(~has("__to", "argument_key"), "missing_argument")
        .when(~same_value(value("__from", "result_key"), value("__to", "argument_key")), "transfer_mismatch")
    )
    return ready.select("id", "source", "target", "result_key", "argument_key", failure.alias("failure"))


def verified(records: DataFrame, executions: DataFrame) -> DataFrame:
    """(id, place, call, name, status, reason, raised, fixture): calls of records (id, messages) run again, against their recorded results.

    executions has (id, call, status, result, raised, fixture): what a run of each call gave; raised marks a call whose
    run broke off. A passed run whose record has no result, none that is JSON or another one is invalid_result, with the
    reason. A call that executions lack has failed as not_executed; of several runs of a call the least row counts, found
    before the shuffle. Null results of passed runs are JSON nulls.
    """
    own = _each(records).select("id", F.col("place").cast("long").alias("place"), "c.*")
    runs = executions.groupBy("id", "call").agg(F.min(F.struct("status", "result", "raised", "fixture")).alias("r"))
    met = own.join(runs, ["id", "call"], "left").select("id", "place", "call", "name", "answered", F.col("result").alias("recorded"), "r.*", F.col("r").isNotNull().alias("ran"))
    raised = F.coalesce("raised", F.lit(False))
    fine = F.col("ran") & ~raised & (F.col("status") == "passed")
    reason = (
        F.when(~F.col("ran"), "not_executed")
        .when(raised, "exception")
        .when(fine & ~F.col("answered"), "missing_tool_result_message")
        .when(fine & F.try_parse_json("recorded").isNull(), "invalid_tool_result_json")
        .when(fine & ~same_value(F.col("recorded"), F.coalesce("result", F.lit("null"))), "recorded_result_mismatch")
    )
    status = F.when(~F.col("ran") | raised, "failed").when(fine & reason.isNotNull(), "invalid_result").otherwise(F.coalesce("status", F.lit("failed")))
    return met.select("id", "place", "call", "name", status.alias("status"), reason.alias("reason"), (raised | ~F.col("ran")).alias("raised"), "fixture")


def execution_state(records: DataFrame, calls: DataFrame, allowed: bool = False) -> DataFrame:
    """(id, type, status, error_code, fixture_id, gate) of records (id, messages, metadata) from their verified() calls.

    A record without calls is not_applicable and not_called. One whose kind of execution is guarded is not_called, real
    calls only unless allowed. Else it failed if a run broke off, or has the first status that isn't passed; the fixture
    is told where there is one call. gate is the state that validation takes. ids don't repeat (see refusals()).
    """
    wrong = F.min(F.when(F.col("status") != "passed", F.struct("place", "status")))["status"]
    each = calls.groupBy("id").agg(F.count("*").alias("n"), F.bool_or("raised").alias("broken"), wrong.alias("wrong"), F.max("fixture").alias("fixture"))
    met = records.select("id", F.col("metadata.execution.type").alias("kind"), F.size(_calls()).alias("calls")).join(each, "id", "left")
    none = F.coalesce("calls", F.lit(0)) <= 0
    closed = F.col("kind").isin(*GUARDED) & ~((F.col("kind") == REAL_API) & F.lit(allowed))
    status = F.when(none | closed, "not_called").when(F.col("broken"), "failed").otherwise(F.coalesce("wrong", F.lit("passed")))
    out = met.select("id", F.when(none, "not_applicable").otherwise(F.col("kind")).alias("type"), status.alias("status"), F.when(~none & ~closed & (F.col("n") == 1), F.col("fixture")).alias("fixture_id"))
    code = F.when(~F.col("status").isin("passed", "not_called"), FAILED_CODE)
    gate = F.when(F.col("type") == "not_applicable", "not_applicable").when(F.col("status") == "not_called", "not_run").when(F.col("status") == "passed", "passed").otherwise("failed")
    return out.select("id", "type", "status", code.alias("error_code"), "fixture_id", gate.alias("gate"))
