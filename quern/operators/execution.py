"""Tool calls run in tasks: arguments are checked, functions dispatched by mode and name, outcomes normalized."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.jsons import canonical, canonical_json, violations

OUTCOME = T.StructType([T.StructField(c, T.StringType()) for c in ("status", "result", "error")])
Functions = dict[str, Callable[[dict], Any]]


def run_one(functions: Functions, name: str, arguments: str, parameters: str | None, output: str | None) -> tuple[str, str | None, str | None]:
    """Status, result and error of a call; an exception never leaves the task."""
    if parameters is None:
        return "failed", None, "function_not_in_registry"
    try:
        given = json.loads(arguments)
    except (TypeError, ValueError):
        return "failed", None, "arguments_invalid"
    if violations(json.loads(parameters), given):
        return "failed", None, "arguments_invalid"
    if name not in functions:
        return "failed", None, "local_function_not_found"
    try:
        result = functions[name](given)
    except TimeoutError:
        return "timeout", None, "timeout"
    except Exception as e:  # noqa: BLE001  an outcome, whatever it is
        return "failed", None, type(e).__name__
    if result is None or result in ([], {}):
        return "empty_result", canonical(result), None
    if output and violations(json.loads(output), result):
        return "invalid_result", canonical(result), "output_invalid"
    return "passed", canonical(result), None


def execute(calls: DataFrame, registry: DataFrame, functions: Functions) -> DataFrame:
    """calls (name, arguments, ...) with outcome: status, result and error of each, in its own row's task."""

    @F.pandas_udf(OUTCOME)
    def run(name: pd.Series, arguments: pd.Series, parameters: pd.Series, output: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([run_one(functions, *x) for x in zip(name, arguments, parameters, output, strict=True)], columns=OUTCOME.names)

    met = calls.join(registry.select("name", "parameters", "output_schema"), "name", "left")
    return met.withColumn("outcome", run("name", "arguments", "parameters", "output_schema")).drop("parameters", "output_schema")


def from_fixtures(calls: DataFrame, fixtures: DataFrame) -> DataFrame:
    """calls with the result that fixtures (function_name, arguments, result) hold for the same function and arguments."""
    own = fixtures.select(F.col("function_name").alias("name"), canonical_json("arguments").alias("__args"), F.col("result"))
    found = calls.withColumn("__args", canonical_json("arguments")).join(own, ["name", "__args"], "left").drop("__args")
    return found.withColumn("status", F.when(F.col("result").isNull(), "failed").otherwise("passed"))


def record_status(outcomes: DataFrame) -> DataFrame:
    """(id, status): the status of a record's first call, by place, that didn't pass; passed if all did."""
    bad = F.min(F.when(F.col("status") != "passed", F.struct("place", "status")))
    return outcomes.groupBy("id").agg(F.coalesce(bad["status"], F.lit("passed")).alias("status"))


#: Functions that need no table.
ARITHMETIC: Functions = {"utility_add": lambda a: {"result": a["left"] + a["right"]}, "utility_multiply": lambda a: {"result": a["left"] * a["right"]}}
