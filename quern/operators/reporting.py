"""Distributions, targets, gates and evaluation metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.jsons import canonical_json, schema_issues
from quern.functions.text import foreign_letters
from quern.operators.quality import argument_signature


def distributions(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(dimension, label, n): counts of each dimension's labels, all in one aggregation; nulls are the label 'null'."""
    each = F.array(*(F.struct(F.lit(k).alias("dimension"), F.coalesce(v.cast("string"), F.lit("null")).alias("label")) for k, v in dimensions.items()))
    return df.select(F.explode(each).alias("d")).groupBy("d.dimension", "d.label").agg(F.count("*").alias("n"))


def against_targets(actual: DataFrame, targets: DataFrame) -> DataFrame:
    """(dimension, label, actual, target, delta, matches): labels of either side; matches holds for a whole dimension."""
    both = actual.withColumnRenamed("n", "actual").join(targets, ["dimension", "label"], "full_outer").na.fill(0, ["actual", "target"])
    delta = both.withColumn("delta", F.col("actual") - F.col("target"))
    hits = delta.groupBy("dimension").agg(F.bool_and(F.col("delta") == 0).alias("matches"))
    return delta.join(hits, "dimension")


def evaluated(df: DataFrame, decision: Column, tools: Column, structure: Column, values: Column, flow: Column, valid: Column) -> DataFrame:
    """df with the five criteria as 0 or 1, their total, exact, and the codes of those that failed.

    Tools and flow need the decision, structure and values need the tools.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    d = yes(decision)
    t = d & yes(tools)
    checks = {"decision": (d, "DECISION_INCORRECT"), "tool_or_order": (t, "TOOL_SELECTION_OR_ORDER_INCORRECT"), "names_types": (t & yes(structure), "ARGUMENT_NAMES_OR_TYPES_INCORRECT"), "values": (t & yes(values), "ARGUMENT_VALUES_INCORRECT"), "flow": (d & yes(flow), "FLOW_OR_FINAL_BEHAVIOR_INCORRECT"), "schema_valid": (yes(valid), "PREDICTION_SCHEMA_INVALID")}
    out = df.withColumns({k: v.cast("int") for k, (v, _) in checks.items()} | {"errors": F.array_join(F.array_compact(F.array(*(F.when(~v, F.lit(code)) for v, code in checks.values()))), ",")})
    total = reduce(lambda a, b: a + b, (F.col(k) for k in list(checks)[:5]))
    return out.withColumn("total", total).withColumn("exact", ((F.col("total") == 5) & (F.col("schema_valid") == 1)).cast("int"))


def same_calls(expected: Column, predicted: Column, parallel: Column) -> Column:
    """Equality of call lists: as multisets where they are parallel, in order elsewhere."""
    return F.when(parallel, F.array_sort(expected) == F.array_sort(predicted)).otherwise(expected == predicted)


CALLS = "array<struct<name:string,arguments:string>>"


def run_benchmark(gold: DataFrame, predictions: DataFrame, registry: DataFrame, judgments: DataFrame) -> DataFrame:
    """Each gold row (id, category, tags, decision, calls, missing) against its prediction, with the columns of evaluated() and missing_prediction.

    predictions (id, decision, calls, response, missing, flow_valid, execution_status) may lack gold rows; repeated ids
    on either side and predictions for unknown ones are refused. registry (name, parameters) has the schemas of
    arguments, judgments (id, passed) the verdicts on answers without a call.
    """
    for df, name in ((gold, "gold"), (predictions, "predictions")):
        if not df.groupBy("id").count().where("count > 1").isEmpty():
            raise ValueError(f"BENCHMARK_REFUSED: repeated ids in {name}")
    if not predictions.join(gold, "id", "left_anti").isEmpty():
        raise ValueError("BENCHMARK_REFUSED: predictions for unknown ids")

    def facts(df: DataFrame) -> DataFrame:
        each = df.select("id", F.posexplode_outer("calls").alias("i", "c")).where("i IS NOT NULL").select("id", "i", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"))
        return each.select("*", F.concat_ws("|", "name", argument_signature(F.col("arguments"))).alias("shape"), F.concat_ws("|", "name", canonical_json("arguments")).alias("whole"))

    lists = lambda prefix: F.array_sort(F.collect_list(F.struct("i", "name", "shape", "whole"))).alias(prefix)  # noqa: E731  bounded by a row's calls
    expected = facts(gold).groupBy("id").agg(lists("e"))
    told = facts(predictions).join(registry.select("name", "parameters"), "name", "left").withColumn("x", F.when(F.col("parameters").isNotNull(), F.transform(schema_issues("parameters", "arguments"), lambda x: x["code"])))
    structural = F.col("x").isNull() | F.arrays_overlap("x", F.array(*map(F.lit, ("REQUIRED", "TYPE", "ADDITIONAL"))))
    predicted = told.groupBy("id").agg(lists("p"), F.bool_or(structural).alias("misshaped"), F.bool_or(F.col("x").isNull() | (F.size("x") > 0)).alias("invalid"))
    given = predictions.select("id", F.lit(True).alias("given"), F.col("decision").alias("said"), "response", F.col("missing").alias("asked"), "flow_valid", "execution_status")
    df = gold.join(given, "id", "left").join(expected, "id", "left").join(predicted, "id", "left").join(judgments.select("id", "passed"), "id", "left")
    none = F.array().cast("array<string>")
    part = lambda side, field: F.coalesce(F.transform(side, lambda c: c[field]), none)
    parallel = F.coalesce(F.array_contains("tags", "parallel_tool"), F.lit(False))
    agree = lambda field: same_calls(part("e", field), part("p", field), parallel)
    calls, names = F.coalesce(F.size("p"), F.lit(0)) > 0, lambda c: F.array_sort(F.array_distinct(F.coalesce(c, none)))
    answered = F.coalesce(F.trim("response") != "", F.lit(False)) & F.coalesce("passed", F.lit(False))
    flow = F.when(F.col("decision") == "tool_call", calls & F.col("response").isNull() & F.coalesce("flow_valid", F.lit(True))).when(calls, False).when((F.col("decision") == "request_information") & (names(F.col("asked")) != names(F.col("missing"))), False).otherwise(answered)
    fine = lambda c: ~F.coalesce(c, F.lit(False))
    out = evaluated(df, F.col("said") == F.col("decision"), agree("name"), agree("shape") & fine(F.col("misshaped")), agree("whole"), flow, fine(F.col("invalid")))
    return out.withColumns({"missing_prediction": F.col("given").isNull(), "executed": F.when(F.col("execution_status").isNotNull(), F.col("execution_status") == "passed")})


def metrics(results: DataFrame, group: str) -> DataFrame:
    """Means over all rows (group '*') and by group, from one pass; the execution mean is over rows that have one."""
    keyed = results.select(F.explode(F.array(F.lit("*"), F.col(group).cast("string"))).alias("group"), "exact", "total", "executed")
    return keyed.groupBy("group").agg(F.count("*").alias("examples"), F.avg("exact").alias("exact_mean"), F.avg("total").alias("total_mean"), F.avg(F.col("executed").cast("double")).alias("executed_mean"))


def judgment_passes(verdict: Column, least_score: Column, severe: Column) -> Column:
    return (verdict == "pass") & (least_score >= 4) & ~severe


SEVERE = ("critical", "major")


def judgment_valid(scores: Column, verdict: Column, severities: Column, text: Column) -> Column:
    """Whether a judgment is well formed: whole scores from 1 to 5, known severities, Latin text, and a verdict that its own scores and issues bear.

    scores is a map of names to JSON text, as a judge writes them.
    """
    whole = F.forall(F.map_values(scores), lambda x: x.rlike("^[1-5]$"))
    known = F.forall(severities, lambda x: x.isin(*SEVERE, "minor"))
    clash = (verdict == "pass") & (F.exists(F.map_values(scores), lambda x: x.try_cast("int") < 4) | F.exists(severities, lambda x: x.isin(*SEVERE)))
    return F.coalesce(whole & known & verdict.isin("pass", "revise", "reject") & (foreign_letters(text) == 0) & ~clash, F.lit(False))


def severity_counts(issues: DataFrame) -> DataFrame:
    """(severity, n), and whether the report is valid, which it is without an error."""
    counts = issues.groupBy("severity").agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(issues.agg((F.count_if(F.col("severity") == "error") == 0).alias("valid"))))  # one row
