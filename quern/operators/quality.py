"""Gates of a quality run: judgments with escalation, model comparison, and argument signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import sampled
from quern.functions.jsons import kind_name, kind_of


def judged(records: DataFrame, first: DataFrame, second: DataFrame, rate: float, production: bool) -> DataFrame:
    """(id, escalated, status) from judgments (id, passes): a record that fails or is sampled needs the second judge.

    Only a production run certifies: passed if all judges asked pass, failed if the last one doesn't, else not_run.
    """
    one, two = first.select("id", F.col("passes").alias("p1")), second.select("id", F.col("passes").alias("p2"))
    both = records.select("id").join(one, "id", "left").join(two, "id", "left")
    asked = ~F.coalesce("p1", F.lit(False)) | sampled(F.col("id"), rate)
    status = F.when(F.col("p1").isNull(), "not_run").when(asked & F.col("p2").isNull(), "not_run").when(asked & ~F.col("p2"), "failed").when(F.lit(production) & F.col("p1"), "passed").otherwise("not_run")
    return both.select("id", F.coalesce(asked & F.col("p1").isNotNull(), F.lit(False)).alias("escalated"), status.alias("status"))


def model_summary(scores: DataFrame) -> DataFrame:
    """(model, samples, mean) from rows (model, id, dimension, score): the mean of a model's rounded means by dimension.

    Both means are rounded to four places, exactly and with halves away from zero; scores count with six places.
    """
    half_up = lambda total, n, unit: F.expr(f"CASE WHEN {total} < 0 THEN -1 ELSE 1 END * ((2 * abs({total}) * 10000 + {n} * {unit}) div (2 * {n} * {unit}))")  # noqa: E731  in ten-thousandths
    sums = scores.where("score IS NOT NULL").groupBy("model", "dimension").agg((F.sum(F.col("score").cast("decimal(18,6)")) * 1_000_000).cast("decimal(28,0)").alias("total"), F.count("*").cast("decimal(18,0)").alias("n"))
    means = sums.select("model", half_up("total", "n", 1_000_000).alias("m"))
    whole = means.groupBy("model").agg(F.sum("m").cast("decimal(28,0)").alias("total"), F.count("*").cast("decimal(18,0)").alias("n"))
    sizes = scores.groupBy("model").agg(F.count_distinct("id").alias("samples"))
    return whole.select("model", (half_up("total", "n", 10_000) / 10_000).cast("double").alias("mean")).join(sizes, "model")


def usage(counts: Column) -> Column:
    """Input, output and total tokens from a map of counts under either naming; the total is derived where it lacks."""
    pick = lambda *names: F.coalesce(*(F.try_element_at(counts, F.lit(n)) for n in names))
    a, b = pick("input_tokens", "prompt_tokens"), pick("output_tokens", "completion_tokens")
    return F.struct(a.alias("input"), b.alias("output"), F.coalesce(pick("total_tokens"), a + b).alias("total"))


def argument_signature(arguments: Column) -> Column:
    """Sorted names and JSON types of a call's arguments, as text; null for what is no object."""
    quoted = F.from_json(arguments, "map<string,variant>")
    entries = F.transform(F.map_entries(quoted), lambda e: F.struct(e["key"].alias("key"), kind_of(F.to_json(e["value"])).alias("kind")))  # so each value is parsed once
    kinds = F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(kind_name(e["kind"]), F.lit("null"))))
    return F.array_join(F.array_sort(kinds), ",")


#: What a cheaper model has to reach before it may go first.
RULES = {"samples": 30, "score": 4.0, "score_gap": 0.15, "pass_gap": 1}


def recommendation(sample_size: Column, judged: Column, cheap: dict[str, Column], strong: dict[str, Column]) -> Column:
    """(status, reasons): whether the cheaper of two models may go first, from the summaries of both over the same samples.

    A summary has generation_failed, judge_failed, mean and passes; generation_failed is null where the model is absent.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    gap = strong["mean"] - cheap["mean"]
    scored = cheap["mean"].isNotNull() & strong["mean"].isNotNull()
    found = {
        "cheap_generation_failed": cheap["generation_failed"] > 0,
        "strong_generation_failed": strong["generation_failed"] > 0,
        "no_judge": ~judged,
        "judge_failed": judged & ((cheap["judge_failed"] > 0) | (strong["judge_failed"] > 0)),
        "scores_incomplete": judged & ~scored,
        "score_low": judged & scored & (cheap["mean"] < RULES["score"]),
        "score_gap": judged & scored & (gap > RULES["score_gap"]),
        "not_all_passed": judged & (cheap["passes"] != sample_size),
        "pass_gap": judged & (strong["passes"] - cheap["passes"] > RULES["pass_gap"]),
    }
    reasons = F.array_compact(F.array(*(F.when(yes(v), F.lit(k)) for k, v in found.items())))
    absent = cheap["generation_failed"].isNull() | strong["generation_failed"].isNull()
    early = F.when(sample_size < RULES["samples"], "insufficient_sample").when(absent, "incomplete_model_pair")
    status = F.coalesce(early, F.when(F.size(reasons) == 0, "accepted").otherwise("rejected"))
    return F.struct(status.alias("status"), F.when(early.isNull(), F.array_join(reasons, ",")).otherwise(early).alias("reasons"))
