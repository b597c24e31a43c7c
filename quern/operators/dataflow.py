"""The quality run as one dataflow: inputs refused as a whole, gates set from what was found, counts observed on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.operators import calls
from quern.sources.schemas import GATES

#: Sources of records that a run takes.
ACTIVE = ("original_turkish", "turkey_native")


def refusals(records: DataFrame, references: DataFrame, issues: DataFrame) -> DataFrame:
    """(id, problem): why a run of records against references (both id, metadata) may not begin; none if it may.

    issues (id) names records of either side that break a rule. Problems are duplicate_record_id, accepted_record,
    paused_source_type, invalid_record, duplicate_reference_id, unaccepted_reference and id_collision. Both sides meet in
    one grouping by id, whose counts are combined before the shuffle. A null id is an id.
    """
    side = lambda df, reference: df.select("id", F.lit(reference).alias("reference"), F.col("metadata.review.status").alias("status"), F.col("metadata.source_type").alias("source"), F.lit(False).alias("broken"))
    broken = issues.select("id", F.lit(None).cast("boolean").alias("reference"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("source"), F.lit(True).alias("broken"))
    own, other = ~F.col("reference"), F.col("reference")
    accepted = F.coalesce(F.col("status") == "accepted", F.lit(False))
    met = side(records, False).unionByName(side(references, True)).unionByName(broken).groupBy("id").agg(
        F.count_if(own).alias("n"), F.count_if(other).alias("m"), F.count_if("broken").alias("b"), F.count_if(own & accepted).alias("done"),
        F.count_if(own & ~F.coalesce(F.col("source").isin(*ACTIVE), F.lit(False))).alias("paused"), F.count_if(other & ~accepted).alias("open"),
    )
    found = {
        "duplicate_record_id": F.col("n") > 1, "accepted_record": F.col("done") > 0, "paused_source_type": F.col("paused") > 0,
        "invalid_record": (F.col("b") > 0) & (F.col("n") + F.col("m") > 0), "duplicate_reference_id": F.col("m") > 1,
        "unaccepted_reference": F.col("open") > 0, "id_collision": (F.col("n") > 0) & (F.col("m") > 0),
    }
    return met.select("id", F.explode(F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in found.items())))).alias("problem"))


def refuse(found: DataFrame) -> None:
    """ValueError with the first ten of refusals(), if there are any."""
    first = [f"{r['id']}: {r['problem']}" for r in found.orderBy("id", "problem").limit(10).collect()]
    if first:
        raise ValueError("QUALITY_REFUSED: " + ", ".join(first))


def counts(n_references: int) -> list[Column]:
    """The seven counts of a run, over the rows of gated(), to be observed or aggregated."""
    n = F.count("*")
    return [
        n.alias("records_checked"), F.lit(n_references).cast("long").alias("reference_records"), F.floor(n * (n - 1) / 2 + n * n_references).cast("long").alias("pairs_checked"),
        F.count_if(F.col("validation.duplicate") == "failed").alias("duplicate_findings"), F.count_if(F.size("automatic_failures") > 0).alias("records_with_automatic_failures"),
        F.count_if(F.col("validation.semantic") == "passed").alias("records_with_model_pass"), F.count_if(F.col("validation.language") == "not_run").alias("records_pending_human_language_review"),
    ]


def gated(records: DataFrame, executions: DataFrame, judgments: DataFrame, duplicates: DataFrame, allowed: bool = False, observed: Observation | None = None, n_references: int = 0) -> DataFrame:
    """(id, execution, validation, automatic_failures, pending_gates) of records (id, messages, metadata) after a run.

    executions are what verified() takes; judgments (id, status) and duplicates (id, status) set the semantic and the
    duplicate gate, not_run where they lack a record. Of the other gates json and schema have passed, since records with
    issues were refused; tool_call and turn_level apply to records with calls and with several turns; execution comes
    from the results run again; language is a person's. A gate that failed is an automatic failure, but for language;
    one that is not_run is pending. Given an observation, the seven counts are taken as the rows pass, without another
    look. ids don't repeat (see refusals()). A run changes neither texts nor reviews.
    """
    run = calls.execution_state(records, calls.verified(records, executions), allowed)
    status = lambda df, name: df.groupBy("id").agg(F.min("status").alias(name))
    kept = records.select("id", F.col("metadata.main_category").alias("category"))
    met = kept.join(run, "id").join(status(judgments, "semantic"), "id", "left").join(status(duplicates, "duplicate"), "id", "left")
    gates = {
        "json": F.lit("passed"), "schema": F.lit("passed"),
        "tool_call": F.when(F.col("type") == "not_applicable", "not_applicable").otherwise("passed"),
        "execution": F.col("gate"), "semantic": F.coalesce("semantic", F.lit("not_run")),
        "turn_level": F.when(F.col("category") == "multi_turn", "passed").otherwise("not_applicable"),
        "language": F.lit("not_run"), "duplicate": F.coalesce("duplicate", F.lit("not_run")),
    }
    out = met.select("id", F.struct("type", "status", "error_code", "fixture_id").alias("execution"), F.struct(*(gates[g].alias(g) for g in GATES)).alias("validation"))
    named = lambda state, names: F.array_compact(F.array(*(F.when(F.col(f"validation.{g}") == state, F.lit(g)) for g in names)))
    out = out.withColumns({"automatic_failures": named("failed", [g for g in GATES if g != "language"]), "pending_gates": named("not_run", GATES)})
    return out.observe(observed, *counts(n_references)) if observed is not None else out
