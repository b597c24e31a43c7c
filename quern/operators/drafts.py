"""Drafts: briefs from plans, messages from language plans, status resets and history."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import exact_hash
from quern.functions.jsons import mapped, pruned
from quern.functions.text import MARKER_STEMS, MARKER_WORDS, foreign_letters, markers, numbers, raw_timestamp
from quern.functions.versions import first_failure
from quern.sources.schemas import GATES, MESSAGE

#: Keys that stay inside, at any depth.
INTERNAL = frozenset({
    "data_version",
    "execution_type",
    "fixture_id",
    "intended_execution_type",
    "is_synthetic",
    "provenance",
    "record_id",
    "source",
    "source_id",
    "source_version",
    "synthetic",
})
_MARKED = re.compile(r"(?<![^\W_])(?:" + "|".join([*MARKER_WORDS, *(stem + r"\w*" for stem in MARKER_STEMS)]) + r")(?![^\W_])", re.IGNORECASE)


def _told(value: Any) -> Any:
    """A copy without internal keys, and without texts that name the machinery; a marked text alone gives null."""
    copy = pruned([value], INTERNAL)
    nodes = [copy]
    for node in nodes:
        inner = list(node.items() if isinstance(node, dict) else enumerate(node))
        marked = [k for k, v in inner if isinstance(v, str) and _MARKED.search(v)]
        for k in reversed(marked):
            del node[k]
        nodes += [v for _, v in inner if isinstance(v, (dict, list))]
    return copy[0] if copy else None


def _machine(content: Any) -> Any:
    """content without its words: the query, the response, and what describes tools and their parameters."""
    if not isinstance(content, dict):
        return content
    kept = {k: v for k, v in content.items() if k not in ("query", "response")}
    tools = [{k: pruned(v, frozenset({"description"})) if k == "parameters" else v for k, v in t.items() if k != "description"} if isinstance(t, dict) else t for t in kept.get("tools") or []]
    return kept | {"tools": tools} if "tools" in kept else kept


visible_facts = mapped(_told)
machine_part = mapped(_machine)


def machine_fingerprint(content: Column) -> Column:
    """Digest of what localization may not change."""
    return exact_hash(machine_part(content))


def briefs(plans: DataFrame) -> DataFrame:
    """What a writer may see of plans (id, user_goal, main_category, expected_behavior, missing_parameters, expected_tool_result)."""
    turns = F.when(F.col("main_category") == "multi_turn", 2).otherwise(1)
    return plans.select("id", "user_goal", "expected_behavior", "missing_parameters", turns.alias("user_message_count"), visible_facts("expected_tool_result").alias("facts"))


def plan_verdict(user_messages: Column, multi_turn: Column, asks: Column, between: Column, final: Column) -> Column:
    """The first check that a language plan fails, or 'passed'.

    user_messages is an array of text; between, the assistant's text between two turns, and final may be null. asks
    says whether a plan of two turns has to ask for something between them.
    """
    spoken = F.concat_ws("\n", user_messages, between, final)
    said = lambda x: F.coalesce(F.trim(x) != "", F.lit(False))
    lower = F.lower(spoken)
    return first_failure({
        "message_count": (F.size(user_messages) == F.when(multi_turn, 2).otherwise(1)) & F.forall(user_messages, said),
        "intermediate": F.when(multi_turn, said(between)).otherwise(between.isNull()),
        "clarification": ~multi_turn | ~asks | between.contains("?"),
        "final": said(final),
        "script": foreign_letters(spoken) == 0,
        "think_tag": ~(lower.contains("<think") | lower.contains("</think")),
        "timestamp": ~raw_timestamp(spoken),
        "markdown": ~(spoken.contains("**") | spoken.contains("`")),
        "marker": F.size(markers(spoken)) == 0,
    })


def messages(user: Column, clarification: Column, calls: Column, results: Column, sequential: Column, final: Column) -> Column:
    """Messages of a candidate: user turns with a clarification between, calls with their results, and the final text.

    calls is array<struct<name,arguments>>, results array<string> in the same order. Sequential calls alternate with
    their results; parallel ones share a message.
    """
    say = lambda role, text: F.from_json(F.to_json(F.struct(role.alias("role"), text.alias("content"))), MESSAGE)
    ident = lambda i: F.format_string("call_%03d", i + 1)
    call = lambda c, i: F.struct(ident(i).alias("id"), F.lit("function").alias("type"), c.alias("function"))
    ask = lambda these: F.struct(F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), these.alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("string").alias("name"))
    nothing = F.lit(None).cast(MESSAGE)["tool_calls"]
    tell = lambda c, i: F.struct(F.lit("tool").alias("role"), F.get(results, i).alias("content"), nothing.alias("tool_calls"), ident(i).alias("tool_call_id"), c["name"].alias("name"))
    first = F.array(say(F.lit("user"), F.get(user, F.lit(0))))
    more = F.when(F.size(user) > 1, F.array(say(F.lit("assistant"), clarification), say(F.lit("user"), F.get(user, F.lit(1)))))
    each = F.when(sequential, F.flatten(F.transform(calls, lambda c, i: F.array(ask(F.array(call(c, i))), tell(c, i))))).otherwise(F.concat(F.array(ask(F.transform(calls, call))), F.transform(calls, tell)))
    none = F.filter(first, lambda m: F.lit(False))
    return F.concat(first, F.coalesce(more, none), F.coalesce(F.when(F.size(calls) > 0, each), none), F.coalesce(F.when(final.isNotNull(), F.array(say(F.lit("assistant"), final))), none))


def append_event(metadata: Column, action: str, timestamp: Column, actor: str, details: Column) -> Column:
    """metadata with one more event at the end of its history."""
    event = F.struct(F.lit(action).alias("action"), timestamp.alias("timestamp"), F.lit(actor).alias("actor_id"), details.alias("details"), F.lit(None).cast("string").alias("from_execution_type"), F.lit(None).cast("string").alias("to_execution_type"))
    history = F.coalesce(metadata["provenance"]["transformation_history"], F.filter(F.array(event), lambda e: F.lit(False)))
    return metadata.withField("provenance.transformation_history", F.array_append(history, event))


def sanitized(records: DataFrame, timestamp: str) -> DataFrame:
    """Drafts whose claims of validation and review are replaced; the change is an event in their history."""
    reset = F.col("metadata").withField("validation", F.struct(*(F.lit("not_run").alias(g) for g in GATES))).withField("review.status", F.lit("needs_revision"))
    return records.withColumn("metadata", append_event(reset, "sanitized", F.lit(timestamp), "system", F.lit("provider claims replaced")))


def response_selection(language: Column, result: Column, validated: Column, answer: Column, verified: Column, method: Column) -> Column:
    """(method, reason) by which a final response is made, and why none is: the result's own words, or an answer that the source had.

    A source answer with a number that the result lacks is in conflict with it, so the result is told instead.
    """
    adapted, told = "source_answer_adaptation", "tool_result_regeneration"
    has = F.coalesce(F.trim(answer) != "", F.lit(False))
    sure = has & F.coalesce(verified, F.lit(False))
    usable = result.isNotNull() & F.coalesce(validated, F.lit(False))
    conflict = has & (F.size(F.array_except(numbers(answer), numbers(F.regexp_replace(result, r'"[^"]*"\s*:', " ")))) > 0)
    wanted = F.when(conflict, told).otherwise(F.coalesce(method, F.lit(told)))
    reason = (
        F.when(F.coalesce(language != "tr", F.lit(True)), "language")
        .when(~usable & ~sure, "nothing_verifiable")
        .when(~usable & (F.coalesce(method, F.lit("")) != adapted), "adaptation_required")
        .when(~usable, "human_verification")
        .when((wanted == adapted) & ~sure, "answer_not_verified")
    )
    chosen = F.when(reason.isNull(), wanted).when(reason == "human_verification", adapted)
    return F.struct(chosen.alias("method"), reason.alias("reason"))


def grounded(response: Column, request: Column, result: Column) -> Column:
    """Whether every number of a response is in the request or among the result's values."""
    allowed = F.array_union(numbers(request), numbers(F.regexp_replace(F.coalesce(result, F.lit("")), r'"[^"]*"\s*:', " ")))
    return F.size(F.array_except(numbers(response), allowed)) == 0
