"""Conversations: texts, categories, flow rules and the training projection, from one row a message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import markers


def by_conversation(turns: DataFrame) -> DataFrame:
    """(conv_id, messages): a conversation's messages in order of turn; bounded by the conversation."""
    message = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("messages"))


def said_by(role: str) -> Column:
    return F.filter("messages", lambda m: m["role"] == role)


def query_text(convs: DataFrame) -> DataFrame:
    """(conv_id, query): the user's texts joined by newlines."""
    return convs.select("conv_id", F.array_join(F.transform(said_by("user"), lambda m: m["text"]), "\n").alias("query"))


def category(user_turns: Column, calls: Column, decision: Column) -> Column:
    """A conversation's main category by priority; null where nothing applies."""
    return F.when(calls >= 2, "multi_tool").when(user_turns > 1, "multi_turn").when(decision == "request_information", "missing_parameter").when(decision.isin("direct_answer", "cannot_answer"), "no_tool").when(calls == 1, "single_tool")


def flow_issues(convs: DataFrame) -> DataFrame:
    """(conv_id, code): what is wrong with the order of roles, texts and turns; one pass, one row an issue."""
    m, last = F.col("messages"), F.element_at("messages", -1)
    pairs = F.zip_with(F.slice("messages", 1, F.size("messages") - 1), F.slice("messages", 2, F.size("messages")), lambda a, b: F.struct(a["role"].alias("a"), b["role"].alias("b"), (b["turn"] - a["turn"]).alias("gap")))
    some = lambda test: F.exists(m, test)
    rules = {
        "NO_USER_MESSAGE": ~some(lambda x: x["role"] == "user"),
        "FINAL_BEHAVIOR_INVALID": last["role"] != "assistant",
        "EMPTY_MESSAGE": some(lambda x: F.trim(x["text"]) == ""),
        "ROLE_REPEATED": F.exists(pairs, lambda p: p["a"] == p["b"]),
        "SYSTEM_NOT_FIRST": F.exists(F.slice(m, 2, F.size(m)), lambda x: x["role"] == "system"),
        "TURN_GAP": F.exists(pairs, lambda p: p["gap"] != 1),
        "NATURAL_TEXT_INTERNAL_MARKER": F.size(markers(F.array_join(F.transform(m, lambda x: x["text"]), "\n"))) > 0,
    }
    found = F.array_compact(F.array(*(F.when(test, F.lit(code)) for code, test in rules.items())))
    return convs.select("conv_id", F.explode(found).alias("code"))


def training_projection(convs: DataFrame) -> DataFrame:
    """(conv_id, messages): conversations as lines of role and text, for those without markers."""
    line = F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n")
    return convs.select("conv_id", line.alias("messages")).where(F.size(markers(F.col("messages"))) == 0)
