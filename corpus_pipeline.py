"""The corpus pipeline: documents through quality, line and near-duplicate filters and redaction, into packed sequences.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next stage's docs. All
but the last return the columns of documents. Null and empty texts are rejected by the first stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import packing, parity_join, perplexity, pii, site_lines
from quern.llm.common import BROADCAST_ROWS, durable, table, unique_path
from quern.llm.queries import WORD_BPE
from quern.sources import tables

#: Words of a shingle and least similarity of near duplicates here.
SHINGLE, NUM, DEN = 5, 80, 100


#: Names a stage's result in the metadata of its first column, which Parquet keeps; the tables that each result is made of.
MARK = "quern.result"
_made_of: dict[str, list[str]] = {}


def _release(spark: SparkSession, docs: DataFrame) -> None:
    """Deletes the tables that docs were made of, if docs are a stage's result that was written and read again.

    A result that hasn't been written still reads its tables, so it, and any other, is left alone.
    """
    owned = _made_of.get(docs.schema[0].metadata.get(MARK, ""))
    if owned:
        folders = {name.rsplit("/", 1)[-1] for name in owned if "/" in name}
        if not any(folders & set(file.split("/")) for file in docs.inputFiles()):
            tables.forget(spark, _made_of.pop(docs.schema[0].metadata[MARK]))


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """work, after the tables of the result that it goes on from are gone; its own stay until its result has been written and read."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _release(spark, docs)
        start, name = len(tables.made), uuid.uuid4().hex
        out = work(spark, docs, sf_dir)
        _made_of[name] = tables.made[start:]
        first = out.schema[0]
        return out.withMetadata(first.name, first.metadata | {MARK: name})

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose perplexity is within their language's limit; labels come from sf_dir."""
    return perplexity.judge(docs, table(spark, sf_dir, "labels")).where("__kept").select(*docs.columns)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines of each source out of its texts; n_chars follows.

    Null texts and sources, repeated rows and empty tables as in site_lines.drop_boilerplate(); a text of boilerplate
    alone becomes empty.
    """
    out = site_lines.drop_boilerplate(docs)
    return out.withColumn("n_chars", F.when(F.col("__n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates: the one with the least doc_id, of rows that repeat it the one with the least digest.

    An empty table gives none. A null doc_id comes after all others. Documents without words are duplicates of nothing, so of these all stay but
    repeated rows. Other columns pass through, and don't tell rows apart.
    """
    # An id of each row's own: its doc_id from the least on, as text, and its text's digest.
    place = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.expr("CAST('9223372036854775808' AS DECIMAL(20,0))")).cast("string"), 20, "0")
    rid = F.concat_ws(":", F.coalesce(place, F.lit("~")), F.coalesce(F.sha2("text", 256), F.lit("")))
    groups = durable(parity_join.group(docs.select(rid.alias("doc_id"), "text"), SHINGLE, NUM, DEN), "groups")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("rid")).distinct()
    near = F.broadcast(kept) if kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else kept
    once = docs.join(near, rid == F.col("rid"), "left_semi")
    return once.dropDuplicates(["doc_id", "text"]) if groups.select("doc_id").distinct().count() < groups.count() else once


@stage
def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks; n_chars follows, and is null for a null text. Repeated rows stay; an empty table gives none."""
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of token ids by length buckets, in place of documents, a row a batch; the rest as in packing.batches()."""
    return packing.batches(docs, WORD_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", redaction),
    ("packing", packed),
]

#: SQL can express neither the perplexity model nor the boosted trees; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder, and deleted once the next one is."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = unique_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.forget(spark, before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
