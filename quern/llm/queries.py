"""The queries of this subpackage, over whole tables and whole texts, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import audio, best_fit, bpe, collocations, packing, parity_join, perplexity, pii, quality_rules, site_lines, substring, toxicity, vector_codes
from quern.llm.common import table

#: The rank file of op9; a path is a parameter of the operator.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: The tokenizer of op13.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.spans(docs, pii.fit(docs))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.batches(table(spark, sf_dir, "documents"), WORD_BPE)
    each = out.select("bucket_tokens", "batch", F.posexplode(F.arrays_zip("doc_id", "chunk", "n_tokens", "ids")).alias("slot", "x"))
    return each.select("x.doc_id", "x.chunk", "x.n_tokens", "bucket_tokens", "batch", F.col("slot").cast("long").alias("slot"), F.crc32("x.ids").alias("ids_crc32"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = perplexity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep_text=False)
    return out.select("doc_id", "lang", F.col("__n_chars").alias("n_chars"), F.exp("__log_ppl").alias("perplexity"), F.exp("__limit").alias("max_perplexity"), F.col("__kept").alias("kept"))


def op6_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = site_lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.digests(table(spark, sf_dir, "documents"))


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.strip(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS)


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.group(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), WORD_BPE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_perplexity": op5_perplexity,
    "op6_site_lines": op6_site_lines,
    "op7_media_columns": op7_media_columns,
    "op8_fm_index": op8_fm_index,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_parity_join": op10_parity_join,
    "op11_vector_codes": op11_vector_codes,
    "op12_collocations": op12_collocations,
    "op13_dominance_packing": op13_dominance_packing,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op6_site_lines": site_lines.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_collocations": collocations.ORACLE,
}
