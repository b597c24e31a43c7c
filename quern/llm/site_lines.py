"""Boilerplate lines by their frequency within a site, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import durable, fresh, join_small

#: A line on more than this share of its host's pages is boilerplate, if it is on so many pages at least.
RATIO, LEAST = 0.1, 3


def is_line(x: Column) -> Column:
    return x.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(host, lines): hashes of each host's boilerplate lines.

    A page has at most so many lines, so a host has at most its mean lines a page / ratio of them, however many
    pages it has. Counts are combined before the shuffle, so a line on every page of a hot host costs a row a task.
    """
    keys = F.transform(F.array_distinct(F.filter(F.split(text_col, "\n"), is_line)), lambda x: F.xxhash64(x))
    host = F.col(host_col).alias("host")
    counts = pages.where(F.col(text_col).isNotNull()).select(host, F.explode(keys).alias("line")).groupBy("host", "line").count()
    totals = durable(pages.groupBy(host).agg(F.count("*").alias("pages")), "hosts")
    common = join_small(durable(counts.where(F.col("count") >= least), "lines"), totals, "host", "inner").where(F.col("count") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """pages with boilerplate lines taken out of their texts, and two more columns, __n_lines and __n_dropped.

    Lines are split at \\n; those without a word (blank ones) are kept and not counted. A null text stays null and
    counts as a page; null hosts are one host; repeated rows are pages of their own; an empty table gives no rows.
    Other columns pass through, whatever their names, but for those named as the two, which are replaced.
    """
    passed = [c for c in pages.columns if c not in ("__n_lines", "__n_dropped")]
    lines, kept, every = (fresh(pages, c) for c in ("lines", "kept", "every"))
    found = durable(boilerplate(pages, host_col, text_col, ratio, least), "boilerplate").withColumnsRenamed({"lines": lines, "host": host_col})
    split = F.split(text_col, "\n")
    both = join_small(pages.select(passed), found, host_col).withColumn(every, split)
    some = F.filter(every, lambda x: ~(is_line(x) & F.array_contains(lines, F.xxhash64(x))))
    both = both.withColumn(kept, F.when(F.col(lines).isNotNull(), some).otherwise(F.col(every)))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    own = [F.array_join(kept, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in passed]
    return both.select(*own, count(F.size(F.filter(every, is_line))).alias("__n_lines"), count(F.size(every) - F.size(kept)).alias("__n_dropped"))


ORACLE = f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
n AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (
  SELECT l.source, line FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY l.source, line, pages HAVING count(DISTINCT doc_id) >= {LEAST} AND count(DISTINCT doc_id) > {RATIO} * pages),
k AS (SELECT l.*, b.line IS NULL AS stays FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line)
SELECT doc_id, CAST(count_if(regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS BIGINT) AS n_lines, CAST(count_if(NOT stays) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""
