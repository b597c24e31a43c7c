"""Length buckets with the least padding, found on the global histogram, and batches within a token budget."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.best_fit import pieces
from quern.llm.common import BROADCAST_ROWS, durable, words

#: Longer texts are cut into sequences of MAX_LEN tokens; lengths are padded to multiples of GRAIN, so the
#: histogram has MAX_LEN / GRAIN cells however large the corpus is.
MAX_LEN, GRAIN = 2048, 8
#: Buckets at most, and padded tokens of a batch at most.
BUCKETS, BUDGET = 16, 65_536
#: The id that fills a sequence up to its bucket's bound.
PAD = 0
#: Sequences that one window numbers, on average.
SHARD_ROWS = 200_000


def best_bounds(counts: Sequence[int], k: int) -> list[int]:
    """Upper bounds (cells, 1-based) of at most k buckets that cover all cells with a count, at the least padding.

    counts[i] is the number of sequences of i + 1 cells; a sequence is padded to its bucket's bound. Exact dynamic
    programme over (buckets, last cell); of equally good solutions that with fewer buckets is taken.
    """
    n = np.trim_zeros(np.asarray(counts, np.int64), "b")
    if not len(n):
        return []
    total = np.concatenate([[0], np.cumsum(n)])
    cells = np.arange(1, len(n) + 1)
    cost = (total[1:][:, None] - total[:-1][None, :]) * cells[:, None].astype(np.float64)  # [last, cells before first]
    cost[np.triu_indices(len(n), 1)] = np.inf
    best, back = [cost[:, 0]], []
    for _ in range(1, min(k, len(n))):
        before = np.concatenate([[np.inf], best[-1][:-1]])
        options = before[None, :] + cost
        back.append(options.argmin(axis=1))
        best.append(options.min(axis=1))
    used = int(np.argmin([b[-1] for b in best]))
    bounds, last = [], len(n)
    for step in range(used, -1, -1):
        bounds.append(last)
        last = int(back[step - 1][last - 1]) if step else 0
    return bounds[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET, max_len: int = MAX_LEN, grain: int = GRAIN) -> DataFrame:
    """One row a sequence: doc_id, chunk, n_tokens, bucket_tokens (its padded length), batch and slot.

    Tokens are words. Texts over max_len tokens give several sequences; a null or empty text gives one row without
    bucket, batch and slot. batch numbers the batches within a bucket; all but a bucket's last hold
    floor(budget / bucket_tokens) sequences (at least one). Repeated rows are sequences of their own, and sequences that
    tie in all these are in no fixed order; an empty table gives none. Other columns are ignored, whatever their names.
    """
    n = F.size(words(F.col(text_col))).cast("long")
    seqs = docs.select(F.col(id_col).alias("doc_id"), n.alias("n"))
    seqs = seqs.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0)))).alias("chunk"))
    seqs = seqs.select("doc_id", "chunk", F.least(F.col("n") - F.col("chunk") * max_len, F.lit(max_len)).alias("n_tokens"))
    seqs = durable(seqs.withColumn("cell", F.ceil(F.col("n_tokens") / grain).cast("int")), "lengths")
    found = {r["cell"]: r["count"] for r in seqs.groupBy("cell").count().collect()}  # max_len / grain + 1 rows at most
    bounds = best_bounds([found.get(i + 1, 0) for i in range(-(-max_len // grain))], buckets)
    bound = F.array_min(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("cell"))) if bounds else F.lit(None).cast("int")
    shards = max(64, sum(found.values()) // SHARD_ROWS)
    dealt = seqs.withColumn("bound", F.when(F.col("cell") > 0, bound)).withColumn("shard", F.pmod(F.xxhash64("doc_id", "chunk"), F.lit(shards)))
    # Rows are numbered within (bucket, shard); what earlier shards of a bucket hold is added, from buckets x shards counts.
    sizes = dealt.groupBy("bound", "shard").count()
    before = Window.partitionBy("bound").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("bound").alias("bound_"), F.col("shard").alias("shard_"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("bound", "shard").orderBy("doc_id", "chunk", "n_tokens"))
    near = F.broadcast(starts) if (len(bounds) + 1) * shards <= BROADCAST_ROWS else durable(starts, "starts")
    placed = dealt.withColumn("own", own).join(near, F.col("bound").eqNullSafe(F.col("bound_")) & (F.col("shard") == F.col("shard_")), "left")
    place, tokens = F.col("start") + F.col("own") - 1, F.col("bound") * grain
    room = F.greatest(F.floor(F.lit(budget) / tokens), F.lit(1))
    placed = placed.select("doc_id", "chunk", "n_tokens", tokens.cast("long").alias("bucket_tokens"), place.alias("place"), room.alias("room"))
    return placed.select("doc_id", "chunk", "n_tokens", "bucket_tokens", F.when(F.col("bucket_tokens").isNotNull(), F.floor(F.col("place") / F.col("room"))).alias("batch"), F.when(F.col("bucket_tokens").isNotNull(), F.col("place") % F.col("room")).alias("slot"))


def batches(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET, max_len: int = MAX_LEN, grain: int = GRAIN, pad: int = PAD) -> DataFrame:
    """One row a batch, as a trainer reads it: bucket_tokens, batch, and by slot doc_id, chunk, n_tokens and ids.

    Tokens are those of the tokenizer at path, and END after each document; ids are little-endian unsigned 32-bit
    integers, padded to bucket_tokens with pad. All but a bucket's last batch are as full as the budget allows, so a row
    has at most budget tokens (or one sequence). A null or empty text is END alone; texts over max_len tokens are cut into
    several sequences and none is dropped. Sequences of equal length may stand in each other's place; repeated rows,
    empty tables and other columns as in pack(). A sequence's place in its bucket follows from its rank in its length and
    task, and from counts of these, so ids are shuffled once, into their batches.
    """
    rows = durable(pieces(docs, path, id_col, text_col, max_len, True), "sequences")
    sizes = durable(rows.groupBy("part", "length").count(), "sequence-counts")
    found = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # max_len rows at most
    cells = [0] * -(-max_len // grain)
    for n, count in found.items():
        cells[(n - 1) // grain] += count
    bounds, base, before_it = best_bounds(cells, buckets), [], {}
    for n in sorted(found):  # where a length starts in its bucket: after all shorter ones
        bound = next(b for b in bounds if b * grain >= n) * grain
        base.append((n, bound, before_it.get(bound, 0)))
        before_it[bound] = before_it.get(bound, 0) + found[n]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lengths = F.broadcast(rows.sparkSession.createDataFrame(base, "length long, bucket_tokens long, base long"))  # a row a length
    starts = sizes.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).join(lengths, "length")
    starts = durable(starts.select(F.col("part").alias("part_"), F.col("length").alias("length_"), "bucket_tokens", (F.col("base") + F.col("before")).alias("begins")), "sequence-starts")
    near = F.broadcast(starts) if starts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else starts.hint("merge")
    placed = rows.join(near, (F.col("part") == F.col("part_")) & (F.col("length") == F.col("length_"))).withColumn("place", F.col("begins") + F.col("own"))
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket_tokens")), F.lit(1))
    item = F.struct((F.col("place") % room).alias("slot"), "doc_id", F.col("piece").cast("long").alias("chunk"), F.col("length").alias("n_tokens"), "ids")
    own = placed.select("bucket_tokens", F.floor(F.col("place") / room).alias("batch"), item.alias("item")).groupBy("bucket_tokens", "batch").agg(F.array_sort(F.collect_list("item")).alias("rows"))  # bounded by the budget
    filled = F.transform("rows", lambda x: F.rpad(x["ids"], (F.col("bucket_tokens") * 4).cast("int"), F.lit(pad.to_bytes(4, "little"))))
    return own.select("bucket_tokens", "batch", *(F.col(f"rows.{c}").alias(c) for c in ("doc_id", "chunk", "n_tokens")), filled.alias("ids"))
