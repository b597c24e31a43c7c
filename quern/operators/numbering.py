"""Numbers for ordered rows without a window over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.sources.tables import durable


def numbered(df: DataFrame, order: str, by: list[str] | None = None, name: str = "number") -> DataFrame:
    """df with the 1-based place of each row in ascending order, within by if given (nulls are a group of their own).

    Rows are dealt to ranges and sorted there, so an even number of them is in each task whatever the values are; a
    row's place is that in its range and the sizes of the ranges before. Rows that tie are numbered in no fixed order.
    """
    by, spark = by or [], df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *by, order).sortWithinPartitions(*by, order)
    placed = durable(dealt.withColumn("__at", F.monotonically_increasing_id()), "ordered")  # written, so that all looks agree
    placed = placed.withColumns({"__part": F.shiftright("__at", 33), "__own": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__part").count()
    starts = sizes.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))  # a row a range
    out = placed.join(F.broadcast(starts), "__part").withColumn("__place", F.col("__start") + F.col("__own"))
    if not by:
        return out.withColumn(name, (F.col("__place") + 1).cast("long")).drop("__at", "__part", "__own", "__start", "__place")
    keys = {c: f"__k{i}" for i, c in enumerate(by)}
    firsts = durable(out.groupBy(*by).agg(F.min("__place").alias("__first")), "firsts").withColumnsRenamed(keys)
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()))
    return out.join(firsts, same).withColumn(name, (F.col("__place") - F.col("__first") + 1).cast("long")).drop("__at", "__part", "__own", "__start", "__place", "__first", *keys.values())


def shard_plan(df: DataFrame, order: str, size: int) -> DataFrame:
    """(shard, first, last, rows): contiguous ranges of `size` rows in order; first and last are 0-based and half-open."""
    place = F.col("number") - 1
    plan = numbered(df.select(order), order).groupBy(F.floor(place / size).alias("shard"))
    return plan.agg(F.min(place).alias("first"), (F.max(place) + 1).alias("last"), F.count("*").alias("rows"))


def identifiers(df: DataFrame, order: str, code: Column, start: int = 1, kind: str = "tctr", limited: bool = True) -> DataFrame:
    """df with record ids that count on from start within each code; with a limit those beyond it are null."""
    from quern.functions.hashing import record_id

    return numbered(df.withColumn("__code", code), order, ["__code"]).withColumn("record_id", record_id(F.col("__code"), F.col("number") + start - 1, kind, limited)).drop("__code")
