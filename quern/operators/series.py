"""Sparse time series by key: range searches with extremes, comparisons between dates, gaps and overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_search(df: DataFrame, key: str, day: str, value: str, start: str, end: str) -> DataFrame:
    """Per key the rows between two days, both included, with the highest and lowest value; the earliest day wins ties.

    The extremes are structs under min, so they combine before the shuffle and need no window over a hot key.
    """
    inside = df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    out = inside.groupBy(key).agg(F.count("*").alias("rows"), F.min(F.struct((-F.col(value)).alias("v"), F.col(day).alias("d"))).alias("hi"), F.min(F.struct(F.col(value).alias("v"), F.col(day).alias("d"))).alias("lo"))
    return out.select(key, "rows", (-F.col("hi.v")).alias("highest"), F.col("hi.d").alias("highest_day"), F.col("lo.v").alias("lowest"), F.col("lo.d").alias("lowest_day"))


def covered(asked: DataFrame, df: DataFrame, key: str, day: str, release: str) -> DataFrame:
    """asked (key, start, end, ...) with status, the number of rows in the range, and release_id, the releases of its first and last day.

    status is range_error for a range that ends before it starts, coverage_error for one that leaves the days that df
    has in all, else covered. Releases are taken by day, as their names have no order.
    """
    ends = df.agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    known = asked.crossJoin(F.broadcast(ends))  # one row
    status = F.when(F.col("start") > F.col("end"), "range_error").when(F.coalesce((F.col("start") < F.col("__lo")) | (F.col("end") > F.col("__hi")), F.lit(True)), "coverage_error").otherwise("covered")
    known = known.withColumn("status", status).drop("__lo", "__hi")
    rows = df.select(F.col(key).alias("__key"), F.col(day).alias("__day"), F.col(release).alias("__release"))
    inside = (F.col(key) == F.col("__key")) & F.col("__day").between(F.col("start"), F.col("end")) & (F.col("status") == "covered")
    first, last = F.min_by("__release", "__day"), F.max_by("__release", "__day")
    return known.join(rows, inside, "left").groupBy(*known.columns).agg(F.count("__day").alias("rows"), F.concat_ws("-", first, last).alias("release_id")).withColumn("release_id", F.nullif("release_id", F.lit("")))


def change(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Per key the first and last value by day, their difference and percentage, rounded half to even to 4 and 2 digits; null for one day."""
    ends = df.groupBy(key).agg(F.min(F.struct(day, value)).alias("a"), F.max(F.struct(day, value)).alias("b"), F.count_distinct(day).alias("days"))
    a, b = F.col(f"a.{value}"), F.col(f"b.{value}")
    several = F.col("days") > 1
    return ends.select(key, a.alias("opening"), b.alias("closing"), F.when(several, F.bround(b - a, 4)).alias("change"), F.when(several & (a != 0), F.bround((b - a) * 100 / a, 2)).alias("change_percent"))


def missing_days(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, day): days without a row between a key's first and last one."""
    known = df.select(key, F.col(day).alias("day")).distinct()
    spans = known.groupBy(key).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    return spans.select(key, F.explode(F.sequence("lo", "hi")).alias("day")).join(known, [key, "day"], "left_anti")


def looked_up(requests: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """requests with what table has for them and status: found, lookup_error (no row) or snapshot_error (several)."""
    counted = table.groupBy(*on).agg(F.count("*").alias("__n"), *(F.first(c).alias(c) for c in table.columns if c not in on))
    status = F.when(F.col("__n").isNull(), "lookup_error").when(F.col("__n") > 1, "snapshot_error").otherwise("found")
    return requests.join(counted, on, "left").withColumn("status", status).drop("__n")


def overlaps(df: DataFrame, key: str, id_col: str, start: Column, minutes: int) -> DataFrame:
    """(id, conflict_with): for slots of `minutes` that begin at start, the earliest other slot of the key that it overlaps and that began before it.

    A slot is joined with those that begin in its own or the previous stretch of that length, so the join is on
    equal keys and the half-open test decides.
    """
    size = minutes * 60
    slots = df.select(F.col(key).alias("k"), F.col(id_col).alias("id"), F.unix_micros(start.cast("timestamp")).alias("at")).withColumn("stretch", F.floor(F.col("at") / (size * 1_000_000)))
    earlier = slots.select("k", F.col("id").alias("other"), F.col("at").alias("began"), F.explode(F.array("stretch", F.col("stretch") + 1)).alias("stretch"))
    clash = slots.join(earlier, ["k", "stretch"]).where((F.col("began") < F.col("at")) & (F.col("at") < F.col("began") + size * 1_000_000))
    return clash.groupBy("id").agg(F.min(F.struct("began", "other")).alias("m")).select("id", F.col("m.other").alias("conflict_with"))
