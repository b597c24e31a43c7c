"""Acceptance, export, freezing and resumable jobs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.operators.numbering import numbered


def export_accepted(records: DataFrame, issues: DataFrame, path: str, columns: list[str] | None = None) -> int:
    """Writes accepted records as JSON lines and returns their number; blocked as a whole if any of them has an issue."""
    accepted = records.where("metadata.review.status = 'accepted'")
    if not accepted.join(issues.select("id").distinct(), "id", "left_semi").isEmpty():
        raise ValueError("EXPORT_BLOCKED: accepted records have issues")
    written = Observation()
    lines = (accepted.select(*columns) if columns else accepted).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    lines.observe(written, F.count("*").alias("n")).write.mode("errorifexists").text(path)
    return written.get["n"]


def shard_digests(records: DataFrame, order: str, line: str, size: int) -> DataFrame:
    """(shard, records, first, last, digest) over stretches of `size` values of order, each digested in order."""
    own = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.sha2(line, 256).alias("h"))))
    shards = records.groupBy(F.floor(F.col(order) / size).alias("shard")).agg(F.count("*").alias("records"), F.min(order).alias("first"), F.max(order).alias("last"), own.alias("own"))
    return shards.withColumn("digest", F.sha2(F.array_join(F.transform("own", lambda x: x["h"]), "\n"), 256)).drop("own")


def freeze(records: DataFrame, contamination: str, order: str, line: str, path: str, size: int = 10_000) -> DataFrame:
    """Writes records and the manifest of their shards; refused if contamination hasn't passed, or records are none or repeat."""
    if contamination != "passed":
        raise ValueError("FREEZE_BLOCKED: contamination check")
    if records.isEmpty() or not records.groupBy(order).count().where("count > 1").isEmpty():
        raise ValueError("FREEZE_BLOCKED: no records, or repeated ids")
    records.select(order, line).write.mode("errorifexists").parquet(f"{path}/records")
    shard_digests(records, order, line, size).write.mode("errorifexists").parquet(f"{path}/manifest")
    return records.sparkSession.read.parquet(f"{path}/manifest")


def verify_freeze(path: str, spark, order: str, line: str, size: int = 10_000) -> DataFrame:
    """Shards that the written records and the manifest don't agree on; none if the freeze holds."""
    now = shard_digests(spark.read.parquet(f"{path}/records"), order, line, size)
    then = spark.read.parquet(f"{path}/manifest")
    return now.exceptAll(then.select(*now.columns)).select("shard").union(then.select(*now.columns).exceptAll(now).select("shard")).distinct()


def job_manifest(rows: DataFrame, order: str, line: str, size: int, dimensions: dict[str, Column], number: str = "number") -> DataFrame:
    """(shard, start, end, digest, distributions) of rows in order, dealt to shards of `size` rows; start and end are 0-based and half-open.

    distributions is JSON: for each dimension its labels with their counts, by name. The digest is over the shard's
    lines in order, so no task sees more than a shard.
    """
    placed = numbered(rows, order, name=number).withColumn("shard", F.floor((F.col(number) - 1) / size))
    own = F.array_sort(F.collect_list(F.struct(F.col(number).alias("o"), F.sha2(line, 256).alias("h"))))  # bounded by the shard
    shards = placed.groupBy("shard").agg(F.min(F.col(number) - 1).alias("start"), F.max(number).alias("end"), own.alias("own"))
    each = F.array(*(F.struct(F.lit(k).alias("d"), F.coalesce(v.cast("string"), F.lit("null")).alias("l")) for k, v in dimensions.items()))
    counts = placed.select("shard", F.explode(each).alias("x")).groupBy("shard", "x.d", "x.l").count().groupBy("shard", "d").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("l", "count")))).alias("m"))
    dists = counts.groupBy("shard").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("d", F.struct(F.map_keys("m").alias("labels"), F.map_values("m").alias("counts"))))))).alias("distributions"))
    return shards.select("shard", "start", "end", F.sha2(F.array_join(F.transform("own", lambda x: x["h"]), "\n"), 256).alias("digest")).join(dists, "shard")


def manifest_problems(then: DataFrame, now: DataFrame) -> DataFrame:
    """(shard, problem): shards of a manifest that are gone, new, moved, or whose lines or labels changed since."""
    b = now.select("shard", *(F.col(c).alias(f"{c}_") for c in ("start", "end", "digest", "distributions")))
    both = then.join(b, "shard", "full_outer")
    problem = F.when(F.col("start").isNull(), "added").when(F.col("start_").isNull(), "gone").when((F.col("start") != F.col("start_")) | (F.col("end") != F.col("end_")), "moved").when(F.col("digest") != F.col("digest_"), "changed").when(F.col("distributions") != F.col("distributions_"), "relabelled")
    return both.select("shard", problem.alias("problem")).where("problem IS NOT NULL")


def job_progress(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """(shard, processed, succeeded, failed, status) from a checkpoint (shard, error): pending, running, failed or completed."""
    counts = done.groupBy("shard").agg(F.count("*").alias("processed"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    both = manifest.select("shard", (F.col("end") - F.col("start")).alias("rows")).join(counts, "shard", "left").na.fill(0, ["processed", "failed"])
    status = F.when(F.col("processed") == 0, "pending").when(F.col("processed") < F.col("rows"), "running").when(F.col("failed") > 0, "failed").otherwise("completed")
    return both.select("shard", "processed", (F.col("processed") - F.col("failed")).alias("succeeded"), "failed", status.alias("status"))


def quality_summary(records: DataFrame, gates: dict[str, Column], references: int) -> DataFrame:
    """Seven counts of a quality run from records (id, finding) and the states of their gates, and the verdict: passed without an automatic failure.

    finding says whether the duplicate check named the record; pairs are those within the records and with the
    references. The language gate is a person's and fails nothing automatically.
    """
    failed = reduce(lambda a, b: a | b, (F.coalesce(g == "failed", F.lit(False)) for k, g in gates.items() if k != "language"))
    n = F.count("*")
    counts = records.agg(n.alias("records_checked"), F.lit(references).cast("long").alias("reference_records"), F.floor(n * (n - 1) / 2 + n * references).cast("long").alias("pairs_checked"), F.count_if("finding").alias("duplicate_findings"), F.count_if(failed).alias("records_with_automatic_failures"), F.count_if(gates["semantic"] == "passed").alias("records_with_model_pass"), F.count_if(gates["language"] == "not_run").alias("records_pending_human_language_review"))
    return counts.withColumn("passed", F.col("records_with_automatic_failures") == 0)


def input_problems(records: DataFrame, status: str = "status") -> DataFrame:
    """(id, problem): ids that come up again, and records that were accepted and may not be rewritten."""
    again = records.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("duplicate_record_id").alias("problem"))
    return again.unionByName(records.where(F.col(status) == "accepted").select("id", F.lit("accepted_record").alias("problem")).distinct())


def run_job(rows: DataFrame, done: DataFrame, process: Callable[[DataFrame], DataFrame], index: str = "index") -> DataFrame:
    """What process makes of the rows that a checkpoint (index) lacks; process returns index, record and error.

    A failed item is a row with an error and stops nothing. Appended to the checkpoint, the result resumes the job.
    """
    return process(rows.join(done.select(index), index, "left_anti"))


PARTS = "index LONG, line STRING"


def _refused(rows: DataFrame, code: str) -> None:
    """ValueError with the first ten indexes of rows, if there are any."""
    first = [str(r["index"]) for r in rows.select("index").orderBy("index").limit(10).collect()]
    if first:
        raise ValueError(f"{code}: {', '.join(first)}")


def parts_at(spark: SparkSession, path: str) -> DataFrame:
    """(index, line) of the parts that have been written at path; none where nothing has."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(PARTS).parquet(path) if there else spark.createDataFrame([], PARTS)


def write_parts(rows: DataFrame, path: str) -> int:
    """Adds parts (index, line) of a job to those at path and returns how many are new.

    A part that is there already with the same line is passed over, so a job that was killed can send all again; one
    with another line, or two lines for an index, are refused before anything is written. Each call's files appear
    together or not at all, as Spark's committer moves them when the job is done. Lines aren't null.
    """
    own = rows.select(F.col("index").cast("long").alias("index"), "line").distinct()
    _refused(own.groupBy("index").count().where("count > 1 OR index IS NULL"), "PART_REPEATED")
    before = parts_at(rows.sparkSession, path).withColumnRenamed("line", "was")
    both = own.join(before, "index", "left")
    _refused(both.where("was <> line"), "PART_DIFFERS")
    written = Observation()
    both.where("was IS NULL").select("index", "line").observe(written, F.count("*").alias("n")).write.mode("append").parquet(path)
    return written.get["n"]


def assemble(spark: SparkSession, path: str, total: int, out: str, size: int = 10_000) -> DataFrame:
    """Writes the parts at path as text in order of index and returns the digests of their shards.

    Refused unless each index from 0 to total - 1 has its part. Each file holds a stretch of indexes, and files sort by
    name as their stretches do. Text that is there already is kept if it is the same, and an error otherwise.
    """
    parts = parts_at(spark, path)
    found = parts.agg(F.count("*").alias("n"), F.count_distinct("index").alias("own"), F.min("index").alias("low"), F.max("index").alias("high")).first()
    if (found["n"], found["own"]) != (total, total) or total and (found["low"], found["high"]) != (0, total - 1):
        raise ValueError(f"ASSEMBLY_REFUSED: {found['own']} of {total} parts, {found['low']} to {found['high']}")
    wanted = shard_digests(parts, "index", "line", size)
    place = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        parts.repartitionByRange("index").sortWithinPartitions("index").select("line").write.text(out)
        return wanted
    lines = spark.read.text(out).select(F.struct(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i")).alias("at"), F.col("value").alias("line"))
    there = shard_digests(numbered(lines, "at").withColumn("index", F.col("number") - 1), "index", "line", size)
    if not there.exceptAll(wanted).isEmpty() or not wanted.exceptAll(there).isEmpty():
        raise ValueError(f"ASSEMBLY_DIFFERS: {out}")
    return wanted
