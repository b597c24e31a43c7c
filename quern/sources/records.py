"""Records from JSON and JSON Lines files, with their lines; what can't be parsed becomes issues."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.jsons import canonical_json
from quern.operators.numbering import numbered
from quern.sources.tables import durable

#: Splits of files that are broadcast; more are joined by a shuffle.
SPLITS = 500_000


def read_lines(spark: SparkSession, path: str, names: str = "*.jsonl") -> DataFrame:
    """(file, line, raw): lines of the .jsonl files at path (a file, or a folder's own files); blank ones are left out.

    Spark cuts files into splits at line ends, so a file may be larger than a task. A line's number is its place in its
    split and the lines of the splits before it.
    """
    text = spark.read.option("pathGlobFilter", names).text(path).withColumn("m", F.col("_metadata"))
    own = text.select(F.col("m.file_path").alias("path"), F.col("m.file_name").alias("file"), F.col("m.file_block_start").alias("start"), F.col("value").alias("raw"), F.monotonically_increasing_id().alias("at"))
    own = durable(own, "lines")  # written once, so that all looks agree on the places
    splits = own.groupBy("path", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = durable(splits.select("path", "start", (before - F.col("first")).alias("shift")), "splits")
    near = F.broadcast(starts) if starts.limit(SPLITS + 1).count() <= SPLITS else starts.hint("merge")
    return own.join(near, ["path", "start"]).select("file", (F.col("at") + F.col("shift") + 1).alias("line"), "raw").where(F.trim("raw") != "")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, raw): the .json files at path, whole, with a null line; each has to fit a task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.lit(None).cast("long").alias("line"), F.decode("content", "UTF-8").alias("raw"))


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, raw): rows of the .jsonl and .json files at path by their lines, or their places in a file's list; a single object is row 1."""
    v = F.try_parse_json("raw")
    listed = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))
    whole = read_documents(spark, path).select("file", "raw", listed.alias("rows"))
    single = whole.where("rows IS NULL").select("file", F.lit(1).cast("long").alias("number"), "raw")
    inner = whole.where("rows IS NOT NULL").select("file", F.posexplode(F.transform("rows", lambda r: F.to_json(r))).alias("at", "raw")).select("file", (F.col("at") + 1).cast("long").alias("number"), "raw")
    return read_lines(spark, path).withColumnRenamed("line", "number").unionByName(single).unionByName(inner)


def record_files(spark: SparkSession, path: str) -> DataFrame:
    """(place, path, name) of the record files at path, a folder's own or the one, in order of their names without case, then as written."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{json,jsonl,JSON,JSONL,Json,Jsonl}").load(path)
    named = found.select("path", F.element_at(F.split("path", "/"), -1).alias("name")).withColumn("__order", F.struct(F.lower("name"), "name"))
    return numbered(named, "__order", name="place").select("place", "path", "name")


def parse(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Records (file, line, raw and the schema's columns) and issues (code, message, file, line).

    A line that is no JSON object is an issue, and the others survive.
    """
    good = F.coalesce(F.schema_of_variant(F.try_parse_json("raw")).startswith("OBJECT"), F.lit(False))
    records = lines.where(good).withColumn("r", F.from_json("raw", schema)).select("file", "line", "raw", "r.*")
    code = F.when(F.col("line").isNull(), "JSON_PARSE_ERROR").otherwise("JSONL_RECORD_PARSE_ERROR")
    issues = lines.where(~good).select(code.alias("code"), F.concat("file", F.lit(": not a JSON object")).alias("message"), "file", "line")
    return records, issues


def first_seen(df: DataFrame, key: str, *order: str) -> DataFrame:
    """df with repeat: whether an earlier row has the key. The first is found by a minimum that combines before the shuffle."""
    first = df.groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    return df.join(first, key, "left").withColumn("repeat", F.struct(*order) > F.col("__first")).drop("__first")


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, name) of the files under root, at any depth, whose names fit a glob; their contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


#: Folders of the states that a record goes through.
STATES = ("accepted", "needs_revision", "rejected", "staging")


def by_state(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, state): record files under the folders of STATES."""
    state = F.regexp_extract("path", f"/({'|'.join(STATES)})/", 1)
    return files(spark, root, "*.{json,jsonl}").withColumn("state", state).where("state <> ''")


def line_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, name) of the .jsonl files under root, refused if it holds .json files or a registry among its parts."""
    found = files(spark, root, "*.{json,jsonl,JSON,JSONL}").withColumn("low", F.lower("name"))
    wrong = [r["name"] for r in found.where("low LIKE '%.json' OR low = 'registry.jsonl'").select("name").orderBy("low", "name").limit(10).collect()]
    if wrong:
        raise ValueError("RECORDS_REFUSED: " + ", ".join(wrong))
    return found.drop("low")


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of the .jsonl files at path; a line that is no record fails all."""
    good, bad = parse(read_lines(spark, path), schema)
    first = bad.orderBy("file", "line").limit(10).collect()
    if first:
        raise ValueError("RECORDS_REFUSED: " + ", ".join(f"{r['file']}:{r['line']} {r['code']}" for r in first))
    return good.drop("file", "line", "raw")


def write(records: DataFrame, path: str) -> int:
    """Writes records as JSON lines with sorted keys, nulls included, and returns their number; an existing path is refused."""
    lines = records.select(canonical_json(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("value"))
    written = Observation()
    lines.observe(written, F.count("*").alias("n")).write.mode("errorifexists").text(path)
    return written.get["n"]


def write_run_log(results: DataFrame, path: str, model: str, run: str) -> None:
    """Writes a run's results as JSON lines under its model's and its own name, which have to be plain."""
    for name in (model, run):
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name):
            raise ValueError(f"RUN_LOG_REFUSED: {name}")
    results.write.mode("errorifexists").json(f"{path}/{model}/{run}")
