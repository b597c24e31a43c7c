"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Where the tables of this application are: paths, and names in the catalogue.
made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where nothing is set a local folder if all runs on this machine, as in tests, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("SHARED_FOLDER_UNSET: set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="quern-checkpoint-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def unique_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quern-{uuid.uuid4().hex}-{name}"


def durable(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here, and the files outlive any executor."""
    path = unique_path(df.sparkSession, name)
    df.write.parquet(path)
    made.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.durable_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes the files of durable tables that nothing reads any more."""
    for df in tables:
        forget(df.sparkSession, [df.durable_path])


def forget(spark: SparkSession, names: list[str]) -> None:
    """Deletes tables that are named as in `made`."""
    for name in names:
        if "/" not in name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame, key: str, name: str) -> DataFrame:
    """df as a table that is dealt over buckets by key: what joins it on the key doesn't shuffle it again."""
    return bucketed(df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key), key, name)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """As dealt(), but each task deals what it has, so that nothing is shuffled; keys should belong to one task each."""
    spark = df.sparkSession
    path, table = unique_path(spark, name), f"quern_{uuid.uuid4().hex}_{name}"
    made.extend((path, table))  # the table is of files elsewhere, so both are to be deleted
    df.write.option("compression", "zstd").option("path", path).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(table)
    return spark.table(table)
