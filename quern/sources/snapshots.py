"""Pinned tables: CSV with typed columns, exchange-rate bulletins in XML, and their provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POPULATION = "province STRING, year INT, population BIGINT"
MIGRATION = "province STRING, year INT, in_migration BIGINT, out_migration BIGINT, net_migration BIGINT, net_migration_rate DOUBLE"
UNEMPLOYMENT = "year INT, period STRING, country STRING, age_group STRING, unemployment_rate DOUBLE"
_CURRENCY = "ARRAY<STRUCT<_CurrencyCode:STRING,Unit:STRING,ForexBuying:STRING,ForexSelling:STRING>>"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table under a fixed schema; a header with other columns, or no rows, is an error."""
    out = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(path)
    if out.isEmpty():
        raise ValueError(f"SNAPSHOT_EMPTY: {path}")
    return out


def read_bulletins(spark: SparkSession, path: str) -> DataFrame:
    """(date, bulletin_no, currency_code, currency_unit, forex_buying, forex_selling) from bulletins named ddMMyyyy.xml.

    Currencies that lack either rate are left out; a name that differs from the bulletin's date is an error.
    """
    raw = spark.read.format("xml").option("rowTag", "Tarih_Date").schema(f"_Tarih STRING, _Bulten_No STRING, Currency {_CURRENCY}").load(path)
    stem = F.regexp_extract(F.input_file_name(), r"([0-9]{8})\.xml$", 1)
    day = F.to_date("_Tarih", "dd.MM.yyyy")
    checked = raw.withColumn("date", F.when(stem == F.date_format(day, "ddMMyyyy"), day).otherwise(F.raise_error(F.concat(F.lit("BULLETIN_DATE_MISMATCH: "), F.input_file_name())).cast("date")))
    rates = checked.select("date", F.col("_Bulten_No").alias("bulletin_no"), F.explode("Currency").alias("c"))
    number = lambda c: F.nullif(F.trim(c), F.lit("")).cast("decimal(18,4)")
    out = rates.select("date", "bulletin_no", F.col("c._CurrencyCode").alias("currency_code"), F.trim("c.Unit").cast("int").alias("currency_unit"), number("c.ForexBuying").alias("forex_buying"), number("c.ForexSelling").alias("forex_selling"))
    return out.where("forex_buying IS NOT NULL AND forex_selling IS NOT NULL")


def check_digests(declared: DataFrame, files: DataFrame) -> DataFrame:
    """(path, code) for declared files (path, sha256) that files (path, content) lacks or has with other bytes."""
    own = files.select("path", F.sha2("content", 256).alias("own"))
    code = F.when(F.col("own").isNull(), "SNAPSHOT_FILE_MISSING").when(F.col("own") != F.col("sha256"), "SNAPSHOT_HASH_MISMATCH")
    return declared.join(own, "path", "left").select("path", code.alias("code")).where("code IS NOT NULL")


def check_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def write_csv(rows: DataFrame, path: str, key: list[str]) -> int:
    """Writes a snapshot as CSV in the order of its key, over as many files as tasks, and returns its rows; a repeated key is refused."""
    again = rows.groupBy(*key).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError("SNAPSHOT_REFUSED: repeated key " + "/".join(str(again[0][k]) for k in key))
    written = Observation()
    rows.orderBy(*key).observe(written, F.count("*").alias("n")).write.mode("errorifexists").option("header", "true").csv(path)
    return written.get["n"]
