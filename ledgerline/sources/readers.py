"""Readers of records, targets and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record per file under a declared schema: its columns, file (name) and corrupt (the text, where it is not JSON of that shape)."""
    rows = spark.read.schema(f"{schema}, corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(path)
    return rows.select("*", F.regexp_extract(F.col("_metadata.file_path"), "[^/]*$", 0).alias("file"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """file and body (text) of every file, for rules on keys that a declared schema would drop."""
    rows = spark.read.option("wholetext", True).text(path)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), "[^/]*$", 0).alias("file"), F.col("value").alias("body"))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """path (name), bytes and sha256 of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", "[^/]*$", 0).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source_repository string, commit string, fork_repository string").option("multiLine", True).json(path)


def repeated_targets(targets: DataFrame) -> DataFrame:
    """Targets listed more than once, whatever the case of their repositories."""
    return targets.groupBy(F.lower("source_repository").alias("source_repository"), "commit", F.lower("fork_repository").alias("fork_repository")).count().where("count > 1")


def require_columns(rows: DataFrame, needed: dict[str, str]) -> DataFrame:
    """rows, if they have the columns and types that a projection reads."""
    have = dict(rows.dtypes)
    wrong = [f"{c} {t}" for c, t in needed.items() if have.get(c) != t]
    if wrong:
        raise ValueError(f"columns missing or of another type: {', '.join(wrong)}")
    return rows
