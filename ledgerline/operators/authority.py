"""The registry's own tables (results, submissions, days, identities) and how a batch may change them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def version_gaps(records: DataFrame) -> DataFrame:
    """Versions of an id that don't count from 1 without a gap."""
    n = F.row_number().over(Window.partitionBy("id").orderBy("version")).cast("long")
    return records.select("id", "version").withColumn("expected", n).where("version <> expected")


def serial_gaps(results: DataFrame) -> DataFrame:
    """Serials of a day that don't count from 1 without a gap."""
    n = F.row_number().over(Window.partitionBy("day").orderBy("serial")).cast("long")
    return results.select("day", "serial").distinct().withColumn("expected", n).where("serial <> expected")


def day_serials(results: DataFrame) -> DataFrame:
    return results.groupBy("day").agg(F.max("serial").alias("last_serial"))


def identity_changes(records: DataFrame) -> DataFrame:
    """Versions whose identity is not that of the first version."""
    own = F.struct("repository", "project_path", "config_path")
    first = F.first_value(own).over(Window.partitionBy("id").orderBy("version"))
    return records.withColumn("same", own.eqNullSafe(first)).where("not same").select("id", "version")


def exclusive_conflicts(records: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys that belong to more than one owner."""
    return records.groupBy(key).agg(F.count_distinct(owner).alias("owners")).where("owners > 1")


def append_transition(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Violations of a batch of versions (id, day, serial, version): versions go on from the id's last, new serials from the day's last."""
    last = prior.groupBy("id").agg(F.max("version").alias("last"))
    n = F.row_number().over(Window.partitionBy("id").orderBy("version"))
    versions = batch.join(last, "id", "left").withColumn("expected", F.coalesce("last", F.lit(0)) + n)
    bad_versions = versions.where("version <> expected").select(F.concat_ws("-v", "id", F.col("version").cast("string")).alias("entity"), F.lit("version").alias("rule"))
    days = prior.groupBy("day").agg(F.max("serial").alias("last_serial"))
    new = batch.join(prior.select("id").distinct(), "id", "left_anti").select("id", "day", "serial").distinct()
    m = F.row_number().over(Window.partitionBy("day").orderBy("serial"))
    serials = new.join(days, "day", "left").withColumn("expected", F.coalesce("last_serial", F.lit(0)) + m)
    return bad_versions.unionByName(serials.where("serial <> expected").select(F.col("id").alias("entity"), F.lit("serial").alias("rule")))


def difference(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are missing from actual, or extra in it."""
    missing = expected.select(*keys).distinct().join(actual.select(*keys), keys, "left_anti").withColumn("rule", F.lit("missing"))
    extra = actual.select(*keys).distinct().join(expected.select(*keys), keys, "left_anti").withColumn("rule", F.lit("extra"))
    return missing.unionByName(extra)


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
