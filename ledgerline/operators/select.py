"""Which versions count: active, current, newest; and the groups of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active(records: DataFrame, takedowns: DataFrame) -> DataFrame:
    """Records without the withdrawn versions. Spark broadcasts the withdrawals only while they are small."""
    return records.join(takedowns.select("id", "version"), ["id", "version"], "left_anti")


def latest_versions(active_records: DataFrame) -> DataFrame:
    """The highest version of each id, without a sort: a partial aggregation before the shuffle."""
    newest = active_records.groupBy("id").agg(F.max_by(F.struct(*[c for c in active_records.columns if c != "id"]), "version").alias("r"))
    return newest.select("id", "r.*")


def newest_first() -> list[Column]:
    return [F.desc("registered_at"), F.desc("id")]


def recent(current: DataFrame, n: int = 200) -> DataFrame:
    """The n newest, by instant, then id."""
    return current.orderBy(*newest_first()).limit(n)


def codes(records: DataFrame) -> DataFrame:
    """One row per record and code: kind, code."""
    pairs = F.array(F.struct(F.lit("brand").alias("kind"), F.col("brand").alias("code")), F.struct(F.lit("type").alias("kind"), F.col("type").alias("code")))
    return records.withColumn("k", F.explode(pairs)).select("*", "k.kind", "k.code").drop("k")


def top_per_code(current: DataFrame, n: int = 50) -> DataFrame:
    """The n newest current records of each code, with their rank."""
    order = Window.partitionBy("kind", "code").orderBy(*newest_first())
    return codes(current).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))


def counts_per_code(ever: DataFrame, current: DataFrame) -> DataFrame:
    """Current records per code; a code once used keeps a row, with 0."""
    seeds = codes(ever).select("kind", "code").distinct()
    now = codes(current).groupBy("kind", "code").agg(F.count("*").alias("results"))
    return seeds.join(now, ["kind", "code"], "left").select("kind", "code", F.coalesce("results", F.lit(0)).alias("results"))


def code_moves(versions: DataFrame) -> DataFrame:
    """For each id, the codes that its latest version has left and joined, against the one before."""
    order = Window.partitionBy("id").orderBy("version")
    listed = versions.withColumn("codes", F.array("brand", "type"))
    before = listed.withColumn("was", F.lag("codes").over(order)).where(F.col("was").isNotNull())
    last = before.groupBy("id").agg(F.max_by(F.struct("version", "codes", "was"), "version").alias("r"))
    text = lambda a: F.array_join(F.array_sort(a), ",")
    return last.select("id", "r.version", text(F.array_except("r.was", "r.codes")).alias("left_codes"), text(F.array_except("r.codes", "r.was")).alias("joined_codes"))


def newly_active(prior_active: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of the batch that had no active version before."""
    return batch.select("id").distinct().join(prior_active.select("id").distinct(), "id", "left_anti")
