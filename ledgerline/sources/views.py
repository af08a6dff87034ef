
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The prefix of record identifiers, PREFIX-YYYY-MM-DD-NNNNNN.
PREFIX = "REC"
LINE_ORDER = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(ts: Column) -> Column:
    """A timestamp as text of second precision."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version ever registered: key (id, version)."""
    orders, lines, parts, suppliers = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part", "supplier"))
    day = F.to_date("o_orderdate")
    results = orders.select("o_orderkey", "o_custkey", day.alias("day"), F.row_number().over(Window.partitionBy(day).orderBy("o_orderkey")).cast("long").alias("serial"))
    versions = lines.withColumn("version", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)).cast("long"))
    joined = versions.join(results, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(
        F.concat(F.lit(f"{PREFIX}-"), F.date_format("day", "yyyy-MM-dd"), F.lit("-"), F.lpad(F.col("serial").cast("string"), 6, "0")).alias("id"),
        "day", "serial", "version", F.col("l_shipdate").alias("registered_at"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.lower("s_name").alias("repository"),
        F.concat(F.lit("owner-"), "o_custkey").alias("owner"), F.col("p_size").cast("long").alias("size"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("src/"), "p_brand")).alias("project_path"),
        F.concat(F.lit("config/"), "p_type").alias("config_path"),
        F.sha1(F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")).alias("commit_sha"),
        (F.col("l_returnflag") == "R").alias("withdrawn"),
        F.concat(F.lit("sub-"), F.col("o_orderkey"), F.lit("-"), F.col("version")).alias("submission_id"),
        F.col("o_orderkey").alias("orderkey"),
    )


def takedowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The withdrawn versions."""
    return records(spark, sf_dir).where("withdrawn").select("id", "version", F.col("registered_at").alias("taken_down_at"), "owner", "orderkey")


def inventory(spark: SparkSession, sf_dir: str, which: int | None = None) -> DataFrame:
    """path, bytes, sha256 of the text records; which = 0 or 1: the earlier or the later of two states of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if which == 0:
        docs = docs.where("doc_id % 10 <> 0")
    if which == 1:
        docs = docs.where("doc_id % 10 <> 1").withColumn("text", F.when(F.col("doc_id") % 10 == 2, F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(F.col("text")))
    return docs.select(F.concat(F.lit("documents/"), "doc_id").alias("path"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, at (to the second), seq and outcome of every check of a source."""
    outcome = F.when(F.col("event_type").isin("view", "click"), "available").when(F.col("event_type") == "error", "missing").when(F.col("event_type") == "signup", "transient").otherwise("budget")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.date_trunc("second", "ts").alias("at"), F.col("event_id").alias("seq"), outcome.alias("outcome"), "props")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key and body (JSON text) of review-like documents."""
    c = table(spark, sf_dir, "conversations")
    finding = F.array(F.struct(F.col("role").alias("evidence"), F.length("text").alias("severity"), F.substring("text", 1, 20).alias("message")))
    body = F.to_json(F.struct(F.lit(2).alias("schema_version"), F.col("role").alias("outcome"), F.concat(F.lit("conv-"), "conv_id").alias("submission_id"), F.when(F.col("turn") % 3 == 0, F.lit("x")).alias("extra"), F.array(F.struct(F.lit("step").alias("step"), finding.alias("findings"))).alias("checks")))
    return c.select("conv_id", "turn", F.col("role"), body.alias("body"))
