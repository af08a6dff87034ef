"""Availability of sources: state from observations, freshness, coverage and the next checks.

A state is status, checked_at, last_attempt_at, streak, last_error. Available
resets it; a first miss makes it unknown, a second one missing; a transient
failure keeps status and streak and records an error; a check that the budget
did not allow changes nothing, but makes a first state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Freshness and skew in seconds, checks per run, hours between runs, hours a cycle may take.
FRESH, SKEW, BUDGET, EVERY_HOURS, CYCLE_HOURS = 64_800, 300, 800, 6, 18
NO_BUDGET, TRANSIENT, STALE = "not checked: no budget", "transient failure", "last check is not fresh"


def states(observations: DataFrame) -> DataFrame:
    """The state of each key after all its observations (key, at, seq, outcome), by aggregations that combine before the shuffle.

    What counts of the past is the last available observation, the misses
    after it and the last attempt, so no key's observations are collected.
    """
    when = F.struct("at", "seq")
    is_ = lambda o: F.col("outcome") == o
    last = observations.groupBy("key").agg(
        F.max(F.when(is_("available"), when)).alias("last_available"),
        F.max(F.when(~is_("budget"), F.struct("at", "seq", "outcome"))).alias("last_attempt"),
    )
    misses = observations.where(is_("missing")).join(last.select("key", "last_available"), "key")
    after = misses.where(F.col("last_available").isNull() | (F.struct("at", "seq") > F.col("last_available")))
    since = after.groupBy("key").agg(F.count("*").alias("streak"), F.max("at").alias("last_miss"))
    joined = last.join(since, "key", "left").withColumn("streak", F.coalesce("streak", F.lit(0)))
    status = F.when(F.col("streak") >= 2, "missing").when((F.col("streak") == 0) & F.col("last_available").isNotNull(), "available").otherwise("unknown")
    checked = F.when(F.col("streak") >= 2, F.col("last_miss")).otherwise(F.col("last_available.at"))
    error = F.when(F.col("last_attempt").isNull(), NO_BUDGET).when(F.col("last_attempt.outcome") == "transient", TRANSIENT)
    return joined.select("key", status.alias("status"), checked.alias("checked_at"), F.col("last_attempt.at").alias("last_attempt_at"), "streak", error.alias("last_error"))


def miss_streaks(observations: DataFrame) -> DataFrame:
    """The streak of misses at every observation; only an available one ends it."""
    order = Window.partitionBy("key").orderBy("at", "seq")
    island = F.sum(F.when(F.col("outcome") == "available", 1).otherwise(0)).over(order)
    within = Window.partitionBy("key", "island").orderBy("at", "seq")
    return observations.withColumn("island", island).withColumn("streak", F.sum(F.when(F.col("outcome") == "missing", 1).otherwise(0)).over(within)).select("key", "seq", "streak")


def fresh(checked_at: Column, as_of: Column) -> Column:
    age = F.unix_timestamp(as_of) - F.unix_timestamp(checked_at)
    return F.coalesce(age.between(-SKEW, FRESH), F.lit(False))


def expired(state_rows: DataFrame, as_of: Column) -> DataFrame:
    """States with a known status whose check isn't fresh made unknown; streak and checked_at stay."""
    stale = F.col("status").isin("available", "missing") & ~fresh(F.col("checked_at"), as_of)
    return state_rows.withColumns({"last_error": F.when(stale, F.coalesce("last_error", F.lit(STALE))).otherwise(F.col("last_error")), "status": F.when(stale, "unknown").otherwise(F.col("status"))})


def coverage(targets: DataFrame, state_rows: DataFrame, as_of: Column) -> DataFrame:
    """One row: total, fresh, stale, unknown, unobserved, oldest and its age in seconds. as_of may be a column of targets."""
    joined = targets.withColumn("_as_of", as_of).select("key", "_as_of").distinct().join(state_rows, "key", "left")
    known = F.col("status").isin("available", "missing")
    is_fresh = fresh(F.col("checked_at"), F.col("_as_of"))
    oldest = F.min("checked_at")
    return joined.agg(
        F.count("*").alias("total"), F.count_if(known & is_fresh).alias("fresh"), F.count_if(known & ~is_fresh).alias("stale"),
        F.count_if(F.col("status") == "unknown").alias("unknown"), F.count_if(F.col("status").isNull()).alias("unobserved"),
        oldest.alias("oldest"), (F.unix_timestamp(F.max("_as_of")) - F.unix_timestamp(oldest)).alias("oldest_age"),
    )


def refresh_cycle(targets: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Endpoints, runs and hours until all were checked (null without a budget), and whether that is soon enough."""
    n = targets.agg(F.count_distinct("key").alias("endpoints"))
    runs = F.ceil(F.col("endpoints") / F.nullif(F.lit(budget), F.lit(0))).cast("long")
    return n.withColumn("runs", runs).withColumn("hours", F.col("runs") * EVERY_HOURS).withColumn("holds", F.coalesce(F.col("hours") <= CYCLE_HOURS, F.lit(False)))


def recheck_queue(targets: DataFrame, state_rows: DataFrame, n: int = BUDGET) -> DataFrame:
    """The n targets to check next: those never settled first, then the longest unchecked; a top-k, not a window over all."""
    joined = targets.select("key").distinct().join(state_rows, "key", "left")
    urgent = F.col("status").isNull() | (F.col("status") == "unknown") | F.col("checked_at").isNull()
    text = F.coalesce(F.date_format("checked_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))
    return joined.select(F.when(urgent, 0).otherwise(1).alias("later"), text.alias("checked"), "key").orderBy("later", "checked", "key").limit(n)


def canonical_spellings(asked: DataFrame) -> DataFrame:
    """Of repositories (repository, commit) that differ in case alone, the least spelling: low, commit, repository."""
    return asked.groupBy(F.lower("repository").alias("low"), "commit").agg(F.min("repository").alias("repository"))


def recheck_sources(asked: DataFrame, state_rows: DataFrame, n: int = BUDGET) -> DataFrame:
    """The n sources (repository, commit) to check next, as recheck_queue; ties go by lower case, spelling, commit.

    state_rows: low, commit, status, checked_at.
    """
    joined = canonical_spellings(asked).join(state_rows, ["low", "commit"], "left")
    urgent = F.col("status").isNull() | (F.col("status") == "unknown") | F.col("checked_at").isNull()
    text = F.coalesce(F.date_format("checked_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))
    rows = joined.select(F.when(urgent, 0).otherwise(1).alias("later"), text.alias("checked"), "low", "repository", "commit")
    return rows.orderBy("later", "checked", "low", "repository", "commit").limit(n).drop("low")


def degraded(state_rows: DataFrame) -> DataFrame:
    return state_rows.where((F.col("status") == "missing") | (F.col("streak") >= 2)).select("key", "status", "streak")


def probe_class(status: Column, remaining: Column, retry_after: Column) -> Column:
    """What an answer of the source means; null status: no answer."""
    limited = (status == 429) | ((status == 403) & ((remaining == 0) | retry_after.isNotNull()))
    return F.when(status.isNull(), "transient").when(status.between(200, 299), "available").when(status.isin(404, 409), "missing").when(F.coalesce(limited, F.lit(False)), "budget").otherwise("transient")


def merged(targets: DataFrame, state_rows: DataFrame, sides: tuple[str, ...]) -> DataFrame:
    """Targets with the state of each side (columns named by sides hold its key), unknown where there is none."""
    out = targets
    for side in sides:
        own = state_rows.select(F.col("key").alias(side), F.col("status").alias(f"{side}_status"), F.col("streak").alias(f"{side}_streak"))
        out = out.join(own, side, "left").withColumn(f"{side}_status", F.coalesce(f"{side}_status", F.lit("unknown"))).withColumn(f"{side}_streak", F.coalesce(f"{side}_streak", F.lit(0)))
    return out
