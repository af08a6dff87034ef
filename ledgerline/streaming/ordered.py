"""Availability states of a stream whose observations come late and out of order.

An observation waits until the time of the stream has passed it, so that what is
before it has come; then it is applied in the order of time, whatever order it
came in. One that comes after that is too late: it changes nothing and goes into
a side table of its own. What a key's past counts for is a summary that batches
add to (the last available observation, the misses after it, the last attempt),
so no batch reads what was applied.

States, waiting observations, late ones and the time of the stream are published
as one release for each batch. A batch that comes again, after a failure, finds
itself applied and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.availability import NO_BUDGET, TRANSIENT
from ledgerline.sources import store
from ledgerline.sources.store import Surface

SUMMARIES, WAITING, LATE = Surface("summaries", ("key",)), Surface("waiting", ("key", "at", "seq")), Surface("late", ("key", "at", "seq"))
_SUMMARY = "key long, last_available struct<at timestamp, seq long>, last_attempt struct<at timestamp, seq long, outcome string>, streak long, last_miss timestamp"
_ROW = "key long, at timestamp, seq long, outcome string"
#: Releases after which the tables are written into one folder each.
COMPACT = 16


def summarised(prior: DataFrame, ready: DataFrame) -> DataFrame:
    """The summaries of ready's keys: prior's, and what ready (all of it later) adds."""
    is_ = lambda o: F.col("outcome") == o
    when = F.struct("at", "seq")
    last = ready.groupBy("key").agg(F.max(F.when(is_("available"), when)).alias("new_available"), F.max(F.when(~is_("budget"), F.struct("at", "seq", "outcome"))).alias("new_attempt"))
    misses = ready.where(is_("missing")).join(last.select("key", "new_available"), "key").where(F.col("new_available").isNull() | (when > F.col("new_available")))
    since = misses.groupBy("key").agg(F.count("*").alias("new_streak"), F.max("at").alias("new_miss"))
    both = last.join(since, "key", "left").join(prior, "key", "left")
    goes_on = F.col("new_available").isNull()
    streak = F.coalesce("new_streak", F.lit(0)) + F.when(goes_on, F.coalesce("streak", F.lit(0))).otherwise(0)
    return both.select("key", F.coalesce("new_available", "last_available").alias("last_available"), F.coalesce("new_attempt", "last_attempt").alias("last_attempt"), streak.alias("streak"), F.coalesce("new_miss", F.when(goes_on, F.col("last_miss"))).alias("last_miss"))


def states(summaries: DataFrame) -> DataFrame:
    """key, status, checked_at, last_attempt_at, streak, last_error, as availability.states has them."""
    status = F.when(F.col("streak") >= 2, "missing").when((F.col("streak") == 0) & F.col("last_available").isNotNull(), "available").otherwise("unknown")
    checked = F.when(F.col("streak") >= 2, F.col("last_miss")).otherwise(F.col("last_available.at"))
    error = F.when(F.col("last_attempt").isNull(), NO_BUDGET).when(F.col("last_attempt.outcome") == "transient", TRANSIENT)
    return summaries.select("key", status.alias("status"), checked.alias("checked_at"), F.col("last_attempt.at").alias("last_attempt_at"), "streak", error.alias("last_error"))


def _stored(spark: SparkSession, root: str, surface: Surface, schema: str, last: dict | None, keys: DataFrame | None = None) -> DataFrame:
    rows = store.read(spark, root, surface, keys, last) if last else None
    return rows if rows is not None else spark.createDataFrame([], schema)


def advance(batch: DataFrame, batch_id: int, root: str, late_seconds: int, digits: int = 2) -> None:
    """Applies one batch of observations (key, at, seq, outcome); the stream's time is the greatest `at` so far, less late_seconds. The tables are divided by so many hexadecimal digits."""
    spark = batch.sparkSession
    last = store.head(spark, root)
    note = (last or {}).get("note") or {"batch": -1, "passed": None}
    if batch_id <= note["batch"]:
        return
    rows = batch.select(F.col("key").cast("long").alias("key"), "at", F.col("seq").cast("long").alias("seq"), "outcome").dropDuplicates(["key", "at", "seq"])
    micros = F.unix_micros("at")
    newest = rows.agg(F.max(micros)).first()[0]
    passed = max((p for p in (note["passed"], None if newest is None else newest - late_seconds * 1_000_000) if p is not None), default=None)
    too_late = micros <= note["passed"] if note["passed"] is not None else F.lit(False)
    waiting = _stored(spark, root, WAITING, _ROW, last)
    there = waiting.unionByName(rows.where(~too_late)).dropDuplicates(["key", "at", "seq"])
    is_ready = micros <= passed if passed is not None else F.lit(False)
    ready = there.where(is_ready)
    summaries = summarised(_stored(spark, root, SUMMARIES, _SUMMARY, last, ready.select("key")), ready)
    stays = rows.where(~too_late & ~is_ready).withColumn("gone", F.lit(False)).unionByName(waiting.where(is_ready).withColumn("gone", F.lit(True)))
    changes = {SUMMARIES: (summaries, _SUMMARY), WAITING: (stays, f"{_ROW}, gone boolean"), LATE: (rows.where(too_late), _ROW)}
    changes = {s: r.to(spark.createDataFrame([], schema).schema) for s, (r, schema) in changes.items()}
    store.publish(spark, root, changes, based_on=last, note={"batch": batch_id, "passed": passed}, width=digits)
    if last and len(last["tables"]["late"]["folders"]) >= COMPACT:
        store.compact(spark, root, [SUMMARIES, WAITING, LATE])


def observe(source: DataFrame, root: str, checkpoint: str, late_seconds: int, digits: int = 2):
    """Applies a stream of observations batch by batch; returns the finished query."""
    query = source.writeStream.foreachBatch(lambda batch, batch_id: advance(batch, batch_id, root, late_seconds, digits)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def settled(spark: SparkSession, root: str) -> DataFrame:
    """The states of all observations that came in time, those that still wait included."""
    last = store.head(spark, root)
    prior = _stored(spark, root, SUMMARIES, _SUMMARY, last)
    waiting = _stored(spark, root, WAITING, _ROW, last)
    more = summarised(prior, waiting)
    return states(prior.join(more.select("key"), "key", "left_anti").unionByName(more.select(prior.columns)))


def late(spark: SparkSession, root: str) -> DataFrame:
    """The observations that came too late."""
    return _stored(spark, root, LATE, _ROW, store.head(spark, root))
