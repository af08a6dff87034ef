"""Availability states as a stream: the same transitions as the batch form, kept per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.availability import FRESH, NO_BUDGET, STALE, TRANSIENT
from ledgerline.sources import store
from ledgerline.sources.store import Surface

STATE = "status string, checked_at timestamp, last_attempt_at timestamp, streak long, last_error string"


def step(state: tuple | None, at: pd.Timestamp, outcome: str) -> tuple:
    """The next state (status, checked_at, last_attempt_at, streak, last_error)."""
    status, checked, attempt, streak, error = state or ("unknown", None, None, 0, None)
    if outcome == "budget":
        return state or ("unknown", None, None, 0, NO_BUDGET)
    if outcome == "available":
        return "available", at, at, 0, None
    if outcome == "missing":
        streak += 1
        return ("missing", at, at, streak, None) if streak >= 2 else ("unknown", checked, at, streak, None)
    return status, checked, at, streak, TRANSIENT


def expire(state: tuple) -> tuple:
    """A state with a known status whose check is no longer fresh."""
    status, checked, attempt, streak, error = state
    return ("unknown", checked, attempt, streak, error or STALE) if status in ("available", "missing") else state


def observe(observations: DataFrame, late: str = "5 minutes") -> DataFrame:
    """A stream of observations (key, at, seq, outcome) as a stream of states.

    Within a batch observations go in order of time; one that is not after the
    state's last attempt is dropped, so a batch that comes twice changes nothing.
    A timer in event time makes a known status unknown once its check is not
    fresh any more, without a further observation of that key.
    """
    # Pandas has times without a zone, in that of the session.
    zone = observations.sparkSession.conf.get("spark.sql.session.timeZone")

    def update(key: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        state = held.get if held.exists else None
        if held.hasTimedOut:
            state = expire(state)
        else:
            rows = pd.concat(list(batches)).sort_values(["at", "seq"])
            begun = state[2] if state else None
            for at, outcome in zip(rows["at"], rows["outcome"], strict=True):
                if begun is None or pd.isna(begun) or at > begun:
                    state = step(state, at, outcome)
        state = tuple(None if x is pd.NaT else x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for x in state)
        held.update(state)
        if state[0] in ("available", "missing"):
            checked = pd.Timestamp(state[1]).tz_localize(zone, ambiguous=False, nonexistent="shift_forward")
            until = int(checked.timestamp() * 1000) + (FRESH + 1) * 1000
            held.setTimeoutTimestamp(max(until, held.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *state)], columns=["key", "status", "checked_at", "last_attempt_at", "streak", "last_error"]).astype({"checked_at": "datetime64[us]", "last_attempt_at": "datetime64[us]"})

    return observations.withWatermark("at", late).groupBy("key").applyInPandasWithState(update, f"key long, {STATE}", STATE, "update", "EventTimeTimeout")


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path, or None where nothing is written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


#: Batches after which the keys of all are written into one folder.
COMPACT = 16


def ingest(source: DataFrame, path: str, checkpoint: str, key: list[str], digits: int = 2):
    """Appends new records of a stream to a table once each, also when a batch is run again or a key comes in a later one; returns the finished query.

    Keys stand beside the records, divided by the first digits of their digests
    (hexadecimal; more for more keys in all) and compacted now and then, so a batch opens the parts that its own keys fall in, and at most
    COMPACT files of each. It writes its own folder of records anew, then its keys.
    """
    index = Surface("keys", tuple(key))
    root = f"{path}-keys"

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(key)
        last = store.head(spark, root)
        if last is not None:
            there = store.read(spark, root, index, new.select(*key), last)
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
            # A batch that is run again has its keys there already.
            new = new.join(there.where(F.col("batch") != batch_id).select(*[F.col(k).alias(f"_{k}") for k in key]), same, "left_anti")
        new.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        store.publish(spark, root, {index: new.select(*key, F.lit(batch_id).cast("long").alias("batch"))}, based_on=last, width=digits)
        if last is not None and len(last["tables"]["keys"]["folders"]) >= COMPACT:
            store.compact(spark, root, [index])

    query = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def release(spark: SparkSession, records: DataFrame, path: str, key: list[str]) -> int:
    """Writes the release after the served one and serves it; returns its number.

    It holds what of records no served release has: what batches that failed,
    or were never released, left behind comes along, whatever the last batch
    was. A release's rows are written first and its header after them, so one
    that broke off is not served and is written anew.
    """
    heads = _written(spark, f"{path}/served")
    number = (heads.agg(F.max("release")).first()[0] if heads is not None else 0) + 1
    rows = _written(spark, f"{path}/rows")
    new = records
    if number > 1 and rows is not None:
        new = records.join(rows.where(F.col("release") < number).select(*key), key, "left_anti")
    new.withColumn("release", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release").parquet(f"{path}/rows")
    spark.createDataFrame([(number, number - 1)], "release int, parent int").write.mode("append").parquet(f"{path}/served")
    return number


def served(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all served releases."""
    heads = spark.read.parquet(f"{path}/served").agg(F.max("release").alias("_last"))
    return spark.read.parquet(f"{path}/rows").join(F.broadcast(heads), F.col("release") <= F.col("_last")).drop("_last")
