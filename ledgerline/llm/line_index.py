"""Line counts that are kept: exact reference and count tables behind sharded cuckoo filters, moved on by insertions and deletions.

Four tables change together, as one release of ledgerline.sources.store: which
documents hold a key, which keys a document holds, how many documents hold a key
(with the largest of them, its keeper), and a cuckoo filter a shard over the
keys that enough of them hold. A change reads and writes the rows of its own
documents and keys, and the filters of the shards where a key came to be
repeated or no longer is. A deletion knows a document's keys from the tables, so
the documents may have left their source before.

Defined cases: rows without a doc_id are no document; a document that is
inserted again adds the keys that it didn't have; deleting one that isn't there
changes nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import store
from ledgerline.sources.store import Surface

from .line_dedup import FILTERS, SHARD_KEYS, SHARDS, CuckooFilter, LineIndex, _shard, references

HOLDERS, HELD = Surface("holders", ("k1", "k2", "doc_id"), ("k1", "k2")), Surface("held", ("doc_id",))
COUNTS, CELLS = Surface("counts", ("k1", "k2")), Surface("filters", ("shard",))
ALL = (HOLDERS, HELD, COUNTS, CELLS)
_SCHEMA = {"holders": "k1 long, k2 long, doc_id long", "held": "doc_id long, keys array<struct<k1 long, k2 long>>", "counts": "k1 long, k2 long, n_docs long, keeper long", "filters": FILTERS}


def _read(spark: SparkSession, root: str, surface: Surface, keys: DataFrame | None, last: dict | None) -> DataFrame:
    rows = store.read(spark, root, surface, keys, last) if last else None
    return rows if rows is not None else spark.createDataFrame([], _SCHEMA[surface.name])


def _published(spark: SparkSession, root: str, last: dict | None, note: dict, changes: dict[Surface, DataFrame]) -> dict:
    typed = {s: rows.to(spark.createDataFrame([], f"{_SCHEMA[s.name]}, gone boolean").schema) for s, rows in changes.items()}
    return store.publish(spark, root, typed, replace=last is None, based_on=last, note=note, width=note["digits"])


def _filtered(spark: SparkSession, root: str, last: dict | None, note: dict, counts: DataFrame) -> DataFrame:
    """The filters of the shards in which counts (k1, k2, was, n_docs, of the touched keys) make a key repeated or no longer so."""
    shards, least = note["shards"], note["min_docs"]
    was, now = F.col("was") >= least, F.col("n_docs") >= least
    moved = counts.where(was != now).select(_shard(shards), "k1", "k2", now.alias("comes")).persist()
    own = moved.select("shard").distinct()
    there = _read(spark, root, CELLS, own, last)

    def update(key: tuple, held: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        made, hashes = CuckooFilter(cells=held["cells"].iloc[0]) if len(held) else CuckooFilter(), keys["k2"].to_numpy().view(np.uint64)
        comes = keys["comes"].to_numpy(bool)
        made.remove(hashes[~comes])
        return pd.DataFrame({"shard": [key[0]], "cells": [made.cells.tobytes() if made.add(hashes[comes]) else None]})

    try:
        made = there.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(update, FILTERS).persist()
        full = made.where("cells is null").select("shard")
        if full.isEmpty():
            return made
        # A filter without room is made anew, from the counts of its shard.
        every = _read(spark, root, COUNTS, None, last).join(counts.select("k1", "k2"), ["k1", "k2"], "left_anti").select("k1", "k2", "n_docs").unionByName(counts.select("k1", "k2", "n_docs"))
        keys = every.where(F.col("n_docs") >= least).withColumn("shard", _shard(shards)).join(full, "shard", "left_semi")

        def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": [key[0]], "cells": [CuckooFilter(rows["k2"].to_numpy().view(np.uint64)).cells.tobytes()]})

        return made.where("cells is not null").unionByName(keys.select("shard", "k2").groupBy("shard").applyInPandas(build, FILTERS))
    finally:
        moved.unpersist()


def build(docs: DataFrame, root: str, min_chars: int = 40, min_docs: int = 5, digits: int | None = None) -> dict:
    """The tables of a corpus, from nothing; digits is how finely they are divided (hexadecimal digits; by default from the number of keys)."""
    spark = docs.sparkSession
    keys = references(docs, min_chars).select("k1", "k2").distinct().count()
    wide = digits or max(1, len(f"{keys // store.PART_ROWS:x}"))
    note = {"min_chars": min_chars, "min_docs": min_docs, "shards": max(SHARDS, -(-keys // SHARD_KEYS)), "digits": wide}
    return _inserted(spark, docs, root, None, note)


def insert(docs: DataFrame, root: str) -> dict:
    """The tables with docs added; what they have already of them is not added again."""
    spark = docs.sparkSession
    last = store.head(spark, root)
    return _inserted(spark, docs, root, last, last["note"])


def _inserted(spark: SparkSession, docs: DataFrame, root: str, last: dict | None, note: dict) -> dict:
    own = references(docs, note["min_chars"]).groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))
    had = _read(spark, root, HELD, own.select("doc_id"), last).select("doc_id", F.col("keys").alias("had"))
    both = own.join(had, "doc_id", "left").withColumn("had", F.coalesce("had", F.slice("keys", 1, 0)))
    both = both.withColumn("new", F.array_except("keys", "had")).where(F.size("new") > 0)
    added = both.select("doc_id", F.explode("new").alias("k")).select("k.k1", "k.k2", "doc_id")
    moves = added.groupBy("k1", "k2").agg(F.count("*").alias("more"), F.max("doc_id").alias("most"))
    before = _read(spark, root, COUNTS, moves.select("k1", "k2"), last).withColumnRenamed("keeper", "kept").withColumnRenamed("n_docs", "was")
    counts = moves.join(before, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("was", F.lit(0)).alias("was"), (F.coalesce("was", F.lit(0)) + F.col("more")).alias("n_docs"), F.greatest("most", "kept").alias("keeper")).persist()
    stays = lambda rows: rows.withColumn("gone", F.lit(False))
    try:
        held = both.select("doc_id", F.array_union("had", "new").alias("keys"))
        return _published(spark, root, last, note, {HOLDERS: stays(added), HELD: stays(held), COUNTS: stays(counts.drop("was")), CELLS: stays(_filtered(spark, root, last, note, counts))})
    finally:
        counts.unpersist()


def delete(doc_ids: DataFrame, root: str) -> dict:
    """The tables without the documents listed: what insertions of them did is undone."""
    spark = doc_ids.sparkSession
    last = store.head(spark, root)
    note = last["note"]
    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    own = _read(spark, root, HELD, ids, last)
    gone = own.select("doc_id", F.explode("keys").alias("k")).select("k.k1", "k.k2", "doc_id").persist()
    less = gone.groupBy("k1", "k2").agg(F.count("*").alias("less"), F.max("doc_id").alias("highest"))
    before = _read(spark, root, COUNTS, less.select("k1", "k2"), last)
    moved = before.join(less, ["k1", "k2"]).select("k1", "k2", F.col("n_docs").alias("was"), (F.col("n_docs") - F.col("less")).alias("n_docs"), "keeper", (F.col("highest") == F.col("keeper")).alias("lost")).persist()
    # Who keeps a line whose keeper goes is asked of the key's holders.
    lost = moved.where("lost and n_docs > 0").select("k1", "k2")
    left = _read(spark, root, HOLDERS, lost, last).join(gone, ["k1", "k2", "doc_id"], "left_anti").groupBy("k1", "k2").agg(F.max("doc_id").alias("next"))
    counts = moved.join(left, ["k1", "k2"], "left").select("k1", "k2", "was", "n_docs", F.when(F.col("lost"), F.col("next")).otherwise(F.col("keeper")).alias("keeper")).persist()
    goes = lambda rows: rows.withColumn("gone", F.lit(True))
    try:
        filters = _filtered(spark, root, last, note, counts).withColumn("gone", F.lit(False))
        return _published(spark, root, last, note, {HOLDERS: goes(gone), HELD: goes(own), COUNTS: counts.drop("was").withColumn("gone", F.col("n_docs") == 0), CELLS: filters})
    finally:
        for rows in (gone, moved, counts):
            rows.unpersist()


def index(spark: SparkSession, root: str) -> LineIndex:
    """What dedup_lines counts in, from the tables as they are."""
    last = store.head(spark, root)
    note = last["note"]
    return LineIndex(_read(spark, root, HOLDERS, None, last), _read(spark, root, CELLS, None, last), note["shards"], note["min_chars"], note["min_docs"])
