"""Reversible line deduplication: sharded cuckoo filters in front of exact reference tables.

The reference table has one row for each document and distinct key, so
documents can be added and taken away again at any time and the counts stay
exact (line_index keeps it, and counts and filters with it). Sharded cuckoo
filters hold the keys that enough documents have. They answer "certainly not
repeated" for nearly all lines, and what passes is settled against the exact
table.

A key is named by 128 bits of xxhash64. Defined cases: null or empty text is
one empty line; rows of one doc_id are one document, and its lines stay or go
in all of them; a row without a doc_id counts as no document and keeps no
repeated line; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_or_empty, written

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shards there are at least, and keys in one of them when they are dealt.
SHARDS, SHARD_KEYS = 64, 500_000
#: All shards' filters are sent to the tasks only up to this size; beyond it, lines are dealt to the shards, SHARD_LINES to a group.
FILTER_BYTES, SHARD_LINES = 64 << 20, 500_000
FILTERS = "shard long, cells binary"


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _named(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2")]


def references(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """The exact table: k1, k2, doc_id for each document and distinct key of at least min_chars code points (more than once where rows share a doc_id)."""
    keys = F.array_distinct(F.filter(F.transform(F.split(text_or_empty(), "\n", -1), key_of), lambda k: F.length(k) >= min_chars))
    rows = docs.where(F.col("doc_id").isNotNull())
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(keys).alias("key")).select(*_named(F.col("key")), "doc_id")


def counts(table: DataFrame, min_docs: int = 5) -> DataFrame:
    """Exact counts of the keys that at least min_docs documents hold: k1, k2, n_docs, keeper (the largest doc_id)."""
    return table.groupBy("k1", "k2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)


class CuckooFilter:
    """16-bit fingerprints in buckets of four, two buckets for a key; insertions and deletions, many keys at a time."""

    WAYS = 4

    def __init__(self, hashes: np.ndarray | None = None, cells: bytes | None = None, load: float = 0.8):
        if cells is not None:
            self.cells = np.frombuffer(cells, np.uint16).reshape(-1, self.WAYS).copy()
            return
        hashes, size = np.zeros(0, np.uint64) if hashes is None else hashes, 1
        while size * self.WAYS * load < len(hashes):
            size *= 2
        self.cells = np.zeros((size, self.WAYS), np.uint16)
        while not self.add(hashes):
            self.cells = np.zeros((2 * len(self.cells), self.WAYS), np.uint16)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = ((hashes >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        return prints, (hashes & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def _other(self, place: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (place ^ (prints.astype(np.int64) * 0x5BD1E995)) & (len(self.cells) - 1)

    def add(self, hashes: np.ndarray) -> bool:
        """Whether all keys found room; where not, the filter is as it was."""
        if not len(hashes):
            return True
        cells, before = self.cells, self.cells.copy()
        if np.count_nonzero(cells) + len(hashes) > cells.size:
            return False
        prints, place = self._places(np.asarray(hashes, np.uint64))
        for turn in range(500):
            order = np.argsort(place, kind="stable")
            own = place[order]
            new = np.concatenate(([True], own[1:] != own[:-1]))
            nth = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
            free = np.cumsum(cells[own] == 0, axis=1)
            fits = nth < free[:, -1]
            way = np.argmax(free == (nth + 1)[:, None], axis=1)
            cells[own[fits], way[fits]] = prints[order[fits]]
            left = order[~fits]
            if not len(left):
                return True
            prints, place = prints[left], place[left]
            if turn == 0:
                place = self._other(place, prints)
                continue
            # One key in each full bucket takes a place there; whose it was goes to its other bucket.
            full, first = np.unique(place, return_index=True)
            out = cells[full, turn % self.WAYS].copy()
            cells[full, turn % self.WAYS] = prints[first]
            prints[first], place[first] = out, self._other(full, out)
        self.cells = before
        return False

    def remove(self, hashes: np.ndarray) -> None:
        """Takes away one insertion of each of the keys, which were inserted."""
        left = np.asarray(hashes, np.uint64)
        while len(left):
            prints, one = self._places(left)
            both = np.stack((one, self._other(one, prints)), 1)
            there = (self.cells[both] == prints[:, None, None]).reshape(len(left), -1)
            flat = (both[:, :, None] * self.WAYS + np.arange(self.WAYS)).reshape(len(left), -1)
            hit = np.flatnonzero(there.any(1))
            cell, chosen = np.unique(flat[hit, np.argmax(there[hit], axis=1)], return_index=True)
            if not len(cell):
                return
            self.cells.reshape(-1)[cell] = 0
            left = np.delete(left, hit[chosen])

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        prints, one = self._places(hashes)
        return (self.cells[one] == prints[:, None]).any(1) | (self.cells[self._other(one, prints)] == prints[:, None]).any(1)


@dataclass(frozen=True)
class LineIndex:
    """references (the exact table, distinct rows), filters (a row for each shard: shard, cells) and what they were made with."""

    references: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int
    min_docs: int


def _shard(shards: int) -> Column:
    return F.pmod("k1", F.lit(shards)).cast("long").alias("shard")


def filters(repeated: DataFrame, shards: int) -> DataFrame:
    """One cuckoo filter per shard over the repeated keys (k1, k2)."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "cells": [CuckooFilter(rows["k2"].to_numpy().view(np.uint64)).cells.tobytes()]})

    return repeated.select(_shard(shards), "k2").groupBy("shard").applyInPandas(build, FILTERS)


def _maybe_repeated(lines: DataFrame, index: LineIndex) -> DataFrame:
    """The rows of lines (with k1, k2) whose key a filter may hold."""
    if (index.filters.agg(F.sum(F.octet_length("cells").cast("long"))).first()[0] or 0) > FILTER_BYTES:
        return _dealt(lines, index)
    sent = lines.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["cells"]) for r in index.filters.collect()})  # FILTER_BYTES at most
    shards = index.shards

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {shard: CuckooFilter(cells=cells) for shard, cells in sent.value.items()}
        for rows in batches:
            k2, shard = rows["k2"].to_numpy().view(np.uint64), np.mod(rows["k1"].to_numpy(), shards)
            passed = np.zeros(len(rows), bool)
            order = np.argsort(shard, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if len(own) and shard[own[0]] in held:
                    passed[own] = held[shard[own[0]]].may_hold(k2[own])
            yield rows[passed]

    return lines.mapInPandas(probe, lines.schema)


def _dealt(lines: DataFrame, index: LineIndex) -> DataFrame:
    """As _maybe_repeated, with lines and filters brought together by shard; a shard's lines are dealt to groups of about SHARD_LINES, each with a copy of its filter."""
    sizes = lines.groupBy(_shard(index.shards)).agg(F.ceil(F.count("*") / SHARD_LINES).cast("int").alias("groups"))  # a row for each shard
    rows = lines.withColumn("shard", _shard(index.shards)).join(F.broadcast(sizes), "shard").withColumn("group", F.pmod(F.xxhash64("doc", "row", "pos"), F.col("groups")).cast("int")).drop("groups")
    columns = lines.columns
    held = index.filters.join(F.broadcast(sizes), "shard").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")

    def probe(key: tuple, rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        rows = rows[columns]
        if not len(rows) or not len(held):
            return rows.iloc[:0]
        return rows[CuckooFilter(cells=held["cells"].iloc[0]).may_hold(rows["k2"].to_numpy().view(np.uint64))]

    return rows.groupBy("shard", "group").cogroup(held.groupBy("shard", "group")).applyInPandas(probe, lines.schema)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, index: LineIndex | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents without their repeated lines: doc_id, text (as given), kept (the rest, joined by \\n), n_lines, n_dropped.

    A line goes if its key has at least min_chars code points, at least
    min_docs documents hold it and another document with a larger doc_id is
    its keeper. index is what to count in; by default that of docs.
    carry names columns of docs to carry along.
    """
    if index is None:
        repeated = written(counts(references(docs, min_chars), min_docs), "repeated-lines")
        shards = max(SHARDS, -(-repeated.count() // SHARD_KEYS))
        index = LineIndex(references(docs, min_chars), written(filters(repeated, shards), "filters"), shards, min_chars, min_docs)
    else:
        repeated = written(counts(index.references, index.min_docs), "repeated-lines")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *carry)
    row = F.xxhash64("text")
    split = F.split(F.col("text"), "\n", -1)
    lines = own.select("doc_id", row.alias("row"), F.posexplode(split).alias("pos", "line")).withColumn("key", key_of(F.col("line"))).where(F.length("key") >= index.min_chars)
    lines = lines.select(F.coalesce("doc_id", F.lit(-1)).alias("doc"), F.col("doc_id").isNull().alias("no_id"), "row", "pos", *_named(F.col("key")))
    found = _maybe_repeated(lines, index).join(repeated, ["k1", "k2"])
    goes = found.where(F.col("no_id") | (F.col("doc") != F.col("keeper")))
    dropped = goes.groupBy("doc", "no_id", "row").agg(F.collect_set("pos").alias("gone"))
    joined = own.withColumns({"doc": F.coalesce("doc_id", F.lit(-1)), "no_id": F.col("doc_id").isNull(), "row": row}).join(dropped, ["doc", "no_id", "row"], "left")
    n_lines = F.size(split)
    stays = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stays, lambda i: F.get(split, i)), "\n"))
    return joined.select("doc_id", *carry, "text", kept.alias("kept"), n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
