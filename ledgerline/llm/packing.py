"""Packing of documents into training sequences: shortest pack first over the histogram of piece lengths.

A document is its token ids and an end id. It is cut into full sequences and
one remainder, so every piece is at most `capacity` long. Only the histogram
of piece lengths (at most `capacity` numbers, whatever the corpus) reaches the
driver, which counts packing patterns; patterns go back to the pieces by each
piece's rank among those of its length. Full pieces are sequences of their own
and need no rank.

Defined cases: null text is empty and is packed as its end id alone; repeated
rows are packed as often as they occur; a null doc_id is kept; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import loaded
from .shared import text_or_empty, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Pieces of one length are ranked in groups of about this many rows, and groups in blocks of so many.
RANK_GROUP = 1_000


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Every document's pieces of at most capacity ids: doc_id, start, length, ids_crc32, doc_tokens (and ids)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(tokenizer)
        for batch in batches:
            doc_ids, starts, lengths, crcs, totals, own = [], [], [], [], [], []
            for k in range(0, len(batch), 256):
                part = batch.iloc[k : k + 256]
                for doc_id, ids in zip(part["doc_id"], bpe.ids(part["text"].tolist()), strict=True):
                    ids = np.append(ids.astype("<u4"), np.uint32(end_id))
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        doc_ids.append(doc_id)
                        starts.append(start)
                        lengths.append(len(piece))
                        crcs.append(zlib.crc32(piece.tobytes()))
                        totals.append(len(ids))
                        if with_ids:
                            own.append(piece.astype(np.int32))
            yield pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "start": starts, "length": lengths, "ids_crc32": crcs, "doc_tokens": totals} | ({"ids": own} if with_ids else {}))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # Nullable integers keep ids exact where some are null.
    rows = rows.select("doc_id", "text") if not with_ids else rows
    return rows.mapInPandas(_exact_ids(cut), PIECES + (", ids array<int>" if with_ids else ""))


def _exact_ids(cut):
    """Reads doc_id as text, since pandas would make floats of longs beside nulls."""

    def run(batches):
        return cut(b.assign(doc_id=[None if pd.isna(x) else int(x) for x in b["doc_id"]]) for b in batches)

    return run


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Packing patterns and how often each is used.

    Lengths go in longest first, each into the shortest pack that can take it
    (so the emptiest), in bulk by counts; packs are split where fewer of a
    length are left than packs. Piece by piece, a new pack would be begun only
    where none has room, and would then be the only one with room for the next
    piece of its length: so new packs are filled with copies of that length.
    """
    open_packs: dict[int, list[tuple[int, list[int]]]] = {}  # space left: (count, lengths)
    done: list[tuple[list[int], int]] = []
    for length in range(capacity, 0, -1):
        left = histogram.get(length, 0)
        while left:
            space = max((s for s, packs in open_packs.items() if packs and s >= length), default=0)
            if space:
                count, lengths = open_packs[space].pop()
                used = min(count, left)
                if count > used:
                    open_packs[space].append((count - used, lengths))
                grown = [*lengths, length]
                rest = space - length
            else:
                fit = max(1, min(capacity // length, left))
                used_packs = max(1, left // fit)
                used, grown, rest = fit * used_packs, [length] * fit, capacity - fit * length
                (open_packs.setdefault(rest, []) if rest else done).append((used_packs, grown) if rest else (grown, used_packs))
                left -= used
                continue
            (open_packs.setdefault(rest, []) if rest else done).append((used, grown) if rest else (grown, used))
            left -= used
    return done + [(lengths, count) for packs in open_packs.values() for count, lengths in packs]


def slots_of(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, offset in the sequence, first sequence) for each place of each pattern."""
    rank: dict[int, int] = {}
    slots, sequence = [], 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            first = rank.get(length, 0)
            slots.append((length, first, count, offset, sequence))
            rank[length] = first + count
            offset += length
        sequence += count
    return slots


def ranked(rows: DataFrame, histogram: list[tuple[int, int]]) -> DataFrame:
    """rows with their rank (from 0) among those of their length, also where one length has most rows.

    A length's rows are dealt to groups by hash, ranked within the group, and
    moved by the sizes of the groups before. Groups are summed in blocks, so no
    task needs all rows or all groups of a length: a thousand million rows of
    one length are a thousand blocks.
    """
    spark = rows.sparkSession
    groups = spark.createDataFrame([(n, -(-c // RANK_GROUP)) for n, c in histogram], "length long, groups long")
    dealt = rows.join(F.broadcast(groups), "length").withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("groups"))).drop("groups")
    sizes = dealt.groupBy("length", "group").agg(F.count("*").alias("size")).withColumn("block", F.floor(F.col("group") / RANK_GROUP))
    blocks = sizes.groupBy("length", "block").agg(F.sum("size").alias("whole"))
    blocks = blocks.withColumn("earlier", F.sum("whole").over(Window.partitionBy("length").orderBy("block")) - F.col("whole")).drop("whole")
    before = sizes.withColumn("before", F.sum("size").over(Window.partitionBy("length", "block").orderBy("group")) - F.col("size"))
    before = before.join(blocks, ["length", "block"]).select("length", "group", (F.col("before") + F.col("earlier")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "start", "ids_crc32")) - 1
    return dealt.withColumn("inside", inside).join(before, ["length", "group"]).withColumn("rank", F.col("before") + F.col("inside")).drop("group", "inside", "before")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    # At most `capacity` rows.
    histogram = [(r["length"], r["count"]) for r in cut.where(F.col("length") < capacity).groupBy("length").count().collect()]
    patterns = shortest_pack_first(dict(histogram), capacity)
    # Every pattern but a few per length is full or starts at its own length: at most some thousand rows at any input size.
    places = spark.createDataFrame(slots_of(patterns), "length long, first long, ranks long, offset long, sequence long")
    where = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("ranks"))
    part = cut.where(F.col("length") < capacity)
    placed = ranked(part, histogram).join(F.broadcast(places.withColumnRenamed("length", "slot_length")), (F.col("length") == F.col("slot_length")) & where)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = placed.select(*columns, (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
    # A full piece's number comes from where it is stored, after those of the patterns.
    own = F.lit(sum(count for _, count in patterns)) + F.monotonically_increasing_id()
    return placed.unionByName(cut.where(F.col("length") == capacity).select(*columns, own.alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def sequences(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (padded to capacity unless their number is a power of two), doc_ids."""
    placed = pack(docs, tokenizer, capacity, end_id)
    own = pieces(docs, tokenizer, capacity, end_id, with_ids=True).select(F.col("doc_id").alias("d"), F.col("start").alias("s"), F.col("ids_crc32").alias("c"), "ids").dropDuplicates(["d", "s", "c"])
    joined = placed.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("start") == F.col("s")) & (F.col("ids_crc32") == F.col("c")))
    # A sequence has at most capacity ids, so its group is small.
    grouped = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    used = F.size(ids)
    whole = F.conv(F.bin(used), 2, 10).isNotNull() & (F.bit_count(used) == 1)
    return grouped.select("sequence_id", F.when(whole, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(capacity) - used))).alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
