"""Places of rows in one order over a whole table, without a task that holds the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources import store

#: Rows of a range, about: the number of ranges grows with the table.
RANGE_ROWS = 200_000
#: monotonically_increasing_id has the partition above these bits, and the row's place in it below.
_LOW = 33


def numbered(rows: DataFrame, key: Column, place: str = "place", ranges: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """rows with their place (from 1) in the order of a key, which must be distinct; with by, inside each group of these columns.

    Rows are dealt to ranges of the key and sorted in them; a row's place is that
    in its range, moved by the sizes of the ranges before. Ranges are written, as
    places must be those of one dealing. One number a range comes to the driver.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("_key", F.struct(*by, key.alias("_own")))
    ranges = ranges or max(1, -(-keyed.count() // RANGE_ROWS))
    dealt = keyed.repartitionByRange(ranges, "_key").sortWithinPartitions("_key").withColumn("_at", F.monotonically_increasing_id())
    path = store.scratch_root(spark, "ranges")
    dealt.write.parquet(path)
    back = spark.read.schema(dealt.schema).parquet(path).withColumns({"_range": F.shiftright("_at", _LOW), "_inside": F.col("_at").bitwiseAND((1 << _LOW) - 1)})
    before, sums = 0, []
    for r in back.groupBy("_range").count().orderBy("_range").collect():
        sums.append((r["_range"], before))
        before += r["count"]
    moved = back.join(F.broadcast(spark.createDataFrame(sums, "_range long, _before long")), "_range").withColumn("_place", F.col("_before") + F.col("_inside") + 1)
    if by:
        # A group's rows are neighbours, so its places begin at its least one.
        firsts = moved.groupBy(*by).agg(F.min("_place").alias("_first"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        moved = moved.join(firsts.select(*[F.col(c).alias(f"_{c}") for c in by], "_first"), same).withColumn("_place", F.col("_place") - F.col("_first") + 1)
    return moved.select(*[F.col(f"`{c}`") for c in rows.columns if c != place], F.col("_place").cast("long").alias(place))


def not_contiguous(rows: DataFrame, group: Sequence[str], position: str, first: int = 0) -> DataFrame:
    """Groups whose positions aren't first, first + 1, ... each once: told by their number, their ends and that none comes twice."""
    once = rows.groupBy(*group, position).agg(F.count("*").alias("_n"))
    told = once.groupBy(*group).agg(F.count("*").alias("_places"), F.max("_n").alias("_most"), F.min(position).alias("_low"), F.max(position).alias("_high"), F.count_if(F.col(position).isNull()).alias("_none"))
    fine = (F.col("_none") == 0) & (F.col("_most") == 1) & (F.col("_low") == first) & (F.col("_high") == first + F.col("_places") - 1)
    return told.where((F.col("_places") > 0) & ~F.coalesce(fine, F.lit(False))).select(*group)
