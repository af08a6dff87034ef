"""Paged collections: pages of a day, days of a year, years of the whole; for one collection or one per code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import coordinate


def placed(rows: DataFrame, prefix: str, page_size: int) -> DataFrame:
    """rows with year, day and page, a closed form of the identifier."""
    where = coordinate(F.col("id"), prefix, page_size)
    return rows.withColumn("c", where).drop("day").select("*", "c.year", "c.day", "c.page").drop("c")


def pages(ever: DataFrame, rows: DataFrame, prefix: str, page_size: int = 200, by: Sequence[str] = ()) -> DataFrame:
    """Per page: distinct results and versions among rows. A page that some record of `ever` was on stays, with 0."""
    keys = [*by, "year", "day", "page"]
    seeds = placed(ever, prefix, page_size).select(*keys, F.lit(None).cast("string").alias("id"))
    now = placed(rows, prefix, page_size).select(*keys, "id")
    # Results are counted before the pages meet: an id has one page.
    per_id = seeds.unionByName(now).groupBy(*keys, "id").agg(F.count("id").alias("n"))
    return per_id.groupBy(*keys).agg(F.count("id").alias("results"), F.sum("n").alias("versions"))


def days(page_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return page_rows.groupBy(*by, "year", "day").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.sum("results").alias("results"), F.sum("versions").alias("versions"))


def years(day_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return day_rows.groupBy(*by, "year").agg(F.count("*").alias("days"), F.sum("results").alias("results"), F.sum("versions").alias("versions"))


def head(year_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return year_rows.groupBy(*by).agg(F.count("*").alias("years"), F.sum("days").alias("days"), F.sum("results").alias("results"), F.sum("versions").alias("versions"))


def write_pages(rows: DataFrame, path: str, prefix: str, page_size: int = 200) -> None:
    """One folder per day and page; rows of a page lie in one file, in order."""
    placed(rows, prefix, page_size).repartition("day", "page").sortWithinPartitions("day", "page", "id", "version").write.mode("overwrite").partitionBy("day", "page").parquet(path)


def missing_pages(page_rows: DataFrame, day_rows: DataFrame) -> DataFrame:
    """Pages that a day names but that are not there."""
    named = day_rows.select("day", F.explode(F.sequence("first_page", "last_page")).alias("page"))
    return named.join(page_rows.select("day", "page"), ["day", "page"], "left_anti")


def moved_counts(before: DataFrame, after: DataFrame, prior_days: DataFrame) -> DataFrame:
    """Day counts moved by the difference between two states of the touched pages only."""
    change = after.select("day", "results", "versions").unionByName(before.select("day", (-F.col("results")).alias("results"), (-F.col("versions")).alias("versions")))
    whole = prior_days.select("day", "results", "versions").unionByName(change)
    return whole.groupBy("day").agg(F.sum("results").alias("results"), F.sum("versions").alias("versions"))
