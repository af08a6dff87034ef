"""Postings kept in releases: a full page is written once, and an append writes the open pages of its terms.

A page is one row, term and page with its names in order. A term's head says how
many names it has. A withdrawal numbers a term's names again from the first page
that loses one, so the pages before it stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators import search
from ledgerline.operators.attest import listing_width
from ledgerline.sources import store
from ledgerline.sources.store import Surface

PAGES = Surface("postings", ("term", "page"))
HEADS = Surface("heads", ("term",))
_PAGE, _HEAD = "term string, page long, names array<string>", "term string, results long"


def _page_rows(ranked: DataFrame, name: str) -> DataFrame:
    """Pages as rows, from term, page, rank, name; a page has a bounded number of names."""
    names = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(name).alias("name")))), lambda x: x["name"])
    return ranked.groupBy("term", "page").agg(names.alias("names"))


def _read(spark: SparkSession, root: str, surface: Surface, keys: DataFrame, last: dict | None) -> DataFrame:
    rows = store.read(spark, root, surface, keys, last) if last else None
    return rows if rows is not None else spark.createDataFrame([], _PAGE if surface is PAGES else _HEAD)


def appended(spark: SparkSession, root: str, term_rows: DataFrame, name: str, page_size: int = search.PAGE_SIZE, replace: bool = False) -> dict:
    """One release more, of names that come after all that are there: their terms' open pages, the pages they fill, and heads."""
    last = None if replace else store.head(spark, root)
    # A row a term, written as it is asked for several times.
    new = store.kept(term_rows.groupBy("term").agg(F.count("*").alias("n")), "postings-new")
    held = _read(spark, root, HEADS, new, last)
    opened = held.where(F.col("results") % page_size > 0).select("term", F.floor(F.col("results") / page_size).cast("long").alias("page"))
    before = _read(spark, root, PAGES, opened, last).select("term", "page", F.col("names").alias("_before"))
    pages = _page_rows(search.appended(held, term_rows, name, page_size), name).join(before, ["term", "page"], "left")
    pages = pages.select("term", "page", F.concat(F.coalesce("_before", F.array().cast("array<string>")), "names").alias("names"))
    heads = new.join(held, "term", "left").select("term", (F.coalesce("results", F.lit(0)) + F.col("n")).cast("long").alias("results"))
    # How many pages there are follows from the counts, so nothing is made only to be counted.
    told = None if last else new.agg(F.count("*").alias("terms"), F.sum(F.ceil(F.col("n") / page_size)).alias("pages")).first()
    width = told and {PAGES: listing_width(int(told["pages"] or 0), store.PART_ROWS), HEADS: listing_width(told["terms"], store.PART_ROWS)}
    return store.publish(spark, root, {PAGES: pages, HEADS: heads}, replace=replace, based_on=last, width=width)


def withdrawn(spark: SparkSession, root: str, gone: DataFrame, name: str, page_size: int = search.PAGE_SIZE) -> dict:
    """One release more without the names of gone (term, name): each term's pages from the first that loses one; a term or page that is left with none goes."""
    last = store.head(spark, root)
    held = _read(spark, root, HEADS, gone.select("term").distinct(), last).where(F.col("results") > 0)
    every = held.select("term", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("results") - 1) / page_size).cast("long"))).alias("page"))
    there = _read(spark, root, PAGES, every, last)
    # A page that loses names, with what is left of it; met by its names once, and written.
    named = there.select("term", "page", F.posexplode("names").alias("_place", name))
    lost = store.kept(named.join(gone.select("term", name).distinct(), ["term", name], "left_semi").groupBy("term", "page").agg(F.collect_list(name).alias("_gone")), "postings-lost")
    first = store.kept(lost.groupBy("term").agg(F.min("page").alias("_first"), F.sum(F.size("_gone")).alias("_lost")), "postings-first")
    left = there.join(lost, ["term", "page"], "left").withColumn("names", F.when(F.col("_gone").isNull(), F.col("names")).otherwise(F.filter("names", lambda x: ~F.array_contains("_gone", x))))
    # A name's new place follows from those left on the pages before its own: one number a page, no sort of names.
    sizes = store.kept(left.select("term", "page", F.size("names").alias("_n")).join(first, "term").where("page >= _first").select("term", "page", "_n", "_first"), "postings-sizes")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("term").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = left.join(sizes.select("term", "page", (F.col("_first") * page_size + before).alias("_before")), ["term", "page"]).select("term", "_before", F.posexplode("names").alias("_place", name))
    rank = (F.col("_before") + F.col("_place")).cast("long")
    again = moved.select("term", F.floor(rank / page_size).cast("long").alias("page"), rank.alias("rank"), name)
    heads = held.join(first, "term").select("term", (F.col("results") - F.col("_lost")).cast("long").alias("results"))
    over = every.join(heads, "term").where(F.col("page") * page_size >= F.col("results")).select("term", "page", F.array().cast("array<string>").alias("names"), F.lit(True).alias("gone"))
    pages = _page_rows(again, name).withColumn("gone", F.lit(False)).unionByName(over)
    return store.publish(spark, root, {PAGES: pages, HEADS: heads.withColumn("gone", F.col("results") == 0)}, based_on=last)


def rows(spark: SparkSession, root: str, page_size: int = search.PAGE_SIZE) -> DataFrame:
    """All postings as rows: term, page, rank, name."""
    pages = store.read(spark, root, PAGES)
    return pages.select("term", "page", F.posexplode("names").alias("_place", "name")).select("term", "page", (F.col("page") * page_size + F.col("_place")).cast("long").alias("rank"), "name")
