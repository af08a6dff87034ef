"""Postings of text records: per term, pages of record names in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.sources import store

PAGE_SIZE, MAX_TERMS, MAX_PAGES = 128, 4_000, 2_048


def terms(docs: DataFrame, name: str, body: str) -> DataFrame:
    """name and term of every document, each term once; rows with unusual characters are folded in Python, the rest by expressions."""
    rows = docs.select(name, F.coalesce(F.col(body), F.lit("")).alias("_body"))
    # One scan: Python gets a null for every text that expressions can fold.
    rows = rows.withColumn("_wide", F.when(text.needs_wide_fold(F.col("_body")), F.col("_body")))
    folded = rows.withColumn("f", F.coalesce(text.wide_fold(F.col("_wide")), text.fold(F.col("_body"))))
    return folded.select(name, F.explode(text.words(F.col("f"))).alias("term"))


def postings(term_rows: DataFrame, name: str, page_size: int = PAGE_SIZE, first_rank: DataFrame | None = None) -> DataFrame:
    """term, page, rank and name: names in order within a term, page_size on a page, counted from 0.

    No task needs all names of a term: names of a common beginning are ranked
    together, and moved by the number of names before. Names must have one
    length, or none may begin another's range.
    first_rank (term, results) is what terms hold already; new names follow.
    """
    grouped = term_rows.select("term", name, _range(F.col(name)).alias("range"))
    sizes = grouped.groupBy("term", "range").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", _sizes_before()).drop("size")
    inside = F.row_number().over(Window.partitionBy("term", "range").orderBy(name)) - 1
    ranked = grouped.withColumn("inside", inside).join(before, ["term", "range"]).withColumn("rank", F.col("before") + F.col("inside"))
    if first_rank is not None:
        ranked = ranked.join(first_rank.select("term", F.col("results").alias("_held")), "term", "left").withColumn("rank", F.col("rank") + F.coalesce("_held", F.lit(0)))
    return ranked.select("term", F.floor(F.col("rank") / page_size).cast("long").alias("page"), F.col("rank").cast("long").alias("rank"), name)


def _range(name: Column) -> Column:
    """A name without its last five characters: ranges are in the names' order where names have one length, as record names do.

    One has 100,000 numbered names at most, which a task can sort, and a term as many ranges as there are hundred thousands of records: far fewer than names.
    """
    return F.substring(name, 1, F.length(name) - 5)


def _sizes_before() -> Column:
    return F.coalesce(F.sum("size").over(Window.partitionBy("term").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def heads(term_rows: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """term, results and pages."""
    return term_rows.groupBy("term").agg(F.count("*").alias("results")).withColumn("pages", F.ceil(F.col("results") / page_size).cast("long"))


def caps(term_rows: DataFrame, name: str, max_terms: int = MAX_TERMS, max_pages: int = MAX_PAGES, page_size: int = PAGE_SIZE) -> DataFrame:
    """Violations: records with too many terms, terms with too many pages."""
    per_record = term_rows.groupBy(F.col(name).alias("entity")).agg(F.count("*").alias("n")).where(F.col("n") > max_terms).withColumn("rule", F.lit("terms"))
    per_term = heads(term_rows, page_size).select(F.col("term").alias("entity"), F.col("pages").alias("n")).where(F.col("n") > max_pages).withColumn("rule", F.lit("pages"))
    return per_record.unionByName(per_term)


def appended(prior_heads: DataFrame, new_terms: DataFrame, name: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Posting rows that a batch adds: they follow what a term holds, so sealed pages stay as they are."""
    return postings(new_terms, name, page_size, prior_heads)


def removed(term_rows: DataFrame, gone: DataFrame, name: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """All postings of the terms that withdrawn records had, closed up and numbered again; a term with none left disappears."""
    # Written with their marks, so terms are made and met with what is gone once, and the shuffle by name is gone before that by term.
    marked = term_rows.select("term", name).join(gone.select(name, F.lit(True).alias("_gone")).distinct(), name, "left").select("term", name, _range(F.col(name)).alias("range"), F.col("_gone").isNotNull().alias("_gone"))
    marked = store.kept(marked, "postings-marked")
    sizes = marked.groupBy("term", "range").agg(F.count_if(~F.col("_gone")).alias("size"), F.count_if("_gone").alias("_lost"))
    before = sizes.withColumns({"before": _sizes_before(), "_lost": F.sum("_lost").over(Window.partitionBy("term"))}).where("_lost > 0").select("term", "range", "before")
    inside = F.row_number().over(Window.partitionBy("term", "range").orderBy(name)) - 1
    ranked = marked.where("not _gone").select("term", "range", name).withColumn("inside", inside).join(before, ["term", "range"]).withColumn("rank", (F.col("before") + F.col("inside")).cast("long"))
    return ranked.select("term", F.floor(F.col("rank") / page_size).cast("long").alias("page"), "rank", name)


def contract(posting_rows: DataFrame, head_rows: DataFrame, name: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Violations of what readers rely on: pages follow from results, are no larger than page_size, hold distinct names in order."""
    counted = posting_rows.groupBy("term", "page").agg(F.count("*").alias("n"), F.count_distinct(name).alias("names"))
    size = counted.where((F.col("n") > page_size) | (F.col("n") != F.col("names"))).select("term", F.lit("page").alias("rule"))
    held = posting_rows.groupBy("term").agg(F.count("*").alias("held"), F.max("page").alias("last"))
    both = head_rows.join(held, "term", "full_outer")
    head = both.where(~(F.col("results").eqNullSafe(F.col("held")) & F.col("pages").eqNullSafe(F.col("last") + 1))).select("term", F.lit("head").alias("rule"))
    return size.unionByName(head)
