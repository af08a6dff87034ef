"""Queries over text records: words, postings and their upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import STOPWORDS
from ledgerline.operators import search
from ledgerline.plans.base import query
from ledgerline.sources.views import table

STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)
TERMS = f"""
with d as (select 'DOC-' || lpad(doc_id::varchar, 8, '0') as name, doc_id, lower(strip_accents(coalesce(text, ''))) as f from documents),
tm as (select distinct name, doc_id, term from (select name, doc_id, unnest(string_split_regex(f, '[^a-z0-9]+')) as term from d)
  where length(term) between 2 and 32 and term not in ({STOP_SQL})),
ps as (select term, name, doc_id, row_number() over (partition by term order by name) - 1 as rank from tm)
"""


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.concat(F.lit("DOC-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("name"), "doc_id", "text")


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return search.terms(_docs(spark, d), "name", "text")


@query(TERMS + "select name, term from tm")
def tokens(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d)


@query(TERMS + "select term, rank // 128 as page, rank, name from ps")
def postings(spark: SparkSession, d: str) -> DataFrame:
    return search.postings(_terms(spark, d), "name")


@query(TERMS + "select term, count(*) as results, ceil(count(*) / 128)::bigint as pages from tm group by term")
def term_heads(spark: SparkSession, d: str) -> DataFrame:
    return search.heads(_terms(spark, d))


@query(TERMS + "select name as entity, count(*) as n, 'terms' as rule from tm group by name having count(*) > 300 union all select term, ceil(count(*) / 128)::bigint, 'pages' from tm group by term having ceil(count(*) / 128) > 2")
def term_caps(spark: SparkSession, d: str) -> DataFrame:
    """Caps of 300 terms and 2 pages, as the tables are small."""
    return search.caps(_terms(spark, d), "name", 300, 2)


@query("select unnest([" + STOP_SQL + "]) as word, n from (select count(*) as n from documents where text is not null)")
def stopwords(spark: SparkSession, d: str) -> DataFrame:
    """The words that are never indexed, with the size of the corpus they were kept out of."""
    words = spark.createDataFrame([(w,) for w in STOPWORDS], "word string")
    return words.join(_docs(spark, d).where("text is not null").agg(F.count("*").alias("n")), how="cross")


@query(TERMS + ", h as (select term, count(*) as held from tm where doc_id % 10 <> 0 group by term), n as (select term, name, row_number() over (partition by term order by name) - 1 as r from tm where doc_id % 10 = 0) select n.term, (coalesce(held, 0) + r) // 128 as page, coalesce(held, 0) + r as rank, name from n left join h using (term)")
def patched_postings(spark: SparkSession, d: str) -> DataFrame:
    """What a batch (every tenth document) adds to the postings of the others."""
    docs = _docs(spark, d)
    held = search.heads(search.terms(docs.where("doc_id % 10 <> 0"), "name", "text"))
    return search.appended(held, search.terms(docs.where("doc_id % 10 = 0"), "name", "text"), "name")


@query(TERMS + ", g as (select distinct term from tm where doc_id % 10 = 1), l as (select term, name, row_number() over (partition by term order by name) - 1 as rank from tm where doc_id % 10 <> 1 and term in (select term from g)) select term, rank // 128 as page, rank, name from l")
def postings_after_withdrawal(spark: SparkSession, d: str) -> DataFrame:
    """The touched terms once every tenth document is withdrawn."""
    gone = _docs(spark, d).where("doc_id % 10 = 1").select("name")
    return search.removed(_terms(spark, d), gone, "name")


@query(TERMS + ", hd as (select term, count(*) + (case when length(term) = 5 then 1 else 0 end) as results, ceil(count(*) / 128)::bigint as pages, count(*) as held from tm group by term) select term, 'head' as rule from hd where results <> held")
def posting_rules(spark: SparkSession, d: str) -> DataFrame:
    """Violations where the heads of five-letter terms claim one result too many."""
    rows = _terms(spark, d)
    heads = search.heads(rows).withColumn("results", F.col("results") + F.when(F.length("term") == 5, 1).otherwise(0))
    return search.contract(search.postings(rows, "name"), heads, "name")
