"""Queries over tables that are kept in releases: built from a part of the records, moved on by batches, read back; each held against the SQL of a full build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import search, stored_postings, surfaces
from ledgerline.plans.base import RECORDS, query
from ledgerline.plans.collections import CODES_SQL, PAGE, PAGES_SQL
from ledgerline.plans.search import TERMS, _docs
from ledgerline.plans.upkeep import BATCH
from ledgerline.sources import store
from ledgerline.sources.views import PREFIX, records

_COLUMNS = ("id", "version", "registered_at", "brand", "type", "repository", "withdrawn")


def _moved_on(spark: SparkSession, d: str) -> str:
    """A store of the records before the batch, and the batch."""
    root = store.scratch_root(spark, "surfaces")
    versions = records(spark, d).select(*_COLUMNS, "serial")
    surfaces.appended(spark, root, versions.where(f"not ({BATCH})").drop("serial"), PREFIX, PAGE, replace=True)
    surfaces.appended(spark, root, versions.where(BATCH).drop("serial"), PREFIX, PAGE)
    return root


@query(PAGES_SQL + "select day, page, results, versions from pg")
def stored_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages after a batch that read and wrote only the results, pages and days that it touches."""
    return store.read(spark, _moved_on(spark, d), surfaces.PAGES)


@query(PAGES_SQL + "select day, first_page, last_page, results, versions from dy")
def stored_days(spark: SparkSession, d: str) -> DataFrame:
    return store.read(spark, _moved_on(spark, d), surfaces.DAYS)


@query(CODES_SQL + ", n as (select k.kind as kind, k.code as code, count(*) as results from cc group by all) select kind, code, results, rank, id, version from (select k.kind as kind, k.code as code, rank, id, version from front) join n using (kind, code)")
def stored_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Front lists of codes after a batch, from the lists before it."""
    rows = store.read(spark, _moved_on(spark, d), surfaces.CODES)
    return rows.select("kind", "code", "results", F.posexplode("list").alias("place", "x")).select("kind", "code", "results", (F.col("place") + 1).cast("long").alias("rank"), "x.id", "x.version")


@query(RECORDS + ", l as (select repository, id, count(*) over (partition by repository) as total, row_number() over (partition by repository order by id desc) as rank from cur) select repository, total, total > 500 as truncated, rank, id from l where rank <= 500")
def stored_repositories(spark: SparkSession, d: str) -> DataFrame:
    rows = store.read(spark, _moved_on(spark, d), surfaces.REPOSITORIES)
    return rows.select("repository", F.col("results").alias("total"), (F.col("results") > surfaces.LISTED).alias("truncated"), F.posexplode("list").alias("place", "x")).select("repository", "total", "truncated", (F.col("place") + 1).cast("long").alias("rank"), "x.id")


@query(CODES_SQL + f""", b as (select distinct id from r where {BATCH}), before as (select * from r where not ({BATCH})), was as (select * from before where not withdrawn qualify row_number() over (partition by id order by version desc) = 1),
two as (select * from was where id in (select id from b) union all select * from cur where id in (select id from b))
select 'results' as surface, count(*) as n from b union all select 'pages', count(distinct (substr(id, 5, 10), (substr(id, 16)::int - 1) // {PAGE})) from b union all select 'days', count(distinct substr(id, 5, 10)) from b
union all select 'repositories', count(distinct repository) from two union all select 'codes', count(distinct (kind, code)) from (select unnest([{{'kind': 'brand', 'code': brand}}, {{'kind': 'type', 'code': type}}], recursive := true) from two)""")
def append_cost(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the batch's release wrote in each table: one for each key that it touches."""
    written = store.head(spark, _moved_on(spark, d))["written"]
    return spark.createDataFrame([(name, told["rows"]) for name, told in written.items()], "surface string, n long")


def _posted(spark: SparkSession, d: str) -> str:
    """Postings in three releases: documents before the batch, the batch, and without what is withdrawn."""
    root = store.scratch_root(spark, "postings")
    # Names of a batch come after all that are there.
    docs = _docs(spark, d).withColumn("name", F.concat(F.when(F.col("doc_id") % 10 == 0, "NEW-").otherwise("DOC-"), F.substring("name", 5, 8)))
    terms = lambda where: search.terms(docs.where(where), "name", "text")
    stored_postings.appended(spark, root, terms("doc_id % 10 <> 0"), "name", replace=True)
    stored_postings.appended(spark, root, terms("doc_id % 10 = 0"), "name")
    stored_postings.withdrawn(spark, root, terms("doc_id % 10 = 1"), "name")
    return root


@query(TERMS + ", l as (select term, case when doc_id % 10 = 0 then 'NEW-' else 'DOC-' end || substr(name, 5) as name from tm where doc_id % 10 <> 1), p as (select term, name, row_number() over (partition by term order by name) - 1 as rank from l) select term, rank // 128 as page, rank, name from p")
def stored_posting_pages(spark: SparkSession, d: str) -> DataFrame:
    """Postings after an append that wrote open pages, and a withdrawal that numbered again from the first page that lost a name."""
    return stored_postings.rows(spark, _posted(spark, d))


@query(TERMS + "select term, count(*) as results from tm where doc_id % 10 <> 1 group by term")
def stored_term_heads(spark: SparkSession, d: str) -> DataFrame:
    return store.read(spark, _posted(spark, d), stored_postings.HEADS)
