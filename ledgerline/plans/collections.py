"""Queries over record versions: current records, pages, codes, cards and feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import cards, pages, select
from ledgerline.plans.base import RECORDS, query
from ledgerline.sources.views import PREFIX, instant, records, table, takedowns

#: Sixteen orders a day would never fill a page of 200.
PAGE = 4
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def active(spark: SparkSession, d: str) -> DataFrame:
    """Active versions. In these tables a withdrawal is a mark on its record, so a filter finds them in one pass; active_index shows the anti join with a table of withdrawals."""
    return records(spark, d).where("not withdrawn")


def current(spark: SparkSession, d: str) -> DataFrame:
    return select.latest_versions(active(spark, d))


@query(RECORDS + f"select id, version, title, strftime(registered_at, {ISO}) as registered from cur")
def latest_versions(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d).select("id", "version", "title", instant(F.col("registered_at")).alias("registered"))


@query(RECORDS + f"""select id, version, n.versions, title, 'entries/' || id || '-v' || version || '.json' as path, strftime(registered_at, {ISO}) as published_at,
  brand, type, repository, project_path, commit_sha, owner as author
  from cur join (select id, count(*) as versions from a group by id) n using (id) order by registered_at desc, id desc limit 200""")
def recent(spark: SparkSession, d: str) -> DataFrame:
    now = active(spark, d)
    newest = select.recent(select.latest_versions(now))
    shown = cards.card(newest, now.join(newest.select("id"), "id", "left_semi"))
    return shown.select("id", "version", "versions", "title", "path", "published_at", F.col("classification.brand")[0].alias("brand"), F.col("classification.type")[0].alias("type"), "source.repository", "source.project_path", "source.commit_sha", F.col("authors")[0]["name"].alias("author"))


@query(RECORDS + "select id, version, title, 'registered' as status, 'entries/' || id || '-v' || version || '.json' as path from a")
def active_index(spark: SparkSession, d: str) -> DataFrame:
    return cards.summary(select.active(records(spark, d), takedowns(spark, d)))


@query(RECORDS + "select id, version, title, 'registered' as status, 'entries/' || id || '-v' || version || '.json' as path from r")
def public_summary(spark: SparkSession, d: str) -> DataFrame:
    return cards.summary(records(spark, d))


@query(RECORDS + f"""select id, version, submission_id, strftime(registered_at, {ISO}) as registered, title, 'registered' as status,
  'entries/' || id || '-v' || version || '.json' as path, brand || '|' || type as classification from r""")
def version_summary(spark: SparkSession, d: str) -> DataFrame:
    return cards.version_summary(records(spark, d))


@query(RECORDS + f"select id, version, title, repository, commit_sha, strftime(registered_at, {ISO}) as registered, size from r")
def entry_view(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("id", "version", "title", "repository", "commit_sha", instant(F.col("registered_at")).alias("registered"), "size")


@query(RECORDS + "select id, version, submission_id, title from r")
def result_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Results with nested versions, exploded again."""
    results = records(spark, d).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("version", "submission_id", "title"))).alias("versions"))
    return results.select("id", F.explode("versions").alias("v")).select("id", "v.*")


@query(RECORDS + """select id, string_agg(version::varchar || ':' || submission_id || ':' || title, ';' order by version) as versions,
  min(day)::varchar as first_day, count(*) as n from r group by id""")
def result_documents(spark: SparkSession, d: str) -> DataFrame:
    grouped = records(spark, d).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("version", "submission_id", "title"))).alias("v"), F.min("day").cast("string").alias("first_day"), F.count("*").alias("n"))
    return grouped.select("id", F.array_join(F.transform("v", lambda x: F.concat_ws(":", x["version"].cast("string"), x["submission_id"], x["title"])), ";").alias("versions"), "first_day", "n")


@query(RECORDS + f"select distinct id, substr(id, 5, 4) as year, substr(id, 5, 10) as day, serial, (serial - 1) // {PAGE} + 1 as page from r")
def coordinates(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("id").distinct().withColumn("c", keys.strict_coordinate(F.col("id"), PREFIX, PAGE)).select("id", "c.*")


@query(RECORDS + f"""select distinct 'browse/' || substr(id, 5, 10) || '/' || ((serial - 1) // {PAGE} + 1) || '.json' as page_path,
  'browse/' || substr(id, 5, 4) || '.json' as year_path from r""")
def page_paths(spark: SparkSession, d: str) -> DataFrame:
    c = keys.coordinate(F.col("id"), PREFIX, PAGE)
    return records(spark, d).select(F.concat(F.lit("browse/"), c["day"], F.lit("/"), c["page"], F.lit(".json")).alias("page_path"), F.concat(F.lit("browse/"), c["year"], F.lit(".json")).alias("year_path")).distinct()


PAGES_SQL = RECORDS + f""", placed as (select *, substr(id, 5, 4) as year, substr(id, 5, 10) as d, (serial - 1) // {PAGE} + 1 as page from r),
pg as (select year, d as day, page, count(distinct case when not withdrawn then id end) as results, count_if(not withdrawn)::bigint as versions from placed group by all),
dy as (select year, day, min(page) as first_page, max(page) as last_page, sum(results)::bigint as results, sum(versions)::bigint as versions from pg group by all),
yr as (select year, count(*) as days, sum(results)::bigint as results, sum(versions)::bigint as versions from dy group by all)
"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.pages(records(spark, d), active(spark, d), PREFIX, PAGE)


@query(PAGES_SQL + "select * from pg")
def browse_pages(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d)


@query(PAGES_SQL + "select * from dy")
def browse_days(spark: SparkSession, d: str) -> DataFrame:
    return pages.days(_pages(spark, d))


@query(PAGES_SQL + "select * from yr")
def browse_years(spark: SparkSession, d: str) -> DataFrame:
    return pages.years(pages.days(_pages(spark, d)))


@query(PAGES_SQL + "select count(*) as years, sum(days)::bigint as days, sum(results)::bigint as results, sum(versions)::bigint as versions from yr")
def browse_head(spark: SparkSession, d: str) -> DataFrame:
    return pages.head(pages.years(pages.days(_pages(spark, d))))


CODES_SQL = RECORDS + """, rc as (select *, unnest([{'kind': 'brand', 'code': brand}, {'kind': 'type', 'code': type}]) as k from r),
cc as (select *, unnest([{'kind': 'brand', 'code': brand}, {'kind': 'type', 'code': type}]) as k from cur),
front as (select *, row_number() over (partition by k.kind, k.code order by registered_at desc, id desc) as rank from cc qualify rank <= 50)
"""


@query(CODES_SQL + """select s.kind, s.code, coalesce(n.results, 0) as results from (select distinct k.kind as kind, k.code as code from rc) s
left join (select k.kind as kind, k.code as code, count(*) as results from cc group by all) n using (kind, code)""")
def subject_counts(spark: SparkSession, d: str) -> DataFrame:
    return select.counts_per_code(records(spark, d), current(spark, d))


@query(CODES_SQL + f""", placed as (
  select k.kind as kind, k.code as code, id, substr(id, 5, 4) as year, substr(id, 5, 10) as d, (serial - 1) // {PAGE} + 1 as page, false as now from rc
  union all select k.kind, k.code, id, substr(id, 5, 4), substr(id, 5, 10), (serial - 1) // {PAGE} + 1, true from cc
) select kind, code, year, d as day, min(page) as first_page, max(page) as last_page, count(distinct case when now then id end) as results, count_if(now)::bigint as versions from placed group by all""")
def subject_days(spark: SparkSession, d: str) -> DataFrame:
    by = ("kind", "code")
    return pages.days(pages.pages(select.codes(records(spark, d)), select.codes(current(spark, d)), PREFIX, PAGE, by), by)


@query(CODES_SQL + f"select k.kind as kind, k.code as code, rank, id, version, title || ' ' || type as abstract, strftime(registered_at, {ISO}) as published_at from front")
def subject_front(spark: SparkSession, d: str) -> DataFrame:
    return cards.front(current(spark, d)).select("kind", "code", "rank", "id", "version", F.concat_ws(" ", "title", "type").alias("abstract"), instant(F.col("registered_at")).alias("published_at"))


@query(CODES_SQL + f"select k.kind as kind, k.code as code, id, version, title, strftime(registered_at, {ISO}) as published_at, brand || '|' || type as classification from cc")
def subject_archive(spark: SparkSession, d: str) -> DataFrame:
    return select.codes(current(spark, d)).select("kind", "code", "id", "version", "title", instant(F.col("registered_at")).alias("published_at"), F.concat_ws("|", "brand", "type").alias("classification"))


@query(RECORDS + """select ids.id, coalesce(v.versions, '') as versions, coalesce(v.n, 0) as n from (select distinct id from r) ids
left join (select id, string_agg(version::varchar, ',' order by version) as versions, count(*) as n from a group by id) v using (id)""")
def version_index(spark: SparkSession, d: str) -> DataFrame:
    """One sorted list per id ever used, empty if all is withdrawn."""
    now = active(spark, d).groupBy("id").agg(F.array_sort(F.collect_list("version")).alias("v"))
    listed = records(spark, d).select("id").distinct().join(now, "id", "left")
    v = F.coalesce("v", F.array().cast("array<long>"))
    return listed.select("id", F.array_join(v, ",").alias("versions"), F.size(v).cast("long").alias("n"))


@query(RECORDS + "select id, version, registered_at::date::varchar as taken_down_on from t")
def tombstones(spark: SparkSession, d: str) -> DataFrame:
    return takedowns(spark, d).select("id", "version", F.to_date("taken_down_at").cast("string").alias("taken_down_on"))


@query(RECORDS + f"select id, version, owner, strftime(registered_at, {ISO}) as taken_down_at from t")
def takedown_targets(spark: SparkSession, d: str) -> DataFrame:
    return takedowns(spark, d).select("id", "version", "owner", instant(F.col("taken_down_at")).alias("taken_down_at"))


@query(RECORDS + "select id, version + 1 as version from t where (id, version + 1) not in (select id, version from r)")
def takedown_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Withdrawals, moved by one version, whose target does not exist."""
    moved = takedowns(spark, d).select("id", (F.col("version") + 1).alias("version"))
    return moved.join(records(spark, d), ["id", "version"], "left_anti")


@query(RECORDS + "select s.id, s.version, s.title, r.commit_sha, (s.title = r.title) as agrees from r s join r on s.id = r.id and s.version = r.version")
def summary_join(spark: SparkSession, d: str) -> DataFrame:
    s = cards.summary(records(spark, d)).select("id", "version", "title")
    other = records(spark, d).select("id", "version", F.col("title").alias("own"), "commit_sha")
    return s.join(other, ["id", "version"]).select("id", "version", "title", "commit_sha", (F.col("title") == F.col("own")).alias("agrees"))


@query(RECORDS + """, listed as (select id, version, [brand, type] as codes, lag([brand, type]) over (partition by id order by version) as was from r),
last as (select * from listed where was is not null qualify row_number() over (partition by id order by version desc) = 1)
select id, version, coalesce(array_to_string(list_sort(list_distinct(list_filter(was, lambda x: not list_contains(codes, x)))), ','), '') as left_codes,
  coalesce(array_to_string(list_sort(list_distinct(list_filter(codes, lambda x: not list_contains(was, x)))), ','), '') as joined_codes from last""")
def code_moves(spark: SparkSession, d: str) -> DataFrame:
    return select.code_moves(records(spark, d))


@query(RECORDS + """select * from (select distinct 'brand' as kind, brand as code from r union select distinct 'type', type from r)
where not regexp_matches(code, case when kind = 'brand' then '^Brand#[0-9]+$' else '^[A-Z]{1,6}$' end)""")
def bad_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes outside their kind's grammar: errors, not drops."""
    good = F.when(F.col("kind") == "brand", F.col("code").rlike("^Brand#[0-9]+$")).otherwise(F.col("code").rlike("^[A-Z]{1,6}$"))
    return select.codes(records(spark, d)).select("kind", "code").distinct().where(~good)


FEED_SQL = """replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"""
HTML_SQL = """replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')"""


@query(RECORDS + f"""select id, version, 'https://registry.example/entry.html?id=' || id || '&version=' || version as link, {FEED_SQL.format("title")} as item_title,
  {FEED_SQL.format(HTML_SQL.format("(title || ' ' || type)"))} as description, strftime(registered_at, '%a, %d %b %Y %H:%M:%S') || ' +0000' as pub_date,
  'brand:' || brand || ',type:' || type as categories from cur order by registered_at desc, id desc limit 200""")
def feed_items(spark: SparkSession, d: str) -> DataFrame:
    return cards.feed_items(select.recent(current(spark, d))).select("id", "version", "link", "item_title", "description", "pub_date", "categories")


@query(CODES_SQL + f"select k.kind as kind, k.code as code, strftime(max(registered_at), {ISO}) as built, count(*) as items from front group by all")
def feed_heads(spark: SparkSession, d: str) -> DataFrame:
    return cards.front(current(spark, d)).groupBy("kind", "code").agg(instant(F.max("registered_at")).alias("built"), F.count("*").alias("items"))


@query(CODES_SQL + f"""select k.kind as kind, k.code as code, count(*) as n_items,
 '<?xml version="1.0" encoding="utf-8"?><rss version="2.0"><channel><title>New results: ' || k.code || '</title><lastBuildDate>' || strftime(max(registered_at), '%a, %d %b %Y %H:%M:%S') || ' +0000</lastBuildDate><link>https://data.example/feeds/'
 || k.kind || '/' || replace(url_encode(k.code), '+', '%20') || '.xml</link>' ||
 string_agg('<item><title>' || {FEED_SQL.format("title")} || '</title><link>https://registry.example/entry.html?id=' || id || '&amp;version=' || version || '</link><guid isPermaLink="true">https://registry.example/entry.html?id=' || id || '&amp;version=' || version
 || '</guid><description>' || {FEED_SQL.format(HTML_SQL.format("(title || ' ' || type)"))} || '</description><pubDate>' || strftime(registered_at, '%a, %d %b %Y %H:%M:%S') || ' +0000</pubDate><category domain="brand">' || brand || '</category><category domain="type">' || type || '</category></item>', '' order by rank)
 || '</channel></rss>' as document from front group by k.kind, k.code""")
def feed_documents(spark: SparkSession, d: str) -> DataFrame:
    return cards.feed_documents(cards.feed_items(cards.front(current(spark, d))))


@query(RECORDS + """, newest as (select id, version from cur order by registered_at desc, id desc limit 200)
select id, version, case when version % 2 = 0 then sha256('fresh' || id) when version % 3 <> 0 then sha256('prior' || id) end as tree_sha256 from newest""")
def recent_renders(spark: SparkSession, d: str) -> DataFrame:
    newest = select.recent(current(spark, d))
    sha = lambda word: F.sha2(F.concat(F.lit(word), "id"), 256).alias("tree_sha256")
    all_versions = records(spark, d)
    return cards.recent_renders(newest, all_versions.where("version % 3 <> 0").select("id", "version", sha("prior")), all_versions.where("version % 2 = 0").select("id", "version", sha("fresh")))


@query(RECORDS + """select id, version, case when size % 5 = 0 then 0::bigint else 1::bigint end as matches, case when size % 5 <> 0 then 'fork/' || repository end as fork from r""")
def source_mapping(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d)
    own = F.struct(F.upper("repository").alias("repository"), F.when(F.col("size") % 5 == 0, "other").otherwise(F.col("commit_sha")).alias("commit"), F.concat(F.lit("fork/"), "repository").alias("fork"))
    other = F.struct(F.lit("some/where").alias("repository"), F.col("commit_sha").alias("commit"), F.lit("fork/none").alias("fork"))
    return cards.source_mapping(r, r.select("id", "version", F.array(other, own).alias("mapping")))


@query(RECORDS + """select a.id, count(*) as n from (select * from a where day >= date '1996-01-01') a
where a.id not in (select id from a where day < date '1996-01-01' or version = 1) group by a.id""")
def newly_active(spark: SparkSession, d: str) -> DataFrame:
    """Ids with active versions in a batch (from 1996 on) that had none before it."""
    now = active(spark, d)
    batch = now.where("day >= date'1996-01-01'")
    new = select.newly_active(now.where("day < date'1996-01-01' or version = 1"), batch)
    return batch.join(new, "id").groupBy("id").agg(F.count("*").alias("n"))
