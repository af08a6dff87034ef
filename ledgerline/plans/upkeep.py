"""Queries that keep derived tables up to date, each held against the SQL of a full build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import cards, incremental, pages, rules, select
from ledgerline.plans.base import INVENTORIES, RECORDS, query
from ledgerline.plans.collections import CODES_SQL, PAGE, PAGES_SQL, active, current
from ledgerline.sources.views import PREFIX, inventory, records

#: The batch: every fifth result of a day.
BATCH = "serial % 5 = 0"


def _before(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Records before the batch: ever and active."""
    ever = records(spark, d).where(f"not ({BATCH})")
    return ever, ever.where("not withdrawn")


@query(PAGES_SQL + "select * from pg")
def patched_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages after a batch, from the pages before it and the touched pages alone; equal to a full build."""
    ever, now = _before(spark, d)
    prior = pages.pages(ever, now, PREFIX, PAGE)
    return incremental.patched_pages(prior, records(spark, d), active(spark, d), records(spark, d).where(BATCH), PREFIX, PAGE)


@query(PAGES_SQL + "select day, sum(results)::bigint as results, sum(versions)::bigint as versions from pg group by day")
def patched_days(spark: SparkSession, d: str) -> DataFrame:
    """Day counts moved by the differences of the touched pages."""
    ever, now = _before(spark, d)
    before, after = pages.pages(ever, now, PREFIX, PAGE), pages.pages(records(spark, d), active(spark, d), PREFIX, PAGE)
    hit = pages.placed(records(spark, d).where(BATCH).select("id").distinct().withColumn("day", F.lit(None)), PREFIX, PAGE).select("year", "day", "page").distinct()
    prior = pages.days(before)
    return pages.moved_counts(before.join(hit, ["year", "day", "page"], "left_semi"), after.join(hit, ["year", "day", "page"], "left_semi"), prior)


@query(CODES_SQL + "select k.kind as kind, k.code as code, rank, id, version from front")
def patched_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Front lists after a batch: codes that it touches (left ones too) are made anew from the base, the others stay."""
    ever, now = _before(spark, d)
    columns = ["kind", "code", "rank", "id", "version"]
    prior = cards.front(select.latest_versions(now)).select(columns)
    batch_ids = records(spark, d).where(BATCH).select("id").distinct()
    moved = select.codes(records(spark, d).join(batch_ids, "id", "left_semi")).select("kind", "code").distinct()
    base = select.codes(current(spark, d)).select("id", "version", "registered_at", "brand", "type", "kind", "code")
    return incremental.patched(prior, base, moved, ["kind", "code"], lambda rows: cards.front(rows.drop("kind", "code").distinct()).join(moved, ["kind", "code"], "left_semi").select(columns))


@query(RECORDS + "select id, version from cur order by registered_at desc, id desc limit 200")
def patched_recent(spark: SparkSession, d: str) -> DataFrame:
    """The newest 200 after a batch of appends, from the list before it and the batch's own current versions."""
    _, now = _before(spark, d)
    columns = ["id", "version", "registered_at"]
    prior = select.recent(select.latest_versions(now)).select(columns)
    batch = current(spark, d).where(BATCH).select(columns)
    return incremental.patched_recent(prior, batch, current(spark, d), 200, records(spark, d).where(BATCH)).select("id", "version")


@query(CODES_SQL + """, n as (select k.kind as kind, k.code as code, count(*) as was, count_if(serial % 3 <> 0) as now from front group by all)
select kind, code from n where was >= 50 and now < was""")
def refill_groups(spark: SparkSession, d: str) -> DataFrame:
    """Full front lists that lose rows when every third serial is withdrawn."""
    front = cards.front(current(spark, d))
    return incremental.refill_groups(front, front.where("serial % 3 <> 0"), ["kind", "code"], 50)


@query(RECORDS + f"""select distinct surface, grp from (select unnest([{{'surface': 'page', 'grp': substr(id, 5, 10) || '/' || ((serial - 1) // {PAGE} + 1)}}, {{'surface': 'year', 'grp': substr(id, 5, 4)}},
 {{'surface': 'brand', 'grp': brand}}, {{'surface': 'type', 'grp': type}}, {{'surface': 'repository', 'grp': repository}}, {{'surface': 'path', 'grp': project_path}}], recursive := true) from r where {BATCH}) where grp is not null""")
def touched_groups(spark: SparkSession, d: str) -> DataFrame:
    c = keys.coordinate(F.col("id"), PREFIX, PAGE)
    groups = {"page": F.concat_ws("/", c["day"], c["page"].cast("string")), "year": c["year"], "brand": F.col("brand"), "type": F.col("type"), "repository": F.col("repository"), "path": F.col("project_path")}
    return incremental.touched(records(spark, d).where(BATCH), groups)


@query(INVENTORIES + "select 'full' as scope, 'not an append: ' || min('entries/' || path) as reason, count(*) as changes from (select a.path from inv0 a left join inv1 b on a.path = b.path where b.path is null or a.sha256 <> b.sha256 union all select 'x' from inv1 where false)".replace("count(*) as changes", "(select count(*) from inv0 a full join inv1 b on a.path = b.path where a.path is null or b.path is null or a.sha256 <> b.sha256) as changes"))
def scope_decision(spark: SparkSession, d: str) -> DataFrame:
    """Whether the difference between two inventories is a closed append; here it is not."""
    from ledgerline.operators import diff

    changes = diff.inventory_diff(inventory(spark, d, 0), inventory(spark, d, 1)).withColumn("path", F.concat(F.lit("entries/"), "path"))
    n = changes.agg(F.count("*").alias("changes"))
    return incremental.scope_decision(changes).join(n)


@query(PAGES_SQL + f""", old as (select * from placed where not ({BATCH})), hit as (select distinct d as day, page from placed where {BATCH}), was as (select year, d as day, page, count(distinct case when not withdrawn then id end) as results, count_if(not withdrawn)::bigint as versions from old group by all),
 patched as (select * from was anti join hit using (day, page) union all select * from pg semi join hit using (day, page))
select (select count(*) from (from pg except all from patched)) + (select count(*) from (from patched except all from pg)) as differences, count(*) as pages from pg""")
def incremental_equals_full(spark: SparkSession, d: str) -> DataFrame:
    """Rows in which the patched pages differ from those of a full build: none."""
    full = pages.pages(records(spark, d), active(spark, d), PREFIX, PAGE)
    different = incremental.unequal(patched_pages(spark, d), full).agg(F.count("*").alias("differences"))
    return different.join(full.agg(F.count("*").alias("pages")))


@query(RECORDS + f""", b as (select * from r where {BATCH}), v as (select id, version, 'enum' as rule from {{}} where type not in ('ECONOMY', 'STANDARD') union all select id, version, 'minimum' from {{}} where size < 10),
 w as (select id, version, 'enum' as rule from r where type not in ('ECONOMY', 'STANDARD') union all select id, version, 'minimum' from r where size < 10), f as (select w.* from w semi join b using (id, version))
select (select count(*) from (from v except all from f)) + (select count(*) from (from f except all from v)) as differences, count(*) as broken from v""".replace("{}", "b"))
def scoped_equals_full(spark: SparkSession, d: str) -> DataFrame:
    """Violations found by validating the batch alone, against those of a full run that are the batch's."""
    r = records(spark, d)
    own = [rules.one_of("type", ("ECONOMY", "STANDARD")), rules.at_least("size", 10)]
    entity = F.concat_ws("-v", "id", F.col("version").cast("string"))
    batch = r.where(BATCH)
    scoped = rules.validate(batch, entity, own)
    full = rules.validate(r, entity, own).join(batch.select(entity.alias("entity")), "entity", "left_semi")
    return incremental.unequal(scoped, full).agg(F.count("*").alias("differences")).join(scoped.agg(F.count("*").alias("broken")))


@query(PAGES_SQL + ", have as (select * from pg where not (page = 1 and day like '%-01')) select dy.day, p.page from dy, lateral (select unnest(generate_series(first_page, last_page)) as page) p where not exists (select 1 from have h where h.day = dy.day and h.page = p.page)")
def missing_groups(spark: SparkSession, d: str) -> DataFrame:
    """Pages that days name when the first pages of every first of a month are lost."""
    whole = pages.pages(records(spark, d), active(spark, d), PREFIX, PAGE)
    return pages.missing_pages(whole.where("not (page = 1 and day like '%-01')"), pages.days(whole))


@query(PAGES_SQL + ", w as (select year, day, results + (substr(day, 9, 2) = '15')::int as results from dy), s as (select day, sum(results) as held from pg group by day) select day, 'results' as rule from w join s using (day) where results <> held")
def browse_rules(spark: SparkSession, d: str) -> DataFrame:
    """Days whose counts don't follow from their pages; here each fifteenth claims one more."""
    whole = pages.pages(records(spark, d), active(spark, d), PREFIX, PAGE)
    claimed = pages.days(whole).withColumn("results", F.col("results") + F.when(F.substring("day", 9, 2) == "15", 1).otherwise(0))
    held = whole.groupBy("day").agg(F.sum("results").alias("held"))
    return claimed.join(held, "day").where("results <> held").select("day", F.lit("results").alias("rule"))


@query(RECORDS + """, nw as (select * from cur order by registered_at desc, id desc limit 200), bk as (select *, case when serial % 4 = 0 then 'x' else commit_sha end as shown from nw)
select id, 'commit' as rule from bk where shown = 'x' union all select id, 'order' from (select id, registered_at, lag((registered_at, id)) over (order by registered_at, id desc) as was, (registered_at, id) as own from nw) where was is not null and not was < own""")
def recent_rules(spark: SparkSession, d: str) -> DataFrame:
    """The contract of the recent list, over one whose commits are partly broken and whose order is by instant, then id the wrong way round."""
    rows = select.recent(current(spark, d)).withColumns({"shown": F.when(F.col("serial") % 4 == 0, "x").otherwise(F.col("commit_sha")), "list": F.lit(1)})
    commit = rows.where(~F.col("shown").rlike("^[0-9a-f]{40}$")).select("id", F.lit("commit").alias("rule"))
    from pyspark.sql import Window

    before = F.lag(F.struct("registered_at", "id")).over(Window.partitionBy("list").orderBy("registered_at", F.desc("id")))
    order = rows.withColumn("was", before).where(F.col("was").isNotNull() & ~(F.col("was") < F.struct("registered_at", "id"))).select("id", F.lit("order").alias("rule"))
    return commit.unionByName(order)
