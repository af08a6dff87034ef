"""Queries over lookups and the registry's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import authority, lookups, select
from ledgerline.plans.base import RECORDS, query
from ledgerline.plans.collections import active, current
from ledgerline.sources.views import records

IDENT = RECORDS + """, idn as (select *, sha256(encode(lower(repository)) || unhex('00') || encode(coalesce(project_path, '')) || unhex('00') || encode(config_path)) as digest from r)
"""


@query(IDENT + "select id, version, repository, project_path, config_path, digest from idn")
def identities(spark: SparkSession, d: str) -> DataFrame:
    return lookups.identities(records(spark, d)).drop("commit_sha")


@query(IDENT + "select digest, count(*) as n from idn group by digest")
def identity_digests(spark: SparkSession, d: str) -> DataFrame:
    return lookups.identities(records(spark, d)).groupBy("digest").agg(F.count("*").alias("n"))


@query(IDENT + "select digest, count(distinct id) as owners from idn group by digest having count(distinct id) > 1")
def identity_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return authority.exclusive_conflicts(lookups.identities(records(spark, d)), "digest", "id")


@query(IDENT + """select distinct 'repositories/' || repository || '.json' as repository_path, 'registration-identities/' || digest || '.json' as identity_path,
 'registrations/results/' || id || '.json' as result_path, 'registrations/days/' || day || '.json' as day_path, 'registrations/submissions/' || submission_id || '.json' as submission_path from idn""")
def lookup_paths(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d)
    digest = keys.identity_digest(F.col("repository"), F.col("project_path"), F.col("config_path"))
    path = lambda folder, c: F.concat(F.lit(f"{folder}/"), c, F.lit(".json"))
    return r.select(path("repositories", F.col("repository")).alias("repository_path"), path("registration-identities", digest).alias("identity_path"), path("registrations/results", F.col("id")).alias("result_path"), path("registrations/days", F.col("day").cast("string")).alias("day_path"), path("registrations/submissions", F.col("submission_id")).alias("submission_path")).distinct()


@query(RECORDS + """, rr as (select distinct repository, id from cur), top as (select *, row_number() over (partition by repository order by id desc) as n from rr)
select repository, count(*) as total, count(*) > 100 as truncated, string_agg(id, ',' order by id desc) filter (where n <= 100) as ids from top group by repository""")
def repository_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Lists of 100."""
    return lookups.repository_lookup(current(spark, d), 100).withColumn("ids", F.array_join("ids", ","))


@query(IDENT + """select e.digest, case when n.low = n.high then n.low end as id, coalesce(n.low <> n.high, false) as ambiguous, e.commits from
 (select digest, string_agg(distinct commit_sha, ',' order by commit_sha) as commits from idn group by digest) e
 left join (select digest, min(id) as low, max(id) as high from idn where not withdrawn group by digest) n using (digest)""")
def identity_lookup(spark: SparkSession, d: str) -> DataFrame:
    return lookups.identity_lookup(active(spark, d), records(spark, d)).withColumn("commits", F.array_join("commits", ","))


@query(RECORDS + "select lower(repository) as source, commit_sha as commit, min('archive/' || owner) as fork, count(distinct owner) > 1 as conflict from a group by all")
def targets(spark: SparkSession, d: str) -> DataFrame:
    return lookups.targets(active(spark, d).withColumn("fork", F.concat(F.lit("archive/"), "owner")))


@query(RECORDS + "select repository, 'truncated' as rule from (select repository, count(distinct id) as n from cur group by repository) where n > 100")
def lookup_rules(spark: SparkSession, d: str) -> DataFrame:
    """Violations when lists cut at 100 never say so."""
    return lookups.contract(lookups.repository_lookup(current(spark, d), 100).withColumn("truncated", F.lit(False)), 100)


@query(IDENT + """, p as (select * from idn where day < date '1996-01-01'), b as (select * from idn where day >= date '1996-01-01'),
pr as (select digest, case when min(id) = max(id) then min(id) end as id, min(id) <> max(id) as ambiguous from p group by digest),
nw as (select digest, count(distinct id) as n, min(id) as low from b group by digest),
cm as (select digest, string_agg(distinct commit_sha, ',' order by commit_sha) as commits from idn group by digest)
select digest, case when coalesce(ambiguous, false) then null when n is null then pr.id when n = 1 and pr.id is null then low end as id,
 case when coalesce(ambiguous, false) then true when n is null then false when n = 1 and pr.id is null then false else true end as ambiguous, commits, false as recompute
from cm left join pr using (digest) left join nw using (digest)""")
def lookup_patch(spark: SparkSession, d: str) -> DataFrame:
    """The identity lookup after a batch of results of 1996 and later."""
    r = records(spark, d)
    base, batch = r.where("day < date'1996-01-01'"), r.where("day >= date'1996-01-01'")
    new = lookups.identities(batch)
    patched = lookups.patched_identities(lookups.identity_lookup(base, base), new.select("digest", "id"), new.select("digest", "id", "commit_sha"))
    return patched.withColumn("commits", F.array_join("commits", ","))


@query(RECORDS + ", g as (select id, version, row_number() over (partition by id order by version) as expected from a) select * from g where version <> expected")
def version_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps that withdrawals leave among active versions."""
    return authority.version_gaps(active(spark, d))


@query(RECORDS + ", g as (select day, serial, row_number() over (partition by day order by serial) as expected from (select distinct day, serial from cur)) select day::varchar as day, serial, expected from g where serial <> expected")
def serial_gaps(spark: SparkSession, d: str) -> DataFrame:
    return authority.serial_gaps(current(spark, d)).withColumn("day", F.col("day").cast("string"))


@query(RECORDS + "select day::varchar as day, max(serial) as last_serial from r group by day")
def day_serials(spark: SparkSession, d: str) -> DataFrame:
    return authority.day_serials(records(spark, d)).withColumn("day", F.col("day").cast("string"))


@query(RECORDS + ", f as (select *, first(struct_pack(a := repository, b := project_path, c := config_path)) over (partition by id order by version) as was from r) select id, version from f where struct_pack(a := repository, b := project_path, c := config_path) is distinct from was")
def identity_changes(spark: SparkSession, d: str) -> DataFrame:
    return authority.identity_changes(records(spark, d))


@query(RECORDS + """, p as (select * from r where version <> 2), b as (select * from r where version = 2 or version = 4), l as (select id, max(version) as last from p group by id)
select id || '-v' || version as entity, 'version' as rule from (select b.*, coalesce(last, 0) + row_number() over (partition by b.id order by version) as expected from b left join l using (id)) where version <> expected""")
def append_transition(spark: SparkSession, d: str) -> DataFrame:
    """A batch of second and fourth versions against all but the second ones: nearly all break the order."""
    r = records(spark, d).select("id", "day", "serial", "version")
    return authority.append_transition(r.where("version <> 2"), r.where("version in (2, 4)"))


@query(RECORDS + "select id, case when s then 'missing' else 'extra' end as rule from (select distinct id, serial % 7 = 0 as s, serial % 5 = 0 as x from r) where s and not x or x and not s")
def authority_diff(spark: SparkSession, d: str) -> DataFrame:
    ids = records(spark, d).select("id", "serial").distinct()
    return authority.difference(ids.where("serial % 5 <> 0").select("id"), ids.where("serial % 7 <> 0").select("id"), ["id"])


@query(RECORDS + "select repository, commit_sha, count(*) as n from r group by all having count(*) > 1 union all select title, brand, count(*) from r group by all having count(*) > 1")
def duplicates(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d)
    return authority.duplicates(r, ["repository", "commit_sha"]).unionByName(authority.duplicates(r.select(F.col("title").alias("repository"), F.col("brand").alias("commit_sha")), ["repository", "commit_sha"]))
