"""Queries of declared orders, keys and fields over the records, wrong here and there; the SQL evaluates each rule over the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import contracts, diff, incremental, ordering, rules, shapes
from ledgerline.plans.base import INVENTORIES, RECORDS, query
from ledgerline.sources.views import PREFIX, instant, inventory, records

ENTITY = "id || '-v' || version"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
#: Every fortieth pair of neighbours changes places.
MOVED = "case when place % 40 = 7 then place + 1 when place % 40 = 8 then place - 1 else place end"
GAPS = "select 'positions' as entity, 'gap' as rule, 'position' as field from (select count(*) as n, count(distinct position) as u, min(position) as low, max(position) as high from mv) where n > 0 and (u <> n or low <> 0 or high <> n - 1)"


def _entity():
    return F.concat_ws("-v", "id", F.col("version").cast("string"))


def _positions(rows: DataFrame, key) -> DataFrame:
    placed = ordering.numbered(rows, key).withColumn("place", F.col("place") - 1)
    moved = F.when(F.col("place") % 40 == 7, F.col("place") + 1).when(F.col("place") % 40 == 8, F.col("place") - 1).otherwise(F.col("place"))
    return placed.withColumn("position", moved).drop("place")


@query(RECORDS + f""", tg as (select distinct case when size % 2 = 0 then upper(repository) else repository end as source, case when size % 23 = 7 then 'short' || commit_sha else commit_sha end as commit, 'archive/' || owner as fork from a),
pl as (select *, row_number() over (order by lower(source), commit, lower(fork)) - 1 as place from tg), mv as (select source, commit, fork, {MOVED} as position from pl)
select source as entity, 'pattern' as rule, 'commit' as field from mv where not regexp_full_match(commit, '[0-9a-f]{{40}}')
union all select b.source, 'order', 'position' from mv a join mv b on b.position = a.position + 1 where not (lower(a.source), a.commit, lower(a.fork)) < (lower(b.source), b.commit, lower(b.fork)) union all {GAPS}""")
def target_order(spark: SparkSession, d: str) -> DataFrame:
    """All active targets in one list, some out of place and some of a malformed commit."""
    r = records(spark, d).where("not withdrawn")
    source = F.when(F.col("size") % 2 == 0, F.upper("repository")).otherwise(F.col("repository"))
    commit = F.when(F.col("size") % 23 == 7, F.concat(F.lit("short"), "commit_sha")).otherwise(F.col("commit_sha"))
    targets = r.select(source.alias("source_repository"), commit.alias("commit"), F.concat(F.lit("archive/"), "owner").alias("fork_repository")).distinct()
    return contracts.target_contract(_positions(targets, F.struct(F.lower("source_repository").alias("s"), F.col("commit").alias("c"), F.lower("fork_repository").alias("f"))))


@query(RECORDS + f""", pl as (select id, version, orderkey as issue, row_number() over (order by id, version) - 1 as place from t), mv as (select id, version, issue, {MOVED} as position from pl)
select b.id || '-v' || b.version as entity, 'order' as rule, 'position' as field from mv a join mv b on b.position = a.position + 1 where not (a.id, a.version) < (b.id, b.version)
union all select issue::varchar, 'unique', 'issue' from mv group by issue having count(*) > 1 union all {GAPS}""")
def takedown_order(spark: SparkSession, d: str) -> DataFrame:
    """Withdrawals in the order of their versions, some out of place; several of one result share its issue."""
    rows = records(spark, d).where("withdrawn").select("id", "version", F.col("orderkey").alias("issue"))
    return contracts.takedown_order(_positions(rows, F.struct("id", "version")))


@query(RECORDS + f""", s as (select id, version, strftime(registered_at, {ISO}) as shown, strftime(day + (case when size % 19 = 4 then 3 else 0 end)::int, '%Y-%m-%d') as first_on, size from r), v as (select id, version, case when size % 10 = 3 then replace(shown, 'T', ' ') else shown end as at_, first_on from s),
f as (select id, substr(at_, 1, 10) as first_day from v where version = 1), j as (select v.*, first_day from v left join f using (id))
select {ENTITY} as entity, 'first version' as rule, 'id' as field from j where first_day is null union all select {ENTITY}, 'first day', 'first_registered_on' from j where first_on <> first_day
union all select {ENTITY}, 'before first', 'registered_at' from j where substr(at_, 1, 10) < first_on union all select {ENTITY}, 'instant', 'registered_at' from j where not regexp_full_match(at_, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}Z')""")
def date_contract(spark: SparkSession, d: str) -> DataFrame:
    """Instants and first days of all versions; some instants are malformed, some first days differ."""
    size, shown = F.col("size"), instant(F.col("registered_at"))
    first = F.date_format(F.date_add("day", F.when(size % 19 == 4, 3).otherwise(0)), "yyyy-MM-dd")
    rows = records(spark, d).select("id", "version", F.when(size % 10 == 3, F.replace(shown, F.lit("T"), F.lit(" "))).otherwise(shown).alias("registered_at"), first.alias("first_registered_on"))
    return contracts.date_contract(rows, _entity())


@query(RECORDS + f"select {ENTITY} as entity, 'file name' as rule, 'file' as field from r where version > 3 union all select {ENTITY}, 'first day', 'id' from r where substr(id, 5, 10) <> strftime(registered_at, '%Y-%m-%d')")
def record_keys(spark: SparkSession, d: str) -> DataFrame:
    """File names that stop at the third version, and identifiers whose day is another than that of the registration."""
    file = F.concat(F.col("id"), F.lit("-v"), F.least("version", F.lit(3)).cast("string"), F.lit(".json"))
    rows = records(spark, d).select("id", "version", file.alias("file"), F.date_format("registered_at", "yyyy-MM-dd").alias("first_registered_on"))
    return rules.validate(rows, _entity(), shapes.key_rules(PREFIX))


@query(RECORDS + f""", s as (select *, size - 5 as alignment, case when project_path is not null then size end as fidelity, version - 2 as clear, case when brand = 'Brand#11' then substr(commit_sha, 2) else commit_sha end as policy, case when type = 'PROMO' then strftime(registered_at, '%Y-%m-%d') else strftime(registered_at, {ISO}) end as reviewed from r)
select {ENTITY} as entity, 'minimum' as rule, 'scores.statement_alignment' as field from s where alignment < 0 union all select {ENTITY}, 'required', 'scores.definition_fidelity' from s where fidelity is null union all select {ENTITY}, 'minimum', 'scores.clarity' from s where clear < 0
union all select {ENTITY}, 'pattern', 'policy_commit' from s where not regexp_full_match(policy, '[0-9a-f]{{40}}') union all select {ENTITY}, 'instant', 'reviewed_at' from s where not regexp_full_match(reviewed, '.*T.*Z') union all select {ENTITY}, 'enum', 'schema_version' from s where version not in (1, 2, 3)""".replace("case when version", "case when version"))
def score_fields(spark: SparkSession, d: str) -> DataFrame:
    """Declared fields of scores, of which some are absent, negative or malformed."""
    marks = F.struct((F.col("size") - 5).alias("statement_alignment"), F.when(F.col("project_path").isNotNull(), F.col("size")).alias("definition_fidelity"), F.col("size").alias("notability"), F.col("size").alias("literature"), (F.col("version") - 2).alias("clarity"))
    policy = F.when(F.col("brand") == "Brand#11", F.expr("substr(commit_sha, 2)")).otherwise(F.col("commit_sha"))
    reviewed = F.when(F.col("type") == "PROMO", F.date_format("registered_at", "yyyy-MM-dd")).otherwise(instant(F.col("registered_at")))
    rows = records(spark, d).select("id", "version", F.when(F.col("version") <= 3, 1).otherwise(2).alias("schema_version"), reviewed.alias("reviewed_at"), policy.alias("policy_commit"), marks.alias("scores"))
    return rules.validate(rows, _entity(), shapes.rules_of(shapes.score_shape(PREFIX)))


@query(INVENTORIES + "select 'full' as scope, 'policy: ' || min('tools/' || a.path) as reason from inv0 a join inv1 b on a.path = b.path where a.sha256 <> b.sha256")
def policy_scope(spark: SparkSession, d: str) -> DataFrame:
    """Whether a validation may look at a batch alone: not where what changed are tools that old records were judged by."""
    changes = diff.inventory_diff(inventory(spark, d, 0), inventory(spark, d, 1))
    folder = F.when(F.col("status") == "M", "tools/").otherwise("entries/")
    return incremental.scope_decision(changes.withColumn("path", F.concat(folder, "path")), validation=True)
