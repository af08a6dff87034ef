"""Queries over observations of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import availability as av
from ledgerline.plans.base import OBSERVATIONS, RECORDS, query
from ledgerline.plans.collections import active
from ledgerline.sources import store
from ledgerline.sources.views import instant, observations, records, table, takedowns
from ledgerline.streaming import ordered

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
STATES = OBSERVATIONS + """, isl as (select *, sum((outcome = 'available')::int) over (partition by key order by "at", seq) as island from obs),
stk as (select *, sum((outcome = 'missing')::int) over (partition by key, island order by "at", seq)::bigint as streak from isl),
evn as (select *, case when outcome = 'available' then 'available' when outcome = 'missing' then case when streak >= 2 then 'missing' else 'unknown' end end as st,
  case when outcome = 'available' or outcome = 'missing' and streak >= 2 then "at" end as ck from stk),
sts as (select key, coalesce(arg_max(st, ("at", seq)) filter (where st is not null), 'unknown') as status, arg_max(ck, ("at", seq)) filter (where ck is not null) as checked_at,
  max("at") filter (where outcome <> 'budget') as last_attempt_at, arg_max(streak, ("at", seq)) as streak,
  case when count_if(outcome <> 'budget') = 0 then 'not checked: no budget' when arg_max(outcome, ("at", seq)) filter (where outcome <> 'budget') = 'transient' then 'transient failure' end as last_error from evn group by key),
now_ as (select max("at") as as_of from obs),
tgt as (select distinct key from obs union select 100000 + n_nationkey from nation)
"""
SHOWN = f"key, status, strftime(checked_at, {ISO}) as checked_at, strftime(last_attempt_at, {ISO}) as last_attempt_at, streak, last_error"


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: instant(F.col(c)) for c in ("checked_at", "last_attempt_at")})


def _targets(spark: SparkSession, d: str) -> DataFrame:
    """All observed keys, and some that never were."""
    never = table(spark, d, "nation").select((F.col("n_nationkey") + 100000).cast("long").alias("key"))
    return observations(spark, d).select("key").distinct().unionByName(never)


def _with_now(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """rows with the time of the last observation: one row, joined."""
    now = observations(spark, d).agg(F.max("at").alias("as_of"))
    return rows.join(F.broadcast(now))


@query(STATES + f"select {SHOWN} from sts")
def observation_state(spark: SparkSession, d: str) -> DataFrame:
    return _shown(av.states(observations(spark, d)))


@query(STATES + "select key, seq, streak from stk")
def miss_streaks(spark: SparkSession, d: str) -> DataFrame:
    return av.miss_streaks(observations(spark, d))


STALE = "status in ('available', 'missing') and not coalesce(epoch(as_of) - epoch(checked_at) between -300 and 64800, false)"


@query(STATES + f"select key, case when {STALE} then 'unknown' else status end as status, strftime(checked_at, {ISO}) as checked_at, streak, case when {STALE} then coalesce(last_error, 'last check is not fresh') else last_error end as last_error from sts, now_")
def observation_freshness(spark: SparkSession, d: str) -> DataFrame:
    rows = av.expired(_with_now(spark, d, av.states(observations(spark, d))), F.col("as_of"))
    return _shown(rows).select("key", "status", "checked_at", "streak", "last_error")


@query(STATES + """, j as (select tgt.key, status, checked_at, as_of, coalesce(epoch(as_of) - epoch(checked_at) between -300 and 64800, false) as f from tgt left join sts using (key), now_)
select count(*) as total, count_if(status in ('available', 'missing') and f)::bigint as fresh, count_if(status in ('available', 'missing') and not f)::bigint as stale, count_if(status = 'unknown')::bigint as unknown, count_if(status is null)::bigint as unobserved,
 strftime(min(checked_at), '%Y-%m-%dT%H:%M:%SZ') as oldest, (epoch(max(as_of)) - epoch(min(checked_at)))::bigint as oldest_age from j""")
def observation_coverage(spark: SparkSession, d: str) -> DataFrame:
    targets = _with_now(spark, d, _targets(spark, d)).withColumnRenamed("as_of", "now")
    states = av.states(observations(spark, d))
    joined = targets.select("key", "now")
    rows = av.coverage(joined, states, F.col("now"))
    return rows.withColumn("oldest", instant(F.col("oldest")))


@query(STATES + "select count(*) as endpoints, ceil(count(*) / 40)::bigint as runs, ceil(count(*) / 40)::bigint * 6 as hours, ceil(count(*) / 40) * 6 <= 18 as holds from tgt")
def refresh_cycle(spark: SparkSession, d: str) -> DataFrame:
    return av.refresh_cycle(_targets(spark, d), 40)


@query(STATES + f"select case when status is null or status = 'unknown' or checked_at is null then 0 else 1 end as later, coalesce(strftime(checked_at, {ISO}), '') as checked, key from tgt left join sts using (key) order by 1, 2, 3 limit 100")
def recheck_queue(spark: SparkSession, d: str) -> DataFrame:
    """The next 100 checks."""
    return av.recheck_queue(_targets(spark, d), av.states(observations(spark, d)), 100)


@query(STATES + "select key, status, streak from sts where status = 'missing' or streak >= 2")
def archive_degraded(spark: SparkSession, d: str) -> DataFrame:
    return av.degraded(av.states(observations(spark, d)))


@query("""with p as (select event_id // 2 as probe, event_id as attempt, [200, 404, 409, 403, 429, 500][event_id % 6 + 1] as status, event_id % 4 as remaining, case when event_id % 5 = 0 then 1 end as retry_after from events),
l as (select * from p qualify row_number() over (partition by probe order by attempt desc) = 1)
select probe, case when status between 200 and 299 then 'available' when status in (404, 409) then 'missing' when status = 429 or status = 403 and (remaining = 0 or retry_after is not null) then 'budget' else 'transient' end as class from l""")
def probe_classes(spark: SparkSession, d: str) -> DataFrame:
    """Answers of the last of each probe's attempts."""
    n = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, (200, 404, 409, 403, 429, 500))), (n % 6 + 1).cast("int"))
    answers = table(spark, d, "events").select(F.floor(n / 2).alias("probe"), F.struct(n.alias("attempt"), status.alias("status"), (n % 4).alias("remaining"), F.when(n % 5 == 0, 1).alias("retry_after")).alias("a"))
    last = answers.groupBy("probe").agg(F.max_by("a", "a.attempt").alias("a"))
    return last.select("probe", av.probe_class(F.col("a.status"), F.col("a.remaining"), F.col("a.retry_after")).alias("class"))


@query(STATES + """, tg as (select distinct key as original, key + 7 as archive from obs) select original, archive, coalesce(o.status, 'unknown') as original_status, coalesce(o.streak, 0) as original_streak, coalesce(a.status, 'unknown') as archive_status, coalesce(a.streak, 0) as archive_streak
from tg left join sts o on o.key = original left join sts a on a.key = archive""")
def observation_merge(spark: SparkSession, d: str) -> DataFrame:
    targets = observations(spark, d).select(F.col("key").alias("original"), (F.col("key") + 7).alias("archive")).distinct()
    return av.merged(targets, av.states(observations(spark, d)), ("original", "archive"))


PATH = "'entries/' || id || '-v' || version || '.json'"


def _path(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat(F.lit("entries/"), "id", F.lit("-v"), "version", F.lit(".json")).alias("path"))


@query(RECORDS + f"select {PATH} as path from a")
def published_paths(spark: SparkSession, d: str) -> DataFrame:
    return _path(active(spark, d))


@query(RECORDS + f"select {PATH} as path from t")
def suppressed_paths(spark: SparkSession, d: str) -> DataFrame:
    return _path(takedowns(spark, d))


@query(RECORDS + f"select {PATH} as path, false as missing from a union all select distinct 'entries/' || id || '-v99.json', true from r")
def named_paths(spark: SparkSession, d: str) -> DataFrame:
    """The paths of listed versions (all there are, and a 99th of each id) but for withdrawn ones; what doesn't exist is marked."""
    r = records(spark, d)
    listed = r.select("id", "version").unionByName(r.select("id").distinct().withColumn("version", F.lit(99).cast("long")))
    there = listed.join(r.select("id", "version", F.lit(False).alias("there")), ["id", "version"], "left").join(takedowns(spark, d).select("id", "version"), ["id", "version"], "left_anti")
    return there.select(F.concat(F.lit("entries/"), "id", F.lit("-v"), "version", F.lit(".json")).alias("path"), F.col("there").isNull().alias("missing"))


@query(RECORDS + f""", pr as (select orderkey, version, {PATH} as path, withdrawn, case (orderkey + version) % 5 when 0 then 200 when 1 then 404 when 2 then 410 when 3 then 500 end as code from r)
select path, case when withdrawn then 'withdrawn but not gone' else 'missing' end as reason from pr where not withdrawn and (code is null or code >= 400) or withdrawn and (code is null or code not in (404, 410))""")
def published_health(spark: SparkSession, d: str) -> DataFrame:
    """Expected paths that don't answer, withdrawn paths that aren't proven gone."""
    r = records(spark, d)
    n = (F.col("orderkey") + F.col("version")) % 5
    probes = r.select("id", "version", F.when(n == 0, 200).when(n == 1, 404).when(n == 2, 410).when(n == 3, 500).alias("code"))
    joined = r.select("id", "version", "withdrawn").join(probes, ["id", "version"], "left")
    gone, bad = F.coalesce(F.col("code").isin(404, 410), F.lit(False)), F.coalesce(F.col("code") >= 400, F.lit(True))
    reason = F.when(~F.col("withdrawn") & bad, "missing").when(F.col("withdrawn") & ~gone, "withdrawn but not gone")
    return joined.select(F.concat(F.lit("entries/"), "id", F.lit("-v"), "version", F.lit(".json")).alias("path"), reason.alias("reason")).where("reason is not null")


#: Observations come in four batches by time, every seventh in a later one; the stream's time is two days behind the newest.
LATE_SECONDS = 2 * 86_400
_SPAN = "floor(4 * (epoch(\"at\") - (select min(epoch(\"at\")) from obs)) / ((select max(epoch(\"at\")) - min(epoch(\"at\")) from obs) + 1))::int"
ORDERED = OBSERVATIONS + f""", bt as (select *, {_SPAN} + case when seq % 7 = 0 then 1 + seq % 3 else 0 end as b from obs),
mk as (select m.b, (select max(epoch("at")) from bt x where x.b < m.b) - {LATE_SECONDS} as passed from (select distinct b from bt) m)"""
LATE_SQL = ORDERED + """ select key, seq, outcome from bt join mk using (b) where epoch("at") <= passed"""


def _in_batches(spark: SparkSession, d: str) -> str:
    rows = observations(spark, d)
    ends = rows.agg(F.min(F.unix_timestamp("at")).alias("low"), F.max(F.unix_timestamp("at")).alias("high")).first()
    span = F.floor(4 * (F.unix_timestamp("at") - ends["low"]) / (ends["high"] - ends["low"] + 1)).cast("int")
    own = span + F.when(F.col("seq") % 7 == 0, 1 + F.col("seq") % 3).otherwise(0)
    root = store.scratch_root(spark, "ordered")
    for b in sorted(r[0] for r in rows.select(own.alias("b")).distinct().collect()):  # seven at most
        ordered.advance(rows.where(own == b), b, root, LATE_SECONDS, 1)
    return root


@query(LATE_SQL)
def late_observations(spark: SparkSession, d: str) -> DataFrame:
    """What comes after the stream's time has passed it, from the side table."""
    return ordered.late(spark, _in_batches(spark, d)).select("key", "seq", "outcome")


@query(STATES.replace(OBSERVATIONS, ORDERED.replace("with obs as (", "with all_obs as (", 1).replace("from obs", "from all_obs") + """, obs as (select bt.* from bt join mk using (b) where passed is null or epoch("at") > passed)""") + f"select {SHOWN} from sts")
def ordered_states(spark: SparkSession, d: str) -> DataFrame:
    """States of observations that came out of order, but in time."""
    return _shown(ordered.settled(spark, _in_batches(spark, d)))
