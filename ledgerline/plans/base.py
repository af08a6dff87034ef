"""How a query and its SQL are registered, and the SQL for the views of ledgerline.sources.views."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}

RECORDS = """
with r as (
  select 'REC-' || strftime(o.day, '%Y-%m-%d') || '-' || lpad(o.serial::varchar, 6, '0') as id, o.day, o.serial, l.version,
         l.l_shipdate as registered_at, p.p_name as title, p.p_brand as brand, p.p_type as type, lower(s.s_name) as repository,
         'owner-' || o.o_custkey as owner, p.p_size::bigint as size,
         case when p.p_size % 2 = 0 then 'src/' || p.p_brand end as project_path, 'config/' || p.p_type as config_path,
         sha1(l.l_orderkey || ':' || l.l_partkey || ':' || l.l_suppkey || ':' || l.l_linenumber) as commit_sha,
         l.l_returnflag = 'R' as withdrawn, 'sub-' || o.o_orderkey || '-' || l.version as submission_id, o.o_orderkey as orderkey
  from (select *, o_orderdate::date as day, row_number() over (partition by o_orderdate::date order by o_orderkey) as serial from orders) o
  join (select *, row_number() over (partition by l_orderkey order by l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as version from lineitem) l on l.l_orderkey = o.o_orderkey
  join part p on p.p_partkey = l.l_partkey join supplier s on s.s_suppkey = l.l_suppkey
), t as (select * from r where withdrawn), a as (select * from r where not withdrawn),
cur as (select * from a qualify row_number() over (partition by id order by version desc) = 1)
"""
INVENTORIES = """
with inv as (
  select doc_id, 'documents/' || doc_id as path, strlen(coalesce(text, ''))::bigint as bytes, sha256(coalesce(text, '')) as sha256 from documents
), inv0 as (select path, bytes, sha256 from inv where doc_id % 10 <> 0),
later as (select doc_id, case when doc_id % 10 = 2 then translate(coalesce(text, ''), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') else coalesce(text, '') end as text from documents where doc_id % 10 <> 1),
inv1 as (select 'documents/' || doc_id as path, strlen(text)::bigint as bytes, sha256(text) as sha256 from later)
"""
OBSERVATIONS = """
with obs as (
  select user_id as key, date_trunc('second', ts) as "at", event_id as seq, props,
         case when event_type in ('view', 'click') then 'available' when event_type = 'error' then 'missing'
              when event_type = 'signup' then 'transient' else 'budget' end as outcome from events
)
"""


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame, and its SQL, under its own name."""

    def register(f: Callable) -> Callable:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return register
