"""Queries over inventories: attestation, differences, path grammars."""

from __future__ import annotations

import mimetypes

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import attest, contracts, diff
from ledgerline.plans.base import INVENTORIES, RECORDS, query
from ledgerline.sources.views import PREFIX, inventory, records, table

COUNTED = "unhex(lpad(hex(strlen({0})), 16, '0')) || encode({0})"
DIGEST = f"sha256({COUNTED.format('path')} || {COUNTED.format('bytes::varchar')} || {COUNTED.format('sha256')})"


def root_sql(source: str) -> str:
    """DuckDB SQL for the root: limbs added as huge integers, carried from the lowest."""
    limb = [f"coalesce(sum(('0x' || substr(dg, {8 * k + 1}, 8))::hugeint), 0)::hugeint as l{k}" for k in range(8)]
    sql = f"(select count(*) as record_count, {', '.join(limb)} from (select {DIGEST} as dg from {source}))"
    carry = "0::hugeint"
    parts = []
    for k in range(7, -1, -1):
        parts.insert(0, f"lpad(to_hex(((l{k} + ({carry})) % 4294967296::hugeint)::bigint), 8, '0')")
        carry = f"(l{k} + ({carry})) // 4294967296::hugeint"
    return f"select record_count, lower({' || '.join(parts)}) as record_root from {sql}"


@query(INVENTORIES + "select path, bytes, sha256 from inv", name="inventory")
def inventory_rows(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d)


@query(INVENTORIES + "select 'documents/' || doc_id as path, sha256 = sha256(coalesce(text, '')) as same from inv join documents using (doc_id)")
def raw_digest_unchanged(spark: SparkSession, d: str) -> DataFrame:
    """The published bytes are the bytes that came in: carried along, never written anew."""
    raw = table(spark, d, "documents").select(F.concat(F.lit("documents/"), "doc_id").alias("path"), F.coalesce("text", F.lit("")).alias("raw"))
    return inventory(spark, d).join(raw, "path").select("path", (F.col("sha256") == F.sha2("raw", 256)).alias("same"))


SECTIONS = INVENTORIES + """, pathed as (select case doc_id % 4 when 0 then 'entries/' when 1 then 'search/t/' when 2 then 'feeds/' else 'other/' end || doc_id || '.json' as path, bytes, sha256, doc_id from inv),
sec as (select *, case when path like 'entries/%' then 'additions' when path like 'other/%' then 'aggregates' else 'stable' end as section from pathed)
"""


def _pathed(spark: SparkSession, d: str) -> DataFrame:
    number = F.substring_index("path", "/", -1).cast("long")
    folder = F.when(number % 4 == 0, "entries/").when(number % 4 == 1, "search/t/").when(number % 4 == 2, "feeds/").otherwise("other/")
    return inventory(spark, d).withColumn("doc_id", number).withColumn("path", F.concat(folder, "doc_id", F.lit(".json")))


@query(SECTIONS + "select path, bytes, sha256, section from sec")
def inventory_sections(spark: SparkSession, d: str) -> DataFrame:
    return attest.sectioned(_pathed(spark, d)).drop("doc_id")


@query(SECTIONS + "select 'r1' as release, section, path, bytes, sha256 from sec")
def release_rows(spark: SparkSession, d: str) -> DataFrame:
    return attest.sectioned(_pathed(spark, d)).select(F.lit("r1").alias("release"), "section", "path", "bytes", "sha256")


@query(INVENTORIES + root_sql("inv1"))
def multiset_root(spark: SparkSession, d: str) -> DataFrame:
    return attest.multiset_root(inventory(spark, d, 1))


@query(INVENTORIES + f"select 'r2' as release, 'r1' as parent, record_count, record_root from ({root_sql('inv1')})")
def release_base(spark: SparkSession, d: str) -> DataFrame:
    return attest.release_header(inventory(spark, d, 1), "r2", "r1")


@query(INVENTORIES + f"select path, {DIGEST} as digest from inv")
def tuple_digests(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).select("path", keys.tuple_digest(F.col("path"), F.col("bytes"), F.col("sha256")).alias("digest"))


def _moves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rows that were added and removed between the two states; a change is both."""
    c = diff.inventory_diff(inventory(spark, d, 0), inventory(spark, d, 1))
    added = c.where("status <> 'D'").select("path", F.col("new_bytes").alias("bytes"), F.col("new_sha256").alias("sha256"))
    return added, c.where("status <> 'A'").select("path", F.col("old_bytes").alias("bytes"), F.col("old_sha256").alias("sha256"))


@query(INVENTORIES + f"select record_root as root from ({root_sql('inv1')})")
def root_after(spark: SparkSession, d: str) -> DataFrame:
    """The later state's root from the earlier one's and the changes alone."""
    added, removed = _moves(spark, d)
    row = attest.multiset_root(inventory(spark, d, 0)).select(F.col("record_root").alias("p"), F.lit(1).alias("one"))
    for name, rows in (("a", added), ("r", removed)):
        row = row.join(attest.multiset_root(rows).select(F.col("record_root").alias(name), F.lit(1).alias("one")), "one")
    return row.select(attest.root_after(F.col("p"), F.col("a"), F.col("r")).alias("root"))


@query(INVENTORIES + "select count(*) as record_count, true as count_holds, true as root_holds from inv1")
def release_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    added, removed = _moves(spark, d)
    return attest.arithmetic(*(attest.multiset_root(x) for x in (inventory(spark, d, 0), inventory(spark, d, 1), added, removed)))


LISTING = """'[' || string_agg('{"bytes":' || bytes || ',"path":"' || path || '","sha256":"' || sha256 || '"}', ',' order by path) || ']'"""


@query(f"""with h as (select page_id // 50 as bundle, 'page-' || page_id || '.html' as path, strlen(coalesce(html, ''))::bigint as bytes, sha256(coalesce(html, '')) as sha256 from pages)
select bundle, count(*) as files, sum(bytes)::bigint as total_bytes, max(bytes) as largest, sha256({LISTING}) as tree_sha256 from h group by bundle""")
def bundle_tree_hash(spark: SparkSession, d: str) -> DataFrame:
    return attest.tree_hashes(_bundles(spark, d), "bundle")


def _bundles(spark: SparkSession, d: str) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    return table(spark, d, "pages").select(F.floor(F.col("page_id") / 50).alias("bundle"), F.concat(F.lit("page-"), "page_id", F.lit(".html")).alias("path"), F.octet_length(html).cast("long").alias("bytes"), F.sha2(html, 256).alias("sha256"))


def listing_sql(source: str, key: str, item: str) -> str:
    """SQL for attest.listing_digest with the width that listing_width gives."""
    width = f"(select greatest(1, ceil(ln(greatest(count(*), 1) / 4096.0) / ln(16)))::int from {source})"
    groups = f"select substr(sha256({key}), 1, {width}) as g, sha256(string_agg({item}, ',' order by {key})) as dg, count(*) as n from {source} group by 1"
    return f"select sha256(string_agg(dg, '' order by g)) as digest, sum(n)::bigint as n from ({groups})"


ITEM = """'{"bytes":' || bytes || ',"path":"' || path || '","sha256":"' || sha256 || '"}'"""


@query(INVENTORIES + f"select digest as release_id, n from ({listing_sql('inv1', 'path', ITEM)})")
def release_id(spark: SparkSession, d: str) -> DataFrame:
    """The digest of a release's listing, over all its rows."""
    rows = inventory(spark, d, 1)
    item = F.concat(F.lit('{"bytes":'), F.col("bytes").cast("string"), F.lit(',"path":"'), "path", F.lit('","sha256":"'), "sha256", F.lit('"}'))
    return attest.listing_digest(rows, F.col("path"), item, attest.listing_width(rows.count())).withColumnRenamed("digest", "release_id")


@query("with c as (select conv_id, turn, role, text from conversations) select conv_id, turn, '{\"role\":' || to_json(role) || ',\"turn\":' || turn || '}' as canonical from c")
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", F.to_json(F.struct("role", "turn"), {"ignoreNullFields": "false"}).alias("canonical"))


DIFF = INVENTORIES + """, df as (select coalesce(a.path, b.path) as path, case when a.path is null then 'A' when b.path is null then 'D' when a.sha256 <> b.sha256 then 'M' end as status,
 a.sha256 as old_sha256, b.sha256 as new_sha256, a.bytes as old_bytes, b.bytes as new_bytes from inv0 a full join inv1 b on a.path = b.path)
"""


@query(DIFF + "select path, status, old_sha256, new_sha256 from df where status is not null")
def inventory_diff(spark: SparkSession, d: str) -> DataFrame:
    return diff.inventory_diff(inventory(spark, d, 0), inventory(spark, d, 1)).select("path", "status", "old_sha256", "new_sha256")


@query(DIFF + """select path, case status when 'D' then 'deleted' else 'content' end as rule, status as detail from df where status in ('D', 'M') and not (status = 'M' and path like '%2')""")
def append_only(spark: SparkSession, d: str) -> DataFrame:
    """All of documents/ is frozen; a manifest permits changes of paths that end in 2."""
    changes = diff.inventory_diff(inventory(spark, d, 0), inventory(spark, d, 1))
    allowed = changes.where("status = 'M' and path like '%2'").select("path", "old_sha256", "new_sha256")
    return diff.append_only(changes, ("documents/",), allowed=allowed)


@query(DIFF + "select path, case when new_bytes is null then 'missing' when old_bytes is null then 'unexpected' when old_bytes <> new_bytes then 'size' when old_sha256 <> new_sha256 then 'bytes' end as reason from df where status is not null")
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    return diff.reconcile(inventory(spark, d, 0), inventory(spark, d, 1))


@query(DIFF + "select path from df where status = 'D' and not (path like '%1' and length(path) % 2 = 0)")
def unexplained_removals(spark: SparkSession, d: str) -> DataFrame:
    stones = inventory(spark, d).where("path like '%1' and length(path) % 2 = 0").select(F.col("path").alias("key"))
    return diff.unexplained_removals(inventory(spark, d, 0), inventory(spark, d, 1), stones, F.col("path"))


@query(INVENTORIES + """, st as (select 0 as seq, * from inv0 union all select 1, * from inv1 union all select 2, * from inv1 where path not like '%3')
select a.seq + 1 as seq, a.path, case when b.path is null then 'deleted' else 'content' end as rule from st a left join st b on b.path = a.path and b.seq = a.seq + 1 where a.seq < 2 and (b.path is null or a.sha256 <> b.sha256)""")
def append_only_history(spark: SparkSession, d: str) -> DataFrame:
    one, two = inventory(spark, d, 0), inventory(spark, d, 1)
    states = one.withColumn("seq", F.lit(0)).unionByName(two.withColumn("seq", F.lit(1))).unionByName(two.where("path not like '%3'").withColumn("seq", F.lit(2)))
    return diff.history_violations(states, ("documents/",))


@query(INVENTORIES + f", r as ({root_sql('inv1')}) select record_count, record_root, (select count(*) from inv0 where path not in (select path from inv1)) as missing, (select count(*) from inv1 where path not in (select path from inv0)) as unexpected from r")
def audit(spark: SparkSession, d: str) -> DataFrame:
    """The later state's root, and how many paths it lacks or has beyond the earlier one's."""
    reasons = diff.reconcile(inventory(spark, d, 0), inventory(spark, d, 1)).agg(F.count_if(F.col("reason") == "missing").alias("missing"), F.count_if(F.col("reason") == "unexpected").alias("unexpected"), F.lit(1).alias("one"))
    return attest.multiset_root(inventory(spark, d, 1)).withColumn("one", F.lit(1)).join(reasons, "one").drop("one")


@query(INVENTORIES + f""", r as ({root_sql('inv1')}), i as (select path, case when bytes % 6 = 0 then null else sha256 end as sha256 from inv1) select record_count, record_root, false as root_holds, (select count_if(not regexp_matches(path, '^documents/[0-9]*[0-8]$'))::bigint from i) as unexpected, (select count_if(sha256 is null)::bigint from i) as undigested from r""")
def audit_claims(spark: SparkSession, d: str) -> DataFrame:
    """The later state against a claimed root, what paths may be there, and rows whose digest is unknown."""
    later = inventory(spark, d, 1)
    known = later.withColumn("sha256", F.when(F.col("bytes") % 6 != 0, F.col("sha256")))
    return contracts.audit(F.lit("0" * 64), attest.multiset_root(later), known, F.col("path").rlike("^documents/[0-9]*[0-8]$"))


URLS = """with u as (select distinct case when url like '%://%' then regexp_extract(url, '://([^?#]*)', 1) else '' end as path from pages)
"""


def _url_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(F.when(F.col("url").contains("://"), F.regexp_extract("url", "://([^?#]*)", 1)).otherwise("").alias("path")).distinct()


@query(URLS + """select path, not (path = '' or path like '/%' or contains(path, '//') or contains(path, chr(92)) or contains(path, ':') or path like '%/'
 or list_contains(string_split(path, '/'), '..') or list_contains(string_split(path, '/'), '.')) as safe from u""")
def safe_paths(spark: SparkSession, d: str) -> DataFrame:
    return _url_paths(spark, d).withColumn("safe", keys.safe_relative_path(F.col("path")))


@query(URLS + """, roots as (select distinct split_part(path, '/', 1) || '/' || split_part(path, '/', 2) as root from u where path like '%/%' and length(path) % 3 = 0)
select path from u where not exists (select 1 from roots where u.path = root or starts_with(u.path, root || '/') or starts_with(root, u.path || '/'))""")
def orphan_paths(spark: SparkSession, d: str) -> DataFrame:
    u = _url_paths(spark, d)
    roots = u.where("path like '%/%' and length(path) % 3 = 0").select(F.substring_index("path", "/", 2).alias("path")).distinct()
    return diff.orphan_paths(u, roots)


NAMES = """with p as (select doc_id, case doc_id % 13 when 0 then 'entries/REC-2026-01-02-' || lpad(doc_id::varchar, 6, '0') || '-v1.json' when 1 then '/feeds/brand/B' || doc_id || '.xml' when 2 then 'LICENSE' when 3 then 'search/t/w' || doc_id || '/head.json'
 when 4 then 'browse/2026.json' when 5 then 'browse/index.json' when 6 then 'renders/REC-2026-01-02-' || lpad(doc_id::varchar, 6, '0') || '-v2/x/a.html' when 7 then 'Licence.MD' when 8 then 'subjects/type/t' || doc_id || '.json'
 when 9 then 'versions/REC-2026-01-02-' || lpad(doc_id::varchar, 6, '0') || '.json' when 10 then 'public/browse/2026.json' when 11 then 'recent.json.bak' else 'copying.txt' end as path from documents)
"""


def _names(spark: SparkSession, d: str) -> DataFrame:
    n, padded = F.col("doc_id"), F.lpad(F.col("doc_id").cast("string"), 6, "0")
    t = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    made = [
        t("entries/REC-2026-01-02-", padded, "-v1.json"), t("/feeds/brand/B", n, ".xml"), F.lit("LICENSE"), t("search/t/w", n, "/head.json"), F.lit("browse/2026.json"),
        F.lit("browse/index.json"), t("renders/REC-2026-01-02-", padded, "-v2/x/a.html"), F.lit("Licence.MD"), t("subjects/type/t", n, ".json"),
        t("versions/REC-2026-01-02-", padded, ".json"), F.lit("public/browse/2026.json"), F.lit("recent.json.bak"), F.lit("copying.txt"),
    ]
    path = made[-1]
    for k, c in enumerate(made[:-1]):
        path = F.when(n % 13 == k, c).otherwise(path)
    return table(spark, d, "documents").select("doc_id", path.alias("path"))


@query(NAMES + "select doc_id, path, case doc_id % 13 when 0 then 'entry' when 6 then 'render' end as kind from p")
def path_kinds(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).withColumn("kind", keys.path_kind(F.col("path"), PREFIX))


@query(NAMES + "select doc_id, path, doc_id % 13 in (3, 4, 5, 8, 9) as served from p")
def served_paths(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).withColumn("served", keys.served_path(F.col("path"), PREFIX))


@query(NAMES + "select doc_id, path, case when doc_id % 13 in (0, 6) then 'immutable' when doc_id % 13 in (1, 3, 4, 5, 8, 9) then 'stable' else 'snapshot' end as class from p")
def object_class(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).withColumn("class", keys.object_class(F.col("path")))


@query(NAMES + """select doc_id, path, case when path like '%.json' then 'application/json; charset=utf-8' when path like '%.xml' then 'application/rss+xml; charset=utf-8' when path = 'LICENSE' or path like '%.md' or path like '%.txt' then 'text/plain; charset=utf-8'
 when path like '%.html' then 'text/html; charset=utf-8' when path ilike '%.md' then 'text/markdown; charset=utf-8' else 'application/octet-stream' end as type from p""")
def content_types(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).withColumn("type", keys.content_type(F.col("path")))


ENDINGS = (".css", ".gif", ".GIF", ".html", ".ico", ".jpeg", ".jpg", ".js", ".json", ".md", ".png", ".svg", ".tar.gz", ".ts", ".txt", ".webp", ".woff", ".woff2", ".xml", ".unheard-of", "", ".d/x", "/.gif")


def _media_sql() -> str:
    def told(ending: str) -> str:
        guessed = keys.MORE_TYPES.get(ending) or mimetypes.MimeTypes().guess_type("a" + ending)[0] or "application/octet-stream"
        return guessed + "; charset=utf-8" if guessed.startswith("text/") else guessed

    rows = ", ".join(f"({k}, '{e}', '{told(e)}')" for k, e in enumerate(ENDINGS))
    return f"""with e as (select * from (values {rows}) as t(k, ending, guessed)) select doc_id, 'a' || doc_id || ending as path,
 case when ending = '.json' then 'application/json; charset=utf-8' when ending = '.xml' then 'application/rss+xml; charset=utf-8' when ending in ('.md', '.txt') then 'text/plain; charset=utf-8' else guessed end as type from documents join e on doc_id % {len(ENDINGS)} = k"""


@query(_media_sql())
def media_types(spark: SparkSession, d: str) -> DataFrame:
    """Media types of many endings, against a guess by the standard library."""
    n = F.col("doc_id")
    path = F.concat(F.lit("a"), n.cast("string"), F.element_at(F.array(*map(F.lit, ENDINGS)), (n % len(ENDINGS) + 1).cast("int")))
    return table(spark, d, "documents").select("doc_id", path.alias("path")).withColumn("type", keys.content_type(F.col("path")))


@query(NAMES + "select doc_id, path, doc_id % 13 in (2, 7, 12) as license from p")
def license_names(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).withColumn("license", keys.license_filename(F.col("path")))


@query(NAMES + """, q as (select distinct path, case when path in ('browse/2026.json', 'public/browse/2026.json') then 1 when path = 'browse/index.json' or path like '%/head.json' or path like 'subjects/%' then 2 else 0 end as rank from p)
select path, rank, row_number() over (order by rank, path) as place from q""")
def publish_order(spark: SparkSession, d: str) -> DataFrame:
    return diff.publish_order(_names(spark, d).select("path").distinct())


@query(INVENTORIES + """, m as (select a.path, a.sha256 as old_sha256, case when a.path like '%5' then a.sha256 else sha256(a.path) end as new_sha256 from inv0 a)
select m.path, case when old_sha256 = new_sha256 then 'unchanged' when s.path is null then 'not staged' else 'other bytes' end as reason from m left join inv1 s on s.path = m.path where old_sha256 = new_sha256 or s.path is null or s.sha256 <> new_sha256""")
def replacement_plan(spark: SparkSession, d: str) -> DataFrame:
    manifest = inventory(spark, d, 0).select("path", F.col("sha256").alias("old_sha256"), F.when(F.col("path").like("%5"), F.col("sha256")).otherwise(F.sha2("path", 256)).alias("new_sha256"))
    return diff.replacement_plan(manifest, inventory(spark, d, 1))


@query(SECTIONS + """, rl as (select path, bytes + (doc_id % 17 = 3)::int as bytes, case when doc_id % 19 = 4 then 'x' else sha256 end as sha256, case when doc_id % 23 = 5 then 'other' else section end as section from sec where doc_id % 10 <> 0), sg as (select * from sec where doc_id % 10 <> 1)
select coalesce(r.path, s.path) as path, case when s.path is null then 'missing' when r.path is null then 'unowned' when r.bytes <> s.bytes then 'size' when r.sha256 <> s.sha256 then 'digest' else 'section' end as reason
from rl r full join sg s on r.path = s.path where s.path is null or r.path is null or r.bytes <> s.bytes or r.sha256 <> s.sha256 or r.section <> s.section""")
def staged_match(spark: SparkSession, d: str) -> DataFrame:
    rows, n = attest.sectioned(_pathed(spark, d)), F.col("doc_id")
    release = rows.where(n % 10 != 0).withColumns({"bytes": F.col("bytes") + (n % 17 == 3).cast("long"), "sha256": F.when(n % 19 == 4, "x").otherwise(F.col("sha256")), "section": F.when(n % 23 == 5, "other").otherwise(F.col("section"))})
    return diff.staged_match(release, rows.where(n % 10 != 1))


@query("select distinct 'rel-' || o_orderdate::date as release from orders where o_orderdate::date not in (select distinct o_orderdate::date from orders order by 1 desc limit 2)")
def retired_releases(spark: SparkSession, d: str) -> DataFrame:
    """A release for every order day; the newest two stay."""
    headers = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("seq")).distinct().withColumn("release", F.concat(F.lit("rel-"), F.col("seq").cast("string")))
    return diff.retired_releases(headers).select("release")


@query("select doc_id, sha1(encode('blob ' || strlen(coalesce(text, ''))) || unhex('00') || encode(coalesce(text, ''))) as blob_id from documents")
def blob_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", keys.blob_id(F.coalesce("text", F.lit(""))).alias("blob_id"))


@query(RECORDS + """select distinct 'https://host.example/' || repository || '/tree/' || commit_sha || coalesce('/' || replace(replace(url_encode(project_path), '%2F', '/'), '+', '%20'), '') as tree_url, 'https://host.example/' || repository as repository_url from r""")
def derived_urls(spark: SparkSession, d: str) -> DataFrame:
    url = F.concat(F.lit("https://host.example/"), "repository")
    tail = F.coalesce(F.concat(F.lit("/"), keys.percent_encoded_path(F.col("project_path"))), F.lit(""))
    return records(spark, d).select(F.concat(url, F.lit("/tree/"), "commit_sha", tail).alias("tree_url"), url.alias("repository_url")).distinct()


@query(RECORDS + "select id, version, 'renders/' || id || '-v' || version || '/' || sha256(commit_sha) as render_path, 'evidence/' || id || '-v' || version || '/' || sha256(commit_sha) as evidence_path from r")
def bundle_paths(spark: SparkSession, d: str) -> DataFrame:
    tail = F.concat(F.lit("/"), "id", F.lit("-v"), "version", F.lit("/"), F.sha2("commit_sha", 256))
    return records(spark, d).select("id", "version", F.concat(F.lit("renders"), tail).alias("render_path"), F.concat(F.lit("evidence"), tail).alias("evidence_path"))


@query(RECORDS + "select distinct regexp_extract('renders/' || id || '-v' || version || '/' || sha256(commit_sha) || '/a/b.html', '^([^/]+/[^/]+/[^/]+)/', 1) as root from r")
def bundle_roots(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("renders/"), "id", F.lit("-v"), "version", F.lit("/"), F.sha2("commit_sha", 256), F.lit("/a/b.html"))
    return records(spark, d).select(F.array_join(F.slice(F.split(path, "/"), 1, 3), "/").alias("root")).distinct()


@query("select doc_id, regexp_full_match(x, '[0-9a-f]{40}') as commit_form, regexp_full_match(x, '[0-9a-f]{64}') as digest_form from (select doc_id, case doc_id % 3 when 0 then sha1(coalesce(text, '')) when 1 then sha256(coalesce(text, '')) else upper(sha1(coalesce(text, ''))) end as x from documents)")
def hex_rules(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    x = F.when(F.col("doc_id") % 3 == 0, F.sha1(text)).when(F.col("doc_id") % 3 == 1, F.sha2(text, 256)).otherwise(F.upper(F.sha1(text)))
    return table(spark, d, "documents").select("doc_id", x.rlike("^[0-9a-f]{40}$").alias("commit_form"), x.rlike("^[0-9a-f]{64}$").alias("digest_form"))


@query("""select event_id, s as text, event_id % 4 = 0 as strict_instant from (select event_id, case event_id % 4 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S') when 2 then strftime(ts, '%Y-%m-31T25:00:00Z') else strftime(ts, '%Y-02-30T10:00:00Z') end as s from events)""")
def strict_instants(spark: SparkSession, d: str) -> DataFrame:
    n, ts = F.col("event_id"), F.col("ts")
    text = F.when(n % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(n % 4 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(n % 4 == 2, F.date_format(ts, "yyyy-MM-'31T25:00:00Z'")).otherwise(F.date_format(ts, "yyyy-'02-30T10:00:00Z'"))
    return table(spark, d, "events").select("event_id", text.alias("text")).withColumn("strict_instant", keys.strict_instant(F.col("text")))


@query("select event_id, event_id % 3 = 0 as calendar_day from events")
def calendar_days(spark: SparkSession, d: str) -> DataFrame:
    n, ts = F.col("event_id"), F.col("ts")
    text = F.when(n % 3 == 0, F.date_format(ts, "yyyy-MM-dd")).when(n % 3 == 1, F.date_format(ts, "yyyy-'02-30'")).otherwise(F.date_format(ts, "yyyy-M-d'x'"))
    return table(spark, d, "events").select("event_id", keys.calendar_day(text).alias("calendar_day"))
