"""Queries that validate: rules over records, relations between tables, and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import attest, contracts, migrate, rules
from ledgerline.operators.ordering import numbered
from ledgerline.plans.base import INVENTORIES, RECORDS, query
from ledgerline.plans.inventories import listing_sql
from ledgerline.sources.views import PREFIX, instant, inventory, records, reviews, table, takedowns

ENTITY = "id || '-v' || version"


def _entity():
    return F.concat_ws("-v", "id", F.col("version").cast("string"))


@query(RECORDS + f"""select {ENTITY} as entity, 'length' as rule, 'title' as field from r where length(title) not between 1 and 8 union all select {ENTITY}, 'enum', 'type' from r where type not in ('ECONOMY', 'STANDARD', 'PROMO')
 union all select {ENTITY}, 'minimum', 'size' from r where size < 10 union all select {ENTITY}, 'required', 'project_path' from r where project_path is null union all select {ENTITY}, 'pattern', 'brand' from r where not regexp_full_match(brand, 'Brand#[1-3][0-9]*')""")
def shape_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.validate(records(spark, d), _entity(), [rules.length("title", 1, 8), rules.one_of("type", ("ECONOMY", "STANDARD", "PROMO")), rules.at_least("size", 10), rules.required("project_path"), rules.pattern("brand", "Brand#[1-3][0-9]*"), rules.pattern("id", keys.identifier(PREFIX))])


@query(RECORDS + f"select {ENTITY} as entity, 'conditional' as rule, 'project_path' as field from r where type = 'PROMO' and project_path is null union all select {ENTITY}, 'either', 'source' from r where (project_path is null) = (size > 25)")
def conditional_rules(spark: SparkSession, d: str) -> DataFrame:
    """One type needs a project path; a record has a project path or is large, not both or neither."""
    needs = rules.Rule("conditional", "project_path", (F.col("type") == "PROMO") & F.col("project_path").isNull())
    return rules.validate(records(spark, d), _entity(), [needs, rules.either("source", F.col("project_path").isNull(), F.col("size") > 25)])


@query(RECORDS + f"select {ENTITY} as entity, case when version > 3 then 'file name' else 'first day' end as rule from r where version > 3 or substr(id, 5, 10) <> (registered_at::date)::varchar")
def key_rules(spark: SparkSession, d: str) -> DataFrame:
    """File names that stop at v3, and identifiers whose day is not that of the registration."""
    r = records(spark, d)
    name = F.concat(_entity(), F.lit(".json"))
    file = F.concat(F.col("id"), F.lit("-v"), F.least("version", F.lit(3)).cast("string"), F.lit(".json"))
    rule = F.when(name != file, "file name").when(keys.coordinate(F.col("id"), PREFIX)["day"] != F.to_date("registered_at").cast("string"), "first day")
    return r.select(_entity().alias("entity"), rule.alias("rule")).where("rule is not null")


@query(RECORDS + f", f as (select id, registered_at as first_at from r where version = 1) select {ENTITY} as entity, case when registered_at < first_at then 'before first' else 'day' end as rule from r join f using (id) where registered_at < first_at or version = 1 and registered_at::date <> day")
def date_rules(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d)
    first = r.where("version = 1").select("id", F.col("registered_at").alias("first_at"))
    rule = F.when(F.col("registered_at") < F.col("first_at"), "before first").when((F.col("version") == 1) & (F.to_date("registered_at") != F.col("day")), "day")
    return r.join(first, "id").select(_entity().alias("entity"), rule.alias("rule")).where("rule is not null")


@query(RECORDS + f"select {ENTITY} as entity, lower(brand) as missing from r where lower(brand) not in ('brand#11', 'brand#12', lower(repository)) and not (lower(brand) = 'brand#13')")
def dependency_subset(spark: SparkSession, d: str) -> DataFrame:
    """Dependencies (after alias and lower case) that are not among the declared ones."""
    alias = F.when(F.lower("brand") == "brand#13", "brand#12").otherwise(F.lower("brand"))
    missing = F.array_except(F.array(alias), F.array(F.lit("brand#11"), F.lit("brand#12"), F.lower("repository")))
    return records(spark, d).select(_entity().alias("entity"), F.explode(missing).alias("missing"))


@query(RECORDS + f"select {ENTITY} as entity, 'trust' as rule, 'brand' as field from r where type = 'ECONOMY' and brand not in ('Brand#11', 'Brand#12') union all select {ENTITY}, 'retired', 'size' from r where size = 13")
def trust_rules(spark: SparkSession, d: str) -> DataFrame:
    trust = rules.Rule("trust", "brand", (F.col("type") == "ECONOMY") & ~F.col("brand").isin("Brand#11", "Brand#12"))
    return rules.validate(records(spark, d), _entity(), [trust, rules.Rule("retired", "size", F.col("size") == 13)])


SOURCES = "list_sort(list_distinct([repository, lower(brand), case when size % 2 = 0 then 'lib/' || lower(type) else repository end]))"


@query(RECORDS + f"select {ENTITY} as entity, array_to_string({SOURCES}, ',') as sources from r")
def preservation_sources(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select(_entity().alias("entity"), F.array_join(_sources(), ",").alias("sources"))


def _sources():
    """A record's own source, its dependency and its upstream one, distinct in lower case, sorted."""
    upstream = F.when(F.col("size") % 2 == 0, F.concat(F.lit("lib/"), F.lower("type"))).otherwise(F.col("repository"))
    return F.array_sort(F.array_distinct(F.transform(F.array("repository", "brand", upstream), F.lower)))


@query(RECORDS + f"select {ENTITY} as entity, 'cover' as rule from r where size % 4 = 0 and len({SOURCES}) > 0")
def preservation_exact(spark: SparkSession, d: str) -> DataFrame:
    """Records whose mappings don't cover their sources exactly and in order: each fourth size lacks the first one."""
    listed = F.when(F.col("size") % 4 == 0, F.slice(_sources(), 2, 100)).otherwise(_sources())
    return records(spark, d).where(~listed.eqNullSafe(_sources())).select(_entity().alias("entity"), F.lit("cover").alias("rule"))


@query(RECORDS + f""", td as (select id, version, case when orderkey % 11 = 0 then strftime(registered_at, '%Y-%m-%d') else strftime(registered_at, '%Y-%m-%dT%H:%M:%SZ') end as at_, ' Owner-' || (orderkey % 7) || ' ' as login, orderkey % 5 as issue, case when orderkey % 13 = 0 then '' else 'r' end as reason from t
 union all select id, 77, '2026-01-01T00:00:00Z', 'owner-1', 1, 'r' from t where serial = 1)
select {ENTITY} as entity, 'instant' as rule, 'taken_down_at' as field from td where length(at_) = 10 union all select {ENTITY}, 'authority', 'login' from td where lower(trim(login)) in ('owner-5', 'owner-6') union all select {ENTITY}, 'minimum', 'issue' from td where issue < 1
union all select {ENTITY}, 'length', 'reason' from td where reason = '' union all select id || '-v77', 'exists', 'target' from t where serial = 1 union all select distinct id || '-v77', 'unique', 'target' from t where serial = 1 and id in (select id from t where serial = 1 group by id having count(*) > 1)""")
def takedown_rules(spark: SparkSession, d: str) -> DataFrame:
    t, n = takedowns(spark, d), F.col("orderkey")
    at = F.when(n % 11 == 0, F.date_format("taken_down_at", "yyyy-MM-dd")).otherwise(instant(F.col("taken_down_at")))
    rows = t.select("id", "version", at.alias("taken_down_at"), F.concat(F.lit(" Owner-"), n % 7, F.lit(" ")).alias("login"), (n % 5).alias("issue"), F.when(n % 13 == 0, "").otherwise("r").alias("reason"))
    extra = t.where("id like '%-000001'").select("id", F.lit(77).cast("long").alias("version"), F.lit("2026-01-01T00:00:00Z").alias("taken_down_at"), F.lit("owner-1").alias("login"), F.lit(1).cast("long").alias("issue"), F.lit("r").alias("reason"))
    authorities = spark.createDataFrame([(f"Owner-{k}",) for k in range(5)], "login string")
    return rules.takedown_rules(rows.unionByName(extra), records(spark, d), authorities)


@query("""with s as (select doc_id + (doc_id % 50 = 3)::int * 1000000 as doc_id, quality, toxic from labels), rc as (select doc_id, case when doc_id % 9 = 0 then 1 - quality else quality end as quality, toxic from labels)
select coalesce(rc.doc_id, s.doc_id) as entity, case when s.doc_id is null then 'missing' when rc.doc_id is null then 'orphan' else 'binding' end as rule from rc full join s on rc.doc_id = s.doc_id
where s.doc_id is null or rc.doc_id is null or rc.quality is distinct from s.quality or rc.toxic is distinct from s.toxic""")
def score_reconcile(spark: SparkSession, d: str) -> DataFrame:
    labels, n = table(spark, d, "labels"), F.col("doc_id")
    scores = labels.withColumn("doc_id", n + F.when(n % 50 == 3, 1000000).otherwise(0))
    scored = labels.withColumn("quality", F.when(n % 9 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    return rules.score_reconcile(scored, scores, "doc_id", ("quality", "toxic"))


@query("select conv_id, turn, '' as extra, '' as missing from conversations where turn % 3 <> 0 union all select conv_id, turn, 'extra', '' from conversations where turn % 3 = 0")
def closed_shapes(spark: SparkSession, d: str) -> DataFrame:
    extra, missing = rules.closed_shape(F.col("body"), ("schema_version", "outcome", "submission_id", "checks"), ("outcome", "checks"))
    return reviews(spark, d).select("conv_id", "turn", extra.alias("extra"), missing.alias("missing"))


@query("select conv_id, turn, 'extra' as field, 'review' as level from conversations where turn % 3 = 0 union all select conv_id, turn, 'severity', 'finding' from conversations")
def public_allowlist(spark: SparkSession, d: str) -> DataFrame:
    return rules.public_allowlist(reviews(spark, d), ("conv_id", "turn"), "body")


@query("select conv_id, turn, turn % 4 = 0 as strict from conversations")
def strict_json(spark: SparkSession, d: str) -> DataFrame:
    """Each second document repeats a key, some deep down; others hold NaN, or are lists."""
    n = F.col("turn") % 4
    body = F.when(n == 0, F.col("body")).when(n == 1, F.concat(F.lit('{"a":'), "body", F.lit(',"a":1}'))).when(n == 2, F.concat(F.lit('{"a":{"b":1,"b":2},"c":'), "body", F.lit("}"))).otherwise(F.concat(F.lit("["), "body", F.lit("]")))
    return reviews(spark, d).select("conv_id", "turn", rules.strict_json(body).alias("strict"))


TAGS = """with c as (select page_id, regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g') as h from pages), x as (select page_id, regexp_extract_all(h, '<(/?[a-zA-Z][a-zA-Z0-9]*)([^>]*)>', 0) as raws from c),
tg as (select page_id, generate_subscripts(raws, 1) as pos, unnest(raws) as raw from x), ts as (select page_id, pos, lower(regexp_extract(raw, '<(/?[a-zA-Z][a-zA-Z0-9]*)([^>]*)>', 1)) as tag, regexp_extract(raw, '<(/?[a-zA-Z][a-zA-Z0-9]*)([^>]*)>', 2) as attributes from tg)
"""


@query(TAGS + """, m as (select *, min(pos) filter (where tag = 'meta' and contains(lower(attributes), 'content-security-policy')) over (partition by page_id) as policy from ts)
select page_id, count_if(tag in ('iframe', 'object', 'embed', 'base', 'form'))::bigint as forbidden, count_if(regexp_matches(attributes, '(?i)\\son[a-z]+\\s*='))::bigint as event, count_if(regexp_matches(attributes, '(?i)(?:href|src)\\s*=\\s*["'']?\\s*javascript:'))::bigint as script_url,
 count_if(tag = 'head')::bigint as heads, count_if(tag = 'script' and (policy is null or pos < policy))::bigint as unguarded from m group by page_id""")
def html_tag_audit(spark: SparkSession, d: str) -> DataFrame:
    tags = rules.tag_stream(table(spark, d, "pages"), "page_id", "html")
    return rules.html_tag_audit(tags, "page_id", ("iframe", "object", "embed", "base", "form"))


@query("""with h as (select page_id % 50 as bundle, case when page_id % 7 = 0 then 'p' || page_id || '.exe' else 'p' || page_id || '.html' end as path, strlen(coalesce(html, '')) as bytes from pages)
select bundle, 'extension' as rule, path as detail from h where path like '%.exe' union all select bundle, 'files', count(*)::varchar from h group by bundle having count(*) > 4 union all select bundle, 'bytes', sum(bytes)::varchar from h group by bundle having sum(bytes) > 40000""")
def bundle_rules(spark: SparkSession, d: str) -> DataFrame:
    """Caps of 4 files and 40,000 bytes; one ending is not allowed."""
    html = F.coalesce("html", F.lit(""))
    files = table(spark, d, "pages").select((F.col("page_id") % 50).alias("bundle"), F.concat(F.lit("p"), "page_id", F.when(F.col("page_id") % 7 == 0, ".exe").otherwise(".html")).alias("path"), F.octet_length(html).cast("long").alias("bytes"))
    bad = files.where(~F.lower(F.regexp_extract("path", r"\.[^./]*$", 0)).isin(*ALLOWED_EXTENSIONS)).select("bundle", F.lit("extension").alias("rule"), F.col("path").alias("detail"))
    totals = files.groupBy("bundle").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    many = totals.where("n > 4").select("bundle", F.lit("files").alias("rule"), F.col("n").cast("string").alias("detail"))
    large = totals.where("b > 40000").select("bundle", F.lit("bytes").alias("rule"), F.col("b").cast("string").alias("detail"))
    return bad.unionByName(many).unionByName(large)


#: Endings that a rendered bundle may hold.
ALLOWED_EXTENSIONS = (".css", ".gif", ".html", ".ico", ".jpeg", ".jpg", ".js", ".json", ".md", ".png", ".ts", ".txt", ".webp", ".woff", ".woff2")


@query(RECORDS + f", s as (select *, case when size % 10 = 0 then title || '!' else title end as served_title from a) select {ENTITY} as entity from s where served_title <> title")
def version_binding(spark: SparkSession, d: str) -> DataFrame:
    """Served rows that are not what the registry says."""
    r = records(spark, d).where("not withdrawn").select("id", "version", "title", "brand", "size")
    served = r.withColumn("title", F.when(F.col("size") % 10 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title")))
    return contracts.served_rows(served, r, ["id", "version"], ["title", "brand"], _entity()).select("entity")


@query(RECORDS + f"select {ENTITY} as entity, 'commit' as field, upper(commit_sha) as actual, commit_sha as expected from r where size % 6 = 0 union all select {ENTITY}, 'project', null, project_path from r where project_path is not null and size % 8 = 0")
def binding_violations(spark: SparkSession, d: str) -> DataFrame:
    """A report's fields against the record's."""
    r = records(spark, d).withColumn("entity", _entity())
    commit = F.when(F.col("size") % 6 == 0, F.upper("commit_sha")).otherwise(F.col("commit_sha"))
    project = F.when(F.col("size") % 8 == 0, F.lit(None)).otherwise(F.col("project_path"))
    return rules.bindings(r, "entity", [("commit", commit, F.col("commit_sha")), ("project", project, F.col("project_path")), ("brand", F.col("brand"), F.col("brand"))])


@query(INVENTORIES + "select coalesce(a.path, b.path) as path, a.path is null as extra, b.path is null as missing from inv0 a full join inv1 b on a.path = b.path and a.bytes = b.bytes and a.sha256 = b.sha256 where a.path is null or b.path is null")
def evidence_match(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one inventory that the other does not carry with the same size and digest."""
    one, two = inventory(spark, d, 0), inventory(spark, d, 1)
    marked = one.withColumn("a", F.lit(True)).join(two.withColumn("b", F.lit(True)), ["path", "bytes", "sha256"], "full_outer")
    return marked.where("a is null or b is null").select("path", F.col("a").isNull().alias("extra"), F.col("b").isNull().alias("missing"))


TARGET = """'{"source_repository":"' || repository || '","commit":"' || commit_sha || '","fork":"' || owner || '"}'"""


@query(RECORDS + ", tg as (select distinct repository, commit_sha, owner from a) " + listing_sql("tg", "(repository || ' ' || commit_sha || ' ' || owner)", TARGET))
def target_digest(spark: SparkSession, d: str) -> DataFrame:
    """The digest of the list of all targets."""
    t = records(spark, d).where("not withdrawn").select(F.col("repository").alias("source_repository"), F.col("commit_sha").alias("commit"), F.col("owner").alias("fork")).distinct()
    key = F.concat_ws(" ", "source_repository", "commit", "fork")
    return attest.listing_digest(t, key, F.to_json(F.struct("source_repository", "commit", "fork")), attest.listing_width(t.count()))


@query(RECORDS + f", p as (select 'entries/' || {ENTITY} || '.json' as path from r where version % 2 = 1 union all select 'renders/' || {ENTITY} || '/x/a.html' from r where version % 2 = 0) select regexp_extract(path, '^(?:entries|renders)/(.*)-v([0-9]+)', 1) as id, regexp_extract(path, '-v([0-9]+)', 1)::bigint as version, starts_with(path, 'entries/') as is_entry from p")
def release_versions(spark: SparkSession, d: str) -> DataFrame:
    """The versions that a release's paths name."""
    r = records(spark, d)
    path = F.when(F.col("version") % 2 == 1, F.concat(F.lit("entries/"), _entity(), F.lit(".json"))).otherwise(F.concat(F.lit("renders/"), _entity(), F.lit("/x/a.html")))
    shape = rf"^(?:entries|renders|evidence)/({keys.identifier(PREFIX)})-v([1-9][0-9]*)(?:\.json|/.+)$"
    return r.select(path.alias("path")).select(F.regexp_extract("path", shape, 1).alias("id"), F.regexp_extract("path", shape, 2).cast("long").alias("version"), F.col("path").startswith("entries/").alias("is_entry"))


@query(INVENTORIES + ", o as (select path, lag(path) over (order by doc_id) as before, doc_id from inv) select path, 'order' as rule from o where before is not null and not before < path")
def release_rules(spark: SparkSession, d: str) -> DataFrame:
    """Paths in document order that don't ascend, and unsafe ones; one release's section is one sorted list."""
    rows = numbered(inventory(spark, d), F.substring_index("path", "/", -1).cast("long")).withColumn("place", F.col("place") - 1)
    unsafe = rows.where(~keys.safe_relative_path(F.col("path"))).select("path", F.lit("unsafe").alias("rule"))
    return contracts.out_of_order(rows, "path", [], "place", F.col("path")).select(F.col("entity").alias("path"), "rule").unionByName(unsafe)


WORDS = (("the", "one"), ("one of", "some of"), ("and", "or"))


@query("select doc_id, sha256(replace(replace(replace(coalesce(text, ''), 'the', 'one'), 'one of', 'some of'), 'and', 'or')) as migrated from documents")
def text_migration(spark: SparkSession, d: str) -> DataFrame:
    rows = migrate.migrate_columns(table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"], WORDS)
    return rows.select("doc_id", F.sha2("text", 256).alias("migrated"))


@query("select conv_id, turn, case role when 'user' then 'neutral' when 'assistant' then 'revision_required' else role end as outcome from conversations")
def enum_migration(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", migrate.migrate_enum(F.col("role"), {"user": "neutral", "assistant": "revision_required"}).alias("outcome"))


@query(INVENTORIES + "select i.path, i.sha256 as entry_sha256, coalesce(n.sha256, i.sha256) as review_sha256 from inv0 i left join (select a.sha256 as old, b.sha256 from inv0 a join inv1 b on a.path = b.path where a.sha256 <> b.sha256 qualify row_number() over (partition by a.sha256 order by b.sha256) = 1) n on n.old = i.sha256")
def digest_rebind(spark: SparkSession, d: str) -> DataFrame:
    """Old digests replaced by new ones in the columns of one suffix."""
    one, two = inventory(spark, d, 0), inventory(spark, d, 1)
    pairs = one.select("path", F.col("sha256").alias("old")).join(two.select("path", F.col("sha256").alias("new")), "path").where("old <> new").groupBy("old").agg(F.min("new").alias("new"))
    rows = one.select("path", F.col("sha256").alias("entry_sha256"), F.col("sha256").alias("review_sha256"))
    return migrate.rebind(rows, "review_sha256", pairs)


@query(RECORDS + "select id, arg_min(commit_sha, version) as old_commit, arg_max(commit_sha, version) as new_commit from r group by id")
def migration_merge(spark: SparkSession, d: str) -> DataFrame:
    runs = records(spark, d).select("id", F.col("version").alias("run"), F.col("commit_sha").alias("old_commit"), F.col("commit_sha").alias("new_commit"))
    return migrate.merge_manifests(runs, "id")


@query(RECORDS + "select * from (select id, version, 'renders/' || id || '/' || sha256(title) as old_path, 'renders/' || id || '/' || sha256(replace(title, 'e', 'a')) as new_path from r) where old_path <> new_path")
def migration_changes(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed paths that a migration of titles moves."""
    at = lambda c: F.concat(F.lit("renders/"), "id", F.lit("/"), F.sha2(c, 256))
    rows = records(spark, d).select("id", "version", at(F.col("title")).alias("old_path"), at(migrate.migrate_text(F.col("title"), (("e", "a"),))).alias("new_path"))
    return rows.where("old_path <> new_path")
