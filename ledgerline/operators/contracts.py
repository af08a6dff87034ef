"""Contracts of derived documents, bundles and releases: each a table of violations (entity, rule, field).

Documents come as rows: one row per listed record, page, day, term or path, as
the operators that make them leave them. A document that is not there has no
rows; what names it says so (missing_groups).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators.attest import canonical_rows, listing_digests
from ledgerline.operators.ordering import not_contiguous
from ledgerline.operators.rules import Rule, closed_shape, pattern, required, strict_json, validate
from ledgerline.sources import store
from ledgerline.sources.store import Surface

#: Bounds of lists and bundles.
RECENT_ROWS, POSTING_PAGE, POSTING_PAGES, REPOSITORY_ROWS = 200, 128, 2_048, 500
RENDER_CAPS = {"files": 2_000, "nodes": 4_000, "file_bytes": 8 << 20, "bytes": 25 << 20}
EVIDENCE_CAPS = {"files": 5, "nodes": 4_000, "file_bytes": 16 << 20, "bytes": 24 << 20}


def _violations(rows: DataFrame, entity: str | Column, rule: str, field: str) -> DataFrame:
    entity = F.col(entity) if isinstance(entity, str) else entity
    return rows.select(entity.cast("string").alias("entity"), F.lit(rule).alias("rule"), F.lit(field).alias("field"))


def _union(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def too_many(rows: DataFrame, entity: str, most: int) -> DataFrame:
    """One violation where a whole list has more rows than it may."""
    return rows.agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.lit(entity).alias("entity"), F.lit("cap").alias("rule"), F.lit("rows").alias("field"))


def out_of_order(rows: DataFrame, entity: str | Column, group: Sequence[str], position: str, key: Column) -> DataFrame:
    """Rows whose key is not above that of the row before in its group, and groups whose positions don't count from 0 without a gap.

    Neighbours meet by an equi-join on the position, so no group has to fit a
    task; that every row has its neighbour follows from the positions' number
    and ends.
    """
    own = rows.withColumn("_key", key)
    before = own.select(*[F.col(g).alias(f"_{g}") for g in group], (F.col(position) + 1).alias("_position"), F.col("_key").alias("_before"))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    joined = own.join(before, [*same, F.col(position) == F.col("_position")])
    gaps = not_contiguous(rows, group, position).select(F.concat_ws("/", *[F.col(g).cast("string") for g in group], F.lit("positions")).alias("entity"))
    return _violations(joined.where(~(F.col("_before") < F.col("_key"))), entity, "order", position).unionByName(_violations(gaps, "entity", "gap", position))


def repeated(rows: DataFrame, entity: str | Column, by: Sequence[str], field: str) -> DataFrame:
    """Groups with more than one row."""
    return _violations(rows.groupBy(*by).count().where("count > 1"), entity, "unique", field)


def _strings(field: str, form: str | None = None) -> list[Rule]:
    """An array of texts: not empty, distinct, of one form."""
    c = F.col(field)
    rules = [Rule("empty", field, F.coalesce(F.size(c) < 1, F.lit(True))), Rule("unique", field, F.size(F.array_distinct(c)) < F.size(c))]
    if form:
        rules.append(Rule("pattern", field, F.coalesce(F.exists(c, lambda x: ~x.rlike(f"^(?:{form})$")), F.lit(False))))
    return rules


def recent_contract(cards: DataFrame, prefix: str, forms: dict[str, str], archive: str, most: int = RECENT_ROWS) -> DataFrame:
    """The newest cards (position, id, version, versions, status, title, path, published_at, authors, codes in forms, theorem_names, trust, repository, commit, mappings).

    forms names the array columns of codes with their form. mappings are
    source_repository, commit, fork_repository of the card's source.
    """
    entity, mapping = F.col("id"), F.get("mappings", 0)
    same = (F.lower(mapping["source_repository"]) == F.lower("repository")) & (mapping["commit"] == F.col("commit")) & mapping["fork_repository"].rlike(f"^{archive}/[A-Za-z0-9_.-]+$")
    rows = validate(cards, entity, [
        pattern("id", keys.identifier(prefix)), Rule("minimum", "version", F.col("version") < 1), Rule("minimum", "versions", F.col("versions") < 1), Rule("enum", "status", F.col("status") != "registered"),
        Rule("empty", "title", F.col("title") == ""), Rule("path", "path", F.col("path") != F.concat(F.lit("entries/"), "id", F.lit("-v"), F.col("version").cast("string"), F.lit(".json"))),
        Rule("instant", "published_at", ~keys.strict_instant(F.col("published_at"))), Rule("empty", "authors", F.coalesce(F.size("authors") < 1, F.lit(True)) | F.exists("authors", lambda a: F.coalesce(a == "", F.lit(True)))),
        *[rule for field, form in forms.items() for rule in _strings(field, form)], *_strings("theorem_names"), Rule("enum", "trust", ~F.col("trust").isin("high", "qualified")),
        Rule("pattern", "repository", ~F.col("repository").rlike("^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$")), Rule("pattern", "commit", ~F.col("commit").rlike("^[0-9a-f]{40}$")),
        Rule("mapping", "mappings", F.coalesce((F.size("mappings") != 1) | ~same, F.lit(True))),
    ])
    # Newest first is ascending from the other end.
    last = cards.agg(F.max("position").alias("_last"))
    turned = cards.join(F.broadcast(last)).withColumn("turned", F.col("_last") - F.col("position")).drop("position")
    order = out_of_order(turned, "id", [], "turned", F.struct("published_at", "id")).withColumn("field", F.lit("position"))
    return _union(rows, order, repeated(cards, "id", ["id"], "id"), too_many(cards, "recent", most))


def render_list_contract(renders: DataFrame, prefix: str, most: int = RECENT_ROWS) -> DataFrame:
    """The list of render hashes (position, id, version, tree_sha256): forms, a cap, ids strictly ascending."""
    rows = validate(renders, F.col("id"), [pattern("id", keys.identifier(prefix)), Rule("minimum", "version", F.col("version") < 1), required("tree_sha256"), pattern("tree_sha256", "[0-9a-f]{64}")])
    return _union(rows, out_of_order(renders, "id", [], "position", F.col("id")), too_many(renders, "renders", most))


def refused(violations: DataFrame) -> None:
    """Raises where there is a violation, naming a few."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError("; ".join(f"{r['entity']}: {r['rule']} {r['field']}" for r in found))


RECENT, RENDERS = Surface("recent", ("id",)), Surface("recent-renders", ("id",))


def write_recent(cards: DataFrame, renders: DataFrame, card_violations: DataFrame, render_violations: DataFrame, root: str) -> dict:
    """Both lists or neither: nothing is written before both contracts hold, and both are published by one pointer; its release."""
    refused(card_violations.unionByName(render_violations))
    return store.publish(cards.sparkSession, root, {RECENT: cards, RENDERS: renders}, replace=True)


def page_contract(rows: DataFrame, prefix: str, page_size: int) -> DataFrame:
    """Rows of pages (day, page, id, version, title, status, path): each on the page of its identifier, its path that of its version."""
    where = keys.coordinate(F.col("id"), prefix, page_size)
    return validate(rows, F.col("id"), [
        required("title"), required("status"), Rule("minimum", "version", F.col("version") < 1), Rule("path", "path", F.col("path") != F.concat(F.lit("entries/"), "id", F.lit("-v"), F.col("version").cast("string"), F.lit(".json"))),
        Rule("place", "page", (where["day"] != F.col("day")) | (where["page"] != F.col("page"))),
    ])


def browse_contract(page_rows: DataFrame, day_rows: DataFrame, year_rows: DataFrame, head: DataFrame) -> DataFrame:
    """Counts of pages (year, day, page, results, versions), days, years and the head (one row): each follows from what is below, pages and days stand once and in their year."""
    def sums(rows: DataFrame, by: list[str], extra: list[Column]) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("results").alias("_results"), F.sum("versions").alias("_versions"), *extra)

    span = [F.min("page").alias("_first"), F.max("page").alias("_last")]
    days = day_rows.join(sums(page_rows, ["year", "day"], span), ["year", "day"], "full_outer")
    years = year_rows.join(sums(day_rows, ["year"], [F.count("*").alias("_days")]), "year", "full_outer")
    counts = [Rule("count", c, ~F.col(c).eqNullSafe(F.col(f"_{c}"))) for c in ("results", "versions")]
    negative = [Rule("minimum", c, F.col(c) < 0) for c in ("results", "versions")]
    range_ = Rule("range", "last_page", (F.col("first_page") < 1) | (F.col("last_page") < F.col("first_page")))
    below = head.withColumn("_one", F.lit(1)).join(sums(year_rows.withColumn("_one", F.lit(1)), ["_one"], [F.count("*").alias("_years")]), "_one")
    return _union(
        validate(page_rows, F.concat_ws("/", "day", F.col("page").cast("string")), [*negative, Rule("minimum", "page", F.col("page") < 1), Rule("year", "day", F.substring("day", 1, 4) != F.col("year"))]),
        validate(days, F.col("day"), [*counts, range_, Rule("pages", "first_page", ~F.col("first_page").eqNullSafe(F.col("_first")) | ~F.col("last_page").eqNullSafe(F.col("_last"))), Rule("year", "day", F.substring("day", 1, 4) != F.col("year"))]),
        validate(years, F.col("year"), [*counts, Rule("count", "days", ~F.col("days").eqNullSafe(F.col("_days")))]),
        validate(below, F.lit("head"), [*counts, Rule("count", "years", ~F.col("years").eqNullSafe(F.col("_years")))]),
        repeated(day_rows, "day", ["day"], "day"), repeated(year_rows, "year", ["year"], "year"),
    )


def posting_contract(heads: DataFrame, postings: DataFrame, page_size: int = POSTING_PAGE, most: int | None = POSTING_PAGES) -> DataFrame:
    """Heads (term, page_size, pages, results) and postings (term, page, position in it, name): one sequence of pages, full but the last, sorted and distinct, no page beyond its head; most is the number of pages that a term may have, None for any."""
    want = F.ceil(F.col("results") / page_size).cast("long")
    rows = validate(heads, F.col("term"), [
        Rule("size", "page_size", F.col("page_size") != page_size), Rule("minimum", "results", F.col("results") < 0), Rule("pages", "pages", F.col("pages") != want), *([Rule("cap", "pages", F.col("pages") > most)] if most is not None else []),
        Rule("term", "term", ~F.col("term").rlike("^[a-z0-9]{2,32}$")),
    ])
    held = store.kept(_pages_held(postings), "postings-held")
    whole = held.groupBy("term").agg(F.sum("n").alias("_held"), F.max("page").alias("_last"))
    joined = heads.join(whole, "term", "full_outer")
    counted = validate(joined, F.col("term"), [Rule("head", "results", ~F.coalesce("results", F.lit(-1)).eqNullSafe(F.coalesce("_held", F.lit(0)))), Rule("beyond", "pages", F.coalesce(F.col("_last") >= F.col("pages"), F.lit(False)))])
    gaps = held.where((F.col("placed") < F.col("n")) | (F.col("again") > 0) | (F.col("low") != 0) | (F.col("high") != F.col("n") - 1))
    order = held.where("wrong > 0").select("term", F.explode(F.sequence(F.lit(1).cast("long"), "wrong")))
    return _union(rows, counted, _violations(held.where(F.col("n") > page_size), "term", "cap", "page"), _violations(order, "term", "order", "position"), _violations(gaps, F.concat_ws("/", "term", F.col("page").cast("string"), F.lit("positions")), "gap", "position"))


def _pages_held(postings: DataFrame) -> DataFrame:
    """Per term and page: n rows, wrong (of how many rows the name is not above that at the position before), and whether their positions count from 0: placed, again, low, high.

    As out_of_order tells, from one shuffle and one sort; a page of any size is streamed past.
    """
    own = Window.partitionBy("term", "page").orderBy("position")
    # Usually one name; more where a position comes twice.
    before = F.collect_list("name").over(own.rangeBetween(-1, -1))
    told = postings.select("term", "page", F.col("position").cast("long").alias("position"), "name").withColumns({"_before": before, "_at": F.lag("position").over(own)})
    wrong = F.when(F.col("position").isNotNull(), F.size(F.filter("_before", lambda x: ~(x < F.col("name"))))).otherwise(0)
    counts = [F.count("*").alias("n"), F.sum(wrong).alias("wrong"), F.count("position").alias("placed"), F.count_if(F.col("_at") == F.col("position")).alias("again"), F.min("position").alias("low"), F.max("position").alias("high")]
    return told.groupBy("term", "page").agg(*counts)


def lookup_contract(listed: DataFrame, prefix: str, cap: int = REPOSITORY_ROWS) -> DataFrame:
    """Repository lists (repository, total, truncated, ids newest first): sizes follow from the total and the cap, ids well formed, distinct, descending."""
    n, total, cut, ids = F.size("ids"), F.col("total"), F.col("truncated"), F.col("ids")
    return validate(listed, F.col("repository"), [
        Rule("minimum", "total", total < 0), Rule("cap", "ids", n > cap), Rule("total", "total", total < n), Rule("truncated", "truncated", F.when(cut, (n != cap) | (total <= cap)).otherwise(total != n)),
        Rule("order", "ids", ids != F.reverse(F.array_sort(ids))), Rule("unique", "ids", F.size(F.array_distinct(ids)) < n), Rule("pattern", "ids", F.exists(ids, lambda x: ~x.rlike(f"^{keys.identifier(prefix)}$"))),
    ])


def identity_contract(identities: DataFrame, prefix: str) -> DataFrame:
    """Identity bindings (digest, id, ambiguous, commits): an id or ambiguous, not both or neither; commits well formed, distinct, sorted."""
    commits = F.col("commits")
    return validate(identities, F.col("digest"), [
        pattern("digest", "[0-9a-f]{64}"), Rule("either", "id", F.col("id").isNotNull() == F.col("ambiguous")), pattern("id", keys.identifier(prefix)),
        Rule("order", "commits", commits != F.array_sort(F.array_distinct(commits))), Rule("pattern", "commits", F.exists(commits, lambda x: ~x.rlike("^[0-9a-f]{40}$"))),
    ])


def target_contract(targets: DataFrame) -> DataFrame:
    """Targets (position, source_repository, commit, fork_repository) strictly ascending in lower case, so each once."""
    key = F.struct(F.lower("source_repository").alias("s"), F.col("commit").alias("c"), F.lower("fork_repository").alias("f"))
    rows = validate(targets, F.col("source_repository"), [pattern("commit", "[0-9a-f]{40}"), required("source_repository"), required("fork_repository")])
    return rows.unionByName(out_of_order(targets, "source_repository", [], "position", key))


def takedown_order(takedowns: DataFrame) -> DataFrame:
    """Withdrawals (position, id, version, issue) sorted by id and version, each issue once."""
    entity = F.concat_ws("-v", "id", F.col("version").cast("string"))
    return out_of_order(takedowns, entity, [], "position", F.struct("id", "version")).unionByName(repeated(takedowns, F.col("issue"), ["issue"], "issue"))


def bundle_contract(bundles: DataFrame, files: DataFrame, manifest: DataFrame, extensions: Sequence[str], caps: dict[str, int] = RENDER_CAPS, entry_file: str | None = None, manifest_name: str = "artifact-manifest.json", trusted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Bundles (bundle, tree_sha256 as its path says) against their files and their manifest rows (bundle, path, bytes, sha256).

    Files are regular and of allowed endings, within caps of files, nodes
    (files and folders), bytes each and in all; the manifest lists just them;
    the listing's hash is the bundle's; the entry file is there. trusted names
    the scripts that may and must be there, with the digests they may have.
    """
    own = files.where(F.col("path") != manifest_name)
    ending = F.lower(F.regexp_extract("path", r"[^/.][^/]*(\.[^./]*)$", 1))
    rules = [Rule("extension", "path", ~ending.isin(*extensions)), Rule("file bytes", "bytes", F.col("bytes") > caps["file_bytes"]), Rule("safe", "path", ~keys.safe_relative_path(F.col("path")))]
    if "mode" in files.columns:
        rules.append(Rule("regular", "mode", F.col("mode") != "100644"))
    at = F.concat_ws("/", "bundle", "path")
    rows = validate(own, at, rules)
    folders = files.select("bundle", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(F.split("path", "/")) - 1, F.lit(1))), lambda n: F.when(F.size(F.split("path", "/")) > 1, F.array_join(F.slice(F.split("path", "/"), F.lit(1), n), "/")))).alias("folder")).where("folder is not null").distinct()
    nodes = files.groupBy("bundle").agg(F.count("*").alias("n")).unionByName(folders.groupBy("bundle").agg(F.count("*").alias("n"))).groupBy("bundle").agg(F.sum("n").alias("nodes"))
    totals = own.groupBy("bundle").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"), F.sha2(canonical_rows(own), 256).alias("actual"))
    # An empty bundle has the listing of nothing.
    joined = bundles.join(totals, "bundle", "left").join(nodes, "bundle", "left").withColumn("actual", F.coalesce("actual", F.sha2(F.lit("[]"), 256)))
    whole = validate(joined, F.col("bundle").cast("string"), [
        Rule("files", "bundle", F.coalesce(F.col("n") > caps["files"], F.lit(False))), Rule("bytes", "bundle", F.coalesce(F.col("b") > caps["bytes"], F.lit(False))), Rule("nodes", "bundle", F.coalesce(F.col("nodes") > caps["nodes"], F.lit(False))),
        Rule("tree", "tree_sha256", F.col("tree_sha256") != F.col("actual")),
    ])
    listed = manifest.select("bundle", "path", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha256"), F.lit(True).alias("_listed"))
    both = own.withColumn("_there", F.lit(True)).join(listed, ["bundle", "path"], "full_outer")
    out = _union(rows, whole, validate(both, at, [Rule("manifest", "files", F.col("_listed").isNull() | F.col("_there").isNull() | (F.col("bytes") != F.col("_bytes")) | (F.col("sha256") != F.col("_sha256")))]))
    if entry_file:
        out = out.unionByName(_violations(bundles.join(own.where(F.col("path") == entry_file).select("bundle"), "bundle", "left_anti"), "bundle", "missing", "entry"))
    if trusted:
        known = [(name, d) for name, digests in trusted.items() for d in digests]
        spark = files.sparkSession
        allowed = spark.createDataFrame(known, "path string, sha256 string")
        scripts = own.where(ending == ".js")
        foreign = scripts.join(F.broadcast(allowed), ["path", "sha256"], "left_anti")  # as many rows as there are trusted digests
        wanted = bundles.select("bundle").withColumn("path", F.explode(F.array(*map(F.lit, trusted))))
        out = _union(out, validate(foreign, at, [Rule("script", "path", F.lit(True))]), _violations(wanted.join(own.select("bundle", "path"), ["bundle", "path"], "left_anti"), at, "missing", "script"))
    return out


def node_cap(files: DataFrame, roots: DataFrame, per_root: int = RENDER_CAPS["nodes"]) -> DataFrame:
    """One violation where all bundles (files: path) together have more nodes, files and folders, than their number allows."""
    parts = F.split("path", "/")
    # A folder is named by every file in it and counted once; the folder of all bundles is none of theirs.
    folders = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("node")).where(F.instr("node", "/") > 0)
    n = folders.distinct().agg(F.count("*").alias("n")).join(roots.agg(F.count("*").alias("roots")))
    return n.where(F.col("n") > F.greatest(F.lit(1), F.col("roots")) * per_root).select(F.lit("bundles").alias("entity"), F.lit("nodes").alias("rule"), F.lit("global").alias("field"))


def release_contract(rows: DataFrame, retired: DataFrame, incremental: bool, prefix: str, always: Sequence[str] = ()) -> DataFrame:
    """A release's rows (section, position, path, bytes, sha256) and retired paths (position, path).

    Sections ascend, paths are safe, sizes and digests well formed. An
    incremental release withdraws no record and writes no tombstone; what it
    retires is a derived, stable, served path that it doesn't stage as well.
    """
    path = F.col("path")
    wrong = [Rule("safe", "path", ~keys.safe_relative_path(path)), Rule("minimum", "bytes", F.col("bytes") < 0), pattern("sha256", "[0-9a-f]{64}"), Rule("enum", "section", ~F.col("section").isin("additions", "withdrawals", "stable", "aggregates"))]
    if incremental:
        wrong += [Rule("withdrawal", "section", F.col("section") == "withdrawals"), Rule("tombstone", "path", (F.col("section") == "stable") & (keys.path_kind(path, prefix) == "tombstone").eqNullSafe(True))]
    record = F.coalesce(keys.path_kind(path, prefix).isin("entry", "render", "evidence", "tombstone"), F.lit(False))
    kept = Rule("retired", "path", path.isin(*always) | record | (keys.object_class(path) != "stable") | ~keys.served_path(path, prefix))
    staged = retired.join(rows.where(F.col("section").isin("stable", "additions")).select("path"), "path", "left_semi")
    return _union(
        validate(rows, path, wrong), out_of_order(rows, "path", ["section"], "position", path), validate(retired, path, [kept, Rule("safe", "path", ~keys.safe_relative_path(path))]),
        out_of_order(retired, "path", [], "position", path), _violations(staged, "path", "staged", "path"),
    )


def _version_of(path: Column, prefix: str) -> Column:
    found = F.regexp_extract(path, rf"^(?:entries|renders|evidence)/({keys.identifier(prefix)}-v[1-9][0-9]*)(?:\.json|/.+)$", 1)
    return F.when(found != "", found)


def delta_evidence(rows: DataFrame, prefix: str) -> DataFrame:
    """Additions of a release (section, path): each belongs to a version whose entry is added too; no version is added and withdrawn; each entry once."""
    added = rows.where("section = 'additions'").withColumn("version", _version_of(F.col("path"), prefix))
    entries = added.where(F.col("path").startswith("entries/")).select("path", "version")
    stones = rows.where("section = 'stable'").select(F.regexp_extract("path", rf"^tombstones/({keys.identifier(prefix)}-v[1-9][0-9]*)\.json$", 1).alias("version")).where("version <> ''")
    return _union(
        _violations(added.where("version is null"), "path", "path", "additions"), _violations(added.where("version is not null").join(entries.select("version"), "version", "left_anti"), "path", "entry", "additions"),
        repeated(entries, "version", ["version"], "additions"), _violations(entries.join(stones, "version", "left_semi"), "version", "both", "tombstones"),
    )


def health_inputs(release: DataFrame, served: DataFrame) -> DataFrame:
    """One row of a release's header (release, document_sha256, parent, takedowns_blob, database_commit) against the served one: its digest is its id, it names the served parent and keeps the withdrawals' authority."""
    was = served.select(F.col("release").alias("_release"), F.col("takedowns_blob").alias("_blob"))
    joined = release.join(was, how="cross")
    incremental = F.col("parent").isNotNull()
    return validate(joined, F.col("release"), [
        Rule("authentic", "release", F.col("release") != F.col("document_sha256")), pattern("database_commit", "[0-9a-f]{40}"), pattern("takedowns_blob", "[0-9a-f]{40}"), pattern("parent", "[0-9a-f]{64}"),
        Rule("parent", "parent", incremental & (F.col("parent") != F.col("_release"))), Rule("authority", "takedowns_blob", incremental & (F.col("takedowns_blob") != F.col("_blob"))),
    ])


def authenticity(rows: DataFrame, heads: DataFrame, pointers: DataFrame) -> DataFrame:
    """Releases held against what they say: rows (number, path, bytes, sha256) of each, heads (number, release, parent, record_count, base_sha256), pointers (number, release, base_sha256).

    A release's id is made anew from its rows and its parent, its base's digest
    from the id, the parent and the count, and what the pointer names from both.
    Ids of parents are those of the release before.
    """
    own = listing_digests(rows, ["number"], F.col("path"), listed_row(), 1)
    told = heads.join(own, "number", "left").join(pointers.select("number", F.col("release").alias("_pointed"), F.col("base_sha256").alias("_base")), "number", "left")
    before = heads.select((F.col("number") + 1).alias("number"), F.col("release").alias("_before"))
    told = told.join(before, "number", "left")
    parent = F.coalesce("parent", F.lit(""))
    return validate(told, F.col("number").cast("string"), [
        Rule("authentic", "release", ~F.col("release").eqNullSafe(F.sha2(F.concat_ws(":", parent, "digest"), 256))),
        Rule("count", "record_count", ~F.col("record_count").eqNullSafe(F.col("n"))),
        Rule("base", "base_sha256", ~F.col("base_sha256").eqNullSafe(F.sha2(F.concat_ws(":", "release", parent, F.col("record_count").cast("string")), 256))),
        Rule("pointer", "release", ~F.col("_pointed").eqNullSafe(F.col("release"))), Rule("pointer", "base_sha256", ~F.col("_base").eqNullSafe(F.col("base_sha256"))),
        Rule("parent", "parent", ~F.col("parent").eqNullSafe(F.col("_before"))),
    ])


def listed_row() -> Column:
    """The compact JSON of one row (path, bytes, sha256)."""
    return F.concat(F.lit('{"bytes":'), F.col("bytes").cast("string"), F.lit(',"path":"'), "path", F.lit('","sha256":"'), "sha256", F.lit('"}'))


def chains(releases: DataFrame, rounds: int = 64) -> DataFrame:
    """Violations of releases (release, parent, change): one that begins anew beside the first (root), that two follow (fork), that names none (orphan), that follows itself (cycle); for the others the count that the chain carries to them is in carried().

    See carried for how far each is followed.
    """
    followed = carried(releases, rounds)
    roots = releases.where("parent is null").select("release")
    first = roots.agg(F.min("release").alias("_first"))
    forks = releases.where("parent is not null").groupBy("parent").count().where("count > 1")
    return _union(
        _violations(roots.join(F.broadcast(first)).where("release <> _first"), "release", "root", "parent"), _violations(forks, "parent", "fork", "release"),
        _violations(followed.where("ended = 'orphan'"), "release", "orphan", "parent"), _violations(followed.where("ended = 'cycle'"), "release", "cycle", "parent"),
    )


def carried(releases: DataFrame, rounds: int = 64) -> DataFrame:
    """release, depth, total (the sum of change from the root to it) and ended: root, orphan (a parent that isn't there) or cycle.

    Pointers double: after k rounds each release has followed 2**k parents, so
    a chain of a million releases takes 20 joins. One that hasn't ended after
    more steps than there are releases goes round.
    """
    spark = releases.sparkSession
    n = releases.count()
    there = releases.select(F.col("release").alias("_there"))
    known = releases.join(there, F.col("parent") == F.col("_there"), "left")
    ended = F.when(F.col("parent").isNull(), "root").when(F.col("_there").isNull(), "orphan")
    # next: the release reached so far; what was summed up excludes it.
    now = known.select("release", F.when(ended.isNull(), F.col("parent")).alias("next"), F.lit(0).cast("long").alias("depth"), F.col("change").cast("long").alias("total"), ended.alias("ended"))
    now = now.withColumn("depth", F.when(F.col("next").isNotNull(), 1).otherwise(0).cast("long"))
    root, steps = store.scratch_root(spark, "chains"), 1
    for k in range(rounds):
        path = f"{root}/{k}"
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        if steps > n or not now.where("next is not null").limit(1).count():
            break
        far = now.select(F.col("release").alias("_release"), F.col("next").alias("_next"), F.col("depth").alias("_depth"), F.col("total").alias("_total"), F.col("ended").alias("_ended"))
        now = now.join(far, F.col("next") == F.col("_release"), "left").select(
            "release", F.col("_next").alias("next"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), (F.col("total") + F.coalesce("_total", F.lit(0))).alias("total"), F.coalesce("ended", "_ended").alias("ended"))
        steps *= 2
    return now.select("release", F.when(F.col("next").isNull(), F.col("depth")).alias("depth"), F.when(F.col("next").isNull(), F.col("total")).alias("total"), F.coalesce("ended", F.lit("cycle")).alias("ended"))


def replacement_contract(manifest: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows of a replacement manifest (entry path, old and new digests of entry, review and evidence tree) against what is staged (path, sha256).

    Old and new differ; the new entry and review are staged with their bytes,
    the new tree is, the old one is not. What the manifest's row alone tells is
    told where it lies. Only the first part of a path below its folder, by which
    a row meets what is staged for it, and 128 bits of each digest and tree are
    shuffled: a manifest's row once, a staged path once.
    """
    stem = F.regexp_extract("entry", r"^entries/(.*)\.json$", 1)
    tree = lambda c: F.concat(F.lit("evidence/"), stem, F.lit("/"), c)
    digests = [f"{age}_{what}_sha256" for age in ("old", "new") for what in ("entry", "review")] + ["old_tree_sha256", "new_tree_sha256"]
    alone = validate(manifest, F.col("entry"), [
        *[pattern(c, "[0-9a-f]{64}") for c in digests], Rule("unchanged", "entry", F.col("old_entry_sha256") == F.col("new_entry_sha256")), Rule("unchanged", "tree", F.col("old_tree_sha256") == F.col("new_tree_sha256")),
    ])
    plain = F.concat(F.lit("entries/"), "_by", F.lit(".json"))
    asked = manifest.withColumn("_by", _met_by(F.col("entry"))).select(
        F.monotonically_increasing_id().alias("_row"), "_by", F.when(F.col("entry") != plain, F.col("entry")).alias("_entry_path"), F.col("new_entry_sha256").isNull().alias("_no_entry"), F.col("new_review_sha256").isNull().alias("_no_review"),
        _short(F.col("new_entry_sha256")).alias("_entry"), _short(F.col("new_review_sha256")).alias("_review"), _short(tree("new_tree_sha256")).alias("_new"), _short(tree("old_tree_sha256")).alias("_old"),
    )
    path, three = F.col("path"), F.substring_index("path", "/", 3)
    in_tree = path.rlike("^evidence/[^/]+/[^/]+/.")
    parent = F.when(path.endswith("/review.json"), F.expr("left(path, length(path) - 12)"))
    there = staged.select(_met_by(path).alias("_by"), "path", F.when(in_tree, three).alias("_in"), parent.alias("_parent"), _short(F.col("sha256")).alias("_sha256"))
    # A plain entry's path and a review's own tree needn't be said again.
    there = there.select(
        "_by", F.when(F.col("_in").isNull(), F.when(path != plain, path)).alias("_path"), _short(F.col("_in")).alias("_tree"), F.col("_in").isNotNull().alias("_has_tree"),
        F.col("_parent").isNotNull().alias("_is_review"), F.when(F.col("_parent") != F.coalesce("_in", F.lit("")), _short(F.col("_parent"))).alias("_of"), "_sha256",
    )
    met = asked.join(there, "_by", "left")
    file = F.coalesce(~F.col("_has_tree"), F.lit(False)) & F.col("_path").eqNullSafe(F.col("_entry_path"))
    review = F.coalesce(F.col("_is_review") & (F.coalesce("_of", "_tree") == F.col("_new")), F.lit(False))
    within = lambda c: F.count_if(F.col("_has_tree") & (F.col("_tree") == F.col(c)))
    counts = met.groupBy("_by", "_row", "_entry_path", "_no_entry", "_no_review").agg(
        F.count_if(file).alias("_files"), F.count_if(file & (F.col("_sha256") != F.col("_entry"))).alias("_other_files"), within("_new").alias("_has_new"), within("_old").alias("_has_old"),
        F.count_if(review).alias("_reviews"), F.count_if(review & (F.col("_sha256") != F.col("_review"))).alias("_other_reviews"),
    )
    # One violation for each staged file of other bytes, one where there is none.
    wrong = lambda found, other, absent: F.when(F.col(found) > 0, F.col(other)).otherwise(F.when(F.col(absent), 0).otherwise(1)).cast("int")
    told = [("not staged", "entry", wrong("_files", "_other_files", "_no_entry")), ("not staged", "tree", F.when(F.col("_has_new") == 0, 1).otherwise(0)), ("not staged", "review", wrong("_reviews", "_other_reviews", "_no_review")), ("still staged", "tree", F.when(F.col("_has_old") > 0, 1).otherwise(0))]
    found = counts.select(F.coalesce("_entry_path", plain).alias("entity"), F.explode(F.flatten(F.array(*[F.array_repeat(F.struct(F.lit(rule).alias("rule"), F.lit(field).alias("field")), n) for rule, field, n in told]))).alias("v"))
    return _union(alone, found.select("entity", "v.rule", "v.field"), repeated(manifest, "entry", ["entry"], "entry"))


def _met_by(path: Column) -> Column:
    """The part of a path below entries/ or evidence/, without the ending of an entry; any other path is met by itself."""
    second = F.split_part(path, F.lit("/"), F.lit(2))
    bare = F.when(second.endswith(".json") & (F.length(second) > 5), second.substr(F.lit(1), F.length(second) - 5)).otherwise(path)
    below = F.when(F.substring_index(path, "/", 2) == path, bare).when(second != "", second).otherwise(path)
    return F.when(path.startswith("entries/") | path.startswith("evidence/"), below).otherwise(path)


def _short(text: Column) -> Column:
    """128 bits of a text's digest; those of an absent text are its own."""
    return F.unhex(F.substring(F.sha2(F.concat(F.when(text.isNull(), "0").otherwise("1"), F.coalesce(text, F.lit(""))), 256), 1, 32))


#: Fields of a report and the record's fields that they must equal.
REPORT_BINDINGS = (
    ("workflow_url", "verification.workflow_url"), ("checked_at", "verification.verified_at"), ("comparator_commit", "verification.comparator_commit"), ("lean4export_commit", "verification.lean4export_commit"),
    ("landrun_commit", "verification.landrun_commit"), ("nanoda_commit", "verification.nanoda_commit"), ("source.repository", "source.repository"), ("source.commit", "source.commit"),
    ("challenge.sha256", "verification.challenge_sha256"), ("solution.sha256", "verification.solution_sha256"), ("submission.submission_id", "submission.submission_id"),
    ("source.project_path", "source.project_path"), ("challenge.path", "formalization.challenge_path"), ("solution.path", "formalization.solution_path"), ("comparator.path", "formalization.comparator_config_path"),
    ("formalization.path", "formalization.formalization_metadata_path"), ("lakefile.path", "formalization.lakefile_path"),
)


def report_bindings(rows: DataFrame, entity: Column) -> DataFrame:
    """Records (column record, a struct) beside their mechanical report (column report, a struct): 19 fields must be what the record says, or a constant."""
    fixed = [Rule("binding", name, ~F.col(f"report.{name}").eqNullSafe(F.lit(value))) for name, value in (("status", "pass"), ("stage", "complete"))]
    return validate(rows, entity, [*fixed, *[Rule("binding", field, ~F.col(f"report.{field}").eqNullSafe(F.col(f"record.{own}"))) for field, own in REPORT_BINDINGS]])


def receipt_bindings(rows: DataFrame, entity: Column) -> DataFrame:
    """Records beside their archive receipt (column receipt, and receipt_sha256 of its bytes)."""
    names = [("id", "id"), ("version", "version"), ("archive_owner", "preservation.archive_owner"), ("archived_at", "preservation.archived_at"), ("repositories", "preservation.repositories")]
    return validate(rows, entity, [
        Rule("binding", "receipt_sha256", ~F.col("receipt_sha256").eqNullSafe(F.col("record.preservation.receipt_sha256"))),
        Rule("binding", "schema_version", ~F.col("receipt.schema_version").eqNullSafe(F.lit(1))), *[Rule("binding", field, ~F.col(f"receipt.{field}").eqNullSafe(F.col(f"record.{own}"))) for field, own in names],
    ])


def run_bindings(rows: DataFrame, entity: Column) -> DataFrame:
    """Records beside the provenance of their run (column run): fields equal the record's or a constant, jobs are there, each once, ended well."""
    constants = {"schema_version": 1, "event": "workflow_dispatch", "status": "completed", "conclusion": "success"}
    equal = {"repository": "repository", "run_id": "run_id", "run_attempt": "workflow_run_attempt", "workflow_path": "workflow_path", "workflow_commit": "workflow_commit", "workflow_url": "workflow_url"}
    jobs = F.col("run.jobs")
    empty = lambda c: F.coalesce(c == "", F.lit(True))
    bad = lambda j: F.coalesce((j["id"] < 1) | (j["status"] != "completed") | ~j["conclusion"].isin("success", "skipped"), F.lit(True)) | empty(j["name"]) | empty(j["started_at"]) | empty(j["completed_at"])
    return validate(rows, entity, [
        *[Rule("binding", f, ~F.col(f"run.{f}").eqNullSafe(F.lit(v))) for f, v in constants.items()], *[Rule("binding", f, ~F.col(f"run.{f}").eqNullSafe(F.col(f"record.verification.{own}"))) for f, own in equal.items()],
        Rule("empty", "created_at", empty(F.col("run.created_at"))), Rule("empty", "updated_at", empty(F.col("run.updated_at"))), Rule("empty", "jobs", F.coalesce(F.size(jobs) < 1, F.lit(True))),
        Rule("job", "jobs", F.coalesce(F.exists(jobs, bad), F.lit(False))), Rule("unique", "jobs", F.size(F.array_distinct(F.transform(jobs, lambda j: j["id"]))) < F.size(jobs)),
    ])


def tag_rules(tags: DataFrame, key: str, policy: str, scripts: Sequence[str]) -> DataFrame:
    """Violations (entity, rule, field) of pages' tag streams (key, pos, tag, attributes; see rules.tag_stream).

    No active elements, attributes or script URLs; one head and in it one
    policy meta, outside templates, with just that policy; nothing before it
    but metas without http-equiv and scripts; scripts deferred, with a source
    and nothing else, each trusted one once and in order. Depths are running
    sums inside a page.
    """
    inside = Window.partitionBy(key).orderBy("pos")
    delta = lambda name: F.sum(F.when(F.col("tag") == name, 1).when(F.col("tag") == f"/{name}", -1).otherwise(0)).over(inside)
    value = lambda name: F.regexp_extract(F.col("attributes"), rf"""(?i)(?:^|\s){name}\s*=\s*["']([^"']*)["']""", 1)
    attribute = lambda name: F.col("attributes").rlike(rf"(?i)(?:^|\s){name}(?:\s|=|/|$)")
    opens = ~F.col("tag").startswith("/")
    is_policy = (F.col("tag") == "meta") & (F.lower(value("http-equiv")) == "content-security-policy")
    depth = tags.withColumns({"head": delta("head"), "template": delta("template"), "is_policy": is_policy})
    active = depth.withColumn("active", F.col("is_policy") & (F.col("head") == 1) & (F.col("template") == 0))
    seen = F.coalesce(F.max(F.col("active").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    marked = active.withColumns({"early": (F.col("head") == 1) & ~seen & opens & (F.col("tag") != "head"), "nth": F.sum(F.when(F.col("tag") == "script", 1).otherwise(0)).over(inside)})
    source, listed = value("src"), F.array(*map(F.lit, scripts))
    found = validate(marked, F.col(key).cast("string"), [
        Rule("element", "tag", F.col("tag").isin("base", "embed", "iframe", "object")), Rule("attribute", "on", opens & F.col("attributes").rlike(r"(?i)(?:^|\s)(?:on[a-z]+|srcdoc)(?:\s|=|/|$)")),
        Rule("url", "javascript", opens & F.col("attributes").rlike(r"""(?i)(?:^|\s)(?:href|src|action|formaction|ping)\s*=\s*["']?[\x00-\x20]*javascript:""")),
        Rule("early", "tag", F.col("early") & ~F.col("tag").isin("meta", "script")), Rule("early", "http-equiv", F.col("early") & (F.col("tag") == "meta") & attribute("http-equiv") & ~F.col("is_policy")),
        Rule("script", "form", (F.col("tag") == "script") & ~F.col("attributes").rlike(r"""(?i)^\s*(?:src\s*=\s*["'][^"']*["']\s+defer|defer\s+src\s*=\s*["'][^"']*["'])\s*$""")),
        Rule("script", "order", (F.col("tag") == "script") & ~source.eqNullSafe(F.get(listed, F.col("nth").cast("int") - 1))),
    ])
    per_page = marked.groupBy(key).agg(F.count_if(F.col("tag") == "head").alias("heads"), F.count_if("is_policy").alias("policies"), F.count_if(F.col("active") & (value("content") == policy)).alias("trusted"), F.count_if(F.col("tag") == "script").alias("scripts"), F.count_if(F.col("tag") == "/script").alias("ends"))
    return found.unionByName(validate(per_page, F.col(key).cast("string"), [
        Rule("one", "head", F.col("heads") != 1), Rule("one", "policy", (F.col("policies") != 1) | (F.col("trusted") != 1)), Rule("script", "count", (F.col("scripts") != len(scripts)) | (F.col("ends") != F.col("scripts"))),
    ]))


def missing_groups(named: DataFrame, there: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups that a head names and that are not there, to be made anew rather than begun afresh: terms' pages, repositories, identities, days, years alike."""
    return named.select(*by).distinct().join(there.select(*by).distinct(), list(by), "left_anti")


def named_pages(heads: DataFrame, key: str) -> DataFrame:
    """The pages that heads (key, pages) name, from 0."""
    return heads.where("pages > 0").select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)).alias("page"))


def rebuild_inputs(changes: DataFrame, projections: Sequence[str], ignored: Sequence[str]) -> DataFrame:
    """Changed paths (path, status) that an incremental run can't answer for: what isn't added, derived or ignored (paths, or beginnings that end in /)."""
    under = lambda names: F.coalesce(F.exists(F.array(*map(F.lit, names)), lambda n: F.when(n.endswith("/"), F.col("path").startswith(n)).otherwise(F.col("path") == n)), F.lit(False)) if names else F.lit(False)
    return changes.where((F.col("status") != "A") & ~under(projections) & ~under(ignored)).select("path", "status")


def date_contract(records: DataFrame, entity: Column) -> DataFrame:
    """Records (id, version, registered_at as text, first_registered_on): all versions of an id name one first day, none is before it, and the first version is of it."""
    first = records.where("version = 1").select("id", F.substring("registered_at", 1, 10).alias("_day"))
    joined = records.join(first, "id", "left")
    day = F.substring("registered_at", 1, 10)
    return validate(joined, entity, [
        Rule("first version", "id", F.col("_day").isNull()), Rule("first day", "first_registered_on", F.coalesce(F.col("first_registered_on") != F.col("_day"), F.lit(False))),
        Rule("before first", "registered_at", day < F.col("first_registered_on")), Rule("instant", "registered_at", ~keys.strict_instant(F.col("registered_at"))),
    ])


def authority_shapes(documents: DataFrame, kind: str, allowed: Sequence[str]) -> DataFrame:
    """Documents (entity, body) of one kind with keys that are missing or too many, or that are no strict JSON."""
    extra, missing = closed_shape(F.col("body"), allowed, allowed)
    told = documents.withColumns({"_extra": extra, "_missing": missing})
    return validate(told, F.col("entity"), [Rule("json", kind, ~strict_json(F.col("body"))), Rule("extra", kind, F.col("_extra") != ""), Rule("missing", kind, F.col("_missing") != "")])


def served_rows(served: DataFrame, authority: DataFrame, by: Sequence[str], fields: Sequence[str], entity: Column) -> DataFrame:
    """Served rows that are not what the authority says: unknown ones, absent ones, and a violation for each field that differs."""
    own = authority.select(*by, F.struct(*fields).alias("_own"))
    joined = served.select(*by, F.struct(*fields).alias("_shown")).join(own, list(by), "full_outer")
    both = F.col("_own").isNotNull() & F.col("_shown").isNotNull()
    return validate(joined, entity, [Rule("unknown", "row", F.col("_own").isNull()), Rule("absent", "row", F.col("_shown").isNull()), *[Rule("differs", f, both & ~F.col(f"_shown.{f}").eqNullSafe(F.col(f"_own.{f}"))) for f in fields]])


def touched_rows(before: DataFrame, after: DataFrame, touched: DataFrame, by: Sequence[str], entity: Column) -> DataFrame:
    """Rows that an append may not change: those not touched by it that came, went or differ, and touched ones that went."""
    columns = [c for c in before.columns if c not in by]
    one = before.select(*by, F.struct(*columns).alias("_before"))
    two = after.select(*by, F.struct(*columns).alias("_after"))
    joined = one.join(two, list(by), "full_outer").join(touched.select(*by, F.lit(True).alias("_touched")).distinct(), list(by), "left")
    own = F.coalesce(F.col("_touched"), F.lit(False))
    return validate(joined, entity, [Rule("removed", "row", F.col("_after").isNull()), Rule("untouched", "row", ~own & F.col("_after").isNotNull() & ~F.col("_before").eqNullSafe(F.col("_after")))])


def audit(claimed_root: Column, recomputed: DataFrame, inventory: DataFrame, allowed: Column) -> DataFrame:
    """One row: whether the root is the claimed one, how many paths nothing allows, how many rows have no digest."""
    rest = inventory.agg(F.count_if(~F.coalesce(allowed, F.lit(False))).alias("unexpected"), F.count_if(F.col("sha256").isNull()).alias("undigested"))
    return recomputed.select("record_count", "record_root", F.col("record_root").eqNullSafe(claimed_root).alias("root_holds")).join(rest)
