"""Differences between inventories, and what they may be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import dependency_rank, frozen_path
from ledgerline.operators.ordering import numbered

REGULAR = "100644"


def inventory_diff(base: DataFrame, head: DataFrame, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """path, status (A, D, M; T where only the mode differs) and both digests; equal rows are left out. A rename is D and A. by names what tells rows apart."""
    modes = "mode" in base.columns and "mode" in head.columns
    old = base.select(*by, F.col("sha256").alias("old_sha256"), F.col("bytes").alias("old_bytes"), (F.col("mode") if modes else F.lit(REGULAR)).alias("old_mode"))
    new = head.select(*by, F.col("sha256").alias("new_sha256"), F.col("bytes").alias("new_bytes"), (F.col("mode") if modes else F.lit(REGULAR)).alias("new_mode"))
    status = (
        F.when(F.col("old_sha256").isNull(), "A").when(F.col("new_sha256").isNull(), "D")
        .when(F.col("old_mode") != F.col("new_mode"), "T").when(F.col("old_sha256") != F.col("new_sha256"), "M")
    )
    return old.join(new, list(by), "full_outer").withColumn("status", status).where("status is not null")


def mode_label(mode: Column) -> Column:
    """What file modes are called."""
    return F.when(mode == "120000", "a symbolic link").when(mode == "160000", "a submodule").when(mode == "100755", "an executable file").otherwise(F.concat(F.lit("mode "), mode))


def append_only(changes: DataFrame, prefixes: tuple[str, ...], armed: bool = True, allowed: DataFrame | None = None, schema_path: str | None = None, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """Violations (path, rule, detail) of frozen paths: nothing is deleted or changed, additions are ordinary files.

    allowed (path, old_sha256, new_sha256) lists changes that a manifest
    permits once. Where the base is not armed nothing is checked.
    """
    if not armed:
        return changes.where("false").select(*by, F.lit("").alias("rule"), F.lit("").alias("detail"))
    ordinary = F.col("new_mode") == REGULAR
    rule = (
        F.when(F.col("status").isin("A", "T") & ~ordinary, "not ordinary")
        .when(F.col("status") == "D", "deleted").when(F.col("status") == "T", "mode").when(F.col("status") == "M", "content")
    )
    if schema_path:
        rule = F.when(F.col("path") == schema_path, F.when(F.col("status") == "T", "mode").otherwise("schema")).otherwise(rule)
    frozen = frozen_path(F.col("path"), prefixes) | (F.col("path") == F.lit(schema_path or ""))
    found = changes.where(frozen).withColumn("rule", rule).where("rule is not null")
    if allowed is not None:
        found = found.join(allowed, ["path", "old_sha256", "new_sha256"], "left_anti")
    detail = F.when(F.col("rule") == "not ordinary", mode_label(F.col("new_mode"))).otherwise(F.col("status"))
    return found.select(*by, "rule", detail.alias("detail"))


def reconcile(expected: DataFrame, served: DataFrame) -> DataFrame:
    """path and what is wrong with it: missing, unexpected, size, bytes."""
    e = expected.select("path", F.col("bytes").alias("eb"), F.col("sha256").alias("es"))
    s = served.select("path", F.col("bytes").alias("sb"), F.col("sha256").alias("ss"))
    wrong = F.when(F.col("sb").isNull(), "missing").when(F.col("eb").isNull(), "unexpected").when(F.col("eb") != F.col("sb"), "size").when(F.col("es") != F.col("ss"), "bytes")
    return e.join(s, "path", "full_outer").select("path", wrong.alias("reason")).where("reason is not null")


def unexplained_removals(existing: DataFrame, staged: DataFrame, tombstones: DataFrame, version_of: Column, armed: bool = True) -> DataFrame:
    """Paths that are served, not staged, name a version (version_of, else null) and have no tombstone (key)."""
    gone = existing.select("path").join(staged.select("path"), "path", "left_anti").withColumn("key", version_of)
    if not armed:
        return gone.where("false").select("path")
    return gone.where("key is not null").join(tombstones.select("key"), "key", "left_anti").select("path")


def publish_order(paths: DataFrame, deleting: bool = False) -> DataFrame:
    """path, rank and place: leaves before what names them; the other way round when deleting."""
    ranked = paths.withColumn("rank", dependency_rank(F.col("path")))
    first = F.lit(2) - F.col("rank") if deleting else F.col("rank")  # one digit
    return numbered(ranked, F.concat(first.cast("string"), F.col("path"))).select("path", "rank", "place")


def history_violations(states: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Violations (seq, path, rule) in each step of a history of inventories (seq, path, sha256, bytes, and mode where there is one): those of append_only between a state and the next."""
    ends = F.broadcast(states.agg(F.min("seq").alias("_first"), F.max("seq").alias("_last")))
    of = states.join(ends)
    base = of.where(F.col("seq") < F.col("_last")).withColumn("seq", F.col("seq") + 1)
    changes = inventory_diff(base, of.where(F.col("seq") > F.col("_first")), ("seq", "path"))
    return append_only(changes, prefixes, by=("seq", "path")).select("seq", "path", "rule")


def component_prefixes(path: Column) -> Column:
    """All beginnings of a path that end at a component's end, the path itself too."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def orphan_paths(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """Paths that are neither under a root nor on the way to one: equi-joins over path beginnings, never a pattern join."""
    under = paths.select("path", F.explode(component_prefixes(F.col("path"))).alias("root")).join(roots.select(F.col("path").alias("root")), "root", "left_semi").select("path")
    way = roots.select(F.explode(component_prefixes(F.col("path"))).alias("path")).distinct()
    return paths.select("path").distinct().join(under.unionByName(way).distinct(), "path", "left_anti")


def replacement_plan(manifest: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows of a replacement manifest (path, old_sha256, new_sha256) that don't hold: nothing changes, or the new bytes aren't staged."""
    joined = manifest.join(staged.select("path", "sha256"), "path", "left")
    reason = F.when(F.col("old_sha256") == F.col("new_sha256"), "unchanged").when(F.col("sha256").isNull(), "not staged").when(F.col("sha256") != F.col("new_sha256"), "other bytes")
    return joined.select("path", reason.alias("reason")).where("reason is not null")


def staged_match(release: DataFrame, staged: DataFrame) -> DataFrame:
    """Release rows (path, bytes, sha256, section) against what is staged (with its section): what differs, in the order it is noticed."""
    r = release.select("path", F.col("bytes").alias("rb"), F.col("sha256").alias("rs"), F.col("section").alias("rc"))
    s = staged.select("path", F.col("bytes").alias("sb"), F.col("sha256").alias("ss"), F.col("section").alias("sc"))
    reason = (
        F.when(F.col("sb").isNull(), "missing").when(F.col("rb").isNull(), "unowned").when(F.col("rb") != F.col("sb"), "size")
        .when(F.col("rs") != F.col("ss"), "digest").when(F.col("rc") != F.col("sc"), "section")
    )
    return r.join(s, "path", "full_outer").select("path", reason.alias("reason")).where("reason is not null")


def retired_releases(headers: DataFrame, keep: int = 2) -> DataFrame:
    """Headers (release, seq) of all releases but the newest `keep`; the kept ones are few, so the rest is an anti join with them."""
    kept = headers.orderBy(F.desc("seq")).limit(keep).select("release")
    return headers.join(kept, "release", "left_anti")
