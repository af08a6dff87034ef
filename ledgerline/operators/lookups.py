"""Reverse lookups: results of a repository, results and commits of an identity, targets of checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.keys import identity_digest

CAP = 500


def identities(records: DataFrame) -> DataFrame:
    """id, version and the identity of every record, its repository in lower case, with its digest."""
    digest = identity_digest(F.col("repository"), F.col("project_path"), F.col("config_path"))
    return records.select("id", "version", F.lower("repository").alias("repository"), "project_path", "config_path", "commit_sha", digest.alias("digest"))


def repository_lookup(active_current: DataFrame, cap: int = CAP) -> DataFrame:
    """Per repository: the total, whether the list is cut, and the newest `cap` ids, newest first."""
    order = Window.partitionBy("repository").orderBy(F.desc("id"))
    rows = active_current.select("repository", "id").distinct()
    total = rows.groupBy("repository").agg(F.count("*").alias("total"))
    newest = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= cap).groupBy("repository").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return total.join(newest, "repository").select("repository", "total", (F.col("total") > cap).alias("truncated"), F.reverse("ids").alias("ids"))


def identity_lookup(active: DataFrame, ever: DataFrame) -> DataFrame:
    """Per identity digest of the versions ever registered: the one active id or none, whether it is ambiguous, and all commits."""
    ids = identities(active).groupBy("digest").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    commits = identities(ever).groupBy("digest").agg(F.array_sort(F.collect_set("commit_sha")).alias("commits"))
    single = F.when(F.col("low") == F.col("high"), F.col("low"))
    return commits.join(ids, "digest", "left").select("digest", single.alias("id"), F.coalesce(F.col("low") != F.col("high"), F.lit(False)).alias("ambiguous"), "commits")


def targets(active: DataFrame) -> DataFrame:
    """Per source and commit (source in lower case): its archive, or a conflict where there are several."""
    mapped = active.groupBy(F.lower("repository").alias("source"), F.col("commit_sha").alias("commit")).agg(F.count_distinct("fork").alias("forks"), F.min("fork").alias("fork"))
    return mapped.select("source", "commit", "fork", (F.col("forks") > 1).alias("conflict"))


def patched_identities(prior: DataFrame, additions: DataFrame, updates: DataFrame) -> DataFrame:
    """The identity lookup after a batch: digest, id, ambiguous, commits, and recompute (the group must be made anew from its base).

    prior: digest, id, ambiguous, commits; additions: digest, id of new
    results; updates: digest, id, commit_sha of all new versions. Once
    ambiguous, a group stays so.
    """
    new = additions.groupBy("digest").agg(F.count_distinct("id").alias("new_ids"), F.min("id").alias("new_id"), F.collect_set("id").alias("all_new"))
    more = updates.groupBy("digest").agg(F.collect_set("commit_sha").alias("more"), F.collect_set("id").alias("update_ids"))
    both = prior.join(new, "digest", "full_outer").join(more, "digest", "full_outer")
    n, was, many = F.coalesce("new_ids", F.lit(0)), F.col("id"), F.coalesce("ambiguous", F.lit(False))
    fresh = F.col("commits").isNull()
    others = F.size(F.array_except(F.coalesce("update_ids", F.array().cast("array<string>")), F.array(was))) > 0
    recompute = F.when(many, False).when((n == 0) & was.isNull(), True).when(n == 0, others).when(was.isNotNull(), F.array_contains("all_new", was)).otherwise(False)
    next_many = F.when(many, True).when(n == 0, False).when((n == 1) & was.isNull() & fresh, False).when((n == 1) & was.isNull(), False).otherwise(True)
    next_id = F.when(next_many, F.lit(None).cast("string")).when(n == 0, was).otherwise(F.col("new_id"))
    commits = F.array_sort(F.array_union(F.coalesce("commits", F.array().cast("array<string>")), F.coalesce("more", F.array().cast("array<string>"))))
    return both.select("digest", next_id.alias("id"), next_many.alias("ambiguous"), commits.alias("commits"), F.coalesce(recompute, F.lit(False)).alias("recompute"))


def contract(lookup: DataFrame, cap: int = CAP) -> DataFrame:
    """Violations of the repository lookup's contract: totals, truncation, order."""
    rules = F.array_compact(F.array(
        F.when(F.col("truncated") != (F.col("total") > cap), F.lit("truncated")),
        F.when(F.size("ids") != F.least("total", F.lit(cap)), F.lit("size")),
        F.when(F.col("ids") != F.reverse(F.array_sort("ids")), F.lit("order")),
        F.when(F.size("ids") != F.size(F.array_distinct("ids")), F.lit("distinct")),
    ))
    return lookup.select("repository", F.explode(rules).alias("rule"))
