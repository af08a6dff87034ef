"""Stored collections that a batch of versions moves on: it reads and writes the rows of the results, pages, days and codes that it touches.

What a batch needs of the past stands in the table of results, one row for each:
its active versions and its newest one. Counts move by differences, lists by
what leaves and comes in. Only a full list that becomes shorter reads on: it
asks the table of results for its code or repository, which is the one case that
reads more than the batch touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.attest import listing_width
from ledgerline.operators.pages import placed
from ledgerline.sources import store
from ledgerline.sources.store import Surface

RESULTS = Surface("results", ("id",))
PAGES = Surface("pages", ("day", "page"))
DAYS = Surface("days", ("day",))
CODES = Surface("codes", ("kind", "code"))
REPOSITORIES = Surface("repositories", ("repository",))
ALL = (RESULTS, PAGES, DAYS, CODES, REPOSITORIES)
#: Rows of a code's front list and of a repository's.
FRONT, LISTED = 50, 500


def results(versions: DataFrame) -> DataFrame:
    """id, ever, active, and the newest active version (null without one), from versions (id, version, registered_at, brand, type, repository, withdrawn)."""
    newest = F.max_by(F.struct("version", "registered_at", "brand", "type", "repository"), F.when(~F.col("withdrawn"), F.col("version")))
    rows = versions.groupBy("id").agg(F.count("*").alias("ever"), F.count_if(~F.col("withdrawn")).alias("active"), newest.alias("newest"))
    return rows.withColumn("newest", F.when(F.col("active") > 0, F.col("newest")))


def _joined(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Results after a batch of new versions, beside what they were: id, was, now (ever, active, newest)."""
    as_struct = lambda df, name: df.select("id", F.struct("ever", "active", "newest").alias(name))
    both = as_struct(batch, "new").join(as_struct(prior, "was"), "id", "left")
    was, new = F.col("was"), F.col("new")
    # A batch's versions come after those that are there.
    now = F.struct((F.coalesce(was["ever"], F.lit(0)) + new["ever"]).alias("ever"), (F.coalesce(was["active"], F.lit(0)) + new["active"]).alias("active"), F.coalesce(new["newest"], was["newest"]).alias("newest"))
    return both.select("id", "was", now.alias("now"))


def page_rows(moved: DataFrame, prefix: str, page_size: int) -> DataFrame:
    """day, page, and by how much results and versions move."""
    where = placed(moved.withColumn("day", F.lit(None)), prefix, page_size)
    active = lambda c: F.coalesce(F.col(c)["active"], F.lit(0))
    held = lambda c: (active(c) > 0).cast("long")
    return where.groupBy("day", "page").agg(F.sum(held("now") - held("was")).alias("results"), F.sum(active("now") - active("was")).alias("versions"))


def _plus(prior: DataFrame, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """prior's rows of the keys that change has, moved by it; a key without a row begins at 0."""
    return change.join(prior.select(*keys, F.col("results").alias("_r"), F.col("versions").alias("_v")), list(keys), "left").select(
        *keys, (F.coalesce("_r", F.lit(0)) + F.col("results")).alias("results"), (F.coalesce("_v", F.lit(0)) + F.col("versions")).alias("versions")
    )


def _code_groups(newest: Column) -> Column:
    return F.array(F.struct(F.lit("brand").alias("kind"), newest["brand"].alias("code")), F.struct(F.lit("type").alias("kind"), newest["type"].alias("code")))


def _repository_groups(newest: Column) -> Column:
    return F.array(F.struct(newest["repository"].alias("repository")))


def _by_instant(newest: Column) -> Column:
    return F.date_format(newest["registered_at"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _by_id(newest: Column) -> Column:
    return F.lit("")


def _members(rows: DataFrame, newest: Column, groups, order) -> DataFrame:
    """The groups that results' newest versions are in: the group's key, at (what its list goes by), id, version."""
    there = rows.where(newest.isNotNull()).select("id", order(newest).alias("at"), newest["version"].alias("version"), F.explode(groups(newest)).alias("g"))
    return there.select("g.*", "at", "id", "version")


def _first(rows: DataFrame, keys: Sequence[str], most: int, name: str) -> DataFrame:
    """Per group the first `most` rows (at, id, version), descending; no group is collected whole."""
    order = Window.partitionBy(*keys).orderBy(F.desc("at"), F.desc("id"))
    top = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most)
    return top.groupBy(*keys).agg(F.reverse(F.array_sort(F.collect_list(F.struct("at", "id", "version")))).alias(name))


def listed(moved: DataFrame, prior: DataFrame, everything: DataFrame, keys: Sequence[str], groups, order, most: int) -> DataFrame:
    """Per group that a batch touches: results, and list, its first `most` results, descending.

    prior has the groups' rows before. everything (the results after the batch)
    is asked only for groups whose full list lost a row that nothing known
    replaces.
    """
    left, come = (_members(moved, F.col(f"{side}.newest"), groups, order) for side in ("was", "now"))
    counts = left.select(*keys, F.lit(-1).alias("n")).unionByName(come.select(*keys, F.lit(1).alias("n"))).groupBy(*keys).agg(F.sum("n").alias("change"))
    before = counts.join(prior.select(*keys, F.col("results").alias("had"), F.col("list").alias("known")), list(keys), "left")
    before = before.withColumn("had", F.coalesce("had", F.lit(0)))
    known = before.select(*keys, F.explode("known").alias("x")).select(*keys, "x.*")
    stay = known.join(left.select(*keys, "id"), [*keys, "id"], "left_anti")
    merged = before.join(_first(stay.unionByName(come), keys, most, "list"), list(keys), "left")
    total = F.col("had") + F.col("change")
    # Under the end of a full list there may be rows that it doesn't know.
    end = F.get("known", F.size("known") - 1)
    sure = F.size(F.filter("list", lambda x: (F.col("had") <= F.coalesce(F.size("known"), F.lit(0))) | (x["at"] > end["at"]) | ((x["at"] == end["at"]) & (x["id"] >= end["id"]))))
    short = F.coalesce(sure, F.lit(0)) < F.least(total, F.lit(most))
    rows = merged.select(*keys, total.cast("long").alias("results"), "list", short.alias("short"))
    again = _members(everything, F.col("newest"), groups, order).join(rows.where("short").select(*keys), list(keys), "left_semi")
    rows = rows.join(_first(again, keys, most, "_again"), list(keys), "left")
    return rows.select(*keys, "results", F.when(F.col("short"), F.col("_again")).otherwise(F.col("list")).alias("list"))


def _none(spark: SparkSession, surface: Surface) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[surface.name])


_LIST = "results long, list array<struct<at string, id string, version long>>"
SCHEMAS = {
    "results": "id string, ever long, active long, newest struct<version long, registered_at timestamp, brand string, type string, repository string>",
    "pages": "day string, page long, results long, versions long",
    "days": "day string, first_page long, last_page long, results long, versions long",
    "codes": f"kind string, code string, {_LIST}",
    "repositories": f"repository string, {_LIST}",
}


def _cast(rows: DataFrame, surface: Surface) -> DataFrame:
    """rows with the columns and types that are stored."""
    return rows.to(_none(rows.sparkSession, surface).schema)


def appended(spark: SparkSession, root: str, versions: DataFrame, prefix: str, page_size: int, replace: bool = False, front: int = FRONT, most: int = LISTED) -> dict:
    """One release more: what a batch of versions (id, version, registered_at, brand, type, repository, withdrawn) changes in all five tables; its document.

    With replace the batch is all there is, and the tables are built anew; so
    are they where versions that are there were withdrawn.
    """
    last = None if replace else store.head(spark, root)

    def prior(surface: Surface, keys: DataFrame) -> DataFrame:
        return (store.read(spark, root, surface, keys, last) if last else None) or _none(spark, surface)

    batch = results(versions)
    moved = _joined(prior(RESULTS, batch), batch).persist()
    try:
        after = moved.select("id", "now.*")
        everything = after
        if last:
            everything = store.read(spark, root, RESULTS, at=last).join(after.select("id"), "id", "left_anti").unionByName(_cast(after, RESULTS))
        by_page = page_rows(moved, prefix, page_size)
        pages = _plus(prior(PAGES, by_page), by_page, ("day", "page"))
        by_day = by_page.groupBy("day").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.sum("results").alias("results"), F.sum("versions").alias("versions"))
        days = by_day.join(prior(DAYS, by_day).select("day", F.col("first_page").alias("_first"), F.col("last_page").alias("_last"), F.col("results").alias("_r"), F.col("versions").alias("_v")), "day", "left")
        days = days.select("day", F.least("first_page", "_first").alias("first_page"), F.greatest("last_page", "_last").alias("last_page"), (F.col("results") + F.coalesce("_r", F.lit(0))).alias("results"), (F.col("versions") + F.coalesce("_v", F.lit(0))).alias("versions"))
        changes = {RESULTS: after, PAGES: pages, DAYS: days}
        # Parts by each table's own rows: the small ones would be thousands of files that the driver lists.
        asked = {RESULTS: moved, PAGES: by_page, DAYS: by_day}
        for surface, groups, order, cap in ((CODES, _code_groups, _by_instant, front), (REPOSITORIES, _repository_groups, _by_id, most)):
            touched = _members(moved, F.col("was.newest"), groups, order).unionByName(_members(moved, F.col("now.newest"), groups, order)).select(*surface.keys).distinct()
            asked[surface] = touched
            changes[surface] = listed(moved, prior(surface, touched), everything, surface.keys, groups, order, cap)
        width = None if last else {s: listing_width(keys.count(), store.PART_ROWS) for s, keys in asked.items()}
        return store.publish(spark, root, {s: _cast(rows, s) for s, rows in changes.items()}, replace=replace, based_on=last, width=width)
    finally:
        moved.unpersist()
