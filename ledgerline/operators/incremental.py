"""Keeping derived tables up to date by recomputing only the groups that a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import _starts
from ledgerline.operators import pages, select

#: What forces a full run, and what never touches what is published.
FULL_INPUTS = ("LICENSE", "requirements-tools.txt", "schema-v3.json", "scores-v1.json", "takedowns.json", ".github/workflows/publish.yml")
FULL_PREFIXES = ("tools/",)
#: What changes the meaning of records that were accepted before.
POLICY_INPUTS = ("schema-v3.json", "scores-v1.json", "takedowns.json")
POLICY_PREFIXES = ("tools/",)
IGNORED = (".gitattributes", ".gitignore", "README.md", "requirements-tools.in", "requirements-test.in", "requirements-test.txt")
IGNORED_PREFIXES = (".github/", "docs/", "tests/", "worker/")
APPEND_PREFIXES = ("entries/", "renders/", "evidence/", "scores/", "registrations/")

#: Ranges of hashes by which two tables are compared.
RANGES = 1_024


def touched(batch: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """surface and group of everything a batch touches: a small table of distinct keys."""
    named = F.array(*[F.struct(F.lit(name).alias("surface"), c.cast("string").alias("grp")) for name, c in groups.items()])
    return batch.select(F.explode(named).alias("g")).select("g.*").where("grp is not null").distinct()


def patched(prior: DataFrame, base: DataFrame, batch_keys: DataFrame, keys: Sequence[str], recompute) -> DataFrame:
    """prior with the groups named by batch_keys made anew from base by recompute; the rest untouched."""
    touched_base = base.join(batch_keys, list(keys), "left_semi")
    return prior.join(batch_keys, list(keys), "left_anti").unionByName(recompute(touched_base))


def patched_pages(prior: DataFrame, ever: DataFrame, active: DataFrame, batch: DataFrame, prefix: str, page_size: int) -> DataFrame:
    """The page table after a batch of versions (id): only pages with a touched id are counted again."""
    keys = ["year", "day", "page"]
    hit = pages.placed(batch.select("id").distinct().withColumn("day", F.lit(None)), prefix, page_size).select(*keys).distinct()
    placed_ever, placed_active = (pages.placed(df, prefix, page_size).join(hit, keys, "left_semi").drop("year", "page") for df in (ever, active))
    return prior.join(hit, keys, "left_anti").unionByName(pages.pages(placed_ever, placed_active, prefix, page_size))


def patched_recent(prior: DataFrame, batch_current: DataFrame, current: DataFrame, n: int, touched: DataFrame | None = None) -> DataFrame:
    """The newest n after a batch (id, registered_at, ... of the touched ids' current versions).

    touched (id) names all ids of the batch, those it withdraws too; without it
    they are those of batch_current. What the prior list can't tell (a full list
    of which fewer than n rows are left or come in at or above its end) comes
    from current: the n newest of it are read instead.
    """
    ids = batch_current.select("id") if touched is None else touched.select("id").unionByName(batch_current.select("id"))
    kept = prior.join(ids.distinct(), "id", "left_anti").unionByName(batch_current)
    place = F.struct("registered_at", "id")
    end = prior.agg(F.count("*").alias("was"), F.min(place).alias("end"))
    known = kept.crossJoin(F.broadcast(end)).agg(F.count_if((F.col("was") < n) | (place >= F.col("end")))).first()[0]
    if known < n and prior.count() >= n:
        return select.recent(current.select(prior.columns), n)
    return select.recent(kept, n)


def refill_groups(before: DataFrame, after: DataFrame, keys: Sequence[str], cap: int) -> DataFrame:
    """Groups whose list was full and is shorter now: they need rows from below, so they are made anew."""
    b = before.groupBy(*keys).agg(F.count("*").alias("was"))
    a = after.groupBy(*keys).agg(F.count("*").alias("now"))
    return b.join(a, list(keys), "left").where((F.col("was") >= cap) & (F.coalesce("now", F.lit(0)) < F.col("was"))).select(*keys)


def global_policy_path(path: Column, inputs: Sequence[str] = POLICY_INPUTS, prefixes: Sequence[str] = POLICY_PREFIXES) -> Column:
    """Whether a change of path changes what was concluded before, so that a scoped validation tells nothing."""
    return path.isin(*inputs) | _starts(path, tuple(prefixes))


def scope_decision(changes: DataFrame, validation: bool = False) -> DataFrame:
    """full or incremental, with the first reason, from changed paths (path, status); for a validation what changes the meaning of old records comes first."""
    policy = F.lit(validation)
    path, added = F.col("path"), F.col("status") == "A"
    full = path.isin(*FULL_INPUTS) | _starts(path, FULL_PREFIXES)
    ignored = (path.isin(*IGNORED) | _starts(path, IGNORED_PREFIXES)) & ~full
    append = added & _starts(path, APPEND_PREFIXES)
    why = lambda p, name: F.struct(F.lit(p).alias("p"), F.concat(F.lit(f"{name}: "), path).alias("reason"))
    reason = F.when(policy & global_policy_path(path), why(0, "policy")).when(full, why(1, "input")).when(~ignored & ~append, why(2, "not an append"))
    worst = changes.agg(F.min(reason).alias("w"))
    return worst.select(F.when(F.col("w").isNull(), "incremental").otherwise("full").alias("scope"), F.col("w.reason").alias("reason"))


def range_digests(rows: DataFrame, ranges: int) -> DataFrame:
    """range, n, and two sums of hashes of the rows whose own hash falls in it: equal for equal multisets of rows, whatever their order. A row for each range is all that is shuffled."""
    one, two = F.xxhash64(*rows.columns), F.xxhash64(F.lit("second"), *rows.columns)
    named = rows.select(F.pmod(one, F.lit(ranges)).alias("range"), one.cast("decimal(38,0)").alias("one"), two.cast("decimal(38,0)").alias("two"))
    return named.groupBy("range").agg(F.count("*").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"))


def differing_ranges(one: DataFrame, other: DataFrame, ranges: int = RANGES) -> list[int]:
    """The ranges in which two tables of the same columns differ: at most `ranges` numbers."""
    left, right = range_digests(one, ranges), range_digests(other, ranges)
    both = left.join(right.select("range", *[F.col(c).alias(f"_{c}") for c in ("n", "one", "two")]), "range", "full_outer")
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("one").eqNullSafe(F.col("_one")) & F.col("two").eqNullSafe(F.col("_two"))
    return sorted(r["range"] for r in both.where(~same).select("range").collect())


def unequal(one: DataFrame, other: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Rows that one of two tables has more often than the other: none where an incremental result equals a full one.

    Digests of ranges are met first, and only rows of ranges that differ are
    compared one by one, so equal tables cost a scan each and no shuffle of rows.
    """
    columns = one.columns
    left, right = one.select(columns), other.select(columns)
    differ = differing_ranges(left, right, ranges)
    own = F.pmod(F.xxhash64(*columns), F.lit(ranges)).isin(differ)
    left, right = (df.where(own) if differ else df.where("false") for df in (left, right))
    return left.exceptAll(right).withColumn("side", F.lit("one")).unionByName(right.exceptAll(left).withColumn("side", F.lit("other")))
