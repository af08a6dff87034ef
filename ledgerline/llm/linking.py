"""From shared buckets to verified links and classes, without listing the pairs of a bucket.

Members of a bucket are first compared with one leader each. Only where a
bucket still holds more than one component, members outside its largest one
meet those of other components, in blocks of bounded size; a block gives no
more links than it needs to join its components. So every pair of a bucket is
compared or inside one component, and no class is split that a comparison of
all pairs in the buckets would join.

A key may hold a third of all rows. Values that go with a key are counted with
it; the few keys with more than their share are joined by broadcast, the others
by a shuffle in which no key is large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import discarded, written

#: A block compares about so many outsiders with so many members; small buckets share a task up to about TOGETHER rows.
OUTSIDERS, MEMBERS, TOGETHER = 32, 256, 500
#: Rows of a block are compared together up to so many elements.
TOGETHER_ELEMENTS = 1 << 15
#: A key is hot with more rows than 1 / HOT of all, so fewer than HOT keys are; and with HOT_ROWS at least.
HOT, HOT_ROWS = 2_000, 250


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, 1.0).otherwise(common / union)


def attached(rows: DataFrame, values: DataFrame, on: list[str], total: int) -> DataFrame:
    """rows joined with values, which has a row for each key and n, how many of the total rows have it.

    Fewer than HOT keys are hot, whatever the input, so theirs can be broadcast.
    """
    bound = max(HOT_ROWS, total // HOT)
    hot = values.where(F.col("n") > bound).collect() if total > bound else []
    if not hot:
        return rows.join(values.drop("n"), on)
    known = rows.sparkSession.createDataFrame(hot, values.schema).drop("n")
    rest = rows.join(F.broadcast(known.select(on)), on, "left_anti").join(values.drop("n"), on)
    return rows.join(F.broadcast(known), on).unionByName(rest)


def _sum_of(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id it is connected with) of every end of the edges (a, b), by alternating stars."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _sum_of(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = attached(both, least, ["u"], 2 * before[0]).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = attached(large, least, ["u"], before[0]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        last, now = now, written(small.where("u <> v").distinct(), "edges")
        discarded(last)
        discarded(large)
        after = _sum_of(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows of (bucket, id) whose bucket has more than one row, with each id's weight: the sizes of its buckets added up.

    Ids may be of any type with an order.
    """
    common = written(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "common")
    total = common.agg(F.sum("n")).first()[0] or 0
    rows = written(attached(buckets, common.withColumn("size", F.col("n")), ["bucket"], total), "buckets")
    weight = rows.groupBy("id").agg(F.sum("size").alias("weight"))
    return rows.select("bucket", "id").join(weight, "id")


def _similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (id, leader) as (a, b) with their exact Jaccard similarity. Both sides grow with the corpus, so both are shuffled at every size."""
    own, other = sets.withColumnRenamed("elements", "own"), sets.select(F.col("id").alias("leader"), F.col("elements").alias("other"))
    joined = pairs.join(own.hint("merge"), "id").join(other.hint("merge"), "leader")
    return joined.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"), jaccard(F.col("own"), F.col("other")).alias("similarity"))


def links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs (a, b) among members (bucket, id, weight; a written table) that connect all that are similar; sets has id, elements (distinct values)."""
    first = written(members.groupBy("bucket").agg(F.max_by("id", F.struct("weight", "id")).alias("leader"), F.count("*").alias("n")), "leaders")
    members = written(attached(members.drop("weight"), first, ["bucket"], members.count()), "led")
    pairs = members.where("id <> leader").select("id", "leader").distinct()
    led = written(_similarities(pairs, sets).where(F.col("similarity") >= threshold).select("a", "b"), "similar")
    placed = written(members.join(components(led), "id", "left").select("bucket", "id", "leader", F.coalesce("component", "id").alias("component")), "placed")
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    parts = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.count("*").alias("parts"), F.sum("size").alias("n")).where("parts > 1")
    parts = written(parts.drop("parts"), "parts")
    if parts.isEmpty():
        return led
    rows = attached(placed, parts, ["bucket"], placed.count())
    outside = (F.col("component") != F.col("largest")) & (F.col("id") != F.col("leader"))
    return led.unionByName(_across(rows.select("bucket", "id", "component", outside.alias("outside")), sets, threshold))


def _across(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between outside rows and rows of other components in the same bucket."""
    rows = written(rows, "open")
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("member_blocks"), F.ceil(F.count_if("outside") / OUTSIDERS).cast("int").alias("outside_blocks"), F.count("*").alias("n")).where("outside_blocks > 0")
    total = rows.count()
    together = max(1, total // TOGETHER)
    whole = attached(rows, sizes, ["bucket"], total).join(sets.hint("merge"), "id")
    # Small buckets share tasks; a large one has tasks of its own.
    small = (F.col("member_blocks") == 1) & (F.col("outside_blocks") == 1)
    whole = whole.withColumn("task", F.when(small, F.pmod("bucket", F.lit(together))).otherwise(F.col("bucket"))).withColumn("alone", ~small)
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["task", "alone", "m", "o", "bucket", "id", "component", "elements"]
    outside = whole.where("outside").withColumn("o", block("outside_blocks", 1)).withColumn("m", every("member_blocks")).select(columns).toDF(*columns)
    inside = whole.withColumn("m", block("member_blocks", 2)).withColumn("o", every("outside_blocks")).select(columns).toDF(*columns)

    def compare(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            inner = dict(_by_bucket(b))
            for bucket, own in _by_bucket(a):
                out += _forest(own, inner[bucket], threshold) if bucket in inner else []
        return pd.DataFrame(out, columns=["a", "b"])

    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    keys = ["task", "alone", "m", "o"]
    return outside.groupBy(*keys).cogroup(inside.groupBy(*keys)).applyInPandas(compare, schema)


def _by_bucket(rows: pd.DataFrame) -> Iterator[tuple[int, tuple[list, list, list]]]:
    """Each bucket with the ids, components and elements of its rows, in their order."""
    bucket = rows["bucket"].to_numpy()
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    ids, of, sets = ([column[k] for k in order.tolist()] for column in (rows[c].tolist() for c in ("id", "component", "elements")))
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist()
    for a, b in zip(start, [*start[1:], len(bucket)], strict=True):
        yield bucket[a], (ids[a:b], of[a:b], sets[a:b])


def _forest(outside: tuple[list, list, list], inside: tuple[list, list, list], threshold: float) -> list[tuple]:
    """Similar pairs between two blocks (ids, components, elements) of a bucket, as few as join the components that they join."""
    (ids, of, sets), (others, components_of, elements) = outside, inside
    sizes, other_sizes = (np.array([len(x) for x in every]) for every in (sets, elements))
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for a, b in _stretches(other_sizes, TOGETHER_ELEMENTS):
        wanted, asks = np.concatenate(elements[a:b]), np.repeat(np.arange(b - a), other_sizes[a:b])
        low = np.searchsorted(values, wanted)
        each = np.searchsorted(values, wanted, side="right") - low
        hits = owner[np.arange(each.sum()) + np.repeat(low - (np.cumsum(each) - each), each)]
        common = np.bincount(np.repeat(asks, each) * len(sets) + hits, minlength=(b - a) * len(sets)).reshape(b - a, len(sets))
        for j, k in np.argwhere(common >= threshold * (sizes + other_sizes[a:b, None] - common) - 1e-9).tolist():
            one, two = find(of[k]), find(components_of[a + j])
            if one != two:
                root[one] = two
                found.append((min(others[a + j], ids[k]), max(others[a + j], ids[k])))
    return found


def _stretches(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches (from, to) of rows whose sizes add up to most, or of one row."""
    ends, a = np.concatenate(([0], np.cumsum(sizes))), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, side="right")) - 1)
        yield a, b
        a = b
