"""Attestation of whole inventories: an additive multiset hash, tree hashes and release arithmetic.

A root is the sum of 256-bit digests modulo 2**256, kept as eight 32-bit limbs
so that partial sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import tuple_digest

LIMBS = 8
BASE = 1 << 32
BIG = "decimal(38,0)"


def limbs(digest: Column) -> list[Column]:
    """The limbs of 64 hex digits, the highest first."""
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(LIMBS)]


def _carried(sums: list[Column]) -> Column:
    """64 hex digits of limb sums (the highest first, of any sign): carries go up, what leaves the top is dropped."""
    low_first = F.array(*[s.cast(BIG) for s in reversed(sums)])
    start = F.struct(F.lit(0).cast(BIG).alias("carry"), F.lit("").alias("text"))

    def add(state: Column, limb: Column) -> Column:
        total = (limb + state["carry"]).cast(BIG)
        rest = F.pmod(total, F.lit(BASE).cast(BIG)).cast("long")
        carry = ((total - rest) / F.lit(BASE)).cast(BIG)
        return F.struct(carry.alias("carry"), F.concat(F.lower(F.lpad(F.hex(rest), 8, "0")), state["text"]).alias("text"))

    return F.aggregate(low_first, start, add, lambda state: state["text"])


def multiset_root(inventory: DataFrame) -> DataFrame:
    """record_count and record_root of an inventory (path, bytes, sha256); 64 zeros for none."""
    own = inventory.select(tuple_digest(F.col("path"), F.col("bytes"), F.col("sha256")).alias("d"))
    sums = [F.coalesce(F.sum(limb.cast(BIG)), F.lit(0).cast(BIG)).alias(f"l{k}") for k, limb in enumerate(limbs(F.col("d")))]
    total = own.agg(F.count("*").alias("record_count"), *sums)
    return total.select("record_count", _carried([F.col(f"l{k}") for k in range(LIMBS)]).alias("record_root"))


def root_after(parent: Column, added: Column, removed: Column) -> Column:
    """parent + added - removed, modulo 2**256."""
    return _carried([a + b - c for a, b, c in zip(limbs(parent), limbs(added), limbs(removed), strict=True)])


def canonical_rows(inventory: DataFrame) -> Column:
    """The compact JSON array of the grouped rows (path, bytes, sha256), keys and rows in order."""
    rows = F.array_sort(F.collect_list(F.struct("path", "bytes", "sha256")))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    item = lambda r: F.concat(F.lit('{"bytes":'), r["bytes"].cast("string"), F.lit(',"path":'), quoted(r["path"]), F.lit(',"sha256":"'), r["sha256"], F.lit('"}'))
    return F.concat(F.lit("["), F.array_join(F.transform(rows, item), ","), F.lit("]"))


def tree_hashes(files: DataFrame, bundle: str) -> DataFrame:
    """Per bundle: files, bytes, the largest file and the hash of its canonical listing. A bundle has a bounded number of files; see bundle_digests for any number."""
    return files.groupBy(bundle).agg(F.count("*").alias("files"), F.sum("bytes").alias("total_bytes"), F.max("bytes").alias("largest"), F.sha2(canonical_rows(files), 256).alias("tree_sha256"))


def listing_width(n: int, rows: int = 4096) -> int:
    """Hex digits by which n rows are dealt to groups of about `rows`, at least one."""
    width = 1
    while rows * 16**width < n:
        width += 1
    return width


def listing_digests(rows: DataFrame, by: list[str], key: Column, item: Column, width: int) -> DataFrame:
    """digest and n of the rows of each group of by, at any size: the digest of the digests of parts, each of its items in the order of their keys.

    Rows are dealt to parts by the first hex digits of their key's digest, so a
    part is bounded by the width, and what is listed last is one digest a part.
    """
    dealt = rows.select(*by, F.substring(F.sha2(key, 256), 1, width).alias("group"), F.struct(key.alias("key"), item.alias("item")).alias("x"))
    groups = dealt.groupBy(*by, "group").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["item"]), ","), 256).alias("digest"), F.count("*").alias("n"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("group", "digest"))), lambda x: x["digest"]), "")
    return groups.groupBy(*by).agg(F.sha2(listed, 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def listing_digest(rows: DataFrame, key: Column, item: Column, width: int) -> DataFrame:
    """digest and n of all rows."""
    return listing_digests(rows, [], key, item, width)


def bundle_digests(files: DataFrame, bundle: str, item: Column, rows: int = 4096) -> DataFrame:
    """Per bundle: files, and a digest over all of them however many they are, as listing_digest makes it; parts have about `rows` files in the largest bundle."""
    most = files.groupBy(bundle).count().agg(F.max("count")).first()[0] or 0
    made = listing_digests(files, [bundle], F.col("path"), item, listing_width(most, rows))
    return made.select(bundle, F.col("n").alias("files"), "digest")


def sectioned(inventory: DataFrame, excluded: tuple[str, ...] = ("index.json", "release-delta.json")) -> DataFrame:
    """Inventory rows with the section of a release that they belong to."""
    from ledgerline.functions.keys import object_class

    section = F.when(object_class(F.col("path")) == "snapshot", "aggregates").when(object_class(F.col("path")) == "immutable", "additions").otherwise("stable")
    return inventory.where(~F.col("path").isin(*excluded)).withColumn("section", section)


def release_header(inventory: DataFrame, release: str, parent: str | None) -> DataFrame:
    return multiset_root(inventory).select(F.lit(release).alias("release"), F.lit(parent).cast("string").alias("parent"), "record_count", "record_root")


def arithmetic(parent: DataFrame, child: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Whether the child's count and root follow from the parent's and the changes; all four are headers of one row."""
    named = [df.select(F.col("record_count").alias(f"{k}_count"), F.col("record_root").alias(f"{k}_root"), F.lit(1).alias("one")) for k, df in (("p", parent), ("c", child), ("a", added), ("r", removed))]
    row = named[0]
    for other in named[1:]:
        row = row.join(other, "one")
    expected = root_after(F.col("p_root"), F.col("a_root"), F.col("r_root"))
    return row.select(F.col("c_count").alias("record_count"), (F.col("p_count") + F.col("a_count") - F.col("r_count") == F.col("c_count")).alias("count_holds"), (expected == F.col("c_root")).alias("root_holds"))
