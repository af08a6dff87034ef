"""Derived tables kept in releases: several tables change together or not at all, and a change costs what it touches.

A table (a Surface) is a set of rows by key. A release writes the rows of the
keys that it changes, and no other, into folders of its own; its pointer, one
small file, is written last. Readers follow the newest pointer to the folders
that count and take each key's row of the latest of them. So what a release
that broke off has written is never read, a folder that counts is never written
again, and a release costs the keys that it touches, whatever is there already.

A folder is divided by the first hexadecimal digits of each key's digest, and
who reads some keys opens only their parts. A release that replaces (a full
build, or a compaction of what is there) begins the list of folders anew.

A pointer is named by its number and can't be written twice; of two publishers
of one number the second fails. It holds the digest of every table's new rows
and is named by its own digest, with its parent's, so a release can be held
against what is stored.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.attest import listing_digest, listing_width

#: Rows that a part of a folder has at most, about, when a table is built.
PART_ROWS = 100_000
#: Since 2 a table's digest is made of its rows' digests, before of the rows themselves.
SCHEMA = 2


@dataclass(frozen=True)
class Surface:
    """A table by name, the columns of its key, and those of them that it is divided and asked by (all, if none are named)."""

    name: str
    keys: tuple[str, ...]
    by: tuple[str, ...] = ()

    @property
    def asked(self) -> tuple[str, ...]:
        return self.by or self.keys

    def digest(self) -> Column:
        """Of what a row is asked by; a null is told from an empty text."""
        return F.sha2(F.to_json(F.struct(*self.asked), {"ignoreNullFields": "false"}), 256)


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its Path class."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return own(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, own = _files(spark, root)
    there = own(f"{root}/pointers")
    names = [s.getPath().getName() for s in fs.listStatus(there)] if fs.exists(there) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _named(document: dict) -> str:
    """A release's name: the digest of its document."""
    return hashlib.sha256(json.dumps({k: v for k, v in document.items() if k != "release"}, sort_keys=True).encode()).hexdigest()


def pointer(spark: SparkSession, root: str, number: int) -> dict | None:
    """The document of one release; None where its file is cut short or isn't the document that its name says."""
    fs, own = _files(spark, root)
    stream = fs.open(own(f"{root}/pointers/{number:012d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        document = json.loads(text)
    except ValueError:
        return None
    return document if isinstance(document, dict) and document.get("release") == _named(document) else None


def head(spark: SparkSession, root: str) -> dict | None:
    """The newest release, or None."""
    return next((d for n in reversed(_numbers(spark, root)) if (d := pointer(spark, root, n))), None)


def history(spark: SparkSession, root: str) -> list[dict]:
    """All releases, the oldest first."""
    return [d for n in _numbers(spark, root) if (d := pointer(spark, root, n))]


def _item(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})


def _attested(rows: DataFrame, surface: Surface, width: int, schema: int = SCHEMA) -> dict:
    """rows and digest of a folder; a digest a row is shuffled, not the row."""
    item = _item(rows) if schema < 2 else F.sha2(_item(rows), 256)
    row = listing_digest(rows, F.concat(surface.digest(), F.to_json(F.struct(*surface.keys), {"ignoreNullFields": "false"})), item, width).first()
    return {"rows": row["n"], "digest": row["digest"] or hashlib.sha256(b"").hexdigest()}


def _folder(spark: SparkSession, path: str, schema: str, parts: Sequence[str] | None = None) -> DataFrame | None:
    """What lies in the named parts of a folder, or in all; None where nothing does."""
    if parts is None:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    fs, own = _files(spark, path)
    there = [p for p in (f"{path}/part={x}" for x in parts) if fs.exists(own(p))]
    return spark.read.schema(schema).option("basePath", path).parquet(*there) if there else None


def publish(spark: SparkSession, root: str, changes: dict[Surface, DataFrame], replace: bool = False, based_on: dict | None = None, width: int | dict[Surface, int] | None = None, note: dict | None = None) -> dict:
    """Writes new rows of several tables as one release and points readers to it; returns its document.

    A row with gone = true takes its key away. With replace the tables hold these
    rows alone, and a table that isn't named is none of the release's. based_on
    is the release that the rows were made from; if there is a newer one by now,
    the publication is refused. width is the digits by which new tables are
    divided, of all or of some by table; without it, it follows from the number
    of their rows, for which they are made once more. note goes into the document
    as it is, that of the release before where there is none.
    """
    with released(spark):
        return _published(spark, root, changes, replace, based_on, width, note)


def _published(spark: SparkSession, root: str, changes: dict[Surface, DataFrame], replace: bool, based_on: dict | None, width: int | dict[Surface, int] | None, note: dict | None) -> dict:
    last = head(spark, root)
    if based_on is not None and (last is None or last["release"] != based_on["release"]):
        raise RuntimeError("another release has been published since")
    number = max(_numbers(spark, root), default=0) + 1
    attempt = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    tables = {} if replace or last is None else {n: dict(t, folders=list(t["folders"])) for n, t in last["tables"].items()}
    written = {}
    for surface, rows in changes.items():
        own = rows if "gone" in rows.columns else rows.withColumn("gone", F.lit(False))
        held = tables.get(surface.name)
        # A table's parts are set when it is built, from the number of its rows, and stay until it is built anew.
        parts = held["width"] if held else (width.get(surface) if isinstance(width, dict) else width) or listing_width(own.count(), PART_ROWS)
        path = f"{root}/{surface.name}/{attempt}"
        own.withColumn("part", F.substring(surface.digest(), 1, parts)).repartition("part").write.partitionBy("part").parquet(path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
        stored = _folder(spark, path, f"{schema}, part string").drop("part")
        # Digits of a group are as many as a part's, so a group of the digest is bounded as well.
        written[surface.name] = _attested(stored, surface, parts)
        if held and held["schema"] != schema:
            raise ValueError(f"{surface.name}: columns are {schema}, not {held['schema']}")
        tables[surface.name] = {"folders": [*(held["folders"] if held else []), attempt], "width": parts, "schema": schema, "keys": list(surface.keys), "by": list(surface.by)}
    document = {"schema": SCHEMA, "number": number, "parent": last["release"] if last else None, "attempt": attempt, "tables": tables, "written": written, "note": note if note is not None else (last or {}).get("note")}
    document["release"] = _named(document)
    fs, own = _files(spark, root)
    fs.mkdirs(own(f"{root}/pointers"))
    # Without overwriting: of two publishers of one number the second fails here.
    out = fs.create(own(f"{root}/pointers/{number:012d}.json"), False)
    try:
        out.write(bytearray(json.dumps(document, sort_keys=True).encode()))
    finally:
        out.close()
    return document


def read(spark: SparkSession, root: str, surface: Surface, keys: DataFrame | None = None, at: dict | None = None) -> DataFrame | None:
    """A table's rows in the newest release (or the one given), or None where it has no such table; with keys (a small table of what it is asked by), only theirs, from their parts alone."""
    document = at or head(spark, root)
    table = (document or {"tables": {}})["tables"].get(surface.name)
    if table is None:
        return None
    parts = None
    if keys is not None:
        # At most 16 ** width of them.
        with released(spark):
            parts = [r[0] for r in keys.select(F.substring(surface.digest(), 1, table["width"]).alias("part")).distinct().collect()]
    read_schema = f"{table['schema']}, part string"
    versions = None
    for at_place, folder in enumerate(table["folders"]):
        rows = _folder(spark, f"{root}/{surface.name}/{folder}", read_schema, parts)
        if rows is not None:
            rows = rows.drop("part").withColumn("_at", F.lit(at_place))
            versions = rows if versions is None else versions.unionByName(rows)
    if versions is None:
        versions = spark.createDataFrame([], table["schema"]).withColumn("_at", F.lit(0))
    if keys is not None:
        same = F.lit(True)
        for k in surface.asked:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        versions = versions.join(keys.select(*[F.col(k).alias(f"_{k}") for k in surface.asked]).distinct(), same, "left_semi")
    values = [c for c in versions.columns if c not in (*surface.keys, "_at")]
    if len(table["folders"]) > 1:
        versions = versions.groupBy(*surface.keys).agg(F.max_by(F.struct(*values), "_at").alias("_v")).select(*surface.keys, "_v.*")
    return versions.where(~F.col("gone")).drop("gone", "_at")


#: Spark's switch by which a query's shuffle files go when it has ended, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go as each ends."""
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, was) if was else spark.conf.unset(_CLEANUP)


def kept(rows: DataFrame, name: str) -> DataFrame:
    """rows, written to a new folder and read from it: for what is read more than once. The shuffle files that they were made with are gone by then."""
    spark = rows.sparkSession
    path = scratch_root(spark, name)
    with released(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def compact(spark: SparkSession, root: str, surfaces: Sequence[Surface]) -> dict:
    """A release of the same rows in one folder a table; a table that isn't named is dropped."""
    last = head(spark, root)
    return publish(spark, root, {s: read(spark, root, s, at=last) for s in surfaces}, replace=True, based_on=last)


def violations(spark: SparkSession, root: str) -> list[tuple[int, str, str]]:
    """(release number, rule, table) of every release that isn't what its pointer says: rows whose number or digest differ, and parents that aren't the release before."""
    found, before = [], None
    for document in history(spark, root):
        if document["parent"] != before:
            found.append((document["number"], "parent", ""))
        before = document["release"]
        for name, told in document["written"].items():
            table = document["tables"][name]
            rows = _folder(spark, f"{root}/{name}/{document['attempt']}", f"{table['schema']}, part string").drop("part")
            if _attested(rows, Surface(name, tuple(table["keys"]), tuple(table["by"])), table["width"], document["schema"]) != told:
                found.append((document["number"], "rows", name))
    return found


def changed(spark: SparkSession, root: str, make: Callable[[dict | None], dict[Surface, DataFrame]], tries: int = 3) -> dict:
    """Publishes what make gives for the newest release, again where another publisher was first."""
    for left in range(tries, 0, -1):
        last = head(spark, root)
        try:
            return publish(spark, root, make(last), based_on=last)
        except RuntimeError:
            if left == 1:
                raise
    raise AssertionError("unreachable")


def scratch_root(spark: SparkSession, name: str) -> str:
    """A new folder for tables of a query, in the folder that all executors share: spark.checkpoint.dir. Only a session whose executors are threads of one process, as in tests, may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.ledgerline.store", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.ledgerline.store", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
