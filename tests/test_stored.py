"""Tables in releases: together or not at all, at a cost that doesn't grow, and equal to a full build."""

import datetime
import hashlib
import pathlib

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ledgerline.operators import search, stored_postings, surfaces
from ledgerline.sources import store
from ledgerline.sources.store import Surface

LIST, RENDERS = Surface("recent", ("id",)), Surface("renders", ("id",))
VERSION = "id string, version long, registered_at timestamp, brand string, type string, repository string, withdrawn boolean"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, value long")


def values(spark, root, surface, **kw):
    return {r["id"]: r["value"] for r in store.read(spark, root, surface, **kw).collect()}


def test_both_tables_change_or_neither_does(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = store.publish(spark, root, {LIST: rows(spark, ("a", 1), ("b", 2)), RENDERS: rows(spark, ("a", 10))})
    write, calls = DataFrameWriter.parquet, []

    def broken(self, path, *a, **kw):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("the second table can't be written")
        return write(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(OSError):
        store.publish(spark, root, {LIST: rows(spark, ("a", 5)), RENDERS: rows(spark, ("a", 50))})
    monkeypatch.undo()
    assert store.head(spark, root) == first
    assert values(spark, root, LIST) == {"a": 1, "b": 2} and values(spark, root, RENDERS) == {"a": 10}
    # What broke off is in nobody's way.
    store.publish(spark, root, {LIST: rows(spark, ("a", 6)), RENDERS: rows(spark, ("a", 60), ("c", 1))})
    assert values(spark, root, LIST) == {"a": 6, "b": 2} and values(spark, root, RENDERS) == {"a": 60, "c": 1}
    assert values(spark, root, LIST, at=first) == {"a": 1, "b": 2}
    assert store.violations(spark, root) == []


def test_a_failure_at_the_pointer_leaves_the_old_release(spark, tmp_path):
    root = str(tmp_path)
    first = store.publish(spark, root, {LIST: rows(spark, ("a", 1))})
    store.publish(spark, root, {LIST: rows(spark, ("a", 2))})
    file = tmp_path / "pointers" / "000000000002.json"
    whole = file.read_bytes()
    (tmp_path / "pointers" / ".000000000002.json.crc").unlink(missing_ok=True)
    for torn in (whole[: len(whole) // 2], b"", whole.replace(b'"number": 2', b'"number": 3')):
        file.write_bytes(torn)
        assert store.head(spark, root) == first and values(spark, root, LIST) == {"a": 1}
    # The number is spent; the next release follows the one that readers have.
    third = store.publish(spark, root, {LIST: rows(spark, ("b", 3))})
    assert third["number"] == 3 and third["parent"] == first["release"]
    assert values(spark, root, LIST) == {"a": 1, "b": 3}


def test_of_two_publishers_the_second_begins_again(spark, tmp_path):
    root = str(tmp_path)
    base = store.publish(spark, root, {LIST: rows(spark, ("a", 1))})
    store.publish(spark, root, {LIST: rows(spark, ("a", 2))}, based_on=base)
    with pytest.raises(RuntimeError, match="since"):
        store.publish(spark, root, {LIST: rows(spark, ("a", 3))}, based_on=base)
    tried = []

    def plus_one(last):
        tried.append(last["number"])
        if len(tried) == 1:
            store.publish(spark, root, {LIST: rows(spark, ("a", 10))})
        return {LIST: store.read(spark, root, LIST, at=last).withColumn("value", F.col("value") + 1)}

    store.changed(spark, root, plus_one)
    assert tried == [2, 3] and values(spark, root, LIST) == {"a": 11}


def test_keys_that_go_and_null_keys(spark, tmp_path):
    root = str(tmp_path)
    store.publish(spark, root, {LIST: rows(spark, ("a", 1), (None, 2), ("", 3))})
    store.publish(spark, root, {LIST: rows(spark, ("a", 1), (None, 4)).withColumn("gone", F.col("id").isNotNull())})
    assert values(spark, root, LIST) == {None: 4, "": 3}
    assert values(spark, root, LIST, keys=rows(spark, (None, 0), ("none", 0))) == {None: 4}
    assert store.read(spark, root, RENDERS) is None and store.head(spark, f"{root}/none") is None
    small = store.compact(spark, root, [LIST])
    assert values(spark, root, LIST) == {None: 4, "": 3} and len(small["tables"]["recent"]["folders"]) == 1
    with pytest.raises(ValueError, match="columns"):
        store.publish(spark, root, {LIST: rows(spark, ("a", 1)).withColumn("more", F.lit(1))})


def test_rows_that_changed_after_publication_are_found(spark, tmp_path):
    root = str(tmp_path)
    store.publish(spark, root, {LIST: rows(spark, ("a", 1), ("b", 2)), RENDERS: rows(spark, ("a", 1))})
    second = store.publish(spark, root, {LIST: rows(spark, ("b", 3))})
    assert store.violations(spark, root) == []
    other = store.publish(spark, f"{root}/other", {LIST: rows(spark, ("b", 4))})
    # The same folders, with another row in one of them.
    own, false = (tmp_path / "recent" / second["attempt"]), (tmp_path / "other" / "recent" / other["attempt"])
    for part in own.glob("part=*"):
        for file in part.iterdir():
            file.unlink()
        for file in (false / part.name).iterdir():
            (part / file.name).write_bytes(file.read_bytes())
    assert store.violations(spark, root) == [(2, "rows", "recent")]
    (tmp_path / "pointers" / "000000000001.json").unlink()
    assert (2, "parent", "") in store.violations(spark, root)


# Collections that batches move on


def version(k, v=1, day="2026-07-28", brand="B", kind="T", repository=None, withdrawn=False, minute=None):
    at = datetime.datetime.fromisoformat(f"{day}T00:00:00") + datetime.timedelta(minutes=k + 1000 * v if minute is None else minute)
    return (f"REC-{day}-{k:06d}", v, at, brand, kind, repository or f"r{k}", withdrawn)


def tables(spark, root):
    return {s.name: sorted(map(str, store.read(spark, root, s).collect())) for s in surfaces.ALL}


def test_batches_leave_what_a_full_build_makes(spark, tmp_path, front=3):
    batches = [
        [version(k, brand=f"B{k % 2}", repository=f"r{k % 3}") for k in range(1, 13)],
        [version(2, 2, brand="B1", repository="r2"), version(3, 2, withdrawn=True), version(13, brand="new")],  # a new version that changes its code, one that counts for nothing, a new code
        [version(12, 2, brand="B0", kind="U", repository="r9"), version(10, 2, brand="B9"), version(8, 2, brand="B9", repository="r0")],  # full lists lose what is newest
        [version(1, day="2027-01-02", withdrawn=True), version(401, brand="B0")],  # a day that only has a withdrawn result, another page
    ]
    every = []
    for k, batch in enumerate(batches):
        every += batch
        one = surfaces.appended(spark, str(tmp_path / "moved"), spark.createDataFrame(batch, VERSION), "REC", 200, front=front, most=front)
        surfaces.appended(spark, str(tmp_path / f"whole{k}"), spark.createDataFrame(every, VERSION), "REC", 200, replace=True, front=front, most=front)
        assert one["number"] == k + 1
        assert tables(spark, str(tmp_path / "moved")) == tables(spark, str(tmp_path / f"whole{k}")), k
    assert store.violations(spark, str(tmp_path / "moved")) == []


def test_an_append_costs_the_same_at_11_and_at_91_records(spark, tmp_path):
    costs = []
    for size in (11, 91):
        root = str(tmp_path / str(size))
        surfaces.appended(spark, root, spark.createDataFrame([version(k) for k in range(1, size)], VERSION), "REC", 200, replace=True, front=3, most=3)
        last = store.head(spark, root)
        batch = spark.createDataFrame([version(1, day="2026-07-29", repository="own")], VERSION)
        touched = {s: keys for s, keys in ((surfaces.RESULTS, batch.select("id")), (surfaces.CODES, spark.createDataFrame([("brand", "B"), ("type", "T")], "kind string, code string")))}
        read = sum(len(store.read(spark, root, s, keys, last).inputFiles()) for s, keys in touched.items())
        new = surfaces.appended(spark, root, batch, "REC", 200, front=3, most=3)
        files = sorted(p.parent.parent.parent.name for p in pathlib.Path(root).glob(f"*/{new['attempt']}/part=*/*.parquet"))
        costs.append((read, {n: w["rows"] for n, w in new["written"].items()}, files))
    assert costs[0][1:] == costs[1][1:] and max(c[0] for c in costs) <= 3
    assert costs[0][1] == {"results": 1, "pages": 1, "days": 1, "codes": 2, "repositories": 1}


# Postings


def test_sealed_pages_are_written_once_and_all_equals_a_rebuild(spark, tmp_path):
    root, size = str(tmp_path / "moved"), 4
    name = lambda k: f"N{k:04d}"
    terms = lambda ks: [(name(k), t) for k in ks for t in {"all", f"mod{k % 3}", f"own{k}"}]
    frame = lambda pairs: spark.createDataFrame(pairs, "name string, term string")
    stored_postings.appended(spark, root, frame(terms(range(5))), "name", size)
    sealed, files = {}, {}
    for step in range(10):
        first = 5 + 3 * step
        made = stored_postings.appended(spark, root, frame(terms(range(first, first + 3))), "name", size)
        # Rows written: the touched terms' heads, and the pages that they had open or opened.
        assert made["written"]["heads"]["rows"] == len({t for _, t in terms(range(first, first + 3))})
        assert made["written"]["postings"]["rows"] <= 2 * made["written"]["heads"]["rows"]
        for file in pathlib.Path(root).glob("postings/*/part=*/*.parquet"):
            now = hashlib.sha256(file.read_bytes()).hexdigest()
            assert files.setdefault(file, now) == now
        for r in store.read(spark, root, stored_postings.PAGES).collect() if step in (2, 5, 9) else ():
            key = r["term"], r["page"]
            if len(r["names"]) == size:
                assert sealed.setdefault(key, r["names"]) == r["names"]
            assert key not in sealed or sealed[key] == r["names"]

    def rebuilt(ks):
        full = search.postings(frame(terms(ks)), "name", size)
        return sorted(map(tuple, full.select("term", "page", "rank", "name").collect()))

    assert sorted(map(tuple, stored_postings.rows(spark, root, size).collect())) == rebuilt(range(35))
    gone = [9, 10, 11, 33]
    made = stored_postings.withdrawn(spark, root, frame(terms(gone)), "name", size)
    left = [k for k in range(35) if k not in gone]
    assert sorted(map(tuple, stored_postings.rows(spark, root, size).collect())) == rebuilt(left)
    heads = {r["term"]: r["results"] for r in store.read(spark, root, stored_postings.HEADS).collect()}
    assert heads["all"] == 31 and "own9" not in heads
    # Pages before the first that loses a name are as they were.
    again = store._folder(spark, f"{root}/postings/{made['attempt']}", f"{made['tables']['postings']['schema']}, part string")
    assert again.where("term = 'all'").agg(F.min("page")).first()[0] == 9 // size
    stored_postings.appended(spark, root, frame(terms(range(40, 43))), "name", size)
    assert sorted(map(tuple, stored_postings.rows(spark, root, size).collect())) == rebuilt([*left, 40, 41, 42])
    store.compact(spark, root, [stored_postings.PAGES, stored_postings.HEADS])
    assert sorted(map(tuple, stored_postings.rows(spark, root, size).collect())) == rebuilt([*left, 40, 41, 42])
    assert store.violations(spark, root) == []
