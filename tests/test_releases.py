"""Places, equality, chains, scoped validation and authorities over small tables."""

import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from ledgerline.operators import attest, authority_documents, availability, contracts, incremental, ordering, rules, scoped
from ledgerline.plans import catalog
from ledgerline.sources import store
from ledgerline.streaming import observe, ordered

RECORD = "id string, day string, serial long, version long, title string, registered_at string, repository string, project_path string, config_path string, submission_id string"


def found(rows):
    return sorted((r.entity, r.rule, r.field) for r in rows.collect())


def test_positions_with_gaps_or_repeats_are_found(spark):
    rows = spark.createDataFrame([("g", 0, "c"), ("g", 2, "b"), ("g", 4, "a"), ("h", 0, "a"), ("h", 1, "b"), ("i", 0, "a"), ("i", 0, "b"), ("i", 2, "c"), ("j", 1, "a"), ("k", None, "a")], "grp string, position long, key string")
    assert sorted(r.grp for r in ordering.not_contiguous(rows, ["grp"], "position").collect()) == ["g", "i", "j", "k"]
    whole = rows.where("grp = 'g'")
    assert found(contracts.out_of_order(whole, "key", [], "position", F.col("key"))) == [("positions", "gap", "position")]
    assert found(contracts.out_of_order(rows.where("grp = 'h'"), "key", ["grp"], "position", F.col("key"))) == []


def test_release_rules_find_paths_that_do_not_ascend_and_no_gap(spark, tmp_path):
    ids = [10, -3, 100, 1, -4, 9, 11]
    spark.createDataFrame([(i, "text") for i in ids], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, catalog.QUERIES["release_rules"](spark, str(tmp_path)).collect()))
    paths = [f"documents/{i}" for i in sorted(ids)]
    assert got == sorted((b, "order") for a, b in zip(paths, paths[1:], strict=False) if not a < b) and len(got) == 3


def test_places_do_not_depend_on_the_number_of_ranges(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"), (F.col("id") % 4).alias("g")).withColumn("place", F.lit(-1))
    want = [r.k for r in rows.orderBy("k").collect()]
    for ranges in (1, 3, 50, 2_000):
        got = ordering.numbered(rows, F.col("k"), ranges=ranges)
        assert [r.k for r in got.orderBy("place").collect()] == want and got.select("place").distinct().count() == 1000
    grouped = ordering.numbered(rows.withColumn("g", F.when(F.col("g") > 0, F.col("g"))), F.col("k"), ranges=9, by=["g"])
    for g in (None, 1, 2, 3):
        own = grouped.where(F.col("g").eqNullSafe(F.lit(g))).orderBy("place").collect()
        assert [r.place for r in own] == list(range(1, 251)) and [r.k for r in own] == sorted(r.k for r in own)


def test_one_changed_row_is_found_by_its_range_alone(spark):
    one = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("n"))
    other = one.withColumn("v", F.when(F.col("id") == 777, "changed").otherwise(F.col("v")))
    assert incremental.differing_ranges(one, one.repartition(7)) == []
    assert len(incremental.differing_ranges(one, other)) <= 2
    assert sorted((r.id, r.side) for r in incremental.unequal(one, other).collect()) == [(777, "one"), (777, "other")]
    # A row that one has twice; and the only shuffle of the digests is of a row for each range.
    assert [(r.id, r.side) for r in incremental.unequal(one.unionByName(one.where("id = 5")), one).collect()] == [(5, "one")]
    plan = incremental.range_digests(one, 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


def test_chains_find_rings_forks_orphans_and_carry_counts(spark):
    draw = random.Random(6)
    parent = {k: k - 1 if k else None for k in range(200)}  # one long chain
    parent |= {300: 301, 301: 302, 302: 300, 303: 302}  # a ring, and one that runs into it
    parent |= {400: 999, 401: 400, 500: 10, 600: None}  # an orphan with a follower, a fork, another root
    change = {k: draw.randrange(-5, 9) for k in parent}
    rows = spark.createDataFrame([(k, p, change[k]) for k, p in parent.items()], "release long, parent long, change long").repartition(5)
    got = {r.release: (r.depth, r.total, r.ended) for r in contracts.carried(rows).collect()}
    for k in parent:
        seen, at = [], k
        while at in parent and at not in seen:
            seen.append(at)
            at = parent[at]
        ended = "root" if at is None else "cycle" if at in seen else "orphan"
        want = (None, None) if ended == "cycle" else (len(seen) - 1, sum(change[s] for s in seen))
        assert got[k][2] == ended and (got[k][:2] == want or ended == "orphan"), k
    assert found(contracts.chains(rows)) == sorted([("600", "root", "parent"), ("10", "fork", "release"), ("302", "fork", "release"), ("400", "orphan", "parent"), ("401", "orphan", "parent"), *[(str(k), "cycle", "parent") for k in (300, 301, 302, 303)]])


def test_scoped_validation_opens_only_what_a_batch_touches(spark, tmp_path):
    rows = [(f"REC-{k:06d}", v, f"digest{k if k != 40 else 39}", "T", 20) for k in range(400) for v in (1, 2)]
    rows += [("REC-000007", 4, "digest7", "T", 20), ("REC-000008", 3, "digest8", "T", 3), ("REC-000009", 3, "other", "T", 20)]
    schema = "id string, version long, digest string, type string, size long"
    root = str(tmp_path)
    scoped.stored(spark, root, spark.createDataFrame(rows[:-3], schema), replace=True)
    last = store.head(spark, root)
    scoped.stored(spark, root, spark.createDataFrame(rows[-3:], schema))
    changes = spark.createDataFrame([(f"entries/REC-{k:06d}-v3.json",) for k in (7, 8, 9, 40)] + [("renders/x/y",)], "path string")
    own = [rules.at_least("size", 10)]
    got = found(scoped.validated(spark, root, changes, own))
    whole = found(scoped.violations(store.read(spark, root, scoped.ENTRIES), store.read(spark, root, scoped.OWNERS), own))
    assert got == [v for v in whole if v[0][4:10] in ("000007", "000008", "000009", "000040")]
    assert {v[1] for v in got} == {"gap", "minimum", "identity", "owner"} and ("REC-000039-v1", "owner", "digest") in whole
    ids = spark.createDataFrame([("REC-000007",)], "id string")
    assert last["tables"]["entries"]["width"] == 1
    assert len(store.read(spark, root, scoped.ENTRIES, ids, last).inputFiles()) == 1 < len(store.read(spark, root, scoped.ENTRIES, at=last).inputFiles())


def record(k, version=1, serial=None, title="t", repository=None, submission=None, day="2026-07-28"):
    serial = serial or k
    return (f"REC-{day}-{serial:06d}", day, serial, version, title, f"{day}T00:00:0{version}Z", repository or f"Own/r{k}", None if k % 2 else "p", "c", submission or f"s{k}v{version}")


def test_an_append_changes_just_what_it_touches(spark):
    frame = lambda rows: spark.createDataFrame(rows, RECORD)
    prior, batch = frame([record(1), record(2), record(2, 2)]), frame([record(1, 2), record(3)])
    docs = authority_documents.documents
    before, after = docs(prior), docs(prior.unionByName(batch))
    assert found(authority_documents.append_violations(prior, batch, before, after)) == []
    assert found(authority_documents.disagreements(after, after)) == []
    day, second = "registrations/days/2026-07-28.json", "registrations/results/REC-2026-07-28-000002.json"
    spoilt = after.withColumn("body", F.when(F.col("path") == second, "{}").otherwise(F.col("body"))).where(F.col("path") != day)
    assert found(authority_documents.append_violations(prior, batch, before, spoilt)) == [(day, "absent", "document"), (second, "untouched", "document")]
    # A submission and an identity that are bound already.
    again = frame([record(3, submission="s1v1", repository="own/R1", serial=3)])
    names = {e.split("/")[1]: r for e, r, _ in found(authority_documents.append_violations(prior, again, before, docs(prior.unionByName(again)))) if r == "bound"}
    assert names == {"submissions": "bound", "identities": "bound"}
    lost = found(authority_documents.disagreements(after, before.unionByName(spark.createDataFrame([("registrations/odd", "x")], "path string, body string"))))
    assert ("registrations/odd", "unexpected", "path") in lost and (day, "differs", "document") in lost
    assert found(authority_documents.append_violations(prior, batch.limit(0), before, before)) == []


def test_a_shuffled_stream_ends_in_the_batch_states_and_names_what_was_late(spark, tmp_path):
    draw = random.Random(8)
    start = dt.datetime(2026, 1, 1)
    rows = [(k, start + dt.timedelta(minutes=draw.randrange(0, 600)), n, draw.choice(["available", "missing", "missing", "transient", "budget"])) for n, k in enumerate(draw.randrange(0, 12) for _ in range(240))]
    schema = "key long, at timestamp, seq long, outcome string"
    rows.sort(key=lambda r: r[1] + dt.timedelta(minutes=draw.randrange(0, 120)))
    batches, passed, late, kept = [rows[k : k + 40] for k in range(0, 240, 40)], None, set(), []
    for batch in batches:
        late |= {r[2] for r in batch if passed is not None and r[1] <= passed}
        kept += [r for r in batch if passed is None or r[1] > passed]
        passed = max(passed or start, max(r[1] for r in batch) - dt.timedelta(minutes=45))
    assert 5 < len(late) < 100
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        ordered.observe(source, str(tmp_path / "out"), str(tmp_path / "ck"), 45 * 60, 1)
    # A batch that comes again changes nothing.
    before = store.head(spark, str(tmp_path / "out"))
    ordered.advance(spark.createDataFrame(batches[2], schema), 2, str(tmp_path / "out"), 45 * 60, 1)
    assert store.head(spark, str(tmp_path / "out")) == before
    assert {r.seq for r in ordered.late(spark, str(tmp_path / "out")).collect()} == late
    want = {tuple(r) for r in availability.states(spark.createDataFrame(kept, schema)).collect()}
    assert {tuple(r) for r in ordered.settled(spark, str(tmp_path / "out")).collect()} == want


def test_batches_open_as_many_files_of_keys_however_many_there_were(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(observe, "COMPACT", 3)
    read, opened = store.read, []

    def counted(spark, root, surface, keys=None, at=None):
        rows = read(spark, root, surface, keys, at)
        if keys is not None:
            opened.append(len(rows.inputFiles()))
        return rows

    monkeypatch.setattr(store, "read", counted)
    for n in range(9):
        spark.createDataFrame([("always",), (f"own{n}",)], "id string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        observe.ingest(spark.readStream.schema("id string").parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), ["id"], 1)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(["always", *[f"own{n}" for n in range(9)]])
    assert len(opened) == 8 and max(opened) <= 2 * 4


def test_a_bundle_of_many_files_has_the_digest_of_its_parts(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") < 29_990, "large").otherwise("small").alias("bundle"), F.concat(F.lit("d/"), F.col("id").cast("string")).alias("path"))
    got = {r.bundle: (r.files, r.digest) for r in attest.bundle_digests(rows, "bundle", F.col("path"), 100).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for name, ids in (("large", range(29_990)), ("small", range(29_990, 30_000))):
        parts = {}
        for path in sorted(f"d/{k}" for k in ids):
            parts.setdefault(sha(path)[:3], []).append(path)
        assert attest.listing_width(29_990, 100) == 3 and got[name] == (len(ids), sha("".join(sha(",".join(parts[g])) for g in sorted(parts))))
