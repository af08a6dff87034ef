"""Single operators: exact results on small tables, one broken row per rule, histories, streams."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import keys, text
from ledgerline.operators import attest, availability, contracts, diff, incremental, lookups, migrate, ordering, pages, rules, search, select, shapes
from ledgerline.sources import readers, store
from ledgerline.streaming import observe


def col(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_fold_matches_unicode_normal_form(spark):
    samples = ["Erdős", "Kähler", "Poincaré", "ﬁn", "x²", "ß", "한글", "½", "ÀÉ́", "plain", "", "𝔄b"]
    rows = spark.createDataFrame([(s,) for s in samples], "x string")
    wide = text.needs_wide_fold(F.col("x"))
    got = {r.x: (r.w or r.n) if r.wide else r.n for r in rows.select("x", wide.alias("wide"), text.fold(F.col("x")).alias("n"), text.wide_fold(F.col("x")).alias("w")).collect()}
    assert got == {s: text.fold_text(s) for s in samples}


def test_words_drop_short_long_and_common_ones(spark):
    assert col(spark, ["the a ab abc " + "x" * 33 + " abc ab-cd"], lambda c: text.words(c)) == [["ab", "abc", "cd"]]


def test_paths(spark):
    good = ["a", "a/b.c", "a b/c"]
    bad = ["", "/a", "a//b", "a/", "../a", "a/../b", "./a", "c:/x", "a\\b", "a?b", "a#b", "a\tb", None]
    assert col(spark, good, keys.safe_relative_path) == [True] * 3
    assert col(spark, bad, keys.safe_relative_path) == [False] * len(bad)
    assert col(spark, ["."], lambda c: keys.safe_relative_path(c, allow_dot=True)) == [True]


def test_object_classes(spark):
    # How public paths are classed.
    classes = {
        "/entries/REC-2026-08-07-383237-v1.json": "immutable", "/renders/REC-2026-08-07-383237-v1/0/x.html": "immutable", "/evidence/x/review.json": "immutable",
        "/feed.xml": "stable", "/recent.json": "stable", "/recent-renders.json": "stable", "/source-availability.json": "stable", "/source-availability-targets.json": "stable",
        "/feeds/brand/a.xml": "stable", "/versions/x.json": "stable", "/registration-identities/0.json": "stable", "/repositories/a/b.json": "stable",
        "/browse/2026.json": "stable", "/search/stopwords.json": "stable", "/subjects/a/b.json": "stable", "/tombstones/x.json": "stable",
        "/schema-v3.json": "snapshot", "/LICENSE": "snapshot", "/release-delta.json": "snapshot", "/entries": "snapshot", "/entriesfoo/x.json": "snapshot",
        "/recent.json.bak": "snapshot", "/feedsomething": "snapshot", "/browsesomething": "snapshot", "/": "snapshot", "/nothing/like/this": "snapshot",
    }
    assert col(spark, list(classes), keys.object_class) == list(classes.values())


def test_dependency_rank(spark):
    ranks = {"browse/2026.json": 1, "subjects/a/b/2026.json": 1, "search/t/ring/2026.json": 0, "browse/index.json": 2, "subjects/a/b.json": 2, "search/t/ring/head.json": 2, "public/browse/2026.json": 1, "snapshots/x/browse/2026.json": 0}
    assert col(spark, list(ranks), keys.dependency_rank) == list(ranks.values())


def test_identity_digest_keeps_absent_parts_apart(spark):
    rows = spark.createDataFrame([("A/b", None, "c"), ("a/b", "", "c"), ("a/b", "c", "")], "r string, p string, c string")
    got = [r[0] for r in rows.select(keys.identity_digest(F.col("r"), F.col("p"), F.col("c"))).collect()]
    assert got[0] == got[1] == hashlib.sha256(b"a/b\0\0c").hexdigest() != got[2]


def test_coordinate_of_another_shape_is_an_error(spark):
    assert col(spark, ["REC-2026-01-02-000005", "REC-2026-1-2-5", None], lambda c: keys.coordinate(c, "REC", 4)["page"]) == [2, None, None]
    with pytest.raises(Exception, match="not an identifier"):
        col(spark, ["nonsense"], lambda c: keys.strict_coordinate(c, "REC"))


def test_root_is_the_sum_of_digests(spark):
    files = [(f"p{i}", i * 7, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(200)]
    field = lambda b: len(b).to_bytes(8, "big") + b
    digest = lambda p, n, h: int.from_bytes(hashlib.sha256(field(p.encode()) + field(str(n).encode()) + field(h.encode())).digest(), "big")
    inv = spark.createDataFrame(files, "path string, bytes long, sha256 string")
    root = lambda fs: f"{sum(digest(*f) for f in fs) % 2**256:064x}"
    assert attest.multiset_root(inv).first().record_root == root(files)
    assert attest.multiset_root(inv.limit(0)).first().record_root == "0" * 64
    row = spark.createDataFrame([(root(files[:150]), root(files[150:]), root(files[:10]))], "p string, a string, r string")
    assert row.select(attest.root_after(F.col("p"), F.col("a"), F.col("r"))).first()[0] == root(files[10:])


def test_tree_hash(spark):
    files = [("b", 'x"y', 2, "22"), ("b", "a", 1, "11")]
    got = attest.tree_hashes(spark.createDataFrame(files, "bundle string, path string, bytes long, sha256 string"), "bundle").first()
    canonical = json.dumps([{"bytes": 1, "path": "a", "sha256": "11"}, {"bytes": 2, "path": 'x"y', "sha256": "22"}], separators=(",", ":"))
    assert got.tree_sha256 == hashlib.sha256(canonical.encode()).hexdigest()


@pytest.mark.parametrize(
    ("old", "new", "rule"),
    [(None, "100644", None), (None, "120000", "not ordinary"), ("100644", None, "deleted"), ("100644", "100755", "not ordinary"), ("100755", "100644", "mode")],
)
def test_append_only_modes(spark, old, new, rule):
    schema = "path string, sha256 string, bytes long, mode string"
    side = lambda m: spark.createDataFrame([("entries/x", "s", 1, m)] if m else [], schema)
    changes = diff.inventory_diff(side(old), side(new))
    assert [r.rule for r in diff.append_only(changes, ("entries/",)).collect()] == ([rule] if rule else [])
    assert diff.append_only(changes, ("entries/",), armed=False).count() == 0


def test_mode_rule_wins_over_content_and_schema_is_frozen(spark):
    schema = "path string, sha256 string, bytes long, mode string"
    base = spark.createDataFrame([("entries/x", "s", 1, "100755"), ("schema", "s", 1, "100644")], schema)
    head = spark.createDataFrame([("entries/x", "t", 1, "100644"), ("schema", "t", 1, "100644")], schema)
    got = {r.path: r.rule for r in diff.append_only(diff.inventory_diff(base, head), ("entries/",), schema_path="schema").collect()}
    assert got == {"entries/x": "mode", "schema": "schema"}


def test_seeded_groups_stay(spark):
    ever = spark.createDataFrame([("REC-2026-01-02-000001", 1), ("REC-2026-01-02-000201", 1)], "id string, version long")
    got = {(r.page, r.results, r.versions) for r in pages.pages(ever, ever.limit(1), "REC").collect()}
    assert got == {(1, 1, 1), (2, 0, 0)}
    day = pages.days(pages.pages(ever, ever.limit(1), "REC")).first()
    assert (day.first_page, day.last_page, day.results) == (1, 2, 1)


def test_withdrawing_the_newest_version_brings_back_the_one_before(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, version long")
    down = spark.createDataFrame([("a", 2), ("b", 1)], "id string, version long")
    assert [tuple(r) for r in select.latest_versions(select.active(rows, down)).collect()] == [("a", 1)]


def prior(spark, id_, many):
    return spark.createDataFrame([("d", id_, many, ["c0"])], "digest string, id string, ambiguous boolean, commits array<string>")


@pytest.mark.parametrize(
    ("was", "many", "added", "updated", "want"),
    [
        ("x", False, [], ["x"], ("x", False, False)), ("x", False, [], ["y"], ("x", False, True)), (None, True, ["z"], ["z"], (None, True, False)),
        (None, False, ["z"], ["z"], ("z", False, False)), ("x", False, ["x"], ["x"], (None, True, True)), ("x", False, ["y"], ["y"], (None, True, False)),
        (None, False, ["y", "z"], ["y", "z"], (None, True, False)), (None, False, [], ["y"], (None, False, True)),
    ],
)
def test_lookup_transition(spark, was, many, added, updated, want):
    add = spark.createDataFrame([("d", i) for i in added], "digest string, id string")
    upd = spark.createDataFrame([("d", i, f"c{i}") for i in updated], "digest string, id string, commit_sha string")
    got = lookups.patched_identities(prior(spark, was, many), add, upd).first()
    assert (got.id, got.ambiguous, got.recompute) == want
    assert got.commits == sorted({"c0", *(f"c{i}" for i in updated)})


def at(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(seconds=n)


HISTORIES = [["available"], ["missing"], ["missing", "missing"], ["available", "missing"], ["available", "missing", "transient", "missing"], ["budget"], ["budget", "budget", "transient"], ["missing", "available", "missing"], ["transient"], ["available", "budget"], ["missing", "missing", "missing", "transient"]]


def test_states_by_aggregation_are_those_of_the_transitions(spark):
    rows = [(k, at(n), n, o) for k, h in enumerate(HISTORIES) for n, o in enumerate(h)]
    got = {r.key: (r.status, r.checked_at, r.last_attempt_at, r.streak, r.last_error) for r in availability.states(spark.createDataFrame(rows, "key long, at timestamp, seq long, outcome string")).collect()}
    for k, h in enumerate(HISTORIES):
        state = None
        for n, o in enumerate(h):
            state = observe.step(state, at(n), o)
        assert got[k] == state, h


def test_freshness_and_cycle(spark):
    state = spark.createDataFrame([(1, "available", at(0), 0, None), (2, "missing", at(64_800 + 400), 2, "e"), (3, "available", None, 0, None)], "key long, status string, checked_at timestamp, streak long, last_error string")
    got = {r.key: (r.status, r.last_error) for r in availability.expired(state, F.lit(at(64_801))).collect()}
    assert got == {1: ("unknown", availability.STALE), 2: ("unknown", "e"), 3: ("unknown", availability.STALE)}
    cycle = availability.refresh_cycle(spark.range(10).withColumnRenamed("id", "key"), 3).first()
    assert (cycle.runs, cycle.hours, cycle.holds) == (4, 24, False)
    assert availability.refresh_cycle(spark.range(10).withColumnRenamed("id", "key"), 0).first().runs is None


def test_stream_of_observations_ends_in_the_batch_states(spark, tmp_path):
    rows = [(k, at(n), n, o) for k, h in enumerate(HISTORIES) for n, o in enumerate(h)]
    schema = "key long, at timestamp, seq long, outcome string"
    for part in range(4):
        spark.createDataFrame([r for r in rows if r[2] == part], schema).write.mode("append").parquet(str(tmp_path / "in"))
    seen = {}

    def keep(batch, _):
        for r in batch.collect():
            seen[r.key] = (r.status, r.checked_at, r.last_attempt_at, r.streak, r.last_error)

    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    observe.observe(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    batch = {r.key: (r.status, r.checked_at, r.last_attempt_at, r.streak, r.last_error) for r in availability.states(spark.createDataFrame(rows, schema)).collect()}
    assert seen == batch


def test_ingested_batches_are_written_once(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "id string, version long").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema("id string, version long").parquet(str(tmp_path / "in"))
        observe.ingest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["id", "version"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_a_key_of_a_later_batch_is_not_ingested_again(spark, tmp_path):
    for rows in ([("a", 1), ("b", 1)], [("a", 1), ("c", 1)], [("c", 1)]):
        spark.createDataFrame(rows, "id string, version long").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id string, version long").parquet(str(tmp_path / "in"))
        observe.ingest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["id", "version"])
    assert sorted((r.id, r.batch) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 0), ("b", 0), ("c", 1)]


def test_a_release_catches_up_from_the_served_one(spark, tmp_path):
    path, rows = str(tmp_path), lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert observe.release(spark, rows("a"), path, ["id"]) == 1
    # A release that broke off after its rows, and a batch that was never released.
    rows("a", "x").withColumn("release", F.lit(2)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release").parquet(f"{path}/rows")
    assert [r.id for r in observe.served(spark, path).collect()] == ["a"]
    assert observe.release(spark, rows("a", "b", "c"), path, ["id"]) == 2
    assert sorted((r.id, r.release) for r in observe.served(spark, path).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_a_timer_makes_old_states_unknown(spark, tmp_path):
    schema, late = "key long, at timestamp, seq long, outcome string", 3 * 86_400
    seen = []
    for rows in ([(1, at(0), 1, "available")], [(2, at(late), 2, "missing")], [(2, at(late + 900), 3, "missing")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        observe.observe(stream).writeStream.outputMode("update").foreachBatch(lambda b, _: seen.extend((r.key, r.status, r.last_error) for r in b.collect())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert (1, "unknown", availability.STALE) in seen and seen[0] == (1, "available", None) and (2, "missing", None) in seen


def test_media_types_are_those_of_the_standard_table(spark):
    names = ["a.json", "x/a.xml", "LICENSE", "b.md", "c.gif", "c.svg", "c.jpeg", "c.webp", "c.woff2", "c.js", "c.PNG", "c.tar.gz", "c", ".gif", "a.b/c", "c.unheard"]
    want = ["application/json; charset=utf-8", "application/rss+xml; charset=utf-8", "text/plain; charset=utf-8", "text/plain; charset=utf-8", "image/gif", "image/svg+xml", "image/jpeg", "image/webp", "font/woff2", "text/javascript; charset=utf-8", "image/png", "application/x-tar", *["application/octet-stream"] * 4]
    assert col(spark, names, keys.content_type) == want


def test_places_in_one_order(spark):
    rows = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = ordering.numbered(rows, F.col("k"), ranges=7)
    assert [r.k for r in got.orderBy("place").collect()] == sorted(r.k for r in rows.collect()) and {r.place for r in got.collect()} == set(range(1, 501))
    assert ordering.numbered(rows.limit(0), F.col("k")).count() == 0


def found(rows):
    return {(r.entity, r.rule, r.field) for r in rows.collect()}


def test_targets_and_withdrawals_must_be_sorted(spark):
    rows = spark.createDataFrame([(0, "B/x", "1" * 40, "f"), (1, "a/x", "1" * 40, "f"), (2, "A/X", "1" * 40, "F"), (3, "c/x", "short", "f")], "position long, source_repository string, commit string, fork_repository string")
    assert found(contracts.target_contract(rows)) == {("a/x", "order", "position"), ("A/X", "order", "position"), ("c/x", "pattern", "commit")}
    rows = spark.createDataFrame([(0, "a", 2, 5), (1, "a", 1, 6), (2, "b", 1, 5)], "position long, id string, version long, issue long")
    assert found(contracts.takedown_order(rows)) == {("a-v1", "order", "position"), ("5", "unique", "issue")}


def test_lookups_rows_and_node_caps(spark):
    one = "REC-2026-01-02-00000"
    rows = spark.createDataFrame([("good", 2, False, [f"{one}2", f"{one}1"]), ("cut", 9, True, [f"{one}3", f"{one}2", f"{one}1"]), ("short", 9, True, [f"{one}1"]), ("silent", 9, False, [f"{one}1"]), ("turned", 2, False, [f"{one}1", f"{one}2"])], "repository string, total long, truncated boolean, ids array<string>")
    assert found(contracts.lookup_contract(rows, "REC", 3)) == {("short", "truncated", "truncated"), ("silent", "truncated", "truncated"), ("turned", "order", "ids")}
    placed = spark.createDataFrame([("2026-01-02", 1, f"{one}1", 1, "t", "s", f"entries/{one}1-v1.json"), ("2026-01-02", 2, f"{one}2", 1, "t", "s", "entries/x")], "day string, page long, id string, version long, title string, status string, path string")
    assert found(contracts.page_contract(placed, "REC", 200)) == {(f"{one}2", "path", "path"), (f"{one}2", "place", "page")}
    # Nine files of one bundle in three folders, two of them in another: twelve nodes.
    files = spark.createDataFrame([(f"b/{'x' if k % 2 else 'y/z'}/{k}",) for k in range(9)], "path string")
    assert contracts.node_cap(files, spark.range(2), 6).count() == 0 and contracts.node_cap(files, spark.range(1), 11).count() == 1


def test_both_lists_or_neither(spark, tmp_path):
    lists = spark.createDataFrame([("a",)], "id string")
    bad = spark.createDataFrame([("a", "order", "position")], "entity string, rule string, field string")
    with pytest.raises(ValueError, match="a: order position"):
        contracts.write_recent(lists, lists, bad.limit(0), bad, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    contracts.write_recent(lists, lists, bad.limit(0), bad.limit(0), str(tmp_path / "out"))
    assert [store.read(spark, str(tmp_path / "out"), s).count() for s in (contracts.RECENT, contracts.RENDERS)] == [1, 1]


def test_scripts_of_a_bundle_and_an_empty_one(spark):
    files = spark.createDataFrame([(1, "a.js", 1, "11"), (1, "x.js", 1, "22"), (1, "artifact-manifest.json", 1, "33")], "bundle long, path string, bytes long, sha256 string")
    tree = attest.tree_hashes(files.where("path like '%.js'"), "bundle").select("bundle", "tree_sha256")
    empty = spark.createDataFrame([(2, hashlib.sha256(b"[]").hexdigest())], "bundle long, tree_sha256 string")
    got = found(contracts.bundle_contract(tree.unionByName(empty), files, files.where("path like '%.js'"), (".js",), trusted={"a.js": ["11"], "b.js": ["44"]}))
    assert got == {("1/x.js", "script", "path"), ("1/b.js", "missing", "script"), ("2/a.js", "missing", "script"), ("2/b.js", "missing", "script")}


def test_dates_keys_and_served_rows(spark):
    one, two = "REC-2026-01-02-000001", "REC-2026-01-03-000001"
    schema = "id string, version long, registered_at string, first_registered_on string, file string"
    rows = [(one, 1, "2026-01-02T10:00:00Z", "2026-01-02", f"{one}-v1.json"), (one, 2, "2026-01-01T10:00:00Z", "2026-01-02", f"{one}-v3.json"), (two, 2, "2026-01-03", "2026-01-04", f"{two}-v2.json")]
    frame = spark.createDataFrame(rows, schema)
    entity = F.concat_ws("-v", "id", F.col("version").cast("string"))
    assert found(contracts.date_contract(frame, entity)) == {(f"{one}-v2", "before first", "registered_at"), (f"{two}-v2", "first version", "id"), (f"{two}-v2", "before first", "registered_at"), (f"{two}-v2", "instant", "registered_at")}
    assert found(rules.validate(frame, entity, shapes.key_rules("REC"))) == {(f"{one}-v2", "file name", "file"), (f"{two}-v2", "first day", "id")}
    side = lambda **x: spark.createDataFrame([(k, v, "same") for k, v in x.items()], "k string, v string, w string")
    assert found(contracts.served_rows(side(a="1", b="2", c="3"), side(a="1", b="x", d="4"), ["k"], ["v", "w"], F.col("k"))) == {("b", "differs", "v"), ("c", "unknown", "row"), ("d", "absent", "row")}
    assert found(contracts.touched_rows(side(a="1", b="2", c="3"), side(a="x", b="y", d="4"), side(a="", d="").select("k"), ["k"], F.col("k"))) == {("b", "untouched", "row"), ("c", "removed", "row")}


def test_shapes_of_authority_documents_and_scores(spark):
    docs = spark.createDataFrame([("good", '{"schema_version":1,"date":"d","last_serial":2}'), ("extra", '{"schema_version":1,"date":"d","last_serial":2,"x":1}'), ("short", '{"schema_version":1,"date":"d"}'), ("twice", '{"schema_version":1,"date":"d","last_serial":2,"date":"e"}')], "entity string, body string")
    got = {(r.entity, r.rule) for r in contracts.authority_shapes(docs, "day", shapes.AUTHORITY_KEYS["day"]).collect()}
    assert {("extra", "extra"), ("short", "missing"), ("twice", "json")} <= got and not any(e == "good" for e, _ in got)
    marks = "scores struct<statement_alignment:int,definition_fidelity:int,notability:int,literature:int,clarity:int>"
    rows = spark.createDataFrame([(1, "REC-2026-01-02-000001", 1, "2026-01-02T10:00:00Z", "1" * 40, (1, 2, 3, 4, 5)), (1, "x", 1, "2026-01-02T10:00:00Z", "1" * 40, (1, None, 3, 4, -5))], f"schema_version int, id string, version long, reviewed_at string, policy_commit string, {marks}")
    assert found(rules.validate(rows, F.col("id"), shapes.rules_of(shapes.score_shape("REC")))) == {("x", "pattern", "id"), ("x", "required", "scores.definition_fidelity"), ("x", "minimum", "scores.clarity")}


def test_history_of_modes(spark):
    rows = [(0, "entries/a", "1", 1, "100644"), (1, "entries/a", "1", 1, "100755"), (1, "entries/b", "2", 1, "120000"), (2, "entries/b", "3", 1, "120000")]
    states = spark.createDataFrame(rows, "seq int, path string, sha256 string, bytes long, mode string")
    assert {tuple(r) for r in diff.history_violations(states, ("entries/",)).collect()} == {(1, "entries/a", "not ordinary"), (1, "entries/b", "not ordinary"), (2, "entries/a", "deleted"), (2, "entries/b", "content")}


def test_dependencies_and_preservation_of_a_record(spark):
    dep = "array<struct<name:string,repository:string,revision:string,path:string>>"
    schema = f"id string, version long, source struct<repository:string,commit:string>, provenance struct<substantive_formalization:struct<repository:string,commit:string>>, formalization struct<project_dependencies:{dep}>, trust struct<level:string,challenge_dependencies:array<struct<repository:string,provenance:string>>>, preservation struct<repositories:array<struct<source_repository:string,commit:string,fork_repository:string,ref:string>>>"
    kept = lambda *pairs: ([(r, c, "keep/x", f"refs/{i}-v1/{c}") for i, r, c in pairs],)

    def record(i, deps=(("d", "Dep/A", "2", None),), asked=(("new/a", "allowlisted"),), level="qualified", mapped=None):
        mapped = mapped or kept((i, "Dep/A", "2"), (i, "own/r", "1"))
        return i, 1, ("own/r", "1"), (None,), (list(deps),), (level, list(asked)), mapped

    rows = [
        record("good"), record("twice", deps=[("d", "Dep/A", "2", None), ("d", None, None, "."), ("e", None, None, ".")]), record("unknown", asked=[("other/b", "allowlisted")]), record("high", level="high"),
        record("retired", asked=[("dep/a", "indexed")]), record("short", mapped=kept(("short", "own/r", "1"))), record("turned", mapped=kept(("turned", "own/r", "1"), ("turned", "Dep/A", "2"))), record("ref", mapped=kept(("x", "Dep/A", "2"), ("x", "own/r", "1"))),
    ]
    own = [*shapes.dependency_rules(("safe/s",), {"new/a": "dep/a"}), *shapes.preservation_rules("keep", "refs/")]
    got = found(rules.validate(spark.createDataFrame(rows, schema), F.col("id"), own))
    d, p = "formalization.project_dependencies", "preservation.repositories"
    assert got == {("twice", "unique", f"{d}.name"), ("twice", "unique", f"{d}.path"), ("unknown", "known", "trust.challenge_dependencies.repository"), ("high", "trust", "trust.level"), ("retired", "retired", "trust.challenge_dependencies.provenance"), ("short", "cover", p), ("turned", "cover", p), ("ref", "ref", f"{p}.ref")}


def test_cost_of_one_append_does_not_grow_with_the_table(spark):
    def touched(n):
        ever = spark.range(1, n + 1).select(F.format_string("REC-2026-01-02-%06d", "id").alias("id"), F.lit(1).cast("long").alias("version"))
        batch = spark.createDataFrame([(f"REC-2026-01-03-{1:06d}", 1)], "id string, version long")
        groups = {"page": keys.coordinate(F.col("id"), "REC")["day"], "year": keys.coordinate(F.col("id"), "REC")["year"]}
        prior = pages.pages(ever, ever, "REC")
        whole = ever.unionByName(batch)
        patched = incremental.patched_pages(prior, whole, whole, batch, "REC", 200)
        assert incremental.unequal(patched, pages.pages(whole, whole, "REC")).count() == 0
        return incremental.touched(batch, groups).count()

    assert touched(11) == touched(91) == 2


def test_postings_append_and_removal(spark):
    rows = spark.createDataFrame([(f"D-{i:04d}", "t") for i in range(300)], "name string, term string")
    first, second = rows.where("name < 'D-0200'"), rows.where("name >= 'D-0200'")
    added = search.appended(search.heads(first), second, "name")
    assert search.postings(first, "name").unionByName(added).exceptAll(search.postings(rows, "name")).count() == 0
    gone = spark.createDataFrame([("D-0000",)], "name string")
    closed = search.removed(rows, gone, "name")
    assert closed.where("name = 'D-0001'").first()["rank"] == 0 and closed.count() == 299


@pytest.mark.parametrize(("body", "ok"), [('{"a":1}', True), ('{"a":1,"a":2}', False), ('{"a":{"b":1,"b":2}}', False), ('{"a":NaN}', False), ("[1]", False), ("x", False), (None, False)])
def test_strict_json(spark, body, ok):
    assert col(spark, [body], rules.strict_json) == [ok]


def test_each_rule_finds_its_broken_row(spark):
    rows = spark.createDataFrame([("good", "ab", 5, ["x", "y"]), ("long", "abcdef", 5, ["x"]), ("null", None, 5, ["x"]), ("low", "ab", 0, ["x"]), ("twice", "ab", 5, ["x", "x"])], "e string, s string, n int, a array<string>")
    got = {(r.entity, r.rule) for r in rules.validate(rows, F.col("e"), [rules.required("s"), rules.length("s", 1, 3), rules.at_least("n", 1), rules.distinct_items("a")]).collect()}
    assert got == {("long", "length"), ("null", "required"), ("low", "minimum"), ("twice", "unique")}
    with pytest.raises(Exception, match="minimum: n"):
        rules.refused(rows, [rules.at_least("n", 1)]).collect()


def test_migration_of_text_goes_in_order_and_into_arrays(spark):
    rows = spark.createDataFrame([("before acceptance", ["a", "b"])], "t string, xs array<string>")
    got = migrate.migrate_columns(rows, ["t", "xs"], [("acceptance", "review"), ("before review", "after"), ("a", "b"), ("b", "c")]).first()
    assert (got.t, got.xs) == ("cfter", ["c", "c"])


def test_prefix_containment_works_at_component_ends(spark):
    paths = spark.createDataFrame([("a/b/c",), ("a",), ("a/bc",), ("x",)], "path string")
    roots = spark.createDataFrame([("a/b",)], "path string")
    assert sorted(r.path for r in diff.orphan_paths(paths, roots).collect()) == ["a/bc", "x"]


def test_scope(spark):
    decide = lambda *c: tuple(incremental.scope_decision(spark.createDataFrame(list(c), "path string, status string")).first())
    assert decide(("entries/x", "A"), ("README.md", "M"), ("docs/x", "D")) == ("incremental", None)
    assert decide(("entries/x", "A"), ("tools/x.py", "M"))[1] == "input: tools/x.py"
    assert decide(("entries/x", "M")) == ("full", "not an append: entries/x")
    assert decide((".github/workflows/publish.yml", "M"))[0] == "full" and decide((".github/workflows/publish-other.yml", "M")) == ("incremental", None)
    changed = spark.createDataFrame([("LICENSE", "M"), ("takedowns.json", "M")], "path string, status string")
    assert incremental.scope_decision(changed, validation=True).first().reason == "policy: takedowns.json"


def test_records_are_read_with_their_file_and_what_is_wrong(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n"id": "a", "version": 1}')
    (tmp_path / "b.json").write_text('{"id": "b", "version":')
    rows = {r.file: r for r in readers.read_records(spark, str(tmp_path), "id string, version long").collect()}
    assert rows["a.json"].id == "a" and rows["a.json"].corrupt is None and rows["b.json"].corrupt is not None
    inv = {r.path: (r.bytes, r.sha256) for r in readers.file_inventory(spark, str(tmp_path)).collect()}
    assert inv["a.json"] == (26, hashlib.sha256((tmp_path / "a.json").read_bytes()).hexdigest())


def test_pages_are_written_one_partition_each(spark, tmp_path):
    rows = spark.createDataFrame([("REC-2026-01-02-000001", 1, None), ("REC-2026-01-02-000201", 1, None)], "id string, version long, day date")
    pages.write_pages(rows, str(tmp_path / "p"), "REC")
    assert sorted(p.parent.name for p in (tmp_path / "p").glob("*/*/*.parquet")) == ["page=1", "page=2"]


def test_targets_must_be_distinct(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"source_repository":"A/b","commit":"c","fork_repository":"f"},{"source_repository":"a/B","commit":"c","fork_repository":"f"}]')
    assert readers.repeated_targets(readers.read_targets(spark, str(tmp_path / "t.json"))).count() == 1
    with pytest.raises(ValueError, match="version"):
        readers.require_columns(spark.range(1), {"id": "bigint", "version": "bigint"})


def test_a_recent_list_is_refilled_after_a_withdrawal(spark):
    rows = lambda days: spark.createDataFrame([(f"r{k}", d) for k, d in days.items()], "id string, registered_at int")
    before = {k: k for k in range(1, 8)}
    prior = select.recent(rows(before), 3)
    got = lambda batch, now, touched, n=3: [r.id for r in incremental.patched_recent(prior, rows(batch), rows(now), n, rows(touched).select("id")).collect()]
    assert got({}, {k: d for k, d in before.items() if k != 6}, {6: 0}) == ["r7", "r5", "r4"]
    assert got({8: 8}, {k: d for k, d in before.items() if k != 6} | {8: 8}, {6: 0, 8: 0}) == ["r8", "r7", "r5"]
    # A touched id whose current version is older than the list's end.
    assert got({6: 1}, before | {6: 1}, {6: 0}) == ["r7", "r5", "r4"]
    assert got({}, {7: 7, 5: 5}, {6: 0}, n=5) == ["r7", "r5"]
