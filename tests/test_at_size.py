"""What queries shuffle and hold at size, and results that only larger tables show."""

import time
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from ledgerline.operators import contracts, search, stored_postings, surfaces
from ledgerline.plans import catalog
from ledgerline.sources import store


def joined_columns(df):
    """Names of all columns that joins of a plan take in."""
    names = set()

    def walk(node):
        children = node.children()
        for k in range(children.size()):
            child = children.apply(k)
            if node.nodeName() == "Join":
                names.update(child.output().apply(i).name() for i in range(child.output().size()))
            walk(child)

    walk(df._jdf.queryExecution().optimizedPlan())
    return names


def test_replacements_meet_what_is_staged_by_short_digests(spark):
    sha = lambda c: c * 64
    manifest = [("entries/a-v1.json", *map(sha, "0123")), ("entries/b-v1.json", *map(sha, "4567")), ("entries/c/d.json", *map(sha, "89ab"))]
    m = spark.createDataFrame(manifest, "entry string, old_entry_sha256 string, new_entry_sha256 string, new_tree_sha256 string, new_review_sha256 string").withColumns({"old_review_sha256": F.lit(sha("c")), "old_tree_sha256": F.lit(sha("d"))})
    staged = [("entries/a-v1.json", sha("1")), (f"evidence/a-v1/{sha('2')}/review.json", sha("3")), ("entries/b-v1.json", sha("5")), ("entries/b-v1.json", sha("f")), (f"evidence/b-v1/{sha('d')}/run.json", "x"), (f"evidence/b-v1/{sha('6')}/log/review.json", sha("7")), ("entries/c/d.json", sha("9")), ("search/a/head.json", "x")]
    found = contracts.replacement_contract(m, spark.createDataFrame(staged, "path string, sha256 string"))
    # The second staged entry of b is of other bytes; its review is not where it must be; c/d has no tree, and neither has its review.
    want = [("entries/b-v1.json", "not staged", "entry"), ("entries/b-v1.json", "not staged", "review"), ("entries/b-v1.json", "still staged", "tree"), ("entries/c/d.json", "not staged", "review"), ("entries/c/d.json", "not staged", "tree")]
    assert sorted(map(tuple, found.collect())) == want
    assert not {c for c in joined_columns(found) if c.endswith("_sha256") and not c.startswith("_")}


def test_a_word_of_very_many_documents_breaks_no_rule_of_the_sql(spark, tmp_path):
    # One document more than 2,048 pages hold.
    spark.range(2_048 * 128 + 1).select(F.col("id").alias("doc_id"), F.lit("common word").alias("text")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"select rule, field, count(*) from ({catalog.ORACLE_SQL['posting_contract']}) group by all order by all").fetchall()
    got = catalog.QUERIES["posting_contract"](spark, str(tmp_path)).groupBy("rule", "field").count().collect()
    assert sorted(map(tuple, got)) == want


def test_posting_pages_are_held_against_their_contract_without_a_join_of_names(spark):
    heads = spark.createDataFrame([("aa", 128, 1, 3), ("bb", 128, 1, 3), ("cc", 128, 2, 130)], "term string, page_size int, pages long, results long")
    rows = [("aa", 0, 0, "n1"), ("aa", 0, 1, "n3"), ("aa", 0, 2, "n2")]  # the last is out of order
    rows += [("bb", 0, 0, "n1"), ("bb", 0, 0, "n5"), ("bb", 0, 1, "n2")]  # a position twice: the row after it is below one of the two
    rows += [("cc", 0, k, f"n{k:03d}") for k in range(129)] + [("cc", 1, None, "n129")]  # a page too long, and a row without a position
    found = contracts.posting_contract(heads, spark.createDataFrame(rows, "term string, page long, position long, name string"))
    want = [("aa", "order", "position"), ("bb", "order", "position"), ("bb/0/positions", "gap", "position"), ("cc", "cap", "page"), ("cc/1/positions", "gap", "position")]
    assert sorted(map(tuple, found.collect())) == want
    assert "name" not in joined_columns(found)


def test_a_withdrawal_makes_terms_once(spark):
    docs = spark.createDataFrame([(f"DOC-{k:08d}", f"every {'even' if k % 2 == 0 else 'odd'} w{k}") for k in range(300)], "name string, body string")
    rows = search.terms(docs, "name", "body")
    left = search.removed(rows, docs.where("name = 'DOC-00000002'").select("name"), "name")
    names = {t: [f"DOC-{k:08d}" for k in range(300) if k != 2 and (t == "every" or k % 2 == 0)] for t in ("even", "every")}
    assert sorted(map(tuple, left.collect())) == [(t, k // 128, k, n) for t in names for k, n in enumerate(names[t])]
    assert "Generate" not in left._jdf.queryExecution().optimizedPlan().toString()


def test_small_tables_of_a_release_have_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "PART_ROWS", 2)
    rows = [(f"REC-2026-07-28-{k:06d}", 1, datetime(2026, 7, 28), "B", "T", "r", False) for k in range(1, 41)]
    versions = spark.createDataFrame(rows, "id string, version long, registered_at timestamp, brand string, type string, repository string, withdrawn boolean")
    made = surfaces.appended(spark, str(tmp_path), versions, "REC", 20, replace=True)
    # Forty results are dealt to more parts than one day, two pages, two codes and one repository.
    assert {n: t["width"] for n, t in made["tables"].items()} == {"results": 2, "pages": 1, "days": 1, "codes": 1, "repositories": 1}
    assert store.violations(spark, str(tmp_path)) == []


def test_a_release_of_postings_makes_no_page_only_to_count_it(spark, tmp_path, monkeypatch):
    counted = []
    own = type(spark.range(0)).count
    monkeypatch.setattr(type(spark.range(0)), "count", lambda df: counted.append(df.columns) or own(df))
    rows = spark.createDataFrame([("word", f"DOC-{k:08d}") for k in range(300)], "term string, name string")
    stored_postings.appended(spark, str(tmp_path), rows, "name", replace=True)
    assert not [c for c in counted if "names" in c]
    gone = rows.where("name in ('DOC-00000130', 'DOC-00000131')")
    stored_postings.withdrawn(spark, str(tmp_path), gone, "name")
    left = [f"DOC-{k:08d}" for k in range(300) if k not in (130, 131)]
    assert sorted(map(tuple, stored_postings.rows(spark, str(tmp_path)).collect())) == [("word", k // 128, k, n) for k, n in enumerate(left)]


def test_a_release_leaves_no_shuffle_files(spark, tmp_path):
    there = lambda: set(Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data"))
    before = there()
    store.publish(spark, str(tmp_path), {store.Surface("sums", ("k",)): spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))}, replace=True)
    end = time.monotonic() + 20
    while there() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not there() - before
