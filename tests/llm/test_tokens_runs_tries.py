"""Words by a table, runs and tries of conversations against brute force, and their defined cases."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import periodic_runs, prefix_trie, queries, word_bpe

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORDS)
    own.no_padding()
    own.no_truncation()
    return own


def by_doc(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, repr(r)))


# Words by a table

ODD = ["́", "가", "ᅡ", "<|endoftext|>", "<|startoftext|>", "<|", "Ᲊ", "日", "\U0001f600", " ", "\u0085", "½", "²", "क", "ि", "re", "'ll", "K", "ǰ", "𑎎"]


@pytest.mark.parametrize("known", [word_bpe.KNOWN, 15, 0])
def test_ids_and_texts_are_those_of_the_library(spark, library, known):
    draw = random.Random(3)
    signs = [*"abcSTdm'' \n\tEeLlvVr09.!?,ÀéΣÖßİ", *ODD]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(0, 50))) for _ in range(600)]
    texts += [None, "", "   ", "don't can't we'll''s's 's", "<|endoftext|>", "ab " * 5000 + "x" * 3000]
    rows = [(k if k % 7 else None, t) for k, t in enumerate(texts)] + [(5, texts[5])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("own")).withColumn("ids", F.lit(0)).repartition(3)
    got = word_bpe.decode(word_bpe.encode(docs, WORDS, known), WORDS).collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert by_doc((r["doc_id"], r["ids"], r["text"]) for r in got) == by_doc(want)


def test_each_distinct_word_is_encoded_once_and_counted_everywhere(spark):
    docs = spark.createDataFrame([(1, "One two, two THREE"), (2, "two"), (3, None)], "doc_id long, text string").repartition(3)
    table = word_bpe.encoded_words(word_bpe.word_counts(docs, WORDS), WORDS)
    assert {r["word"]: r["n"] for r in table.collect()} == {"one": 1, "two": 3, ",": 1, "three": 1}


def test_long_texts_are_split_in_parts_without_a_trace(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "STRETCH", 40)
    text = " ".join(f"w{k}'s x{k % 3}!" for k in range(200))
    split = word_bpe.splitter(WORDS)
    words = [word(k) for keys, _, word in split.split([text, "", text]) for k in range(len(keys))]
    assert [i for w in words for i in split.ids(w)] == library.encode(text, add_special_tokens=False).ids * 2


def test_no_documents_have_no_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert word_bpe.decode(word_bpe.encode(empty, WORDS), WORDS).count() == 0


def test_query_of_words_gives_the_digests_of_the_library(spark, sf, library):
    got = {r["doc_id"]: r for r in queries.op12_word_bpe(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        own = got.pop(row["doc_id"])
        assert (own["n_tokens"], own["ids_sha256"], own["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert not got


# Runs


def runs_by_trial(words, least, times):
    """Every period at every place."""
    found = {}
    for p in range(1, len(words) // times + 1):
        at = 0
        while at + p < len(words):
            end = at
            while end + p < len(words) and words[end] == words[end + p]:
                end += 1
            if end > at and end + p - at >= max(least, times * p):
                found.setdefault((at, end + p), p)
            at = max(end, at + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "times"), [(24, 3), (9, 3), (12, 4)])
def test_runs_are_those_of_a_trial_of_every_period(least, times):
    draw, some = random.Random(least * times), 0
    for _ in range(500):
        k, words = draw.choice([1, 2, 3, 5, 50]), []
        for _ in range(draw.randrange(0, 6)):
            words += [draw.randrange(k) for _ in range(draw.randrange(1, 14))] * draw.randrange(1, 9)
            words = words[: max(0, len(words) - draw.randrange(0, 4))]
        want = runs_by_trial(words, least, times)
        some += bool(want)
        assert periodic_runs.runs(np.array(words, np.int64), least, times) == want
    assert some > 50


def test_long_lists_of_places_stay_in_order(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK", 8)
    for period in (1, 5, 40):
        words = [k % period for k in range(700)]
        assert periodic_runs.runs(np.array([9, *words, 8], np.int64) + 1) == [(1, 700, period)]


def test_collapsed_text_keeps_the_first_period(spark):
    text = "start " + "a b c " * 9 + "end\tand\n" + "x " * 30 + "z"
    rows = [(1, text, "own"), (1, text, "own"), (2, None, None), (3, " \n\t", "s"), (None, "one  two", "s"), (4, "é é " * 24, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("extra.one", F.lit(1))
    got = by_doc((r["doc_id"], r["text"], [tuple(x) for x in r["runs"]], r["extra.one"]) for r in periodic_runs.collapse(docs).collect())
    short = (1, "start a b c end and x z", [(1, 27, 3), (30, 30, 1)], 1)
    assert got == by_doc([short, short, (2, "", [], 1), (3, "", [], 1), (None, "one two", [], 1), (4, "é é", [(0, 24, 1)], 1)])
    assert periodic_runs.collapse(docs.limit(0)).count() == 0


def test_strongest_run_is_found_exactly_and_ties_go_to_the_first(spark):
    big = 3_000_000_000
    row = spark.range(1).select(F.expr(f"array(named_struct('start', 5L, 'length', 30L, 'period', 10L), named_struct('start', 7L, 'length', 3L, 'period', 1L), named_struct('start', 9L, 'length', {3 * big + 1}L, 'period', {big}L))").alias("r"))
    assert tuple(row.select(periodic_runs.strongest(F.col("r")).alias("b")).first()["b"]) == (9, 3 * big + 1, big)
    assert row.select(periodic_runs.strongest(F.slice("r", 1, 2)).alias("b")).first()["b"]["start"] == 5
    assert row.select(periodic_runs.strongest(F.slice("r", 1, 0)).alias("b")).first()["b"] is None


# Tries of conversations


def trie_by_trial(conversations):
    """Every beginning of every conversation, from {conv_id: [(id, size)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv_id, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv_id)
        ends[tuple(turns)].append(conv_id)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (node[-1][1] if node else 0)
        sums[node] = sum(sums[c][0] for c in children[node]) or 1, own + sum(sums[c][1] for c in children[node])
    return sorted(
        (members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), *sums[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members
    )


def digits(k):
    """Ids that share beginnings inside a turn as well."""
    return f"{k:032x}" if k % 3 else f"{k << 100:032x}"


@pytest.mark.parametrize("range_turns", [7, 60, 10**9])
def test_nodes_are_those_of_all_beginnings(spark, range_turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    draw = random.Random(range_turns)
    for wide in (False, True):
        conversations = {}
        for c in range(300):
            turns = [(digits(k), k % 17) for k in (draw.randrange(1, 400 if wide else 4) for _ in range(draw.randrange(0, 6)))]
            conversations[c * 3 - 5] = turns
        for c in range(2000, 2100):  # one conversation in many copies, one first turn before many, and a deep path
            conversations[c] = [(digits(2), 2), (digits(1), 1)]
            conversations[c + 500] = [(digits(2), 2), (digits(1), 1), (digits(c), 3)]
        for c in range(4):
            conversations[5000 + c] = [(digits(5 + k % 2), 5 + k % 2) for k in range(40 + c)]
        rows = spark.createDataFrame(list(conversations.items()), "conv_id long, turns array<struct<id string, size int>>")
        got = sorted(tuple(r) for r in prefix_trie.trie(rows, range_turns).collect())
        assert got == trie_by_trial(conversations)


def test_layouts_of_nodes_grow_and_keep_their_bytes():
    for n in (3, 4, 5, 16, 17, 48, 49, 256):
        keys = [bytes([b]) for b in random.Random(n).sample(range(256), n)]
        root = prefix_trie.inserted(None, b"", "root")
        for key in keys:
            prefix_trie.inserted(root, key, key)
        layout = root.below
        assert isinstance(layout, prefix_trie._Few if n <= 16 else prefix_trie._Indexed if n <= 48 else prefix_trie._Full)
        assert n > 16 or layout.room == (4 if n <= 4 else 16)
        assert [node.held for node in layout] == sorted(keys) and all(layout.get(k[0]).held == k for k in keys)


def test_turns_are_in_order_and_their_gaps_are_filled(spark):
    rows = [(1, 2, "b", "x"), (1, None, "a", "y"), (1, 1, None, None), (1, 1, "a", "é"), (1, 1, "a", "é"), (None, 1, "a", "z"), (2, 1, "", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(0))
    got = {r["conv_id"]: [t["size"] for t in r["turns"]] for r in prefix_trie.turns(table).collect()}
    assert got == {1: [1, 0, 2, 2, 1], 2: [0]}
    nodes = prefix_trie.trie(prefix_trie.turns(table)).collect()
    assert sorted((r["conv_id"], r["depth"]) for r in nodes) == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1)]
    assert prefix_trie.trie(prefix_trie.turns(table.limit(0))).count() == 0


def test_role_and_text_are_kept_apart(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "abc"), ("1:a", "bc")], "role string, text string")
    assert rows.select(prefix_trie.turn_id(F.col("role"), F.col("text"))).distinct().count() == 4
