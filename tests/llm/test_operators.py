"""Every training-data operator against a brute-force version, and over odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, chat_format, dart_minhash, decontaminate, exact_topk, line_dedup, line_index, linking, packing, pii, quality, queries, substring_dedup, textgrams, url_filter
from ledgerline.llm.queries import TOKENIZER
from ledgerline.sources import store

LINE = "This line is long enough to be counted as a key of its own"
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, "a", None, "s", 1), (4, "word " * 60_000, "en", "s", 1), (5, "same text here of five words", "en", "s", 1),
    (6, "same text here of five words", "en", "s", 1), (6, "same text here of five words", "en", "s", 1), (None, "no id at all\n" + LINE, "en", None, 3), (7, "\n\n \t\x0b\n", "en", "s", 5),
    (8, f"{LINE}\n{LINE}\nx", "en", "s", 9), (9, "é😀 ß\u2028\x00 end", "de", "s", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    clash = {"key": 1, "row": 2, "pos": 3, "gone": 4, "doc": 5, "pii": 6, "bands": 7, "id": 8, "rank": 9, "length": 10, "start": 11, "features": 12, "bucket": 13}
    return spark.createDataFrame(ODD, SCHEMA).withColumns({k: F.lit(v) for k, v in clash.items()})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLE_SQL[name])


# Texts


def test_words_are_those_of_split():
    samples = ["a b  c", "", "x", "The the", " a\tb\nc ", "é ß 😀", "w " * 300_000]
    hashes, first, spans = textgrams.words(samples, with_spans=True)
    for k, text in enumerate(samples):
        own = text.lower().encode().split()
        assert first[k + 1] - first[k] == len(own)
        for j in range(0, len(own), 4999):
            a, b = spans[:, first[k] + j]
            assert text.lower().encode()[a:b] == own[j]
            assert hashes[first[k] + j] == textgrams.words([own[j].decode()])[0][0]


def test_ids_are_those_of_the_tokenizer(texts):
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(TOKENIZER)
    bpe.encode_special_tokens = True
    random.seed(1)
    signs = ["a", "b", "'s", "'", "re", "'re", " ", "  ", "\n", "\t", "1", "é", "ß", "２", "½", "!", "%", "'ll", "'d", "\xa0", "中", "😀", "\u0301", "<|endoftext|>", "\x1f", "\x85", "'S", "\r\n"]
    samples = [t or "" for _, t in texts] + ["".join(random.choices(signs, k=random.randint(0, 30))) for _ in range(3000)] + ["ab cd " * 250_000]
    for text, ids in zip(samples, byte_bpe.loaded(TOKENIZER).ids(samples), strict=True):
        assert ids.tolist() == bpe.encode(text, add_special_tokens=False).ids


# 1


def test_layouts_become_the_same_turns(spark):
    records = [
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}],"id":1}',
        '{"prompt":"q","response":"a"}', '{"prompt":"q","completion":"a","id":"x"}', '{"instruction":"q","input":"","output":"a"}', '{"other":1}', "nonsense", None, '{"messages":[]}',
    ]
    rows = spark.createDataFrame([(k, r, "clash") for k, r in enumerate(records)], "id long, raw string, turns string")
    got = chat_format.canonical_turns(rows.drop("turns"), "raw").orderBy("id").collect()
    assert [[(t.role, t.text) for t in r.turns] if r.turns is not None else None for r in got] == [[("user", "q"), ("assistant", "a")]] * 5 + [None] * 3 + [[]]
    assert [r.layout for r in got][5:8] == [None] * 3 and got[5].fingerprint and got[6].fingerprint is None
    assert chat_format.canonical_turns(rows, "raw").columns.count("turns") == 1
    assert chat_format.read_back(chat_format.render(chat_format.canonical_turns(rows.limit(0), "raw")), "id").count() == 0


def test_odd_values_and_nested_layouts(spark):
    records = [
        '{"prompt":5,"response":[]}', '{"messages":["x",{"role":"user","content":"q"}]}', '{"messages":[{"role":"user","content":7}]}', '{"messages":[null,{"role":null,"content":null}]}', '{"messages":[{"role":null,"content":null}]}',
        '{"messages":"x"}', '{"instruction":"a","input":"b","output":null}', '{"request":{"messages":[{"role":"user","content":"q"}]},"response":{"text":"a"}}', "5", '"x"', "[]",
    ]
    rows = spark.createDataFrame([(k, r) for k, r in enumerate(records)], "id long, raw string")
    got = [r.turns and [(t.role, t.text) for t in r.turns] for r in chat_format.canonical_turns(rows, "raw").orderBy("id").collect()]
    assert got == [[("user", "5"), ("assistant", "[]")], None, [("user", "7")], None, [("", "")], None, [("user", "a\nb"), ("assistant", "")], [("user", "q"), ("assistant", "a")], None, None, None]


def test_formatting_is_reversible_and_masks_the_assistant(spark):
    random.seed(2)
    parts = ["\\", "<|turn|>", "<|text|>", "<|end|>", "</s>", "[INST]", "a", "é😀", "\n", "<", "|", "\\\\", ""]
    turns = [[(random.choice(["user", "assistant", "sys<|text|>", ""]), "".join(random.choices(parts, k=random.randint(0, 8)))) for _ in range(random.randint(0, 6))] for _ in range(300)]
    rows = spark.createDataFrame([(k, [{"role": r, "text": t} for r, t in own]) for k, own in enumerate(turns)], f"id long, turns {chat_format.TURNS}")
    for r in chat_format.render(rows).collect():
        assert chat_format.parse(r.formatted) == turns[r.id]
        assert [chat_format.unescape(r.formatted[s.start : s.end]) for s in r.loss_spans] == [t for role, t in turns[r.id] if role == "assistant"]


# 2


def test_top_k_is_that_of_all_scores(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.2, (400, 16)).round(3)
    vectors[50:200] = vectors[50]  # a third are one vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(1000, None), (1001, [None] * 16), (1002, [float("nan")] * 16), (None, [0.0] * 16), (1100, [1.0, 2.0]), (1200, [0.5, 0.5])]
    table = exact_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = collections.defaultdict(list)
    for r in exact_topk.top_k(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    whole = np.floor(1024 * vectors).astype(int)
    for q in (0, 100, 200, 300):
        scores = sorted(((-int(whole[q] @ whole[c]), c) for c in range(400) if c != q))[:10]
        assert got[q] == [(c, -s) for s, c in scores]
    assert [x[0] for x in got[1100]] == [1200]
    assert exact_topk.top_k(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_search_stops_on_proof_and_is_exact():
    rng = np.random.default_rng(12)
    vectors = np.floor(1024 * rng.normal(0, 0.125, (3000, 64))).astype(np.int64)
    ids = np.arange(3000) * 7
    index = exact_topk.ImpactIndex(ids, vectors)
    for q in range(0, 3000, 300):
        found, scores = index.search(vectors[q], ids[q], 10)
        want = sorted((-int(vectors[q] @ v), i) for v, i in zip(vectors, ids.tolist(), strict=True) if i != ids[q])[:10]
        assert list(zip((-scores).tolist(), found.tolist(), strict=True)) == want
        assert index.processed < 0.85 * len(index.dims)


def test_vectors_without_components_and_with_huge_ones(spark):
    rows = spark.createDataFrame([(0, []), (1, []), (100, [4.0e6] * 3), (101, [4.0e5] * 3), (102, [-4.0e5, 1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in exact_topk.top_k(exact_topk.quantised(rows, "vec_id", "embedding"), F.col("vec_id") % 100 == 0, 2).collect())
    q = 1024 * 4 * 10**6
    assert got == [(0, 1, 1, 0), (100, 1, 101, 3 * q * 1024 * 4 * 10**5), (100, 2, 102, q * 1024 * (1 - 4 * 10**5))]


# 3


def brute_pii(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            luhn = sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(reversed(digits))) % 10 == 0
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_is_that_of_the_plain_patterns(spark, texts, odd):
    random.seed(5)
    parts = ["a", "@", ".", "1", "2", "45", " ", "-", "+", "(", ")", "b.c", "4539148803436467", "255", "é", "😀", "_", "\n", "%"]
    made = [(i, "".join(random.choices(parts, k=random.randint(0, 40)))) for i in range(2000)] + texts + [(0, "a" * 2_000 + "@"), (0, "a.b" * 600 + "@c.d"), (0, "1" * 1_000)]
    for rows in (spark.createDataFrame(made, "doc_id long, text string"), odd):
        for r in pii.find(rows).select("text", pii.digest(F.filter("pii", pii.is_base)).alias("x")).collect():
            assert r.x == brute_pii(r.text)


def test_pii_in_very_long_texts(spark):
    rows = spark.createDataFrame([("a" * 300_000 + "@",), ("a.b" * 90_000 + "@c.d",), ("1" * 300_000,), ("@a" + ".a" * 150_000,), ("x@y.z " * 3_000,)], "text string")
    assert [r.n_email for r in pii.find(rows).select(*pii.counts_by_kind(F.col("pii"))).collect()] == [0, 1, 0, 0, 3_000]


def test_iban_needs_its_checksum_and_context_moves_the_score(spark):
    rows = spark.createDataFrame([("pay to iban GB82 WEST 1234 5698 7654 32.",), ("DE89370400440532013000",), ("DE89370400440532013001",), ("call +1 (017) 555-7713",), ("at +1 (017) 555-7713",)], "text string")
    got = [[(s.kind, round(s.score, 1)) for s in r.pii] for r in pii.find(rows).collect()]
    assert got == [[("iban", 1.0)], [("iban", 0.9)], [], [("phone", 0.7)], [("phone", 0.6)]]
    assert pii.redact(rows).collect()[3].redacted == "call [phone]"


# 4


def brute_lines(rows, least=40, docs=5):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(list)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(d)
    owners = {k: {x for x in v if x is not None} for k, v in held.items() if len(k) >= least}
    keeper = {k: max(v) for k, v in owners.items() if len(v) >= docs}
    return sorted((str(d), "\n".join(x for x in (t or "").split("\n") if key(x) not in keeper or keeper[key(x)] == d)) for d, t in rows)


def test_lines_kept_are_those_of_the_definition(spark, odd, none, texts):
    more = [(200 + k % 4, f"{LINE[::-1]}\nagain {k}", "en", "s", 1) for k in range(9)]  # four documents alone
    more += [(100 + k, f"  {LINE.upper() if k % 2 else LINE}\t\nown {k}", "en", "s", 1) for k in range(6)]
    frame = odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(more, SCHEMA)).withColumn("key", F.lit(1))
    for rows in (frame, spark.createDataFrame(texts, "doc_id long, text string")):
        listed = [(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]
        got = sorted((str(r.doc_id), r.kept) for r in line_dedup.dedup_lines(rows).collect())
        assert got == brute_lines(listed)
    assert line_dedup.dedup_lines(none).count() == 0


def _held(index):
    """Each shard's filter, by shard."""
    return {r.shard: line_dedup.CuckooFilter(cells=bytes(r.cells)) for r in index.filters.collect()}


def _may_hold(index, keys):
    held = _held(index)
    return [k.k1 % index.shards in held and bool(held[k.k1 % index.shards].may_hold(np.array([k.k2], np.int64).view(np.uint64))[0]) for k in keys]


def test_a_deletion_undoes_an_insertion(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([(k, f"{LINE}\n{LINE} {k % 2}\n{LINE} own {k}\nx") for k in range(12)] + [(None, LINE)], "doc_id long, text string")
    one, two = docs.where("doc_id < 7"), docs.where("doc_id >= 7 or doc_id is null")
    line_index.build(one, root, digits=1)
    before = line_index.index(spark, root)
    want = sorted(before.references.collect())
    first = line_index.insert(two, root)
    line_index.insert(two, root)
    after = line_index.index(spark, root)
    assert sorted(after.references.collect()) == sorted(line_dedup.references(docs).distinct().collect())
    keys = line_dedup.counts(after.references).orderBy("k1").collect()
    assert len(keys) == 3 and {k.keeper for k in keys} == {10, 11} and all(_may_hold(after, keys))
    told = sorted((r.k1, r.k2, r.n_docs, r.keeper) for r in store.read(spark, root, line_index.COUNTS).where("n_docs >= 5").collect())
    assert told == sorted((k.k1, k.k2, k.n_docs, k.keeper) for k in keys)
    kept = lambda index, rows: sorted((str(r.doc_id), r.kept) for r in line_dedup.dedup_lines(rows, index=index).collect())
    assert kept(after, docs) == kept(None, docs)
    # The documents' texts are not needed to take them away.
    line_index.delete(spark.createDataFrame([(k,) for k in (7, 8, 9, 10, 11, 99)], "doc_id long"), root)
    back = line_index.index(spark, root)
    assert sorted(back.references.collect()) == want
    repeated = {(k.k1, k.k2) for k in line_dedup.counts(back.references).collect()}
    assert len(repeated) == 1 and _may_hold(back, keys) == [(k.k1, k.k2) in repeated for k in keys] == _may_hold(before, keys)
    assert kept(back, one) == kept(None, one) == kept(before, one)
    assert {r.keeper for r in store.read(spark, root, line_index.COUNTS).where("n_docs >= 5").collect()} == {6}
    line_index.delete(one.select("doc_id"), root)
    assert line_index.index(spark, root).references.count() == 0 and store.read(spark, root, line_index.COUNTS).count() == 0
    assert first["written"]["held"]["rows"] == 5 and store.violations(spark, root) == []


def test_an_insertion_opens_the_parts_of_its_own_keys(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([(k, f"{LINE} of {k // 3}") for k in range(600)], "doc_id long, text string")
    line_index.build(docs, root, digits=2)
    last = store.head(spark, root)
    one = spark.createDataFrame([(1000, f"{LINE} of 5")], "doc_id long, text string")
    keys = line_dedup.references(one).select("k1", "k2")
    assert len(store.read(spark, root, line_index.COUNTS, keys, last).inputFiles()) == 1 < 50 < len(store.read(spark, root, line_index.COUNTS, at=last).inputFiles())
    new = line_index.insert(one, root)
    assert {n: w["rows"] for n, w in new["written"].items()} == {"holders": 1, "held": 1, "counts": 1, "filters": 0}


def test_cuckoo_filters_never_lose_a_key():
    keys = np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64)
    held = line_dedup.CuckooFilter(keys[:40_000])
    assert held.may_hold(keys[:40_000]).all()
    cells = held.cells.copy()
    while held.add(keys[40_000:]):
        assert held.may_hold(keys).all()
    assert held.may_hold(keys[:40_000]).all() and len(held.cells) == len(cells)
    held = line_dedup.CuckooFilter(cells=cells.tobytes())
    held.remove(keys[:10_000])
    assert held.may_hold(keys[10_000:40_000]).all() and held.may_hold(keys[:10_000]).mean() < 0.01
    assert held.add(keys[:10_000]) and held.may_hold(keys[:40_000]).all()
    same = np.full(7, 12345, np.uint64)
    held = line_dedup.CuckooFilter(same)
    held.remove(same[:6])
    assert held.may_hold(same[:1]).all()
    held.remove(same[:1])
    assert not held.may_hold(same[:1]).any()


def test_lines_dealt_to_the_filters_are_the_same(spark, texts, monkeypatch):
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    whole = sorted((r.doc_id, r.kept) for r in line_dedup.dedup_lines(rows).collect())
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 0)
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 10)
    assert whole == sorted((r.doc_id, r.kept) for r in line_dedup.dedup_lines(rows).collect())


# 5


def test_repeated_passages_are_found_and_clean_documents_left_alone(spark, texts):
    random.seed(3)
    vocabulary = [w for _, t in texts for w in (t or "").split()][:30_000]
    rows, need = {d: t or "" for d, t in texts}, set()
    for _ in range(25):
        passage = " ".join(random.choices(vocabulary, k=random.randint(51, 70)))
        for d in random.sample(sorted(rows), 3):
            own = rows[d].split(" ")
            at = random.randint(0, len(own))
            rows[d] = " ".join([*own[:at], passage, *own[at:]])
            need.add(d)
    got = substring_dedup.repeated_passages(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    flagged = {r.doc_id for r in got}
    runs = lambda n: [{tuple(t.lower().split()[i : i + n]) for i in range(len(t.split()) - n + 1)} for t in rows.values()]
    counts = collections.Counter(g for own in runs(15) for g in own)
    shares = {d for d, own in zip(rows, runs(15), strict=True) if any(counts[g] > 1 for g in own)}
    assert need <= flagged <= shares


def test_paragraph_classes_are_components_of_exact_similarity(spark):
    random.seed(9)
    base = [f"w{random.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for k in range(12):
        own = base if k < 8 else [f"v{random.randint(0, 5000)}" for _ in range(120)]
        own = [w if random.random() > 0.01 * (k % 4) else f"x{random.randint(0, 10**6)}" for w in own]
        rows.append((k, " ".join(own)))
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(116)} for k, t in rows}
    want = {k for k in sets for j in sets if j != k and len(sets[k] & sets[j]) / len(sets[k] | sets[j]) >= 0.8}
    got = {r.doc_id for r in substring_dedup.paragraph_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_every_window_of_20_words_in_two_documents_is_found(spark):
    """Few different words, so hashes come again within a window, in places and often; and phrases that repeat with short and long periods."""
    draw = random.Random(11)
    rows = {}
    for d in range(40):
        k = draw.choice([2, 3, 6, 40])
        rows[d] = [f"w{draw.randrange(k)}" for _ in range(draw.randrange(15, 60))]
    for _ in range(60):
        period = draw.choice([1, 2, 4, 7, 9, 12, 30])
        phrase = [f"p{draw.randrange(60)}" for _ in range(period)]
        passage = (phrase * 40)[: draw.randrange(20, 40)]
        for d in draw.sample(sorted(rows), 2):
            at = draw.randrange(len(rows[d]) + 1)
            rows[d] = [*rows[d][:at], *passage, *rows[d][at:]]
    holders = collections.defaultdict(set)
    for d, own in rows.items():
        for k in range(len(own) - 19):
            holders[tuple(own[k : k + 20])].add(d)
    docs = spark.createDataFrame([(d, " ".join(own)) for d, own in rows.items()], "doc_id long, text string")
    covered = collections.defaultdict(set)
    for r in substring_dedup.passage_classes(docs).collect():
        covered[r.doc_id] |= set(range(r.first_word, r.first_word + r.n_words))
    for d, own in rows.items():
        need = {w for k in range(len(own) - 19) if len(holders[tuple(own[k : k + 20])]) > 1 for w in range(k, k + 20)}
        assert need == covered[d], d


def test_a_hash_that_comes_again_in_one_document_alone_hides_no_passage(spark):
    draw = random.Random(2)
    for tail in (3, 8, 14):
        phrase = [f"x{draw.randrange(10**6)}" for _ in range(5)]
        passage = [*phrase, *[f"y{draw.randrange(10**6)}" for _ in range(15)]]
        other = lambda n: [f"z{draw.randrange(10**6)}" for _ in range(n)]
        rows = [(1, " ".join([*other(30), *phrase, *other(tail), *passage, *other(30)])), (2, " ".join([*other(40), *passage, *other(9)]))]
        assert {r.doc_id for r in substring_dedup.passage_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1, 2}


def test_rows_whose_short_hashes_clash_keep_their_own_text(spark):
    p, q = (" ".join(f"{c}{k}" for k in range(30)) for c in "pq")
    rows = [(1, p), (7, f"{p} a11240"), (7, f"{q} b162819")]
    got = [r.text for r in substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(q in t for t in got) == 1 and sum(p in t for t in got) == 1


def test_removal_leaves_one_of_each_passage(spark, none, odd):
    passage = " ".join(f"p{k}" for k in range(80))
    rows = spark.createDataFrame([(1, f"one\n{passage}"), (2, f"{passage}\ntwo"), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in substring_dedup.without_repeats(rows).collect()}
    assert got == {1: f"one\n{passage}", 2: "\ntwo", 3: "clean"}
    assert substring_dedup.repeated_passages(none).count() == 0
    assert substring_dedup.repeated_passages(odd).count() == 0


def _own_words(name, n):
    return [f"{name}{k}" for k in range(n)]


def test_passages_side_by_side_each_keep_one_copy(spark):
    p, q = _own_words("p", 60), _own_words("q", 60)
    held = [(1, p), (2, p + q), (3, p + q), (4, q)]
    rows = [(d, " ".join(_own_words(f"a{d}x", 30) + own + _own_words(f"b{d}x", 30))) for d, own in held]
    left = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    count = collections.Counter(w for r in left for w in r.text.split())
    assert {count[w] for w in p + q} == {1}
    assert all(count[w] == 1 for d in range(1, 5) for w in _own_words(f"a{d}x", 30) + _own_words(f"b{d}x", 30))


def test_no_passage_loses_its_last_copy(spark):
    random.seed(21)
    parts = [_own_words(f"s{k}x", 40) for k in range(9)]
    held = [(1, [0, 1]), (2, [0, 1, 2]), (3, [1, 2])] + [(d, random.sample(range(3, 9), random.randint(2, 5))) for d in range(4, 24)]
    held += [(24, [3]), (24, [8]), (25, [8, 4])]  # two rows of one doc_id
    rows = spark.createDataFrame([(d, " ".join(w for k in own for w in parts[k])) for d, own in held], "doc_id long, text string")
    left = [r.text.split() for r in substring_dedup.without_repeats(rows).collect()]
    count = collections.Counter(w for own in left for w in own)
    windows = {tuple(own[i : i + 20]) for own in left for i in range(len(own) - 19)}
    for own in parts:
        assert all(tuple(own[i : i + 20]) in windows for i in range(21)) and all(count[w] <= 2 for w in own)
    assert sum(count.values()) < 1.3 * sum(map(len, parts))


def test_short_stretches_of_different_documents_are_no_passage(spark):
    parts = [_own_words(f"s{k}x", 18) for k in range(3)]
    rows = [(1, sum(parts, []))] + [(k + 2, _own_words(f"c{k}x", 40) + own + _own_words(f"d{k}x", 40)) for k, own in enumerate(parts)]
    assert substring_dedup.passage_classes(spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")).count() == 0


def test_a_passage_inside_copies_of_another_document_is_found(spark):
    p, around = _own_words("p", 51), (_own_words("y", 80), _own_words("z", 80))
    rows = [(1, _own_words("a", 40) + p + _own_words("b", 40)), *((d, around[0] + p + around[1]) for d in (4, 5))]
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    left = {r.doc_id: r.text.split() for r in substring_dedup.without_repeats(frame).collect()}
    assert left == {1: rows[0][1], 4: around[0] + around[1], 5: []}


def test_passages_are_found_to_their_exact_ends(spark):
    rows, want = [], set()
    for k in range(300):
        passage = _own_words(f"p{k}x", 51) if k else ["la", "li", "lo"] * 17
        for d in (2 * k, 2 * k + 1):
            before = 40 + d % 7
            rows.append((d, " ".join(_own_words(f"a{d}x", before) + passage + _own_words(f"b{d}x", 40))))
            want.add((d, before, 51))
    got = substring_dedup.passage_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.n_words) for r in got} == want and len(got) == len(want)
    assert len({r.first for r in got}) == 300


# 6


def test_items_are_found_whole_and_clean_documents_left_alone(spark, sf, odd, none):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    listed = [(r.item_id, plain(r.text)) for r in items.collect()]
    planted = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**6, "x " * 500 + items.first().text.upper() + " y" * 90), (10**6 + 1, None), (10**6 + 2, "")], "doc_id long, text string"))
    want = {(r.doc_id, i) for r in planted.collect() for i, t in listed if t in plain(r.text)}
    for size in (20_000, 7):
        got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(planted, items, index_items=size).collect()}
        assert got == want
    assert decontaminate.contaminated(odd, items).count() == 0
    assert decontaminate.contaminated(none, items).count() == decontaminate.contaminated(docs, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "one")], "item_id long, text string")
    assert {r.item_id for r in decontaminate.contaminated(spark.createDataFrame([(1, "two one")], "doc_id long, text string"), blank).collect()} == {3}


def test_an_item_is_found_after_its_scattered_words_and_beside_a_long_item(spark):
    item = "which river runs through the old town of vell. the answer is the green aster"
    scattered = " ".join(sorted(item.replace(".", "").split()))
    pad = " ".join(f"x{k}" for k in range(200))
    plain = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contaminated(plain([(1, f"{scattered} {pad} {item} {pad}"), (2, f"{scattered} {pad}")]), items).collect()
    assert [(r.doc_id, r.question, r.answer) for r in got] == [(1, 1.0, 1.0)]
    long = spark.createDataFrame([(1, item), (2, " ".join(f"y{k}" for k in range(500)))], "item_id long, text string")
    own = item.replace(".", "").split()
    apart = f" {pad} ".join(" ".join(own[k : k + 3]) for k in range(len(own) - 2))
    tight = " ".join(" ".join(own[k : k + 3]) + f" z{k} z{k + 1} z{k + 2} z{k + 3} z{k + 4} z{k + 5} z{k + 6} z{k + 7} z{k + 8}" for k in range(len(own) - 2))
    got = decontaminate.contaminated(plain([(1, f"{pad} {item} {pad}"), (2, apart), (3, tight)]), long).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1)}


def test_block_max_search_gives_what_a_scan_gives():
    random.seed(4)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [" ".join(random.choices(vocabulary, k=random.randint(3, 20))) for _ in range(200)]
    hashes, first = textgrams.words(items, separators=textgrams._NOT_WORD)
    terms, df = np.unique(np.concatenate([np.unique(hashes[a:b]) for a, b in zip(first, first[1:], strict=False)]), return_counts=True)
    index = decontaminate.ItemIndex(list(range(200)), items, 0.6, 32, 200, float(np.diff(first).mean()), terms, df)
    weights = collections.defaultdict(dict)
    for k in range(len(index.terms)):
        for j in range(index.begin[k], index.begin[k + 1]):
            weights[int(index.items[j])][k] = index.weights[j]
    for n in (3, 10, 30):
        for _ in range(60):
            held = np.unique(np.searchsorted(index.terms, textgrams.words([" ".join(random.choices(vocabulary, k=n))])[0]))
            scores = {i: sum(w for k, w in own.items() if k in set(held.tolist())) for i, own in weights.items()}
            got = dict(index.wand(held))
            assert set(got) == {i for i, x in scores.items() if x >= 0.6 - 1e-9}
            assert all(abs(got[i] - scores[i]) < 1e-9 for i in got)
    assert index.skipped and 0 < index.scored < 0.5 * 180 * 200


def test_rows_are_the_same_however_the_index_is_split(spark, texts):
    random.seed(13)
    vocabulary = [w for _, t in texts for w in (t or "").split()][:400]
    items = [(k, " ".join(random.choices(vocabulary, k=random.choice([6, 15, 40, 90])))) for k in range(60)]
    docs = []
    for k in range(120):
        own = items[k % 60][1].split()
        cut = random.randint(0, len(own) // 3)
        docs.append((k if k % 7 else None, " ".join(random.choices(vocabulary, k=50) + own[cut:] + random.choices(vocabulary, k=30))))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [sorted(decontaminate.retrieve(docs, items, index_items=size).collect(), key=str) for size in (20_000, 9)]
    assert got[0] and got[0] == got[1]
    found = {(r.doc_id, r.row) for r in decontaminate.contaminated(docs, items).collect()}
    left = {(r.doc_id, r.row) for r in decontaminate.decontaminated(docs, items).select("doc_id", F.xxhash64("text").alias("row")).collect()}
    assert any(d is None for d, _ in found) and not found & left and len(left) == 120 - len(found)


# 7


def brute_classes(rows, least=0.8, weighted=True):
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        shingles = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        seen = collections.Counter()
        for g in shingles:
            seen[g] += 1
        sets[d] = frozenset((g, k) for g, n in seen.items() for k in range(n if weighted else 1))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for d, own in sets.items():
        for g in own:
            holders[g].append(d)
    for d, own in sets.items():
        for o, n in collections.Counter(o for g in own for o in holders[g] if o > d).items():
            if n / (len(own) + len(sets[o]) - n) >= least:
                a, b = find(d), find(o)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def test_classes_are_those_of_all_pairs(spark, texts):
    for weighted in (True, False):
        got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), weighted=weighted).collect()}
        assert got == brute_classes(texts, weighted=weighted)


def test_a_large_bucket_of_variants_is_resolved(spark):
    random.seed(11)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(w if random.random() > random.choice([0.005, 0.02, 0.03]) else f"x{random.randint(0, 10**6)}" for w in base)) for k in range(150)]
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_classes(rows)
    assert sum(got[k] != want[k] for k in want) <= 1  # bands miss a link at the threshold with probability 0.0002


def test_signatures_agree_as_weighted_sets_do():
    rng = np.random.default_rng(1)
    estimates, truth = [], []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, n, replace=False)) for n in (200, 150))
        wa, wb = rng.uniform(0.2, 3, len(a)), rng.uniform(0.2, 3, len(b))
        da, db = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
        every = set(da) | set(db)
        truth.append(sum(min(da.get(x, 0), db.get(x, 0)) for x in every) / sum(max(da.get(x, 0), db.get(x, 0)) for x in every))
        names = dart_minhash.dart_signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), np.concatenate((wa, wb)), 64)
        estimates.append((names[0] == names[1]).mean())
    assert abs(np.mean(estimates) - np.mean(truth)) < 0.02


def test_odd_documents_have_classes(spark, odd, none):
    got = collections.defaultdict(set)
    for r in dart_minhash.near_duplicates(odd).collect():
        got[r.doc_id].add(r.class_id)
    assert got[5] == got[6] == {5} and got[1] == {1} and got[2] == {2} and got[None] == {None}
    assert dart_minhash.near_duplicates(none).count() == 0
    kept = dart_minhash.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "8", "9", "None"]
    assert dart_minhash.near_duplicates(odd, weighted=False).count() == odd.count()


def test_rows_of_one_doc_id_are_deduplicated_by_text(spark):
    x, y, z = (" ".join(f"{name}{k}" for k in range(50)) for name in "xyz")
    rows = spark.createDataFrame([(3, x), (5, x), (5, y), (7, z), (7, y), (3, z)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[0]) for r in dart_minhash.deduplicated(rows).collect()) == [(3, "x"), (3, "z"), (5, "y")]
    assert sorted((r.doc_id, r.class_id) for r in dart_minhash.near_duplicates(rows).collect()) == [(3, 3), (3, 3), (5, 3), (5, 5), (7, 3), (7, 5)]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)]
    got = {r.id: r.component for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


# 8


def test_held_out_documents_are_told_apart(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score(docs, labels).toPandas()
    assert len(scored) == docs.count() and scored["score"].between(0, 1).all()
    assert (scored["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in scored["doc_id"]]).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    both = scored.merge(labels.toPandas(), on="doc_id")
    held = both[both["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.9


def test_vectors_and_pooling_are_those_of_loops(spark, texts):
    rows = [(d, t) for d, t in texts if t][:60] + [(10**6, None), (10**6 + 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = [[int(h) for h in quality._tokens([t or ""])[0]] for _, t in rows]
    counts = collections.Counter(w for own in told for w in own)
    least = max(quality.LEAST, sum(counts.values()) * 0.002)
    own = quality.own_words(docs, 0.002)
    assert own.tolist() == sorted(w for w, n in counts.items() if n >= least) and 5 < len(own) <= 500
    row = {w: own.tolist().index(w) if w in set(own.tolist()) else len(own) + w % quality.BUCKETS for w in counts}
    index, sums = quality.index_vectors(), np.zeros((len(own) + quality.BUCKETS, quality.WIDTH))
    for words in told:
        for k, w in enumerate(words):
            for j in range(max(0, k - quality.WINDOW), min(len(words), k + quality.WINDOW + 1)):
                sums[row[w]] += index[words[j] % quality.BUCKETS] if j != k else 0
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    seen = np.linalg.norm(sums, axis=1) > 0
    want = unit(sums)
    want[seen] -= want[seen].mean(0)
    want = unit(want)
    table = quality.word_vectors(docs, own)
    assert np.abs(table - want).max() < 1e-4
    got = {r.doc_id: r.features[: quality.WIDTH] for r in quality.pooled(docs, table, own).collect()}
    for (d, _), words in zip(rows, told, strict=True):
        assert np.abs(np.array(got[d]) - (np.mean([want[row[w]] for w in words], axis=0) if words else 0)).max() < 1e-4


def test_odd_documents_get_scores(spark, odd, none, sf):
    labels = spark.createDataFrame([(2, 0, 0), (3, 1, 0), (5, 1, None), (6, None, 1), (5, 0, 0), (None, 1, 1), (4, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for told in (labels, labels.limit(0), labels.where("quality = 1")):
        got = quality.score(odd, told).toPandas()
        assert len(got) == odd.count() and got["score"].between(0, 1).all()
    assert quality.score(none, labels).count() == 0


# 9


def test_urls_are_judged(spark):
    urls = [(1, "http://A.Example.ORG/es/x?y"), (2, None), (3, "nourl"), (4, "x://org"), (5, "http://org/"), (6, "http://evil.net/bad/1?q=1"), (7, "http://evil.net/bad/2"), (8, "http://ok.net/good/2"), (9, "http://a.com/de/://b"), (9, "http://a.com/de/://b"), (None, "http://xorg/"), (10, "http://example.org/en/123#x")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({"host": F.lit("clash"), "tokens": F.lit(1), "rule": F.lit(2)})
    bad = spark.createDataFrame([(6, True), (7, True), (8, False), (3, False)], "page_id long, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, bad, min_support=0.1, least_urls=1).collect()}
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("org", "", None, "allow"), 5: ("org", "/", "org/", "allow"),
        6: ("evil.net", "/bad/1", None, "block"), 7: ("evil.net", "/bad/2", None, "block"), 8: ("ok.net", "/good/2", None, "allow"), 9: ("a.com", "/de/://b", "com/de/", "block"),
        None: ("xorg", "/", None, "allow"), 10: ("example.org", "/en/123", "example.org/en/1", "block"),
    }
    assert url_filter.judge(pages.limit(0), bad).count() == 0 and url_filter.judge(pages, bad.limit(0)).count() == len(urls)


def test_mined_rules_are_those_of_counting_and_match_either_way(spark):
    random.seed(6)
    rows = []
    for k in range(300):
        own = random.sample("abcdef", 3)
        rows.append((k, sorted(f"host={x}" for x in own), ("a" in own and "b" in own) or random.random() < 0.1))
    table = spark.createDataFrame(rows, "page_id long, tokens array<string>, bad boolean").withColumn("labelled_id", F.col("page_id"))
    mined = url_filter.mine(table, 0.02, 0.6, 1.2, 1)
    share = sum(b for _, _, b in rows) / len(rows)
    want = set()
    import itertools

    for n in (1, 2, 3):
        for some in itertools.combinations([f"host={x}" for x in "abcdef"], n):
            held = [b for _, t, b in rows if set(some) <= set(t)]
            if held and sum(held) / len(rows) >= 0.02 and sum(held) / len(held) >= 0.6 and sum(held) / len(held) / share >= 1.2:
                want.add(some)
    got = {tuple(sorted(r.tokens)): r.confidence for r in mined.collect()}
    assert got and set(got) <= want and all(any(set(g) <= set(w) for g in got) for w in want)
    by = [[r.mined for r in url_filter.matched(table, mined, n).orderBy("page_id").collect()] for n in (2000, 0)]
    assert by[0] == by[1] == [any(set(g) <= set(t) for g in got) for _, t, _ in rows]


def test_tokens_of_one_template_are_mined_as_one(spark):
    template = [f"path=t{k:02d}" for k in range(40)]
    rows = [(k, sorted(["host=all", *(template if k % 3 == 0 else ["host=x"])]), k % 3 == 0) for k in range(300)]
    mined = url_filter.mine(spark.createDataFrame(rows, "labelled_id long, tokens array<string>, bad boolean"), 0.02, 0.6, 1.2, 1).collect()
    assert [(r.tokens, r.confidence) for r in mined] == [(["path=t00"], 1.0)]


# 10


def test_pieces_hold_every_id_once_and_sequences_have_no_gaps(spark, texts, odd, none):
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(TOKENIZER)
    bpe.encode_special_tokens = True
    frame = odd.select("doc_id", "text").where("doc_id is null or doc_id not in (4)").dropDuplicates()
    for rows in (spark.createDataFrame(texts, "doc_id long, text string"), frame):
        got = packing.pack(rows, TOKENIZER).toPandas()
        for r in rows.collect():
            ids = np.array([*bpe.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            own = got[got["doc_id"].isna() if r.doc_id is None else got["doc_id"] == r.doc_id].sort_values("start")
            assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() == len(ids)
            assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(own["start"], own["length"], strict=True)] == own["ids_crc32"].tolist()
            assert (own["doc_tokens"] == len(ids)).all()
        for _, own in got.sort_values("offset").groupby("sequence_id"):
            assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 1024
    assert packing.pack(none, TOKENIZER).count() == 0


def test_packing_leaves_little_padding_and_uses_every_length_once():
    random.seed(8)
    histogram = dict(collections.Counter(min(1024, int(random.expovariate(1 / 300)) + 1) for _ in range(20_000)))
    patterns = packing.shortest_pack_first(histogram, 1024)
    used = collections.Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 1024
        for n in lengths:
            used[n] += count
    assert used == histogram
    assert sum((1024 - sum(x)) * c for x, c in patterns) / sum(n * c for n, c in histogram.items()) < 0.01


def test_sequences_are_padded_to_capacity_or_a_power_of_two(spark, texts):
    rows = spark.createDataFrame(texts[:40], "doc_id long, text string")
    made = packing.sequences(rows, TOKENIZER).collect()
    assert all(len(r.ids) == 1024 or len(r.ids) & (len(r.ids) - 1) == 0 for r in made)
    assert sum(len(set(r.doc_ids)) for r in made) >= 40


def test_ranks_are_whole_also_where_one_length_has_most_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 5)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.when(F.col("id") % 3 == 0, 5).otherwise(7).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    got = packing.ranked(rows, [(5, 1000), (7, 2000)]).collect()
    for length, n in ((5, 1000), (7, 2000)):
        assert sorted(r["rank"] for r in got if r.length == length) == list(range(n))


# The pipeline


def test_pipeline_keeps_what_each_stage_should(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        docs = spark.createDataFrame(out.collect(), out.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        gone = set(before) - set(after)
        if name == "quality":
            assert np.mean([labels[d] == 0 for d in gone if d in labels]) > 0.9
        elif name == "line_dedup":
            assert sorted((str(d), t) for d, t in after.items()) == [x for x in brute_lines(list(before.items())) if x[1].strip() or before[int(x[0])] == x[1]]
        elif name == "near_dedup":
            assert set(after) == {d for d, c in brute_classes(list(before.items())).items() if d == c}
        elif name == "decontamination":
            plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
            items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert gone == {d for d, t in before.items() if any(i in plain(t) for i in items)}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(before)
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages_take_odd_rows(spark, odd, none, sf):
    import corpus_pipeline

    for rows in (odd, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_hashes_are_lower_case_hex(spark, sf):
    r = queries.op1_chat_format(spark, sf).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())


def test_rows_that_repeat_leave_one(spark):
    """Of rows of one doc_id and one text; rows without a doc_id stay, with a clashing column beside."""
    x, y = (" ".join(f"{c}{k}" for k in range(30)) for c in "xy")
    rows = [(1, x), (1, x), (2, x), (3, y), (3, y), (3, y), (4, "short"), (4, "short"), (None, y), (None, y)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(5)).withColumn("a.b", F.lit(1))
    got = [(r[0], r[1]) for r in dart_minhash.deduplicated(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, x), (3, y), (4, "short"), (None, y), (None, y)], key=str)


def test_components_beyond_64_bits_are_refused(spark):
    vectors = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        exact_topk.quantised(vectors, "vec_id", "embedding").collect()


def test_bounding_of_passages_needs_little_memory_and_loses_none(monkeypatch):
    import tracemalloc

    draw = np.random.default_rng(4)
    chance = 1 / np.arange(1, 5001) ** 0.9
    vocabulary, chance = np.array([f"w{k}" for k in range(5000)]), chance / chance.sum()
    text = lambda n: " ".join(vocabulary[draw.choice(5000, n, p=chance)])
    items = [text(int(n)) for n in draw.integers(10, 50, 3000)]
    body = " ".join([text(4000), items[7], text(3000), items[2999], text(50), items[1500]])
    hashes, first = textgrams.words(items, separators=textgrams._NOT_WORD)
    each = [np.unique(hashes[first[k] : first[k + 1]]) for k in range(len(items))]
    terms, df = np.unique(np.concatenate(each), return_counts=True)
    index = decontaminate.ItemIndex(list(range(3000)), items, 0.6, 64, 3000, float(np.diff(first).mean()), terms, df)
    own, begins = textgrams.words([body], separators=textgrams._NOT_WORD)
    weights = np.zeros((3000, len(index.terms)))
    for t in range(len(index.terms)):
        at = slice(index.begin[t], index.begin[t + 1])
        weights[index.items[at], t] = index.weights[at]
    want = set()
    for k in range(0, max(1, len(own) - 64), 64):
        held = np.isin(index.terms, own[k : k + 128])
        want |= set(np.flatnonzero(weights @ held >= 0.6 - 1e-9).tolist())
    results = []
    for size in (decontaminate.SLICE, 5_000):
        monkeypatch.setattr(decontaminate, "SLICE", size)
        tracemalloc.start()
        results.append(sorted(index.search(own, begins)))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 100 << 20
    assert results[0] == results[1] and {r[1] for r in results[0]} == want and {7, 1500, 2999} <= want


def test_distinct_values_of_texts_are_found_without_a_call_of_unique_for_each(monkeypatch):
    draw = np.random.default_rng(5)
    first = np.concatenate(([0], np.cumsum(draw.integers(0, 9, 400))))
    values = draw.integers(0, 6, first[-1]).astype(np.uint64)
    before = values.copy()
    want = [np.unique(values[a:b], return_counts=True) for a, b in zip(first, first[1:], strict=False)]
    called, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **b: called.append(1) or unique(*a, **b))
    got, begin, counts = textgrams.distinct(values, first)
    assert not called and (values == before).all() and len(begin) == len(first)
    for k, (own, each) in enumerate(want):
        assert got[begin[k] : begin[k + 1]].tolist() == own.tolist() and counts[begin[k] : begin[k + 1]].tolist() == each.tolist()
    assert [len(x) for x in textgrams.distinct(np.zeros(0, np.uint64), np.array([0, 0, 0]))] == [0, 3, 0]


@pytest.mark.parametrize("most", [1, 40, 1 << 15])
def test_blocks_are_joined_as_their_similar_pairs_join_them(monkeypatch, most):
    monkeypatch.setattr(linking, "TOGETHER_ELEMENTS", most)
    draw = random.Random(3)
    for _ in range(20):
        n = draw.randrange(2, 30)
        sets = [np.array(sorted(draw.sample(range(9), draw.randrange(1, 8))), np.int64) for _ in range(n)]
        out = sorted(draw.sample(range(n), draw.randrange(1, n)))
        block = lambda rows: (list(rows), list(rows), [sets[k] for k in rows])  # noqa: E731, B023
        got = linking._forest(block(out), block(range(n)), 0.6)
        pairs = [(min(a, b), max(a, b)) for a in out for b in range(n) if a != b and len({*sets[a]} & {*sets[b]}) >= 0.6 * len({*sets[a]} | {*sets[b]})]
        assert {*got} <= {*pairs}

        def classes(edges, n=n):
            of = list(range(n))
            for a, b in edges:
                of = [of[a] if x == of[b] else x for x in of]
            return {frozenset(k for k in range(n) if of[k] == x) for x in of}

        assert classes(got) == classes(pairs) and len(got) == n - len(classes(pairs))
