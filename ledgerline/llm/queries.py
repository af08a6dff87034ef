"""The queries of the training-data operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chat_format, dart_minhash, decontaminate, exact_topk, line_dedup, packing, periodic_runs, pii, prefix_trie, quality, substring_dedup, url_filter, word_bpe
from .shared import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = rows.unionByName(extra).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")))).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    said = [F.get("t", k)["content"] for k in range(3)]
    # Three layouts, as they come from different sources; each keeps all turns.
    raw = (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), F.to_json(F.struct(said[0].alias("prompt"), said[1].alias("response"))))
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), F.to_json(F.struct(said[0].alias("system"), said[1].alias("instruction"), said[2].alias("output"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))))
    )
    formatted = chat_format.render(chat_format.canonical_turns(turns.select("conv_id", raw.alias("raw")), "raw"))
    return chat_format.read_back(formatted, "conv_id")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = exact_topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_topk.top_k(vectors, F.col("vec_id") % 100 == 0)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("pii", pii.is_base)
    return found.select("doc_id", *pii.counts_by_kind(F.col("pii")), F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("pii")).alias("spans"), F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the document of its own number: bad if of low quality or toxic."""
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg((F.bool_or(F.col("quality") == 0) | F.bool_or(F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge(table(spark, sf_dir, "pages"), labels.where(F.col("bad").isNotNull()))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin as the one at the head of their five does, for as many turns as their number's hash says."""
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    base, h = F.col("conv_id") - F.col("conv_id") % 5, (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    five = Window.partitionBy("base")
    own = own.select("conv_id", "turns", base.alias("base"), h.alias("h"))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 8))).over(five)
    none = F.slice("turns", 1, 0)
    rebuilt = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns")))
    return prefix_trie.trie(own.withColumn("head", head).select("conv_id", rebuilt.alias("turns")))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = word_bpe.encode(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return word_bpe.decode(encoded, WORD_TOKENIZER).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    h = F.crc32(F.col("doc_id").cast("string"))
    # Every tenth document repeats its end.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = (F.col("g") % F.col("n")).cast("int")
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    again = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    whole = F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", 1, F.col("a")), again), " ")).otherwise(F.col("text"))
    rows = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.coalesce(n, F.lit(0))).withColumn("g", g)
    rows = rows.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p).select("doc_id", whole.alias("text"))
    done = periodic_runs.collapse(rows).withColumn("best", periodic_runs.strongest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    exponent = F.expr("best.length * 1000 div best.period").alias("exponent_milli")
    return done.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", exponent, F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_exact_topk": op2_exact_topk,
    "op3_pii": op3_pii,
    "op4_line_dedup": op4_line_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_quality": op8_quality,
    "op9_url_filter": op9_url_filter,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_word_bpe": op12_word_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

def _crc32_sql(number: str) -> str:
    """The unsigned CRC-32 of a number's decimal digits, bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({number}::varchar, ''), lambda s: ascii(s)::bigint)), lambda c, b: {bits}), 4294967295)"


def _pii_sql() -> str:
    """The base patterns as they are given, without the anchors that spare the operator a second look; the added kind as the operator has it."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    turned = "(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4])"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: case when i % 2 = 1 then reverse({digits})[i]::int else [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][reverse({digits})[i]::int + 1] end)) % 10 = 0"
    mod97 = f"list_reduce(list_prepend(0::bigint, list_transform(string_split({turned}, ''), lambda c: case when c between '0' and '9' then c::bigint else (ascii(c) - 55)::bigint end)), lambda r, n: (r * case when n > 9 then 100 else 10 end + n) % 97) = 1"
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.8),
        ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) <= 3 and coalesce(try_cast(x as hugeint), 999) <= 255))", 0.5),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({digits}) between 13 and 19 and {luhn}", 0.7),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) between 9 and 15", 0.6),
        ("iban", pii.IBAN, mod97, 0.9),
    ]
    selects = []
    for n, (kind, pattern, holds, score) in enumerate(kinds):
        words = "|".join(next(k for k in pii.BASE + pii.ADDED if k.name == kind).context)
        near = f"(?i)(?:^|[^a-z])(?:{words})(?:$|[^a-z])"
        selects.append(f"""select doc_id, {n} as ord, '{kind}' as kind, s, s + length(m) as e,
  {score} + case when regexp_matches(right(parts[i], {pii.NEAR}), '{near}') or regexp_matches(left(parts[i + 1], {pii.NEAR}), '{near}') then 0.1 else 0 end as score
  from (select doc_id, i, ms[i] as m, parts, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as s
    from (select doc_id, parts, ms, unnest(range(1, len(ms) + 1)) as i from (select doc_id, string_split_regex(t, '{pattern}') as parts, regexp_extract_all(t, '{pattern}') as ms from src where regexp_matches(t, '{pattern}')))) where {holds}""")
    counts = ", ".join(f"coalesce(count_if(kind = '{k}'), 0)::bigint as n_{k}" for k in ("email", "ip", "card", "phone"))
    span = "kind || ':' || s::bigint || ':' || e::bigint"
    return f"""with src as (select doc_id, coalesce(text, '') as t from documents), found as ({' union all '.join(selects)})
select doc_id, {counts}, sha256(coalesce(string_agg({span}, ',' order by ord, s) filter (where ord < 4), '')) as base_sha256,
  coalesce(string_agg({span}, ',' order by ord, s), '') as spans, coalesce(string_agg(format('{{:.2f}}', score), ',' order by ord, s), '') as scores
from documents left join found using (doc_id) group by doc_id"""


ORACLE_SQL = {
    "op11_prefix_trie": f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), own as (
  select conv_id, list({{'id': sha256(length(role) || ':' || role || text), 'size': strlen(text)}} order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as ts,
         {_crc32_sql("conv_id")} % 9 as h
  from turns group by conv_id
), rebuilt as (
  select o.conv_id, list_concat(coalesce(b.ts[1:o.h], []), o.ts[o.h + 1:]) as ts from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 5
), members as (
  select conv_id, d, array_to_string(list_transform(ts[1:d], lambda t: t.id), '') as k, d = len(ts) as at_end, coalesce(ts[d].size, 0) as size
  from (select *, unnest(range(0, len(ts) + 1)) as d from rebuilt)
), nodes as (
  select k, d, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as saved, left(k, 64 * (d - 1)) as above,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where at_end), '')) as ends_sha256
  from members group by k, d
), marked as (
  select n.*, p.conv_id as parent_conv_id, coalesce(c.n, 0) as n_children
  from nodes n left join nodes p on n.d > 0 and p.d = n.d - 1 and p.k = n.above
  left join (select above, d, count(*) as n from nodes where d > 0 group by above, d) c on c.above = n.k and c.d = n.d + 1
), sums as (
  select left(k, 64 * e) as k, e as d, sum((n_children = 0)::int)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
  from (select *, unnest(range(0, d + 1)) as e from marked) group by all
)
select conv_id, d as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 from marked join sums using (k, d)
""",
    "op13_periodic_runs": f"""
with own as (
  select rowid as row, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as w, {_crc32_sql("doc_id")} as h from (select *, row_number() over () as rowid from documents)
), sized as (
  select *, len(w) as n, h // 10 as g from own
), placed as (
  select *, g % n as a, 1 + (n - g % n) // (3 + g % 8) as p from sized where h % 10 = 0 and n > 0
), texts as (
  select s.row, s.doc_id, s.n, case when p.row is null then s.w else list_concat(s.w[1:p.a], list_transform(range(p.a, p.n), lambda i: s.w[p.a + (i - p.a) % p.p + 1])) end as w
  from sized s left join placed p using (row)
), windows as (
  select row, i, array_to_string(w[i + 1:i + 16], ' ') as k from (select *, unnest(range(0, n - 15)) as i from texts where n >= 24)
), pairs as (
  select a.row, a.i, b.i - a.i as q from windows a join windows b on a.row = b.row and a.k = b.k and b.i > a.i
), stretches as (
  select row, q, min(i) as s, count(*) + 15 + q as len from (select *, i - row_number() over (partition by row, q order by i) as island from pairs) group by row, q, island
), runs as (
  select row, s, len, min(q) as q from stretches where len >= greatest(24, 3 * q) group by row, s, len
), best as (
  select row, count(*) as n_runs, first({{'s': s, 'len': len, 'q': q}} order by len::double / q desc, s, q) as b, sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q)) as runs_sha256 from runs group by row
), dropped as (
  select distinct row, unnest(range(s + q, s + len)) as i from runs
), kept as (
  select t.row, sha256(coalesce(string_agg(t.word, ' ' order by t.i) filter (where d.row is null), '')) as collapsed_sha256
  from (select row, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from texts) t left join dropped d using (row, i) group by t.row
)
select doc_id, coalesce(n_runs, 0) as n_runs, b.s as start, b.len as length, b.q as period, 1000 * b.len // b.q as exponent_milli,
       coalesce(runs_sha256, sha256('')) as runs_sha256, coalesce(collapsed_sha256, sha256('')) as collapsed_sha256
from texts left join best using (row) left join kept using (row)
""",
    "op3_pii": _pii_sql(),
    "op1_chat_format": """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped as (
  select *, list_reduce(['<|turn|>', '<|text|>', '<|end|>', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '<|im_start|>', '<|im_end|>', '<|endoftext|>'],
    lambda t, c: replace(t, c, c[1] || chr(92) || c[2:]), replace(text, chr(92), chr(92) || chr(92))) as shown from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length(role) + length(shown) + length('<|turn|><|text|><|end|>'))::bigint as formatted_chars
from escaped group by conv_id
""",
    "op2_exact_topk": """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from whole q join whole c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored
qualify rank <= 10
""",
    "op4_line_dedup": """
with lines as (
  select doc_id, generate_subscripts(l, 1) as pos, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5
), marked as (
  select k.*, r.key is not null and k.doc_id <> r.keeper as gone from keyed k left join repeated r using (key)
)
select doc_id, count(*) as n_lines, count_if(gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
""",
}
