"""URL filtering by written rules and by association rules mined with FP-growth.

Written rules name a host and the start of a path; the longest that fits a URL
decides. Where none fits, mined rules do: combinations of URL tokens that go
with a bad label more often than by chance, with enough support and
confidence. They match through an inverted index from token to rules, sent to
the tasks while it is small and joined as a table beyond that.

Defined cases: a null URL, or one without ://, has an empty host and path, no
tokens, and is allowed; repeated rows are judged each; unlabelled URLs teach
nothing; with no label or no mined rule everything else is allowed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .line_dedup import LOWER, UPPER
from .shared import written

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
BAD = "label=bad"
#: The index is a literal in the plan up to this many rules; beyond it, a joined table.
LITERAL_RULES = 2_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, after, 1), UPPER, LOWER), F.regexp_extract(url, after, 2)


def written_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (its host is the URL's or a parent of it, its path starts the URL's) and its verdict, both null if none."""
    name = verdict = F.lit(None).cast("string")
    for own, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first, so it goes on last
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        name, verdict = F.when(fits, own + start).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """A URL's distinct tokens: labels of its host, words of its path (numbers as one), its ending and its query's keys."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host="), x))
    parts = F.filter(F.split(F.translate(path, UPPER, LOWER), "[/._-]+"), lambda x: x != "")
    words = F.transform(parts, lambda x: F.concat(F.lit("path="), F.when(x.rlike("^[0-9]+$"), "#").otherwise(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.regexp_extract(x, "^[^=]*", 0)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(labels, words, keys)))


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, min_lift: float = 1.2, least_urls: int = 30) -> DataFrame:
    """Rules (rule_id, tokens, n_tokens, confidence, support) from rows with labelled_id, tokens and bad (boolean).

    A rule's tokens and label stand together in min_support of all labelled URLs, and in least_urls of them at least.
    Pruned: a rule whose tokens contain those of another kept rule of at least its confidence goes.

    Before mining, tokens go that no such rule can need: those without the
    support of their own, and those of every URL. Of tokens that stand in just
    the same URLs, as those of a site's template do, the least stands for all,
    so they don't make a set of items for each combination of them.
    """
    rows = labelled.where(F.size("tokens") > 0)
    total = rows.count()
    support = min(1.0, max(min_support, least_urls / max(1, total)))
    of_token = rows.select(F.xxhash64("labelled_id", "tokens").cast("decimal(38,0)").alias("url"), "bad", F.explode("tokens").alias("token"))
    of_token = of_token.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.sum("url").alias("urls"))
    apart = of_token.where((F.col("n_bad") >= support * total) & (F.col("n") < total)).groupBy("n", "urls").agg(F.min("token").alias("token"))
    # A token of that support stands in so many URLs that there are at most (tokens of a URL) / support of them.
    used = F.array(*[F.lit(r["token"]) for r in apart.select("token").collect()]).cast("array<string>")
    tokens = F.array_intersect("tokens", used)
    baskets = rows.select(F.when(F.col("bad"), F.concat(tokens, F.array(F.lit(BAD)))).otherwise(tokens).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= min_lift))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support").withColumn("n_tokens", F.size("tokens")).withColumn("rule_id", F.xxhash64("tokens"))
    shorter = rules.select(F.col("tokens").alias("part"), F.col("n_tokens").alias("n_part"), F.col("confidence").alias("sure"), F.explode("tokens").alias("token"))
    inside = rules.withColumn("token", F.explode("tokens")).join(shorter, "token").where((F.col("n_part") < F.col("n_tokens")) & (F.col("sure") >= F.col("confidence")))
    redundant = inside.groupBy("rule_id", "n_part", "part").count().where(F.col("count") == F.col("n_part")).select("rule_id").distinct()
    return rules.join(redundant, "rule_id", "left_anti").select("rule_id", "tokens", "n_tokens", "confidence", "support")


def matched(urls: DataFrame, rules: DataFrame, literal_rules: int = LITERAL_RULES) -> DataFrame:
    """urls (with tokens) plus mined: whether some rule's tokens are all among the URL's."""
    listed = rules.limit(literal_rules + 1).collect()
    if not listed:
        return urls.withColumn("mined", F.lit(False))
    if len(listed) <= literal_rules:
        index: dict[str, list[int]] = {}
        for k, rule in enumerate(listed):
            for token in rule["tokens"]:
                index.setdefault(token, []).append(k)
        postings = F.create_map(*[x for token, ids in sorted(index.items()) for x in (F.lit(token), F.array(*map(F.lit, ids)))])
        sizes = F.array(*[F.lit(rule["n_tokens"]) for rule in listed])
        hits = F.flatten(F.transform("tokens", lambda t: F.coalesce(F.element_at(postings, t), F.array().cast("array<int>"))))
        found = urls.withColumn("_hits", hits)
        full = F.exists(F.array_distinct("_hits"), lambda k: F.size(F.filter("_hits", lambda h: h == k)) == F.get(sizes, k))
        return found.withColumn("mined", full).drop("_hits")
    # One row per distinct set of tokens, so a common URL shape meets the index once.
    shapes = urls.select(F.array_sort("tokens").alias("shape")).distinct()
    hits = shapes.withColumn("token", F.explode("shape")).join(rules.select("rule_id", "n_tokens", F.explode("tokens").alias("token")), "token")
    full = hits.groupBy("shape", "rule_id", "n_tokens").count().where(F.col("count") == F.col("n_tokens")).select("shape").distinct()
    return urls.withColumn("shape", F.array_sort("tokens")).join(full.withColumn("mined", F.lit(True)), "shape", "left").withColumn("mined", F.coalesce("mined", F.lit(False))).drop("shape")


def judge(pages: DataFrame, bad_ids: DataFrame, rules: tuple = RULES, **mining: float) -> DataFrame:
    """page_id, host, path, rule, verdict, mined of every row of pages.

    bad_ids (page_id, bad) labels some pages; rules are the written rules.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    labelled = urls.join(bad_ids.select(F.col("page_id").alias("labelled_id"), "bad"), F.col("page_id") == F.col("labelled_id")).select("labelled_id", "tokens", "bad")
    judged = matched(urls, written(mine(written(labelled, "labelled-urls"), **mining), "url-rules"))
    name, verdict = written_rule(F.col("host"), F.col("path"), rules)
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined")
