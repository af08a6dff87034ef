"""Validation as one table of violations: row rules in one pass, set rules as aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.keys import strict_instant


@dataclass(frozen=True)
class Rule:
    """A row rule: what is broken where `broken`, a column or SQL text, holds (an unknown outcome counts as broken)."""

    name: str
    field: str
    broken: Column | str

    def holds(self) -> Column:
        return F.expr(self.broken) if isinstance(self.broken, str) else self.broken


def quoted(text: str) -> str:
    """Text as a literal of Spark's SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def required(field: str) -> Rule:
    return Rule("required", field, F.col(field).isNull())


def pattern(field: str, regex: str) -> Rule:
    return Rule("pattern", field, F.col(field).isNotNull() & ~F.col(field).rlike(f"^(?:{regex})$"))


def length(field: str, least: int, most: int) -> Rule:
    return Rule("length", field, F.col(field).isNotNull() & ~F.char_length(field).between(least, most))


def one_of(field: str, values: Sequence) -> Rule:
    return Rule("enum", field, F.col(field).isNotNull() & ~F.col(field).isin(*values))


def at_least(field: str, least: int) -> Rule:
    return Rule("minimum", field, F.col(field).isNotNull() & (F.col(field) < least))


def distinct_items(field: str) -> Rule:
    return Rule("unique", field, F.size(field) != F.size(F.array_distinct(field)))


def either(name: str, one: Column, other: Column) -> Rule:
    """Exactly one of two."""
    return Rule("either", name, one == other)


def validate(rows: DataFrame, entity: Column, rules: Sequence[Rule]) -> DataFrame:
    """entity, rule, field of every broken rule, in one projection."""
    checks = [F.when(F.coalesce(r.broken, F.lit(True)), F.struct(F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"))) for r in rules if not isinstance(r.broken, str)]
    # Rules in text are parsed together, so a hundred of them take the driver no longer than one.
    told = [f"case when coalesce({r.broken}, true) then named_struct('rule', {quoted(r.name)}, 'field', {quoted(r.field)}) end" for r in rules if isinstance(r.broken, str)]
    found = ([F.array(*checks)] if checks else []) + ([F.expr(f"array({', '.join(told)})")] if told else [])
    return rows.select(entity.alias("entity"), F.explode(F.array_compact(F.concat(*found) if len(found) > 1 else found[0])).alias("v")).select("entity", "v.rule", "v.field")


def refused(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rows, with an error on the first broken rule: the strict form of validate."""
    worst = reduce(lambda rest, r: F.when(F.coalesce(r.holds(), F.lit(True)), F.raise_error(F.lit(f"{r.name}: {r.field}")).cast("boolean")).otherwise(rest), reversed(list(rules)), F.lit(True))
    return rows.where(worst)


def strict_json(body: Column) -> Column:
    """Whether text is one JSON object without repeated keys (at any depth), NaN or infinities."""
    parsed = F.try_parse_json(body)
    return F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))


def closed_shape(body: Column, allowed: Sequence[str], needed: Sequence[str]) -> tuple[Column, Column]:
    """Keys of a JSON object that are not allowed, and needed ones that it lacks, both sorted and comma-joined."""
    keys = F.coalesce(F.json_object_keys(body), F.array().cast("array<string>"))
    named = lambda xs: F.array(*map(F.lit, xs))
    return F.array_join(F.array_sort(F.array_except(keys, named(allowed))), ","), F.array_join(F.array_sort(F.array_except(named(needed), keys)), ",")


#: The keys of a review document that may be shown, at its three levels.
REVIEW_KEYS = ("schema_version", "submission_id", "source", "mechanical_report", "policy_commit", "reviewed_at", "reviewer_models", "outcome", "summary", "requested_changes", "checks")
CHECK_KEYS = ("step", "outcome", "summary", "findings", "trust_level", "sources_checked", "codes_checked", "declarations_checked")
FINDING_KEYS = ("evidence", "message")


def public_allowlist(reviews: DataFrame, key: Sequence[str], body: str) -> DataFrame:
    """Keys (with their level) of review documents that are not to be shown."""
    named = lambda xs: F.array(*map(F.lit, xs))
    top = reviews.select(*key, F.explode(F.array_except(F.json_object_keys(body), named(REVIEW_KEYS))).alias("field"), F.lit("review").alias("level"))
    checks = reviews.select(*key, F.explode(F.from_json(F.get_json_object(body, "$.checks"), "array<string>")).alias("c"))
    middle = checks.select(*key, F.explode(F.array_except(F.json_object_keys("c"), named(CHECK_KEYS))).alias("field"), F.lit("check").alias("level"))
    findings = checks.select(*key, F.explode(F.from_json(F.get_json_object("c", "$.findings"), "array<string>")).alias("f"))
    low = findings.select(*key, F.explode(F.array_except(F.json_object_keys("f"), named(FINDING_KEYS))).alias("field"), F.lit("finding").alias("level"))
    return top.unionByName(middle).unionByName(low)


def score_reconcile(records: DataFrame, scores: DataFrame, key: str, bound: Sequence[str]) -> DataFrame:
    """Records without a score, scores without a record, and pairs whose bound fields differ."""
    s = scores.select(F.col(key).alias("_k"), *[F.col(b).alias(f"_{b}") for b in bound])
    joined = records.join(s, F.col(key).eqNullSafe(F.col("_k")), "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(b).eqNullSafe(F.col(f"_{b}")) for b in bound])
    rule = F.when(F.col("_k").isNull(), "missing").when(F.col(key).isNull(), "orphan").when(differs, "binding")
    return joined.select(F.coalesce(key, "_k").alias("entity"), rule.alias("rule")).where("rule is not null")


def bindings(rows: DataFrame, key: str, fields: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """One row for each named field whose actual value is not the expected one, null-safe."""
    named = F.array(*[F.struct(F.lit(n).alias("field"), a.cast("string").alias("actual"), e.cast("string").alias("expected")) for n, a, e in fields])
    return rows.select(key, F.explode(named).alias("b")).select(key, "b.*").where("not actual <=> expected")


def takedown_rules(takedowns: DataFrame, records: DataFrame, authorities: DataFrame) -> DataFrame:
    """Violations of withdrawals (id, version, taken_down_at text, login, issue, reason): row rules, authority, unique and existing targets."""
    entity = F.concat_ws("-v", "id", F.col("version").cast("string"))
    known = takedowns.withColumn("_login", F.lower(F.trim("login"))).join(authorities.select(F.lower("login").alias("_login"), F.col("login").alias("canonical")), "_login", "left")
    row = validate(known, entity, [
        at_least("version", 1), Rule("instant", "taken_down_at", ~strict_instant(F.col("taken_down_at"))), Rule("authority", "login", F.col("canonical").isNull()),
        at_least("issue", 1), length("reason", 1, 4000),
    ])
    repeated = takedowns.groupBy("id", "version").count().where("count > 1").select(entity.alias("entity"), F.lit("unique").alias("rule"), F.lit("target").alias("field"))
    absent = takedowns.join(records.select("id", "version"), ["id", "version"], "left_anti").select(entity.alias("entity"), F.lit("exists").alias("rule"), F.lit("target").alias("field"))
    return row.unionByName(repeated).unionByName(absent)


def ascending(rows: DataFrame, group: Sequence[str], order: Column, key: Column) -> DataFrame:
    """Rows whose key is not above the one before, in the given order. A group has to fit a task; contracts.out_of_order is for lists of any length."""
    before = F.lag(key).over(Window.partitionBy(*group).orderBy(order))
    return rows.withColumn("_before", before).where(F.col("_before").isNotNull() & ~(F.col("_before") < key)).drop("_before")


TAG = r"<(/?[a-zA-Z][a-zA-Z0-9]*)([^>]*)>"


def tag_stream(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, pos, tag (lower case, / for an end) and attributes of every tag outside comments.

    What a tag is, is the expression TAG, not a browser's parser.
    """
    clean = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?s)<!--.*?-->", "")
    tags = pages.select(key, F.posexplode(F.regexp_extract_all(clean, F.lit(TAG), F.lit(0))).alias("pos", "raw"))
    return tags.select(key, "pos", F.lower(F.regexp_extract("raw", TAG, 1)).alias("tag"), F.regexp_extract("raw", TAG, 2).alias("attributes"))


def html_tag_audit(tags: DataFrame, key: str, forbidden: Sequence[str]) -> DataFrame:
    """Counts per page and rule: forbidden elements, event attributes, script URLs, other than one head, scripts before the policy."""
    policy = F.min(F.when((F.col("tag") == "meta") & F.lower("attributes").contains("content-security-policy"), F.col("pos"))).over(Window.partitionBy(key))
    marked = tags.withColumn("policy", policy)
    counts = marked.groupBy(key).agg(
        F.count_if(F.col("tag").isin(*forbidden)).alias("forbidden"),
        F.count_if(F.col("attributes").rlike(r"(?i)\son[a-z]+\s*=")).alias("event"),
        F.count_if(F.col("attributes").rlike(r"(?i)(?:href|src)\s*=\s*[\"']?\s*javascript:")).alias("script_url"),
        F.count_if(F.col("tag") == "head").alias("heads"),
        F.count_if((F.col("tag") == "script") & (F.col("policy").isNull() | (F.col("pos") < F.col("policy")))).alias("unguarded"),
    )
    return counts
