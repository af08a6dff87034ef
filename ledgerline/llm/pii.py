"""Personal data in whole texts, with DataFrame functions only.

Regular expressions propose spans, checksums and ranges settle them (Luhn for
cards, mod-97 for account numbers, 0 to 255 for addresses, digit counts for
phones), and words close to a span move its score. Offsets count code points;
ends are exclusive.

Defined cases: null text is empty and has no spans; kinds may overlap one
another; spans of one kind don't overlap; a match that fails its test is
dropped and nothing inside it is tried again; other columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_or_empty

#: What must be near for a match to begin, so that one pass over the text is enough: at the end of the last match, or where a run begins.
#: Possessive quantifiers keep matching iterative and linear on very long texts.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A whole run of digits, single blanks and hyphens between them allowed, with 13 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b"
BYTE = "^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
#: Code points on either side of a span in which context words count.
NEAR = 40


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)
    # 2 * d with its digits added, for every second digit from the right.
    doubled = F.translate(back, "0123456789", "0246813579")
    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(places, F.lit(0), lambda s, i: s + F.when(i % 2 == 1, F.substring(back, i, F.lit(1))).otherwise(F.substring(doubled, i, F.lit(1))).cast("int"))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without blanks passes the mod-97 test of ISO 7064."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    signs = F.split(turned, "(?<=.)(?=.)")
    return F.aggregate(
        F.transform(signs, lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)),
        F.lit(0),
        lambda rest, n: (rest * F.when(n > 9, 100).otherwise(10) + n) % 97,
    ) == 1


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: where it may be, which matches count, and what a match is worth."""

    name: str
    pattern: str
    holds: object  # Column -> Column
    score: float
    context: tuple[str, ...]


def _four_bytes(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda part: part.rlike(BYTE))


def _digit_count(least: int, most: int):
    return lambda match: F.length(digits_of(match)).between(least, most)


BASE = (
    Kind("email", EMAIL, lambda m: F.lit(True), 0.8, ("mail", "e-mail", "contact", "write", "from", "to")),
    Kind("ip", IP, _four_bytes, 0.5, ("ip", "address", "host", "server", "client", "login")),
    Kind("card", CARD, lambda m: luhn(digits_of(m)), 0.7, ("card", "credit", "visa", "mastercard", "amex", "payment", "paid")),
    Kind("phone", PHONE, _digit_count(9, 15), 0.6, ("phone", "tel", "call", "mobile", "fax", "whatsapp", "number")),
)
ADDED = (Kind("iban", IBAN, lambda m: mod97(F.replace(m, F.lit(" "), F.lit(""))), 0.9, ("iban", "account", "bank", "transfer")),)
SPAN = "struct<kind:string,start:long,end:long,text:string,score:double>"


def spans_of(text: Column, kind: Kind) -> Column:
    """All spans of a kind in a text, in order.

    The text's parts between the matches and the matches themselves come from
    two passes of the same expression; adding up their lengths gives offsets.
    """
    between = F.split(text, kind.pattern, -1)
    parts = F.arrays_zip(between.alias("before"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match"), F.slice(between, F.lit(2), F.size(between)).alias("after"))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    near_word = r"(?i)(?<![a-z])(?:" + "|".join(kind.context) + r")(?![a-z])"

    def add(found: Column, part: Column) -> Column:
        start = found["at"] + F.length(part["before"])
        end = start + F.length(part["match"])
        near = F.right(part["before"], F.lit(NEAR)).rlike(near_word) | F.left(F.coalesce(part["after"], F.lit("")), F.lit(NEAR)).rlike(near_word)
        score = F.lit(kind.score) + F.when(near, 0.1).otherwise(0.0)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), part["match"].alias("text"), score.alias("score"))
        spans = F.when(kind.holds(part["match"]), F.concat(found["spans"], F.array(span))).otherwise(found["spans"])
        return F.when(part["match"].isNull(), found).otherwise(F.struct(end.alias("at"), spans.alias("spans")))

    every = F.aggregate(parts, nothing, add, lambda found: found["spans"])
    return F.when(text.rlike(kind.pattern), every).otherwise(F.array().cast(f"array<{SPAN}>"))


def find(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = BASE + ADDED) -> DataFrame:
    """docs with a column `pii`: every span of every kind, by kind as listed, then by start."""
    value = text_or_empty(text)
    return docs.withColumn("pii", F.concat(*[spans_of(value, kind) for kind in kinds]))


def redact(docs: DataFrame, text: str = "text", least_score: float = 0.0) -> DataFrame:
    """docs with `redacted`: the text with every span of at least that score written as its kind in brackets, the first of overlapping spans winning."""
    found = find(docs, text)
    ordered = F.array_sort(F.filter("pii", lambda s: s["score"] >= least_score), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(b["end"] - a["end"]).cast("int"))
    value = text_or_empty(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(done: Column, span: Column) -> Column:
        gap = F.substring(value, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.when(span["start"] < done["at"], done).otherwise(F.struct(span["end"].alias("at"), F.concat(done["out"], gap, F.lit("["), span["kind"], F.lit("]")).alias("out")))

    whole = F.aggregate(ordered, start, add, lambda done: F.concat(done["out"], F.substring(value, (done["at"] + 1).cast("int"), F.length(value))))
    return found.withColumn("redacted", whole)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counts_by_kind(spans: Column, kinds: tuple[Kind, ...] = BASE) -> list[Column]:
    def number(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return [number(kind.name) for kind in kinds]


def is_base(span: Column) -> Column:
    return reduce(lambda a, b: a | b, [span["kind"] == kind.name for kind in BASE])
