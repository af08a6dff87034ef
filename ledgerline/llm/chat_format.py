"""Conversations of many layouts as canonical turns, and turns as training text with a loss mask.

A record is JSON text. Its nested field paths, hashed, are its schema
fingerprint; a registry of declarative mappings, keyed by fingerprint, says
which paths hold which turns. The template marks turns with control strings;
control strings inside roles and texts are escaped reversibly.

Defined cases: null text and null role are empty; records of an unknown layout
or that are not JSON keep their row, with a fingerprint (null if not JSON) and
null turns, and so do records whose list of turns is none or has entries that
are no objects; a text or role that is a number, a list or the like is its
JSON; an empty list of turns gives an empty text.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class One:
    """One turn of a fixed role: the texts at its paths, joined by a line break where several aren't empty. None where the record has none of the paths."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Many:
    """A turn for each entry of the list at path, with the role and text at the entry's own paths."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns, in order.

    required and optional are the record's field paths, with dots between keys
    and `[]` for the entries of a list; roles renames roles.
    """

    name: str
    required: tuple[str, ...]
    turns: tuple[One | Many, ...]
    optional: tuple[str, ...] = ()
    roles: dict = field(default_factory=dict)

    def fingerprints(self) -> list[str]:
        chosen = itertools.chain.from_iterable(itertools.combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [fingerprint_of({*self.required, *some}) for some in chosen]


def paths(value: object, at: str = "") -> set[str]:
    """The nested field paths of a JSON value."""
    if isinstance(value, dict):
        return set().union(*({f"{at}.{k}".lstrip(".")} | paths(v, f"{at}.{k}".lstrip(".")) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union({f"{at}[]"}, *(paths(v, f"{at}[]") for v in value)) if value else set()
    return set()


def fingerprint_of(field_paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(field_paths)).encode()).hexdigest()


def _entries(path: str, *keys: str) -> tuple[str, ...]:
    return (f"{path}[]", *(f"{path}[].{k}" for k in keys))


MAPPINGS = (
    Mapping("messages", ("messages",), (Many("messages", "role", "content"),), (*_entries("messages", "role", "content"), "id")),
    Mapping("conversations", ("conversations",), (Many("conversations", "from", "value"),), (*_entries("conversations", "from", "value"), "id"), {"human": "user", "gpt": "assistant"}),
    Mapping("prompt", ("prompt", "response"), (One("system", ("system",)), One("user", ("prompt",)), One("assistant", ("response",))), ("system", "id")),
    Mapping("completion", ("prompt", "completion"), (One("user", ("prompt",)), One("assistant", ("completion",))), ("id",)),
    Mapping("instruction", ("instruction", "output"), (One("system", ("system",)), One("user", ("instruction", "input")), One("assistant", ("output",))), ("system", "input", "id")),
    Mapping("request", ("request", "request.messages", "response", "response.text"), (Many("request.messages", "role", "content"), One("assistant", ("response.text",))), (*_entries("request.messages", "role", "content"), "id")),
)

_ABSENT = object()


def _at(value: object, path: str) -> object:
    for key in path.split("."):
        if not isinstance(value, dict) or key not in value:
            return _ABSENT
        value = value[key]
    return value


def _text(value: object) -> str:
    """A text as it is, null or absent as empty, anything else as its JSON."""
    if isinstance(value, str):
        return value
    return "" if value is None or value is _ABSENT else json.dumps(value, ensure_ascii=False)


def _turns(record: object, mapping: Mapping) -> list[dict] | None:
    """The turns of a record, None where it hasn't the shape that its layout's mapping needs."""
    out = []
    for spec in mapping.turns:
        if isinstance(spec, Many):
            entries = _at(record, spec.path)
            if not isinstance(entries, list) or not all(isinstance(e, dict) for e in entries):
                return None
            for entry in entries:
                role = _text(_at(entry, spec.role))
                out.append({"role": mapping.roles.get(role, role), "text": _text(_at(entry, spec.text))})
        else:
            values = [v for v in (_at(record, p) for p in spec.paths) if v is not _ABSENT]
            if values:
                out.append({"role": spec.role, "text": "\n".join(x for x in map(_text, values) if x)})
    return out


def canonical_turns(records: DataFrame, raw: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """records with fingerprint, layout and turns of the JSON text in column raw; columns of these names are replaced."""
    registry = {f: m for m in mappings for f in m.fingerprints()}

    @F.pandas_udf(f"fingerprint string, layout string, turns {TURNS}")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            try:
                record = json.loads(text)
            except (TypeError, ValueError):
                rows.append((None, None, None))
                continue
            found = fingerprint_of(paths(record))
            mapping = registry.get(found)
            rows.append((found, mapping and mapping.name, mapping and _turns(record, mapping)))
        return pd.DataFrame(rows, columns=["fingerprint", "layout", "turns"])

    told = records.drop(*({"fingerprint", "layout", "turns"} - {raw})).withColumn("_read", read(F.col(raw)))
    return told.select("*", "_read.fingerprint", "_read.layout", "_read.turns").drop("_read")


@dataclass(frozen=True)
class Template:
    """Control strings around a turn, others to escape as well, and the roles whose text is learnt."""

    begin: str = "<|turn|>"
    middle: str = "<|text|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    learnt: tuple[str, ...] = ("assistant",)

    @property
    def escaped(self) -> tuple[str, ...]:
        return (self.begin, self.middle, self.end, *self.controls)


def escape(text: Column, template: Template) -> Column:
    """Backslashes doubled, and one backslash put after the first sign of every control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.escaped:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: str) -> str:
    """What escape was given. Doubled backslashes become one, single ones go."""
    return "\\".join(part.replace("\\", "") for part in text.split("\\\\"))


def render(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conversations (with turns) plus formatted, the training text, and loss_spans, where in it (code points) the learnt texts are."""
    role, text = (lambda t: escape(F.coalesce(t["role"], F.lit("")), template)), (lambda t: escape(F.coalesce(t["text"], F.lit("")), template))
    parts = F.transform("turns", lambda t: F.struct(F.concat(F.lit(template.begin), role(t), F.lit(template.middle)).alias("head"), text(t).alias("text"), F.coalesce(t["role"], F.lit("")).isin(*template.learnt).alias("learnt")))
    shown = conversations.withColumn("_parts", parts)
    formatted = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["text"], F.lit(template.end))), "")
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def add(found: Column, p: Column) -> Column:
        start = found["at"] + F.length(p["head"])
        end = start + F.length(p["text"])
        spans = F.when(p["learnt"], F.concat(found["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(found["spans"])
        return F.struct((end + len(template.end)).alias("at"), spans.alias("spans"))

    spans = F.aggregate("_parts", none, add, lambda found: found["spans"])
    return shown.withColumns({"formatted": formatted, "loss_spans": spans}).drop("_parts")


def parse(formatted: str, template: Template = Template()) -> list[tuple[str, str]]:
    """The (role, text) turns that a formatted text was made of."""
    turns = []
    for turn in formatted.split(template.end)[:-1]:
        role, _, text = turn.removeprefix(template.begin).partition(template.middle)
        turns.append((unescape(role), unescape(text)))
    return turns


def read_back(shown: DataFrame, key: str, template: Template = Template()) -> DataFrame:
    """Digests of turns and of the text under the loss mask, from formatted and loss_spans alone."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for own, formatted, spans in zip(rows[key], rows["formatted"], rows["loss_spans"], strict=True):
                turns = parse(formatted, template)
                whole, learnt, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, text in turns:
                    whole.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                for span in spans:
                    text = unescape(formatted[span["start"] : span["end"]])
                    learnt.update(text.encode("utf-8", "replace"))
                    chars += len(text)
                out.append((None if pd.isna(own) else int(own), len(turns), whole.hexdigest(), chars, learnt.hexdigest(), len(formatted)))
            yield pd.DataFrame(out, columns=[key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({key: "Int64"})

    return shown.select(F.col(key).cast("string").alias(key), "formatted", "loss_spans").mapInPandas(digest, f"{key} long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
