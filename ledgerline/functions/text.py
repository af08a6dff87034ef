"""Folding and words of texts, without Python on the hot path."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The function words that are never indexed.
STOPWORDS = tuple(
    """
    about above after again against all am an and any are as at be because been
    before being below between both but by can cannot did do does doing down
    during each few for from further had has have having he her here hers him
    his how if in into is it its itself just me more most my no nor not of off
    on once only or other our ours out over own same she should so some such
    than that the their theirs them then there these they this those through to
    too under until up very was we were what when where which while who whom
    why will with you your yours
    """.split()
)
LEAST, MOST = 2, 32
_tables: dict[str, str] = {}


def _fold_tables() -> tuple[str, str, str]:
    """Characters of the basic plane that fold to one character, what to, and those that fold to several."""
    if not _tables:
        one, to, many = [], [], []
        for c in range(0x80, 0x10000):
            if 0xD800 <= c < 0xE000 or 0xAC00 <= c < 0xD7A4:
                continue
            left = "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if unicodedata.category(x) != "Mn")
            if len(left) == 1 and left != chr(c):
                one.append(chr(c))
                to.append(left)
            elif len(left) > 1:
                many.append(chr(c))
        _tables.update(one="".join(one), to="".join(to), many="".join(many))
    return _tables["one"], _tables["to"], _tables["many"]


def fold_text(text: str) -> str:
    """NFKD, without nonspacing marks, in lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn").lower()


def is_ascii(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\x7f]")


def fold(text: Column) -> Column:
    """fold_text of a text without characters that fold to several: by a table of single characters and one expression."""
    one, to, _ = _fold_tables()
    return F.when(is_ascii(text), F.lower(text)).otherwise(F.lower(F.regexp_replace(F.translate(text, one, to), r"\p{Mn}", "")))


def needs_wide_fold(text: Column) -> Column:
    """Whether a text has a character that fold can't do: one that folds to several, or lies beyond the basic plane or in Hangul."""
    several = F.length(F.translate(text, _fold_tables()[2], "")) < F.length(text)
    return ~is_ascii(text) & (several | text.rlike(r"[\x{ac00}-\x{d7a3}\x{10000}-\x{10ffff}]"))


def wide_fold(text: Column) -> Column:
    """As fold, for any text, by a vectorised function in Python."""

    @F.pandas_udf("string")
    def fold_any(texts: pd.Series) -> pd.Series:
        return texts.map(fold_text, na_action="ignore")

    return fold_any(text)


def words(folded: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """The distinct words of a folded text that can be indexed; longer ones are dropped, not cut."""
    # Words of ASCII letters and digits only, so length in characters is length in bytes.
    split = F.split(folded, "[^a-z0-9]+")
    sized = F.filter(split, lambda w: F.length(w).between(LEAST, MOST))
    return F.array_except(F.array_distinct(sized), F.array(*map(F.lit, stopwords)))
