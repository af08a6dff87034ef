"""Changes of vocabulary and shape across records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def migrate_text(text: Column, replacements: Sequence[tuple[str, str]]) -> Column:
    """Phrases replaced one after another: an earlier replacement's result is a later one's text."""
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), replacements, text)


def migrate_columns(rows: DataFrame, columns: Sequence[str], replacements: Sequence[tuple[str, str]]) -> DataFrame:
    """migrate_text over the named columns; inside arrays of text as well."""
    out = {}
    for c in columns:
        array = dict(rows.dtypes)[c].startswith("array")
        out[c] = F.transform(c, lambda t: migrate_text(t, replacements)) if array else migrate_text(F.col(c), replacements)
    return rows.withColumns(out)


def migrate_enum(value: Column, mapping: dict[str, str]) -> Column:
    """A value by its mapping; others stay."""
    return reduce(lambda rest, pair: F.when(value == pair[0], pair[1]).otherwise(rest), mapping.items(), value)


def rebind(rows: DataFrame, suffix: str, pairs: DataFrame) -> DataFrame:
    """Every column with that suffix with old values replaced by new ones (pairs: old, new)."""
    for c in [c for c in rows.columns if c.endswith(suffix)]:
        rows = rows.join(pairs.select(F.col("old").alias(c), F.col("new").alias("_new")), c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return rows


def merge_manifests(runs: DataFrame, key: str) -> DataFrame:
    """Per key the first run's old values and the last run's new ones (columns old_*, new_*, run)."""
    old, new = ([c for c in runs.columns if c.startswith(p)] for p in ("old_", "new_"))
    return runs.groupBy(key).agg(*[F.min_by(c, "run").alias(c) for c in old], *[F.max_by(c, "run").alias(c) for c in new])
