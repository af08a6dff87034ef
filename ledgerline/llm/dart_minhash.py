"""Near-duplicate documents by DartMinHash signatures of their word shingles.

Darts are thrown, by hashing alone, at the plane of elements and weights: each
unit of an element's weight receives a Poisson stream of darts in time, each
with a coordinate. A document keeps the earliest dart of every coordinate
among those that land inside its elements' weights, so two documents agree in
a coordinate with the probability of their weighted Jaccard similarity. Only
about k ln k darts are made for a document, however long it is.

Signatures are banded; documents that share a band are compared exactly.

Defined cases: null text is empty; texts without a word are in no class but
their own; copies share a class whatever their number; rows of one doc_id are
judged each by its own text, and only those of its first text can stand for a
class; rows without a doc_id take no part, have a null class and are kept;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linking import attached, components, links, shared_buckets
from .shared import kept, scratch, text_or_empty, written
from .textgrams import distinct, mix, shingles, words

_U = np.uint64
#: 16 bands of 4: a pair at 0.8 is missed by all of them with probability 0.00023.
BANDS, ROWS = 16, 4


def dart_signatures(elements: np.ndarray, first: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """k darts (64-bit names) for each set; weights are of the elements, which are distinct in a set and none of them empty."""
    n = len(first) - 1
    out = np.zeros((n, k), np.uint64)
    todo, factor = np.arange(n), 1.0
    while len(todo):
        own = np.concatenate([np.arange(first[d], first[d + 1]) for d in todo])
        each = np.diff(first)[todo]
        here = np.concatenate(([0], np.cumsum(each)))
        names, full = _throw(elements[own], here, weights[own], k, factor)
        out[todo] = names
        todo, factor = todo[~full], factor * 2
    return out


def _throw(elements: np.ndarray, first: np.ndarray, weights: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """The earliest dart of each coordinate, and which sets have one for all, among about factor * k (ln k + 3) darts a set."""
    n = len(first) - 1
    total = np.add.reduceat(weights, first[:-1])
    until = factor * k * (np.log(k) + 3) / total
    # One cell for each started unit of weight; the last one of an element may be lower than 1.
    layers = np.ceil(weights).astype(np.int64)
    element = np.repeat(np.arange(len(elements)), layers)
    layer = np.arange(len(element)) - np.repeat(np.cumsum(layers) - layers, layers)
    height = np.minimum(1.0, weights[element] - layer)
    cell = mix(elements[element] + layer.astype(np.uint64) * _U(0xA0761D6478BD642F))
    owner = np.repeat(np.arange(n), np.diff(first))[element]
    at, turn = np.zeros(len(cell)), 0
    darts, owners, times = [], [], []
    while len(cell):
        turn += 1
        dart = mix(cell ^ _U(turn * 0xE7037ED1A0B428DB % 2**64))
        wait = (dart >> _U(11)).astype(np.float64) * 2.0**-53
        limit = until[owner] - at
        soon = wait > np.exp(-np.minimum(limit, 700))  # waiting times are -ln(u); this spares the logarithm of most
        cell, owner, height, dart = cell[soon], owner[soon], height[soon], dart[soon]
        at = at[soon] - np.log(wait[soon])
        inside = (mix(dart ^ _U(0x8EBC6AF09C88C6E3)) >> _U(11)).astype(np.float64) * 2.0**-53 < height
        darts.append(dart[inside])
        owners.append(owner[inside])
        times.append(at[inside])
    darts, owners, times = np.concatenate(darts), np.concatenate(owners), np.concatenate(times)
    place = owners * k + (mix(darts) % _U(k)).astype(np.int64)
    late_first = np.argsort(-times, kind="stable")
    names = np.zeros(n * k, np.uint64)
    names[place[late_first]] = darts[late_first] | _U(1)  # of several darts in a place the last written, the earliest, stays
    names = names.reshape(n, k)
    return names, (names != 0).all(1)


def _sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, first = words(texts)
    return distinct(*shingles(hashes, first, n))


def _stretches(batch: pd.DataFrame, chars: int = 1 << 20) -> Iterator[pd.DataFrame]:
    sizes = np.cumsum(batch["text"].str.len().to_numpy(np.int64))
    for part in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(sizes // chars)) + 1):
        if len(part):
            yield batch.iloc[part]


def row_of(text: Column) -> Column:
    """Names a row among those of its doc_id."""
    return F.xxhash64(text)


def _rows(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_of(text).alias("row"), text.alias("text"))


def sketches(docs: DataFrame, n: int = 5, bands: int = BANDS, rows: int = ROWS, weighted: bool = True) -> DataFrame:
    """doc_id, row, f1, f2 (a name of the set; null where it is empty) and the hashes of its bands, for every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _stretches(batch):
                elements, first, counts = _sets(part["text"].tolist(), n)
                size = np.diff(first)
                some = np.flatnonzero(size)
                f1, f2, band = np.full(len(part), None, object), np.full(len(part), None, object), [[]] * len(part)
                if len(some):
                    starts = first[:-1][some]
                    named = mix(elements + mix(counts.astype(np.uint64))) if weighted else elements
                    f1[some] = np.add.reduceat(mix(named ^ _U(1)), starts).view(np.int64)
                    f2[some] = np.add.reduceat(mix(named ^ _U(2)), starts).view(np.int64)
                    whole = np.append(starts, first[-1])
                    darts = dart_signatures(elements, whole, counts.astype(np.float64) if weighted else np.ones(len(elements)), bands * rows)
                    hashed = np.zeros((len(some), bands), np.uint64)
                    for r in range(rows):
                        hashed = mix(hashed + darts[:, r::rows])
                    hashed = mix(hashed + np.arange(bands, dtype=np.uint64))
                    for k, own in zip(some.tolist(), hashed.view(np.int64), strict=True):
                        band[k] = own
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "row": part["row"].to_numpy(), "f1": pd.array(f1, "Int64"), "f2": pd.array(f2, "Int64"), "bands": band})

    rows_in = _rows(docs).withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows_in.mapInPandas(run, "doc_id string, row long, f1 long, f2 long, bands array<long>").withColumn("doc_id", F.col("doc_id").cast("long"))


def shingle_sets(texts: DataFrame, n: int = 5, weighted: bool = True) -> DataFrame:
    """id and elements of every row of texts (id, text): distinct shingles (with weighted, a shingle's second and later occurrences are elements too)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _stretches(batch):
                elements, first, counts = _sets(part["text"].tolist(), n)
                if weighted:
                    owner = np.repeat(np.arange(len(part)), np.diff(first))
                    again = np.repeat(np.arange(len(elements)), counts)
                    nth = np.arange(len(again)) - np.repeat(np.cumsum(counts) - counts, counts)
                    elements = mix(elements[again] + nth.astype(np.uint64))
                    first = np.concatenate(([0], np.cumsum(np.bincount(owner[again], minlength=len(part)))))
                values = elements.view(np.int64)
                yield pd.DataFrame({"id": part["id"].to_numpy(), "elements": [values[first[k] : first[k + 1]] for k in range(len(part))]})

    return texts.select("id", "text").mapInPandas(run, "id long, elements array<long>")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5, weighted: bool = True) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class), row (names the row's text) and kept of every row.

    Texts whose weighted Jaccard similarity over shingles of n words is at
    least threshold are linked; classes are the components. A shingle weighs
    as often as it occurs; with weighted off every distinct one weighs 1.
    kept is whether the row has the text that stands for its class.
    """
    place = F.struct("doc_id", "row")
    in_class = F.col("f1").isNotNull() & F.col("doc_id").isNotNull()
    with scratch():
        made = written(sketches(docs, n, weighted=weighted), "sketches")
        with scratch():
            texts = made.where(in_class).groupBy("f1", "f2").agg(F.min(place).alias("place"), F.min_by("bands", place).alias("bands"), F.count("*").alias("n"))
            texts = written(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
            members = written(shared_buckets(texts.select("id", F.explode("bands").alias("bucket"))), "shared")
            wanted = texts.join(members.select("id").distinct(), "id", "left_semi").select("id", "place.*")
            own = _rows(docs).join(wanted.hint("merge"), ["doc_id", "row"]).dropDuplicates(["doc_id", "row"])
            found = components(links(members, written(shingle_sets(own, n, weighted), "sets"), threshold))
            named = texts.select("f1", "f2", "id", "place", "n").join(found, "id", "left").withColumn("class", F.coalesce("component", "id"))
            firsts = written(named.groupBy("class").agg(F.min("place").alias("first"), F.count("*").alias("n")), "firsts")
            classed = attached(named.select("f1", "f2", F.col("n").alias("copies"), "class"), firsts, ["class"], texts.count())
            classed = kept(classed.select("f1", "f2", "first", F.col("copies").alias("n")), "classes")
        rows = attached(made.where(in_class).select("doc_id", "row", "f1", "f2"), classed, ["f1", "f2"], made.count())
        rows = rows.select("doc_id", F.col("first.doc_id").alias("class_id"), "row", (place == F.col("first")).alias("kept"))
        alone = made.where(~in_class).select("doc_id", F.col("doc_id").alias("class_id"), "row", F.lit(True).alias("kept"))
        return kept(rows.unionByName(alone), "near-duplicates")


def deduplicated(docs: DataFrame, **options: object) -> DataFrame:
    """docs with one row of each class, of its smallest doc_id; of rows that repeat (one doc_id, one text) one stays, and rows without a doc_id all do."""
    found = near_duplicates(docs, **options).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "kept")
    gone = found.where(~F.col("kept")).select("_doc", "_row").distinct()
    again = found.where(F.col("kept") & F.col("_doc").isNotNull()).groupBy("_doc", "_row").count().where("count > 1").select("_doc", "_row")
    same = (F.col("doc_id") == F.col("_doc")) & (row_of(text_or_empty()) == F.col("_row"))
    # Rows that repeat are merged where they are read, before they are shuffled.
    once = docs.join(again, same).dropDuplicates(["_doc", "_row"]).select(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.join(gone.unionByName(again).hint("merge"), same, "left_anti").unionByName(once)
