"""Passages that repeat across documents, with a class for each.

Paragraphs (lines) with enough words are compared by MinHash: bands tuned for
high recall bring candidates together, exact Jaccard similarity over word
shingles settles them, and components of the links are the classes.

A passage may also repeat inside paragraphs that differ around it. So every
window of min_words words is a paragraph too, with one MinHash for a band:
equal windows have it in common, always, and neighbouring windows mostly share
theirs, so a text has about one row for each eight words. Windows around hashes
that several documents share, with half of the other words on one side, are
verified: all their words must be equal. The first document that has a window
keeps it. A passage's ends are exact, and what
is removed stands in an earlier document. Windows that touch a removed
paragraph take no part, so no document is freed of a passage for the sake of
one that is removed itself.

Places count words: runs of anything but ASCII white space.

Defined cases: null text is empty; a repetition inside one document is none,
and rows of one doc_id are one document, whose places go with the row's text
(row is its hash); rows without a doc_id take no part and stay as they are;
other columns are ignored; the result has a row for each repeated passage and
none for clean documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .linking import attached, components, links, shared_buckets
from .shared import kept, scratch, text_or_empty, written
from .textgrams import distinct, mix, rolled, shingles, words

_U = np.uint64
_FACTOR = 0xA24BAED4963EE407
_INVERSE = pow(_FACTOR, -1, 2**64)
PLACE = ["doc_id", "row", "first_word"]
#: How often a hash may come again within min_words words before its places become one.
FEW = 4
SKETCH = "doc_id long, row long, first_word int, n_words int, f1 long, f2 long, bands array<long>, names array<long>, places array<int>, more array<int>, lefts array<int>, rights array<int>"


def tuned_bands(threshold: float, recall: float = 0.998, most: int = 64) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, whose bands find a pair at threshold with that recall in at most that many hashes."""
    best = (most, 1)
    for rows in range(1, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def minhashes(elements: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """k minima of each set under k hash functions; no set may be empty."""
    rng = np.random.default_rng(1234)
    out = np.empty((len(first) - 1, k), np.uint64)
    h, high = np.empty((2, len(elements)), np.uint64)
    for j, (a, b) in enumerate(rng.integers(0, 2**63, (k, 2), dtype=np.uint64)):
        np.multiply(elements, a | _U(1), out=h)
        h += b
        np.right_shift(h, _U(32), out=high)
        h ^= high
        out[:, j] = np.minimum.reduceat(h, first[:-1])
    return out


def row_of(text: Column) -> Column:
    return F.xxhash64(text)


def _texts(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), row_of(text).alias("row"), text.alias("text"))


def _parts(sizes: np.ndarray, chars: int = 1 << 20) -> Iterator[np.ndarray]:
    """Places of a batch's texts in stretches of about a million characters."""
    for own in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // chars)) + 1):
        if len(own):
            yield own


def _lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, each line's first word, each line's text, and each text's first word."""
    lines = [t.split("\n") for t in texts]
    count = np.array([len(x) for x in lines], np.int64)
    hashes, first = words([line for own in lines for line in own])
    return hashes, first, np.repeat(np.arange(len(texts)), count), first[np.concatenate(([0], np.cumsum(count)))]


def _paragraph_sets(hashes: np.ndarray, first: np.ndarray, keep: np.ndarray, n: int):
    size = np.diff(first)[keep]
    own = np.repeat(first[:-1][keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return distinct(*shingles(hashes[own], np.concatenate(([0], np.cumsum(size))), n))


def _slide(values: np.ndarray, n: int, best) -> np.ndarray:
    """best of every n neighbours, by doubling; one entry for each first of them."""
    done = 1
    while done < n:
        step = min(done, n - done)
        values = best(values[: len(values) - step], values[step:])
        done += step
    return values


def window_hashes(hashes: np.ndarray, first: np.ndarray, n: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The places and names of the shingles that are the MinHash of some window of min_words words inside a text."""
    span = min_words - n + 1
    named = rolled(hashes, n)
    if len(named) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    named[named == 0] = 1
    least = _slide(named, span, np.minimum)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(least))
    least = np.where(text[at] == text[at + min_words - 1], least, _U(0))
    # A shingle is chosen where it is the least of some window that holds it.
    around = np.concatenate((np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)))
    places = np.flatnonzero(_slide(around, span, np.maximum) == named)
    return places, named[places]


def sketches(docs: DataFrame, n: int = 5, min_words: int = 20, bands: int = 12, rows: int = 4) -> DataFrame:
    """For every paragraph its place, n_words, f1 and f2 (a name of its set of shingles) and bands; for what is left of a text one row without them.

    names are the MinHashes of windows that lie in the paragraph, from places
    to places + more; lefts and rights name them with the words beside them (0
    where there are none, 1 where places of one hash became one, as where words
    repeat with a short period).
    """
    side = (min_words - n + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids, of = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
            for own in _parts(np.array([len(t) for t in texts])):
                yield part(ids[own], of[own], texts[own[0] : own[-1] + 1])

    def part(ids: np.ndarray, of: np.ndarray, texts: list[str]) -> pa.RecordBatch:
        hashes, first, text, begins = _lines(texts)
        size = np.diff(first)
        keep = np.flatnonzero(size >= min_words)
        # Rows: the paragraphs in order, then what is left of each text.
        row_text = np.concatenate((text[keep], np.arange(len(texts))))
        row_first = np.concatenate((first[:-1][keep] - begins[:-1][text[keep]], np.zeros(len(texts), np.int64)))
        row_size = np.concatenate((size[keep], np.zeros(len(texts), np.int64)))
        f, band = np.zeros((2, len(keep)), np.int64), np.zeros((len(keep), bands), np.uint64)
        if len(keep):
            elements, at, _ = _paragraph_sets(hashes, first, keep, n)
            f = np.stack([np.add.reduceat(mix(elements ^ _U(s)), at[:-1]) for s in (1, 2)]).view(np.int64)
            least = minhashes(elements, at, bands * rows)
            for r in range(rows):
                band = mix(band + least[:, r::rows])
            band = mix(band + np.arange(bands, dtype=_U))
        places, names = window_hashes(hashes, begins, n, min_words)
        prefix = _prefix(hashes, 5)
        line = np.searchsorted(first, places, side="right") - 1
        row = np.full(len(size), -1)
        row[keep] = np.arange(len(keep))
        row = np.where(row[line] >= 0, row[line], len(keep) + text[line])
        order = np.argsort(row, kind="stable")
        row, places, names = row[order], places[order], names[order]
        # Where words repeat with a short period, one hash is chosen again and again: once is enough.
        new = np.ones(len(places), bool)
        new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1]) | (places[1:] - places[:-1] > min_words)
        start = np.flatnonzero(new)
        often = np.diff(np.append(start, len(places)))
        # A hash that comes again a few times keeps each of its places, with the words beside it.
        new |= np.repeat(often <= FEW, often)
        start = np.flatnonzero(new)
        last = np.append(start[1:], len(places)) - 1 if len(start) else start
        offsets = pa.array(np.searchsorted(row[start], np.arange(len(row_text) + 1)), pa.int32())
        again = places[last] > places[start]
        sides = []
        for a, b in ((places[start] - side, places[start] + n), (places[start], places[start] + n + side)):
            fits = (a >= begins[:-1][row_text[row[start]]]) & (b <= begins[1:][row_text[row[start]]])
            named = _between(*prefix, np.where(fits, a, 0), np.where(fits, b, 0)).astype(np.int32) | 2
            sides.append(np.where(again, 1, np.where(fits, named, 0)).astype(np.int32))
        inside = (places[start] - begins[:-1][row_text[row[start]]]).astype(np.int32)
        left = np.arange(len(row_text)) >= len(keep)
        listed = lambda x: pa.ListArray.from_arrays(offsets, pa.array(x))
        padded = lambda x: pa.array(np.concatenate((x, np.zeros(len(texts), np.int64))), pa.int64(), mask=left)
        band_ends = pa.array(np.minimum(np.arange(len(row_text) + 1), len(keep)) * bands, pa.int32())
        columns = [
            pa.array(ids[row_text]), pa.array(of[row_text]), pa.array(row_first.astype(np.int32)), pa.array(row_size.astype(np.int32)), padded(f[0]), padded(f[1]),
            pa.ListArray.from_arrays(band_ends, pa.array(band.view(np.int64).ravel())), listed(names[start].view(np.int64)), listed(inside), listed((places[last] - places[start]).astype(np.int32)), listed(sides[0]), listed(sides[1]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SKETCH.split(", ")])

    return _texts(docs).mapInArrow(run, SKETCH)


def paragraph_sets(docs: DataFrame, n: int = 5, min_words: int = 20) -> DataFrame:
    """doc_id, row, first_word and elements (distinct shingles) of every paragraph."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own in _parts(batch["text"].str.len().to_numpy(np.int64)):
                hashes, first, text, begins = _lines(batch["text"].iloc[own].tolist())
                keep = np.flatnonzero(np.diff(first) >= min_words)
                if len(keep):
                    elements, at, _ = _paragraph_sets(hashes, first, keep, n)
                    values, where = elements.view(np.int64), own[text[keep]]
                    yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[where], "row": batch["row"].to_numpy()[where], "first_word": first[:-1][keep] - begins[text[keep]], "elements": [values[at[k] : at[k + 1]] for k in range(len(keep))]})

    return docs.mapInPandas(run, "doc_id long, row long, first_word int, elements array<long>")


def paragraph_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5, min_words: int = 20, made: DataFrame | None = None) -> DataFrame:
    """doc_id, row, first_word, n_words, first (its class's first place) of every paragraph that another document has as well, exactly or nearly.

    made are the sketches, where they are there already.
    """
    bands, rows = tuned_bands(threshold)
    made = (written(sketches(docs, n, min_words, bands, rows), "sketches") if made is None else made).where("f1 is not null")
    # One row for each different set of shingles, with the first place that has it and a number of its own.
    place = F.struct(*PLACE)
    sets_of = made.groupBy("f1", "f2").agg(F.min(place).alias("place"), F.min_by("bands", place).alias("bands"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    sets_of = written(sets_of.withColumn("id", F.monotonically_increasing_id()), "paragraphs")
    members = written(shared_buckets(sets_of.select("id", F.explode("bands").alias("bucket"))), "shared")
    wanted = written(sets_of.join(members.select("id").distinct(), "id", "left_semi").select("id", "place.*"), "wanted")
    texts = _texts(docs).join(wanted.select("doc_id", "row").distinct().hint("merge"), ["doc_id", "row"], "left_semi").dropDuplicates(["doc_id", "row"])
    sets = written(paragraph_sets(texts, n, min_words).join(wanted, PLACE).select("id", "elements"), "sets")
    of = components(links(members, sets, threshold))
    named = sets_of.select("f1", "f2", "id", "place", "high", "n").join(of, "id", "left").withColumn("class", F.coalesce("component", "id"))
    across = named.groupBy("class").agg(F.min("place").alias("first"), F.max("high").alias("high"), F.count("*").alias("n")).where("first.doc_id <> high").drop("high")
    classed = attached(named.select("f1", "f2", F.col("n").alias("copies"), "class"), across, ["class"], sets_of.count())
    classed = written(classed.select("f1", "f2", F.col("copies").alias("n"), "first"), "classes")
    return attached(made.select(*PLACE, "n_words", "f1", "f2"), classed, ["f1", "f2"], made.count()).select(*PLACE, "n_words", "first")


def _prefix(hashes: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    power, back = (np.multiply.accumulate(np.concatenate(([_U(1)], np.full(len(hashes), f, np.uint64)))) for f in (_FACTOR, _INVERSE))
    return np.concatenate(([_U(0)], np.cumsum(mix(hashes ^ _U(salt)) * power[:-1]))), back


def _between(prefix: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of the words between starts and ends."""
    return mix((prefix[ends] - prefix[starts]) * back[starts]).view(np.int64)


def _covered(first: np.ndarray, begins: pd.Series, ends: pd.Series) -> np.ndarray:
    """Whether each word lies between some begin and end of its text."""
    change = np.zeros(first[-1] + 1, np.int64)
    for k, (begin, end) in enumerate(zip(begins, ends, strict=True)):
        np.add.at(change, np.clip(first[k] + np.asarray(begin, np.int64), first[k], first[k + 1]), 1)
        np.add.at(change, np.clip(first[k] + np.asarray(end, np.int64), first[k], first[k + 1]), -1)
    return np.cumsum(change[:-1]) > 0


def windows(docs: DataFrame, seeds: DataFrame, min_words: int) -> DataFrame:
    """doc_id, row, first_word, h1, h2 (a name of its words) of every window inside the seeds (doc_id, row, begin, end), and outside the stretches from low to high."""
    places = seeds.groupBy("doc_id", "row").agg(*[F.collect_list(c).alias(c) for c in ("begin", "end", "low", "high")]).where(F.size("begin") > 0)
    rows = _texts(docs).join(places.hint("merge"), ["doc_id", "row"]).dropDuplicates(["doc_id", "row"])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own in _parts(batch["text"].str.len().to_numpy(np.int64)):
                yield run(batch.iloc[own])

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        hashes, first = words(batch["text"].tolist())
        inside = _covered(first, batch["begin"], batch["end"]) & ~_covered(first, batch["low"], batch["high"])
        held = np.concatenate(([0], np.cumsum(inside)))
        doc = np.repeat(np.arange(len(batch)), np.diff(first))
        at = np.arange(max(0, len(hashes) - min_words + 1))
        at = at[(held[at + min_words] - held[at] == min_words) & (doc[at] == doc[at + min_words - 1])]
        names = [_between(*_prefix(hashes, salt), at, at + min_words) for salt in (3, 4)]
        return pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[doc[at]], "row": batch["row"].to_numpy()[doc[at]], "first_word": at - first[:-1][doc[at]], "h1": names[0], "h2": names[1]})

    return rows.mapInPandas(each, "doc_id long, row long, first_word int, h1 long, h2 long")


def _shared(rows: DataFrame, keys: list[str], *more: Column, told: DataFrame | None = None) -> DataFrame:
    """rows (with doc_id) whose keys several documents have, with more aggregates of their keys; told are the rows with only what these need."""
    common = (rows if told is None else told).groupBy(*keys).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"), *more).where("low <> high").drop("low", "high")
    common = written(common, "common")
    return attached(rows, common, keys, common.agg(F.sum("n")).first()[0] or 0)


def passage_classes(docs: DataFrame, n: int = 5, min_words: int = 20, made: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """doc_id, row, first_word, n_words, first (its class's first place) of every run of words of which each min_words words stand in another document as well.

    The first document that has a window keeps it; what it keeps in one run is
    a class, with the runs of other documents that stand in it. So each word of
    a run stands in an earlier document, or in its class's first. removed
    (doc_id, row, first_word, n_words) are paragraphs that are gone.
    """
    made = written(sketches(docs, n, min_words), "sketches") if made is None else made
    paragraphs = made.select("doc_id", "row", "first_word", "n_words", "names", "places", "more", "lefts", "rights").where(F.size("names") > 0)
    if removed is not None:
        paragraphs = paragraphs.join(removed.where("n_words > 0").select(*PLACE, "n_words"), [*PLACE, "n_words"], "left_anti")
    listed = ("names", "places", "more", "lefts", "rights")
    seeds = paragraphs.select("doc_id", "row", F.inline(F.arrays_zip(*listed)))
    told = paragraphs.select("doc_id", F.inline(F.arrays_zip("names", "lefts")))
    # Places that became one have no words beside them, so all that have their hash are looked at.
    found = written(_shared(seeds, ["names"], F.max(F.col("lefts") == 1).alias("all"), told=told), "seeds")
    # Of a window's other words, at least half (rounded up) stand on one side of its hash.
    side, rest = (min_words - n + 1) // 2, min_words - n
    beside = F.array(F.struct(F.lit(0).alias("side"), F.col("lefts").alias("h")), F.struct(F.lit(1).alias("side"), F.col("rights").alias("h")))
    sided = found.where("not all").withColumn("s", F.explode(beside)).select("doc_id", "row", "names", "places", "s.*").where("h <> 0")
    begin = F.col("places") - F.when(F.col("side") == 0, rest).otherwise(rest - side)
    end = F.col("places") + F.when(F.col("side") == 1, min_words).otherwise(min_words - side)
    sure = _shared(sided, ["names", "side", "h"]).select("doc_id", "row", begin.alias("begin"), end.alias("end"))
    found = sure.unionByName(found.where("all").select("doc_id", "row", (F.col("places") - rest).alias("begin"), (F.col("places") + F.col("more") + min_words).alias("end")))
    if removed is not None:
        gone = removed.select("doc_id", "row", F.col("first_word").alias("low"), (F.col("first_word") + F.col("n_words")).alias("high"))
        found = found.unionByName(gone, allowMissingColumns=True)
    else:
        found = found.withColumns({"low": F.lit(None).cast("int"), "high": F.lit(None).cast("int")})
    named = written(windows(docs, found, min_words), "windows")
    firsts = named.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("of"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("of.doc_id <> last").drop("last")
    firsts = written(firsts, "firsts")
    some = attached(named, firsts, ["h1", "h2"], named.count()).select(*PLACE, "of")
    same_row = (F.col("of.doc_id") == F.col("doc_id")) & (F.col("of.row") == F.col("row"))
    # A window that its own document has in another row first is that row's.
    some = some.where(same_row | (F.col("of.doc_id") != F.col("doc_id"))).withColumn("own", same_row)
    by_place = Window.partitionBy("doc_id", "row", "own").orderBy("first_word")
    before = lambda c: F.lag(c).over(by_place)
    next_word = F.col("first_word") == before("first_word") + 1
    next_of = (before("of.doc_id") == F.col("of.doc_id")) & (before("of.row") == F.col("of.row")) & (F.col("of.first_word") == before("of.first_word") + 1)
    new = ~(next_word & (F.col("own") | next_of))
    pieces = some.withColumn("piece", F.sum(F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).over(by_place)).groupBy("doc_id", "row", "own", "piece")
    # A piece's windows are those of one row, so its least place is that of the least word.
    of = F.struct(*[F.min(f"of.{c}").alias(c) for c in PLACE])
    pieces = written(pieces.agg(of.alias("of"), F.min("first_word").alias("low"), F.max("first_word").alias("high")).drop("piece"), "pieces")
    held = pieces.where("own").select("doc_id", "row", "low", "high", F.struct("doc_id", "row", F.col("low").alias("first_word")).alias("first"))
    runs = held.select(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row"), "low", "high").groupBy("of_doc", "of_row").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("runs"))
    # A document's kept runs are a list as long as it at most; each piece stands in one of them.
    other = pieces.where("not own").withColumns({"of_doc": F.col("of.doc_id"), "of_row": F.col("of.row"), "at": F.col("of.first_word")}).select("doc_id", "row", "low", "high", "of_doc", "of_row", "at")
    runs = runs.join(other.groupBy("of_doc", "of_row").agg(F.count("*").alias("n")), ["of_doc", "of_row"])
    other = attached(other, runs, ["of_doc", "of_row"], pieces.count()).withColumn("from", F.expr("array_max(transform(filter(runs, r -> r.low <= at), r -> r.low))"))
    other = other.select("doc_id", "row", "low", "high", F.struct(F.col("of_doc").alias("doc_id"), F.col("of_row").alias("row"), F.col("from").alias("first_word")).alias("first"))
    # Pieces of one class that meet are one run, as where words repeat inside it.
    by_class = Window.partitionBy("doc_id", "row", "first").orderBy("low", "high")
    until = F.max("high").over(by_class.rowsBetween(Window.unboundedPreceding, -1))
    other = other.withColumn("run", F.sum(F.when(F.col("low") <= until + 1, 0).otherwise(1)).over(by_class)).groupBy("doc_id", "row", "first", "run")
    spans = held.unionByName(other.agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("run"))
    return spans.select("doc_id", "row", F.col("low").alias("first_word"), (F.col("high") - F.col("low") + min_words).cast("int").alias("n_words"), "first")


def repeated_passages(docs: DataFrame, threshold: float = 0.8, n: int = 5, min_words: int = 20) -> DataFrame:
    """doc_id, row, kind (paragraph or passage), first_word, n_words, class_id and kept (whether it is its class's first) of every repeated passage."""
    is_first = F.struct(*PLACE) == F.col("first")
    with scratch():
        made = written(sketches(docs, n, min_words, *tuned_bands(threshold)), "sketches")
        with scratch():
            paragraph = kept(paragraph_classes(docs, threshold, n, min_words, made).withColumn("kept", is_first), "repeated")
        passage = kept(passage_classes(docs, n, min_words, made, paragraph.where("not kept")).withColumn("kept", is_first), "repeated")
    both = paragraph.withColumn("kind", F.lit("paragraph")).unionByName(passage.withColumn("kind", F.lit("passage")))
    class_id = F.concat_ws("-", "first.doc_id", F.hex("first.row"), "first.first_word")
    return both.select("doc_id", "row", "kind", F.col("first_word").cast("long").alias("first_word"), F.col("n_words").cast("long").alias("n_words"), class_id.alias("class_id"), "kept")


def without_repeats(docs: DataFrame, **options: float) -> DataFrame:
    """docs with `text` freed of every repeated passage but each class's first."""
    import re

    gone = repeated_passages(docs, **options).where("not kept").groupBy(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).agg(F.collect_list(F.struct("first_word", "n_words")).alias("_gone"))

    @F.pandas_udf("string")
    def freed(texts: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, places, strict=True):
            if text is None or own is None:
                out.append(text)
                continue
            spans = [m.span() for m in re.finditer(r"[^\x09-\x0d\x20]+", text)]
            drop = np.zeros(len(text) + 1, bool)
            for place in own:
                drop[spans[place["first_word"]][0] : spans[place["first_word"] + place["n_words"] - 1][1]] = True
            out.append("".join(c for c, d in zip(text, drop, strict=False) if not d))
        return pd.Series(out)

    same = (F.col("doc_id") == F.col("_doc")) & (row_of(text_or_empty()) == F.col("_row"))
    return docs.join(gone.hint("merge"), same, "left").withColumn("text", freed("text", "_gone")).select(*docs.columns)
