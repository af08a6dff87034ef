"""Runs: stretches of words that repeat with a period, found as maximal pairs in a tree of common prefixes.

Two places of one text whose following words agree for exactly k words, and
whose words before differ, are a maximal pair. If they lie p words apart and k
is at least twice p, the stretch from the first place to the end of the second
match has period p and no neighbouring word extends it. So every run is such a
pair, with p its period, and needs no extension.

A text's suffixes are sorted, and the intervals of its array of common prefixes
are gone through bottom-up. An interval holds the places of its suffixes in
classes by the word before them; joining two children forms pairs only between
classes of different words. Of all places of an interval only neighbours within
half the common prefix matter: a place between them would be a smaller period.
Prefixes shorter than two thirds of the least length can't carry a run, so
texts without a repeated window of that many words are done after one hash pass.

Defined cases: null text is empty; a text without words has no run and an empty
collapsed text; rows that repeat are judged each on its own; all columns are
kept but one named runs, which is replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textgrams import mix, words

_U = np.uint64
RUNS = "array<struct<start long, length long, period long>>"
#: Places in a block of a sorted list.
BLOCK = 1_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xA24BAED4963EE407
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def with_repeats(texts: list[str], window: int) -> np.ndarray:
    """Which texts hold a window of so many words twice; a clash of hashes only makes more work."""
    hashes, first = words(texts, lower=False)
    counts = np.diff(first)
    found = np.zeros(len(texts), bool)
    # Slices of texts of bounded size; a long text is a slice of its own.
    cuts = [0]
    for k in range(len(texts)):
        if first[k + 1] - first[cuts[-1]] > 1 << 19:
            cuts.append(k + 1)
    for a, b in zip(cuts, [*cuts[1:], len(texts)], strict=True):
        part, n = hashes[first[a] : first[b]], int(first[b] - first[a])
        if n < window:
            continue
        up, down = _powers(n + 1)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(part * up[:n], out=prefix[1:])
        at = np.arange(n - window + 1)
        owner = np.repeat(np.arange(a, b), counts[a:b])
        at = at[owner[at] == owner[at + window - 1]]
        own = owner[at]
        keys = mix(mix((prefix[at + window] - prefix[at]) * down[at]) ^ mix(own.astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        again = keys[order[1:]] == keys[order[:-1]]
        found[own[order[1:][again]]] = True
    return found


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ids in order, and how many words each has in common with the one before it (the first: 0)."""
    n = len(ids)
    ranks = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while step < n and ranks[-1].max() < n - 1:
        last = ranks[-1]
        second = np.zeros(n, np.int64)
        second[: n - step] = last[step:] + 1
        ranks.append(np.unique(last * (n + 1) + second, return_inverse=True)[1].astype(np.int64))
        step *= 2
    order = np.argsort(ranks[-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        rank = np.append(ranks[level], -1)
        same = (rank[np.minimum(left, n)] == rank[np.minimum(right, n)]) & (left < n) & (right < n)
        size = same.astype(np.int64) << level
        common += size
        left += size
        right += size
    return order, np.concatenate(([0], common))


class Places:
    """The places of an interval: in order, in blocks, and counted by class."""

    __slots__ = ("blocks", "firsts", "classes", "size")

    def __init__(self, place: int, before: int):
        self.blocks, self.firsts, self.classes, self.size = [[place]], [place], {before: 1}, 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def beside(self, place: int) -> tuple[int, int]:
        """The places next before and next after this one, -1 where there is none."""
        b = max(bisect_left(self.firsts, place) - 1, 0)
        block = self.blocks[b]
        k = bisect_left(block, place)
        after = block[k] if k < len(block) else self.firsts[b + 1] if b + 1 < len(self.blocks) else -1
        return (block[k - 1] if k else -1), after

    def add(self, place: int) -> None:
        b = max(bisect_left(self.firsts, place) - 1, 0)
        block = self.blocks[b]
        block.insert(bisect_left(block, place), place)
        self.firsts[b] = block[0]
        if len(block) > BLOCK:
            half = BLOCK // 2
            self.blocks[b : b + 1] = [block[:half], block[half:]]
            self.firsts[b : b + 1] = [block[0], block[half]]


def runs(ids: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least `least` words and `times` periods, by start and period; times is 3 or more."""
    n, shortest = len(ids), -(-least * (times - 1) // times)
    if n < least:
        return []
    order, common = suffixes(ids)
    before = np.concatenate(([-1], ids[:-1])).tolist()
    found: dict[tuple[int, int], int] = {}

    def paired(a: int, b: int, length: int) -> None:
        """Keeps the pair of places a < b that agree for exactly length words."""
        period = b - a
        if length >= (times - 1) * period and length + period >= least and before[a] != before[b]:
            stretch = (a, b + length)
            found[stretch] = min(period, found.get(stretch, period))

    def joined(one: Places, two: Places, length: int) -> Places:
        """Both children of an interval whose suffixes have length words in common."""
        if one.size < two.size:
            one, two = two, one
        # Pairs are formed between classes of different words only.
        if len(one.classes) > 1 or one.classes.keys() != two.classes.keys():
            for place in two:
                previous, following = one.beside(place)
                if previous >= 0:
                    paired(previous, place, length)
                if following >= 0:
                    paired(place, following, length)
        for place in two:
            one.add(place)
        for word, count in two.classes.items():
            one.classes[word] = one.classes.get(word, 0) + count
        one.size += two.size
        return one

    # Intervals of shorter prefixes are left out, so the tree falls into one for each block of suffixes.
    deep = np.flatnonzero(common >= shortest)
    if not len(deep):
        return []
    starts = np.flatnonzero(np.diff(deep, prepend=-2) > 1)
    for a, b in zip(starts, [*starts[1:], len(deep)], strict=True):
        places = order[deep[a] - 1 : deep[b - 1] + 1].tolist()
        lengths = common[deep[a] : deep[b - 1] + 1].tolist()
        stack: list[tuple[int, Places]] = []
        child = Places(places[0], before[places[0]])
        for place, length in zip(places[1:], lengths, strict=True):
            while stack and stack[-1][0] > length:
                own, group = stack.pop()
                child = joined(group, child, own)
            if stack and stack[-1][0] == length:
                stack[-1] = length, joined(stack[-1][1], child, length)
            else:
                stack.append((length, child))
            child = Places(place, before[place])
        while stack:
            own, group = stack.pop()
            child = joined(group, child, own)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """docs with runs (start, length, period by start and period, in words), and as text the words that no run holds after its first period, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found, kept = [], []
            for text, look in zip(texts, with_repeats(texts, -(-least * (times - 1) // times)), strict=True):
                own = text.encode("utf-8", "replace").split()
                number: dict[bytes, int] = {}
                here = runs(np.array([number.setdefault(w, len(number)) for w in own], np.int64), least, times) if look else []
                if here:
                    edge = np.zeros(len(own) + 1, np.int64)
                    for start, length, period in here:
                        edge[start + period] += 1
                        edge[start + length] -= 1
                    own = [own[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                found.append([{"start": s, "length": n, "period": p} for s, n, p in here])
                kept.append(b" ".join(own).decode())
            struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            made = {"text": pa.array(kept, pa.string()), "runs": pa.array(found, struct)}
            names = [*batch.schema.names, "runs"]
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names)

    names = [c for c in docs.columns if c.lower() != "runs"]
    # Plain names on the way, since others may hold dots.
    plain = ["text" if c.lower() == "text" else f"c{k}" for k, c in enumerate(names)]
    carried = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(names, plain, strict=True)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried.schema)
    return carried.mapInArrow(run, f"{schema}, runs {RUNS}").toDF(*names, "runs")


def strongest(runs: Column) -> Column:
    """The run of the greatest length against its period, exactly; the first of equal ones; null without a run."""
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast("struct<start long, length long, period long>"), lambda best, r: F.when(more(best, r), r).otherwise(best))
