"""Word hashes and word shingles of many texts at once, as numpy arrays.

A word's hash is a polynomial over its UTF-8 bytes, taken from prefix sums
modulo 2**64, so the cost is a few array passes over the bytes however many
words there are. Words are the runs of bytes between separators. Everything
here is a pure function of the text, the same on every executor.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_rng = np.random.default_rng(90210)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
#: Texts are hashed in stretches of about this many bytes, which bounds the memory of a task.
STRETCH = 1 << 19

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, STRETCH * 2)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stretches(blobs: list[bytes]):
    """(first text, text indices, bytes): whole texts together up to STRETCH, longer texts cut at white space."""
    group: list[tuple[int, bytes]] = []
    size = 0
    for k, blob in enumerate(blobs):
        while len(blob) > 2 * STRETCH:
            cut = max(blob.rfind(b" ", STRETCH, 2 * STRETCH), blob.rfind(b"\n", STRETCH, 2 * STRETCH))
            if cut < 0:
                after = [p for p in (blob.find(b" ", STRETCH), blob.find(b"\n", STRETCH)) if p >= 0]
                if not after:
                    break
                cut = min(after)
            group.append((k, blob[:cut]))
            blob = blob[cut:]
            yield group
            group, size = [], 0
        group.append((k, blob))
        size += len(blob) + 1
        if size >= STRETCH:
            yield group
            group, size = [], 0
    if group:
        yield group


def words(texts: list[str], lower: bool = True, separators: np.ndarray = _WHITE, with_spans: bool = False, kinds: bool = False):
    """Hashes of all words, and for each text the index of its first word (one entry more than texts).

    with_spans adds each word's first byte and end in its own (lower-cased)
    text; kinds makes runs of signs between words into words of their own.
    """
    blobs = [(t.lower() if lower else t).encode("utf-8", "replace") for t in texts]
    counts = np.zeros(len(blobs) + 1, np.int64)
    found, spans = [], []
    base_of = np.zeros(len(blobs) + 1, np.int64)
    for group in _stretches(blobs):
        raw = np.frombuffer(b" ".join(b for _, b in group) + b" ", np.uint8)
        up, down = _power_tables(len(raw) + 1)
        if kinds:
            kind = np.where(_WHITE[raw], 0, np.where(_NOT_WORD[raw], 2, 1)).astype(np.int8)
            change = np.flatnonzero(np.diff(np.concatenate(([0], kind))))
            starts = change[kind[change] != 0]
            after = np.searchsorted(change, starts, side="right")
            ends = change[after]
        else:
            inside = ~separators[raw]
            edge = np.diff(np.concatenate(([0], inside.astype(np.int8))))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[raw] * up[: len(raw)], out=prefix[1:])
        found.append(mix((prefix[ends] - prefix[starts]) * down[starts]))
        at = np.concatenate(([0], np.cumsum([len(b) + 1 for _, b in group])))
        own = np.array([k for k, _ in group])
        each = np.diff(np.searchsorted(starts, at))
        np.add.at(counts, own + 1, each)
        if with_spans:
            shift = np.repeat(at[:-1] - base_of[own], each)
            spans.append(np.stack((starts - shift, ends - shift)))
            np.add.at(base_of, own, [len(b) for _, b in group])
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    first = np.cumsum(counts)
    if with_spans:
        return hashes, first, np.concatenate(spans, axis=1) if spans else np.zeros((2, 0), np.int64)
    return hashes, first


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, across texts as well."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out = out * _U(0xD6E8FEB86659FD93) + hashes[j : len(hashes) - n + 1 + j]
    return mix(out)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside each text, and each text's first shingle.

    A text of fewer than n words, but at least one, has one shingle: all of its words.
    """
    counts = np.diff(first)
    runs = rolled(hashes, n)
    short = np.flatnonzero((counts > 0) & (counts < n))
    each = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(each)))
    out = np.empty(begin[-1], np.uint64)
    keep = np.zeros(len(out), bool)
    text = np.repeat(np.arange(len(counts)), each)
    keep = counts[text] >= n
    place = np.arange(len(out)) - begin[text] + first[:-1][text]
    out[keep] = runs[place[keep]]
    for k in short:
        own = np.full(1, counts[k], np.uint64)
        for j in range(first[k], first[k + 1]):
            own = mix(own * _U(0xD6E8FEB86659FD93) + hashes[j : j + 1])
        out[begin[k]] = own[0]
    return out, begin


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, each text's first of them, and how often each occurs."""
    values, edges = values[first[0] : first[-1]].copy(), (first - first[0]).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    begins = np.array(edges)
    new[begins[:-1][np.diff(begins) > 0]] = True
    at = np.flatnonzero(new)
    return values[at], np.searchsorted(at, begins), np.diff(np.append(at, len(values)))
