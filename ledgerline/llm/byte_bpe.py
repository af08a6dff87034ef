"""Token ids of whole texts by a public byte-level BPE file, with each distinct word encoded once.

Byte-level BPE never merges across the pieces of its pre-tokeniser, so a
text's ids are its pieces' ids in order. The pieces are found with array
passes over code points; each distinct piece is merged by the ranks of the
file's own vocabulary once for a worker, and its ids are kept for the next
texts. Files whose ids are not in merge order go through `tokenizers` instead.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from .textgrams import mix

_U = np.uint64
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
#: Code points worked on at once, distinct pieces kept by a worker and places to find them; all three only bound memory.
STRETCH, KEPT, SLOTS = 1 << 19, 700_000, 1 << 21
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
_cache: dict = {}


def _kinds() -> np.ndarray:
    if "kinds" not in _cache:
        kinds = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            group = unicodedata.category(chr(c))[0]
            kinds[c] = _LETTER if group == "L" else _NUMBER if group == "N" else _OTHER
        for c in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
            kinds[c] = _SPACE
        _cache["kinds"] = kinds
    return _cache["kinds"]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _cache.get("powers")
    if have is None or len(have[0]) < n:
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(max(n, STRETCH * 2), base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _cache["powers"] = have = tuple(both)
    return have


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where the pieces of 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+ begin in a text's code points."""
    n = len(points)
    kind = _kinds()[points]
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    space = kind == _SPACE
    if n > 1:
        # A run of white space before another kind gives up its last character: a blank joins the next piece, another stands alone.
        last = np.flatnonzero(space[:-1] & ~space[1:])
        start[last] = True
        blank = last[points[last] == 0x20]
        start[blank + 1] = False
    for k in np.flatnonzero(points == 0x27):  # contractions win only where a piece begins
        if start[k]:
            tail = "".join(map(chr, points[k + 1 : k + 3]))
            size = 3 if tail in ("re", "ve", "ll") else 2 if tail[:1] in ("s", "t", "m", "d") and tail else 0
            if not size:
                continue
            start[k + 1 : k + size] = False
            if k + size < n:
                start[k + size] = True
                # What follows a contraction begins anew, also inside a run of letters; a blank keeps joining the next piece.
    return np.flatnonzero(start)


def _byte_signs() -> dict[str, int]:
    """The printable sign that a byte-level BPE file writes for each byte, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _single_piece_encoder(path: str):
    """bytes -> ids for one piece, where the file's ids follow the order of its merges; else None."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    signs, vocab = _byte_signs(), model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if model.get("ignore_merges") or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    ranks = {bytes(signs[c] for c in t): k for t, k in vocab.items() if k < 256 + len(merges)}
    encoding = tiktoken.Encoding("file", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})
    return encoding._core_bpe.encode_single_piece


class ByteBpe:
    """The ids that `tokenizers` gives by the file at path, without special tokens; their strings in a text are ordinary text.

    A distinct piece is encoded by its merge ranks where the file's ids are in
    merge order (measured five times as fast), else by `tokenizers` itself.
    """

    def __init__(self, path: str):
        self.single = _single_piece_encoder(path)
        if self.single is None:
            from tokenizers import Tokenizer

            bpe = Tokenizer.from_file(path)
            bpe.encode_special_tokens = True
            self.single = lambda piece: bpe.encode(piece.decode(), add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.slots = np.zeros(SLOTS, np.int32)
        self.known = 0
        self.pool = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Encodes pieces and gives their slots."""
        found = [self.single(p.encode("utf-8", "replace")) for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total, first = int(sizes.sum()), self.known
        self.known += len(found)
        while self.known > len(self.begin):
            self.begin, self.size = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.size, 2 * len(self.size))
        while self.used + total > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + total] = np.fromiter((i for ids in found for i in ids), np.uint32, total)
        self.begin[first : self.known] = self.used + np.cumsum(sizes) - sizes
        self.size[first : self.known] = sizes
        self.used += total
        return np.arange(first, self.known, dtype=np.int32)

    def _slots_of(self, keys: np.ndarray, piece) -> np.ndarray:
        """The slot of each key in a table with two places for a key; missing ones are learnt."""
        places = (keys & _U(SLOTS - 1)).astype(np.int64)
        slots, missing = self.slots[places], np.flatnonzero(self.keys[places] != keys)
        if len(missing):
            second = (keys[missing] >> _U(40)).astype(np.int64) & (SLOTS - 1)
            there = self.keys[second] == keys[missing]
            slots[missing[there]] = self.slots[second[there]]
            missing = missing[~there]
        if len(missing):
            distinct, where, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            own = self._learn([piece(k) for k in missing[where].tolist()])
            slots[missing] = own[back]
            one, two = (distinct & _U(SLOTS - 1)).astype(np.int64), (distinct >> _U(40)).astype(np.int64) & (SLOTS - 1)
            place = np.where(self.keys[one] == 0, one, two)
            self.keys[place], self.slots[place] = distinct, own
        return slots

    def _stretch(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, np.uint32) for _ in texts]
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        parts = [piece_starts(points[at[k] : at[k + 1]]) + at[k] if len(texts[k]) else np.zeros(0, np.int64) for k in range(len(texts))]
        starts = np.concatenate(parts)
        ends = np.append(starts[1:], len(points))
        up, down = _tables(len(points) + 1)
        prefix = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + _U(0x1F123BB5)) * up[: len(points)], out=prefix[1:])
        keys = mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        if self.known > KEPT:
            self._clear()
        slots = self._slots_of(keys, lambda k: joined[starts[k] : ends[k]])
        sizes = self.size[slots]
        done = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.pool[np.arange(done[-1]) + np.repeat(self.begin[slots] - done[:-1], sizes)]
        bounds = done[np.concatenate(([0], np.cumsum([len(p) for p in parts])))]
        return [ids[bounds[k] : bounds[k + 1]] for k in range(len(texts))]

    def _cuts(self, text: str) -> list[str]:
        """A very long text in parts of about STRETCH, cut only between a letter and a blank, where pieces part as well."""
        parts = []
        while len(text) > 2 * STRETCH:
            at = text.find(" ", STRETCH)
            while at > 0 and not text[at - 1].isalpha():
                at = text.find(" ", at + 1)
            if at < 0:
                break
            parts.append(text[:at])
            text = text[at:]
        return [*parts, text]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if len(text) > 2 * STRETCH:
                if group:
                    out += self._stretch(group)
                    group, size = [], 0
                out.append(np.concatenate([self._stretch([part])[0] for part in self._cuts(text)]))
                continue
            group.append(text)
            size += len(text)
            if size >= STRETCH:
                out += self._stretch(group)
                group, size = [], 0
        return out + (self._stretch(group) if group else [])


def loaded(path: str) -> ByteBpe:
    """The worker's own tokenizer for this file, loaded once."""
    if ("bpe", path) not in _cache:
        _cache["bpe", path] = ByteBpe(path)
    return _cache["bpe", path]
