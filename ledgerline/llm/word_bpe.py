"""Token ids of whole texts through a table of distinct words, and back through the table of pieces.

Texts are split into words, each distinct word of the corpus is encoded once,
and its ids go back to every place the word has. The table of distinct words
grows with the corpus, so it stays a table: only its most frequent words (at
most `known`, each of at most LONGEST characters) are held by every worker, and
the places of all other words are joined with the table by word.

The tokenizer's file must have a normaliser of NFC, white space and lower case,
the pattern below, byte-level signs and a BPE model, as word_bpe_49k.json has.
Special tokens' strings in a text are those tokens, as the tokenizers library
has it. Texts with marks or signs whose normal form depends on a version of
Unicode go through the library's own normaliser and splitter; all others are
split with array passes.

Defined cases: null text is empty and has no ids; a null doc_id is kept; rows
that repeat are encoded as often as they occur; other columns are ignored; an
empty table gives an empty result. A word is known by a hash of 64 bits inside
a worker and by its text in every table.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import _byte_signs, _tables
from .shared import text_or_empty, written
from .textgrams import mix

_U = np.uint64
_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = 0, 1, 2, 3, 4
#: Code points worked on at once, and distinct words that a task counts before it passes them on; both only bound memory.
STRETCH, COUNTED = 1 << 18, 80_000
#: Words that every worker holds, and their greatest length: at most KNOWN x (4 x LONGEST bytes of ids) = 134 MB, and 30 MB where they have four ids each.
KNOWN, LONGEST = 1 << 19, 64
SLOTS = 1 << 20
#: Rows whose texts are Python's at once.
ROWS = 256
_cache: dict = {}


def _kinds() -> np.ndarray:
    """Each code point's part in the pattern; unsure are marks, conjoining signs, unassigned ones and those that NFC changes or whose lower case has a mark."""
    if "kinds" not in _cache:
        kinds = np.full(0x110000, _UNSURE, np.uint8)
        for c in range(0x110000):
            sign = chr(c)
            group = unicodedata.category(sign)
            if group[0] != "M" and group != "Cn" and not 0x1100 <= c <= 0x11FF and unicodedata.is_normalized("NFC", sign) and len(sign.lower()) == 1:
                kinds[c] = _LETTER if group[0] == "L" else _NUMBER if group[0] == "N" else _OTHER
        for c in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2002, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
            kinds[c] = _SPACE
        _cache["kinds"] = kinds
    return _cache["kinds"]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the matches of 's|'t|'re|'ve|'m|'ll|'d|L+|N|[^\\sLN]+ in a lower-cased text."""
    n = len(points)
    kind = _kinds()[points]
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        # A contraction wins only where a match begins; what follows it begins anew.
        padded = np.append(points, np.zeros(3, np.uint32))
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 2, np.where(pair, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + size
        start[after[after < n]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], n)
    word = kind[starts] != _SPACE
    return starts[word], ends[word]


def _keys(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of code points, from prefix sums."""
    up, down = _tables(len(points) + 1)
    prefix = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + _U(0x1F123BB5)) * up[: len(points)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def keys_of(words: list[str]) -> np.ndarray:
    """The hashes of whole words."""
    out = []
    for k in range(0, len(words), 1 << 16):
        part = words[k : k + (1 << 16)]
        ends = np.cumsum([len(w) for w in part])
        out.append(_keys(_points("".join(part)), np.concatenate(([0], ends[:-1])), ends))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Splitter:
    """The words of texts, as the file at path normalises and splits them."""

    def __init__(self, path: str):
        self.path, self._own = path, None
        with open(path, encoding="utf-8") as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.parting = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")
        self.sign = {b: s for s, b in _byte_signs().items()}

    @property
    def own(self):
        """The library's tokenizer, loaded by those workers that need it."""
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_file(self.path)
        return self._own

    def ids(self, word: str) -> list[int]:
        """The ids of one word."""
        if word in self.special:
            return [self.special[word]]
        return [t.id for t in self.own.model.tokenize("".join(self.sign[b] for b in word.encode("utf-8", "replace")))]

    def _unsure(self, text: str) -> bool:
        return any(s in text for s in self.special) or (not text.isascii() and bool((_kinds()[_points(text)] == _UNSURE).any()))

    def _carefully(self, text: str) -> list[str]:
        """The words of one text by the library's own parts; special tokens stand for themselves."""
        words = []
        # Special tokens and what lies between them, by turns.
        for k, part in enumerate(self.parting.split(text)):
            if k % 2:
                words.append(part)
                continue
            normal = self.own.normalizer.normalize_str(part)
            words += [normal[a:b] for _, (a, b) in self.own.pre_tokenizer.pre_tokenize_str(normal)]
        return words

    def _parts(self, text: str) -> list[str]:
        """A very long text in parts of about STRETCH, cut before white space only."""
        parts = []
        while len(text) > 2 * STRETCH:
            at = text.find(" ", STRETCH)
            if at < 0:
                break
            parts.append(text[:at])
            text = text[at:]
        return [*parts, text]

    def split(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, Callable[[int], str]]]:
        """Stretches of words in the order of the texts: each word's hash, its text's number, and a function from a place in the stretch to the word."""
        group: list[tuple[int, str]] = []
        size = 0

        def stretch():
            joined = "\n".join(t for _, t in group)
            points = _points(joined)
            starts, ends = _bounds(points)
            at = np.cumsum([len(t) + 1 for _, t in group])
            owner = np.array([k for k, _ in group])[np.searchsorted(at, starts, side="right")]
            return _keys(points, starts, ends), owner, lambda k: joined[starts[k] : ends[k]]

        for k, text in enumerate(texts):
            if self._unsure(text):
                if group:
                    yield stretch()
                    group, size = [], 0
                words = self._carefully(text)
                yield keys_of(words), np.full(len(words), k), words.__getitem__
                continue
            for part in self._parts(text.replace("Σ", "σ").lower()):
                group.append((k, part))
                size += len(part) + 1
                if size >= STRETCH:
                    yield stretch()
                    group, size = [], 0
        if group:
            yield stretch()


def splitter(path: str) -> Splitter:
    """The worker's own splitter for this file, loaded once."""
    if ("splitter", path) not in _cache:
        _cache["splitter", path] = Splitter(path)
    return _cache["splitter", path]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches, and their texts."""
    for batch in batches:
        for k in range(0, len(batch), ROWS):
            part = batch.slice(k, ROWS)
            yield part, part.column("text").to_pylist()


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Each distinct word of all texts and how often it occurs: word, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        words: dict[int, str] = {}

        def passed_on():
            return pa.RecordBatch.from_arrays([pa.array([words[k] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for _, texts in _texts(batches):
            for keys, _, word in splitter(tokenizer).split(texts):
                distinct, first, n = np.unique(keys, return_index=True, return_counts=True)
                for key, where, times in zip(distinct.tolist(), first.tolist(), n.tolist(), strict=True):
                    if key in counts:
                        counts[key] += times
                    else:
                        counts[key], words[key] = times, word(where)
                if len(counts) >= COUNTED:
                    yield passed_on()
                    counts, words = {}, {}
        if counts:
            yield passed_on()

    return docs.select(text_or_empty().alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encoded_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """words with the ids of each: word, n, ids (four bytes each, the low one first)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array(splitter(tokenizer).ids(w), "<i4").tobytes() for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(ids, pa.binary())], ["word", "n", "ids"])

    return words.select("word", "n").mapInArrow(encode, "word string, n long, ids binary")


def _most_frequent(table: DataFrame, known: int) -> pa.Table:
    """The words of a frequency from which on there are at most `known`, in the driver: a bounded number of bounded rows, as columns."""
    short = table.where(F.length("word") <= LONGEST)
    # A step is an eighth of a power of two, so there are at most 8 x 63 of them.
    step = F.floor(F.log2("n") * 8)
    least, total = None, 0
    for row in sorted(short.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > known:
            break
        least = row["step"]
    return short.where(step >= least if least is not None else F.lit(False)).select("word", "n", "ids").toArrow()


class Known:
    """Frequent words by hash: a word's number, and its ids. Frequent ones have small numbers."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()
        keys = np.concatenate([keys_of(rows.column("word").slice(k, 1 << 16).to_pylist()) for k in range(0, max(1, len(rows)), 1 << 16)])
        self.order = np.argsort(keys).astype(np.int32)
        self.sorted = keys[self.order]
        blobs = rows.column("ids").to_pylist()
        self.first = np.concatenate(([0], np.cumsum([len(b) // 4 for b in blobs]))).astype(np.int32)
        self.pool = np.frombuffer(b"".join(blobs), "<i4")
        self.slot_key, self.slot = np.zeros(SLOTS, np.uint64), np.full(SLOTS, -1, np.int32)
        place = (keys & _U(SLOTS - 1)).astype(np.int64)[::-1]  # of two words of one place the more frequent is written last
        self.slot_key[place], self.slot[place] = keys[::-1], np.arange(len(keys), dtype=np.int32)[::-1]

    def __len__(self) -> int:
        return len(self.sorted)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, -1 for one that isn't known."""
        place = (keys & _U(SLOTS - 1)).astype(np.int64)
        found = np.where(self.slot_key[place] == keys, self.slot[place], -1)
        rest = np.flatnonzero(found < 0)
        if len(rest) and len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, keys[rest]), len(self.sorted) - 1)
            found[rest] = np.where(self.sorted[at] == keys[rest], self.order[at], -1)
        return found

    def ids(self, numbers: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by number, in order, and how many each has; words from len(self) on are in others."""
        sizes, values = np.empty(len(numbers), np.int64), None
        own = numbers < len(self)
        at = numbers[own]
        sizes[own] = self.first[at + 1] - self.first[at]
        more = np.array([len(o) for o in others] or [0], np.int64)
        at_other = numbers[~own] - len(self)
        sizes[~own] = more[at_other]
        values = np.empty(sizes.sum(), np.int32)
        of_own = np.repeat(own, sizes)

        def places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
            return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)

        values[of_own] = self.pool[places(self.first[at].astype(np.int64), sizes[own])]
        if len(at_other):
            values[~of_own] = np.concatenate(others)[places((np.cumsum(more) - more)[at_other], sizes[~own])]
        return values, sizes


def _numbered(texts: list[str], split: Splitter, known: Known) -> Iterator[tuple[np.ndarray, list[str]]]:
    """For each text its words' numbers, words that aren't known being numbered from len(known) on as they first occur, and those words."""
    held: list[np.ndarray] = []
    others: dict[int, tuple[int, str]] = {}
    at = 0
    for keys, owner, word in split.split(texts):
        numbers = known.numbers(keys)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(owner)] if len(cuts) else [], strict=True):
            while at < owner[a]:
                yield np.concatenate(held) if held else np.zeros(0, np.int32), [w for _, w in others.values()]
                held, others = [], {}
                at += 1
            own = numbers[a:b]
            for k in np.flatnonzero(own < 0):
                key = int(keys[a + k])
                if key not in others:
                    others[key] = len(known) + len(others), word(a + k)
                own[k] = others[key][0]
            held.append(own)
    while at < len(texts):
        yield np.concatenate(held) if held else np.zeros(0, np.int32), [w for _, w in others.values()]
        held, others = [], {}
        at += 1


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, the low ones of all first: frequent words have small numbers, so what is left is mostly zeros."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 4)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def encode(docs: DataFrame, tokenizer: str, known: int = KNOWN) -> DataFrame:
    """Every row's ids: doc_id, ids."""
    spark = docs.sparkSession
    table = written(encoded_words(word_counts(docs, tokenizer), tokenizer), "words")
    common = spark.sparkContext.broadcast(Known(_most_frequent(table, known)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # The name of a row only finds its own rare words; two rows of one name would share them without harm.
    named = texts.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            rows, words = [], []
            names = batch.column("row").to_pylist()
            for k, (_, others) in enumerate(_numbered(texts, splitter(tokenizer), common.value)):
                rows += [names[k]] * len(others)
                words += others
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(words, pa.string())], ["row", "word"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = TaskContext.get().partitionId() << 40
        for batch, texts in _texts(batches):
            names, packed, lists = batch.column("row").to_pylist(), [], []
            for k, (numbers, others) in enumerate(_numbered(texts, splitter(tokenizer), common.value)):
                packed.append(_packed(numbers))
                lists.append(others)
                if not others:  # needs no partner, so it may go anywhere
                    names[k] = int(mix(np.array([seen], np.uint64)).view(np.int64)[0])
                    seen += 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(lists, pa.list_(pa.string()))], ["row", "doc_id", "numbers", "others"])

    # A word that isn't known is rare, so no key of this join is large; a text names each of its rare words once.
    found = named.select("row", "text").mapInArrow(rare, "row long, word string").join(table.select("word", "ids"), "word")
    found = found.groupBy("row").agg(F.collect_list(F.struct("word", "ids")).alias("found"))
    rows = named.mapInArrow(placed, "row long, doc_id long, numbers binary, others array<string>").join(found, "row", "left")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            held, rare_ids, words, since = [], [], 0, 0
            for k in range(len(batch)):
                numbers = _unpacked(batch.column("numbers")[k].as_py())
                others = batch.column("others")[k].as_py()
                if others:
                    by_word = {f["word"]: f["ids"] for f in batch.column("found")[k].as_py()}
                    numbers[numbers >= len(common.value)] += len(rare_ids)
                    rare_ids += [np.frombuffer(by_word[w], "<i4") for w in others]
                held.append(numbers)
                words += len(numbers)
                if words >= STRETCH or k == len(batch) - 1:
                    values, sizes = common.value.ids(np.concatenate(held), rare_ids)
                    ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum([len(n) for n in held])))]
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(since, len(held)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))], ["doc_id", "ids"])
                    held, rare_ids, words, since = [], [], 0, k + 1

    return rows.select("doc_id", "numbers", "others", "found").mapInArrow(joined, "doc_id long, ids array<int>")


def pieces(spark, tokenizer: str) -> DataFrame:
    """The table of the tokenizer's ids: id, piece."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, p) for p, i in vocab.items()], "id int, piece string")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """encoded with text, the pieces of its ids joined by blanks, as the library decodes where a file names no decoder; an id that isn't in the table is an error.

    The table of pieces, bounded by the vocabulary, is one row with all pieces in
    the order of their ids, and each id takes its piece by place: the join needs
    no row of its own for each token.
    """
    table = pieces(encoded.sparkSession, tokenizer)
    whole = table.agg(F.array_sort(F.collect_list(F.struct("id", "piece"))).alias("p")).select(F.transform("p", lambda x: x["piece"]).alias("_pieces"), F.transform("p", lambda x: x["id"]).alias("_ids"))
    row = whole.first()
    if row["_ids"] != list(range(len(row["_ids"]))):
        raise ValueError("the tokenizer's ids aren't 0, 1, 2 and so on")
    joined = encoded.join(F.broadcast(whole.select("_pieces")), F.lit(True))
    return joined.withColumn("text", F.array_join(F.transform("ids", lambda i: F.element_at("_pieces", i + 1)), " ")).drop("_pieces")
