"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Random indexing: every word has a fixed sparse random index vector, and a word
vector is the sum of the index vectors of the words beside it, over the whole
corpus. A word that is at least SHARE of all words has a row of its own in the
table, so the table grows with the corpus's vocabulary up to 1 / SHARE rows,
which is small enough for every task; rarer words share BUCKETS rows by hash. A
document is the mean of its words' vectors with a few pooled figures of its own. The network is fitted
in numpy on at most `sample` labelled documents and its logits are divided by
a temperature fitted on others.

Defined cases: null text is empty; empty texts get a score too; repeated rows
are scored each; a document labelled twice counts by its lowest label; labels
that are null take no part; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_or_empty, written
from .textgrams import words

BUCKETS, WIDTH, NONZERO, WINDOW = 1 << 13, 32, 4, 2
#: The part of all words from which on a word has a vector of its own; so at most 1 / SHARE words have.
SHARE = 1e-5
#: How often such a word must occur at least, or its vector would be that of a few places.
LEAST = 5
#: Distinct words that a task counts before it passes them on.
COUNTED = 1 << 20
#: Tasks whose tables are added together.
FAN_IN = 256
#: Labelled documents that the network is fitted on, at most, chosen by hash.
SAMPLE = 20_000
_U = np.uint64
EXTRA = 11


def index_vectors() -> np.ndarray:
    """The fixed index vectors: NONZERO entries of 1 or -1 in WIDTH."""
    rng = np.random.default_rng(4711)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    for row in out:
        row[rng.choice(WIDTH, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words and runs of signs as 64-bit hashes, case kept, and each text's first."""
    return words(texts, lower=False, kinds=True)


def _groups(texts: pd.Series, chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Texts in stretches of about that many characters, with the first one's place."""
    group, size, first = [], 0, 0
    for k, text in enumerate(texts):
        group.append(text)
        size += len(text)
        if size >= chars:
            yield first, group
            group, size, first = [], 0, k + 1
    if group:
        yield first, group


def own_words(docs: DataFrame, share: float = SHARE) -> np.ndarray:
    """The hashes, in order, of the words that are at least `share` of all words of all documents and occur LEAST times: at most 1 / share."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for _, texts in _groups(batch["text"]):
                word, n = np.unique(_tokens(texts)[0], return_counts=True)
                held.append((word, n))
                size += len(word)
                if size >= COUNTED:
                    yield merged(held)
                    held, size = [], 0
        if held:
            yield merged(held)

    def merged(held: list) -> pd.DataFrame:
        word, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return pd.DataFrame({"word": word.view(np.int64), "n": np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)})

    counts = written(docs.select(text_or_empty().alias("text")).mapInPandas(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") >= max(LEAST, total * share)).select("word").toPandas() if total else pd.DataFrame({"word": []})
    return np.sort(rows["word"].to_numpy(np.int64).view(np.uint64))


def row_of(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The table's row for each word: its own, or one of the shared rows after those."""
    shared = len(own) + (hashes & _U(BUCKETS - 1)).astype(np.int64)
    if not len(own):
        return shared
    place = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
    return np.where(own[place] == hashes, place, shared)


def word_vectors(docs: DataFrame, own: np.ndarray) -> np.ndarray:
    """The table of word vectors over all documents: a row of WIDTH for each word of own, then BUCKETS shared ones, each of length 1 or 0.

    A task adds up its own documents' table; tables are added by blocks of rows,
    so what is shuffled is at most a table per task.
    """
    block, size = 256, len(own) + BUCKETS
    sent = docs.sparkSession.sparkContext.broadcast(own)  # 8 / SHARE bytes at most

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, total = index_vectors(), np.zeros((size, WIDTH))
        for batch in batches:
            for _, texts in _groups(batch["text"]):
                hashes, first = _tokens(texts)
                bucket, row = (hashes & _U(BUCKETS - 1)).astype(np.int64), row_of(hashes, sent.value)
                text = np.repeat(np.arange(len(texts)), np.diff(first))
                near = np.zeros((len(bucket), WIDTH), np.float32)
                for step in range(1, WINDOW + 1):
                    same = (text[step:] == text[:-step])[:, None]
                    near[step:] += index[bucket[:-step]] * same
                    near[:-step] += index[bucket[step:]] * same
                order = np.argsort(row, kind="stable")
                seen, start = np.unique(row[order], return_index=True)
                if len(seen):
                    total[seen] += np.add.reduceat(near[order], start, axis=0)
        for k in range(0, size, block):
            if total[k : k + block].any():
                yield pd.DataFrame({"block": [k // block], "sums": [total[k : k + block].ravel()]})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": rows["block"].iloc[:1], "sums": [np.sum(np.stack(rows["sums"].to_numpy()), axis=0)], "task": rows["task"].iloc[:1]})

    # Tables of FAN_IN tasks are added at a time, so a group is at most FAN_IN rows of 64 kB; three rounds serve 16 million tasks.
    parts = docs.select(text_or_empty().alias("text")).mapInPandas(sums, "block int, sums array<double>").withColumn("task", F.spark_partition_id())
    for _ in range(3):
        near = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        parts = near.groupBy("block", "task").applyInPandas(added, "block int, sums array<double>, task int")
    rows = parts.collect()  # at most (1 / SHARE + BUCKETS) / block rows
    table = np.zeros((size, WIDTH))
    for r in rows:
        table[r["block"] * block : (r["block"] + 1) * block] = np.array(r["sums"]).reshape(-1, WIDTH)
    # What every word has beside it says little: the common direction goes, then rows get length 1.
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, lengths, out=np.zeros_like(table), where=lengths > 0)
    seen = lengths[:, 0] > 0
    if seen.any():
        table[seen] -= table[seen].mean(0)
        lengths = np.linalg.norm(table, axis=1, keepdims=True)
        table = np.divide(table, lengths, out=np.zeros_like(table), where=lengths > 0)
    return table.astype(np.float32)


def _pool(texts: list[str], table: np.ndarray, own: np.ndarray) -> np.ndarray:
    hashes, first = _tokens(texts)
    row = row_of(hashes, own)
    n = np.diff(first)
    out = np.zeros((len(texts), WIDTH + EXTRA), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        sums = np.add.reduceat(table[row], first[:-1][some], axis=0)
        out[some, :WIDTH] = sums / n[some, None]
    for k, text in enumerate(texts):
        out[k, WIDTH:] = _figures(text, hashes[first[k] : first[k + 1]])
    return out


def _figures(text: str, hashes: np.ndarray) -> list[float]:
    """Pooled figures of one document: length, variety, repetition, and what its characters are."""
    n, chars = len(hashes), len(text)
    if not n:
        return [0.0] * EXTRA
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_BYTE_KIND[raw], minlength=6)
    distinct = len(np.unique(hashes))
    same = float(np.mean(hashes[1:] == hashes[:-1])) if n > 1 else 0.0
    lines = text.count("\n") + 1
    return [
        np.log1p(n) / 10, distinct / n, same, distinct / (n**0.8 + 1),
        kinds[1] / chars, kinds[2] / chars, kinds[3] / chars, kinds[4] / chars, kinds[0] / chars,
        np.log1p(chars / lines) / 10, min(chars / n, 20) / 20,
    ]


_BYTE_KIND = np.zeros(256, np.int64)  # other
_BYTE_KIND[65:91] = 1
_BYTE_KIND[48:58] = 2
for _sign in "#$%&*@^~|<>=+{}[]\\_/":
    _BYTE_KIND[ord(_sign)] = 3
for _sign in ".,;:!?'\"()-":
    _BYTE_KIND[ord(_sign)] = 4
_BYTE_KIND[[9, 10, 13, 32]] = 5


def pooled(docs: DataFrame, table: np.ndarray, own: np.ndarray) -> DataFrame:
    """doc_id, row (names its text) and features (WIDTH + EXTRA floats) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((table, own))  # at most (1 / SHARE + BUCKETS) * WIDTH * 4 bytes: 14 MB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in _groups(batch["text"]):
                part = batch.iloc[first : first + len(texts)]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "row": part["row"].to_numpy(), "features": list(_pool(texts, *sent.value))})

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    return rows.mapInPandas(run, "doc_id string, row long, features array<float>").withColumn("doc_id", F.col("doc_id").cast("long"))


class Network:
    """Two layers, fitted by Adam on class-weighted log loss; a temperature divides the logits."""

    def __init__(self, width: int, hidden: int = 32, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.w1, self.b1 = rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden)
        self.w2, self.b2 = rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)
        self.mean, self.scale, self.temperature = np.zeros(width), np.ones(width), 1.0
        self.rng = rng

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> Network:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.mean) / self.scale
        parts = [self.w1, self.b1, self.w2, self.b2]
        first, second, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
        steps = max(1, min(epochs * len(z) // batch, 6000))
        for _ in range(steps):
            pick = self.rng.integers(0, len(z), min(batch, len(z)))
            a = np.maximum(z[pick] @ self.w1 + self.b1, 0)
            p = 1 / (1 + np.exp(-(a @ self.w2 + self.b2)))
            g = (p - y[pick]) / len(pick)
            back = np.outer(g, self.w2) * (a > 0)
            grads = [z[pick].T @ back + decay * self.w1, back.sum(0), a.T @ g + decay * self.w2, np.array([g.sum()])]
            t += 1
            for k, (part, grad) in enumerate(zip(parts, grads, strict=True)):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                part -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Network:
        """The temperature with the least log loss on documents that weren't fitted on."""
        logits = self.logits(x)
        tries = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t)) for t in tries]
        self.temperature = float(tries[int(np.argmin(loss))])
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fold_of(doc_id: str = "doc_id"):
    """crc32(doc_id as text) mod 5; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """doc_id, row (names its text), held_out, score (0 to 1, higher: label 1 likelier), predicted of every row.

    Learns word vectors from all documents, and labels from at most `sample`
    labelled documents outside fold 0. With labels of one class only, or none,
    every score is that class's share (1 where there are none).
    """
    own = own_words(docs)
    features = written(pooled(docs, word_vectors(docs, own), own), "features")
    told = labels.where(F.col(label).isNotNull() & (fold_of() != 0)).groupBy("doc_id").agg(F.min(label).alias("y"))
    # Too many labels are thinned by a hash first, so that no task sends its own `sample` rows to the driver.
    taken_part = min(1.0, sample / max(1, told.count()))
    told = told.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) <= int(taken_part * (1 << 30)))
    taken = features.join(told.select(F.col("doc_id").cast("long").alias("doc_id"), "y"), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = taken.select("doc_id", "features", "y", fold_of().alias("fold")).toPandas()  # at most `sample` rows
    x = np.stack(rows["features"].to_numpy()).astype(np.float64) if len(rows) else np.zeros((0, WIDTH + EXTRA))
    y = (rows["y"].to_numpy() > 0).astype(np.float64)
    network, share = None, float(y.mean()) if len(y) else 1.0
    if 0 < share < 1:
        fitted = rows["fold"].to_numpy() != 1
        if not 0 < y[fitted].mean() < 1 or not (~fitted).any():
            fitted = np.ones(len(y), bool)
        network = Network(x.shape[1]).fit(x[fitted], y[fitted])
        network.calibrate(x[~fitted], y[~fitted]) if (~fitted).any() else None

    @F.pandas_udf("double")
    def probability(values: pd.Series) -> pd.Series:
        if not len(values) or network is None:
            return pd.Series(np.full(len(values), share))
        return pd.Series(network.probability(np.stack(values.to_numpy()).astype(np.float64)))

    held_out = F.coalesce(fold_of() == 0, F.lit(False))
    scored = features.select("doc_id", "row", held_out.alias("held_out"), probability("features").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
