"""Training documents that hold benchmark items: a BM25 index of the items, asked by every passage.

The items are the indexed texts, a passage is a query. A term's weight in an
item is divided by the item's BM25 score for its own words, so a passage that
holds a whole item scores 1 and one threshold serves all items. The statistics
of BM25 are those of all items, however the index is split.

The index is block-max: each term's postings in the order of items, with its
largest weight over all and in each block of items. A passage first needs a
word without which no item reaches the threshold. Then WAND: cursors sorted by
item, a pivot where the terms' largest weights add up to the threshold, blocks
skipped whose maxima don't, exact scores for the rest. All items at or above
the threshold are returned. Each is verified on its word runs, for its question
and its answer, in stretches of the passage that go by the item's own length.

Passages are overlapping windows that go by the power of four that an item's
words fit in: twice that long, stepped by half, so every occurrence lies inside
one.

Defined cases: null text is empty; items without a word or an item_id can't be
found; an item that occurs twice in a document is returned once, where most of
both its question and its answer is held, then where it scores best; repeated
rows are searched each; a row without a doc_id is searched too and goes if it
holds an item; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_or_empty, written
from .textgrams import _NOT_WORD, mix, words

K1, B, BLOCK = 1.2, 0.75, 2
#: Items and words in one index, at most (but for a single longer item), and indexes in one pass over the documents.
INDEX_ITEMS, INDEX_WORDS, INDEXES = 20_000, 4_000_000, 16
#: Words of passages, and blocks that they reach, that are looked at together.
SLICE = 1 << 20
RUN = 3
_U = np.uint64
FOUND = "doc_id string, row long, item_id long, first_word long, score double, question double, answer double"


def _runs(hashes: np.ndarray, n: int = RUN) -> np.ndarray:
    """Hashes of all runs of n words; of all words together, where there are fewer."""
    n = max(1, min(n, len(hashes)))
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out = mix(out + hashes[j : len(hashes) - n + 1 + j])
    return out


class ItemIndex:
    """The inverted index of some items, and what verification needs of them.

    terms, df are how many of all n_items items hold each word; mean is their
    mean number of words. step is half the length of a passage.
    """

    def __init__(self, ids: list[int], texts: list[str], threshold: float, step: int, n_items: int, mean: float, terms: np.ndarray, df: np.ndarray):
        hashes, first = words(texts, separators=_NOT_WORD)
        self.ids, self.threshold, self.step = np.array(ids, np.int64), threshold, step
        self.sizes = sizes = np.diff(first)
        item = np.repeat(np.arange(len(ids)), sizes)
        self.terms, term = np.unique(hashes, return_inverse=True)
        self.n = len(ids)
        pairs, counts = np.unique(item * max(1, len(self.terms)) + term, return_counts=True)
        item, term = np.divmod(pairs, max(1, len(self.terms)))
        order = np.argsort(terms)
        df = df[order][np.searchsorted(terms[order], self.terms)]
        idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
        weight = idf[term] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * sizes[item] / max(1.0, mean)))
        own = np.bincount(item, weight, minlength=len(ids))
        weight = weight / own[item]
        # Postings by term, then item; each term's largest weight, and that in each block of items.
        order = np.lexsort((item, term))
        self.items, self.weights, by_term = item[order], weight[order], term[order]
        self.keys = by_term * self.n + self.items
        self.begin = np.searchsorted(by_term, np.arange(len(self.terms) + 1))
        self.most = np.maximum.reduceat(self.weights, self.begin[:-1]) if len(self.terms) else np.zeros(0)
        self.blocks = -(-self.n // BLOCK)
        self.block_keys, starts = np.unique(by_term * self.blocks + self.items // BLOCK, return_index=True)
        self.block_max = np.maximum.reduceat(self.weights, starts) if len(starts) else np.zeros(0)
        # An item's lightest words, up to half the threshold, aren't enough, so a passage is asked for the others first:
        # for each term the blocks of the items that have it among those, and the most that the lightest add in a block.
        light = np.lexsort((weight, item))
        sums = np.cumsum(weight[light])
        start = np.searchsorted(item[light], np.arange(len(ids)))
        before = np.where(start > 0, sums[np.maximum(start - 1, 0)], 0.0)
        own_sum = sums - before[item[light]]
        lightest = own_sum < threshold / 2
        self.rest = np.zeros(max(1, self.blocks))
        np.maximum.at(self.rest, item[light][lightest] // BLOCK, own_sum[lightest])
        where = light[~lightest]
        keys, at = np.unique(term[where] * max(1, self.blocks) + item[where] // BLOCK, return_inverse=True)
        self.main_most = np.zeros(len(keys))
        np.maximum.at(self.main_most, at, weight[where])
        self.main_begin = np.searchsorted(keys, np.arange(len(self.terms) + 1) * max(1, self.blocks))
        self.main_blocks = keys % max(1, self.blocks)
        self.scored = self.skipped = 0
        self.question, self.answer = [], []
        for k, text in enumerate(texts):
            cut = self._cut(text, int(sizes[k]))
            own_words = hashes[first[k] : first[k + 1]]
            self.question.append(np.unique(_runs(own_words[:cut])))
            self.answer.append(np.unique(_runs(own_words[cut:])))

    @staticmethod
    def _cut(text: str, size: int) -> int:
        """How many words are the question: all sentences but the last; of a single sentence the first two thirds."""
        ends = [k for k in range(len(text) - 1) if text[k] in ".?!\n" and text[k + 1 :].strip()]
        if ends:
            head = words([text[: ends[-1] + 1]], separators=_NOT_WORD)[0]
            if 0 < len(head) < size:
                return len(head)
        return max(1, (2 * size) // 3)

    def search(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, float, float, float]]:
        """(text, item, first word, score, question share, answer share) of every item that a text of hashes holds."""
        step = self.step
        place = np.searchsorted(self.terms, hashes)
        place[place == len(self.terms)] = 0
        known = self.terms[place] == hashes if len(self.terms) else np.zeros(len(hashes), bool)
        seen = np.concatenate(([0], np.cumsum(known)))
        counts = np.diff(first)
        # A passage is two steps of its text, the last one where there are fewer.
        steps = np.maximum(1, -(-counts // step))
        windows = np.maximum(1, steps - 1)
        text = np.repeat(np.arange(len(counts)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = first[:-1][text] + nth * step
        end = np.minimum(begin + 2 * step, first[1:][text])
        best: dict[tuple[int, int], tuple] = {}
        asked = np.flatnonzero(seen[end] > seen[begin])
        for k in self._open(asked, begin, end, place, known):
            terms = place[begin[k] : end[k]]
            terms = np.unique(terms[known[begin[k] : end[k]]])
            hits = self.wand(terms)
            if not hits:
                continue
            inside, t = hashes[begin[k] : end[k]], int(text[k])
            held = {n: _runs(inside, n) for n in range(1, RUN + 1)}
            for item, score in hits:
                at, question, answer = self._verified(item, len(inside), held)
                # Verified before ranked: a passage with all of an item's words scattered scores as much as the item itself.
                if (t, item) not in best or (min(question, answer), score) > (min(best[t, item][4:]), best[t, item][3]):
                    best[t, item] = (t, item, int(begin[k] - first[t]) + at, score, question, answer)
        return list(best.values())

    def _open(self, asked: np.ndarray, begin: np.ndarray, end: np.ndarray, place: np.ndarray, known: np.ndarray) -> Iterator[int]:
        """Which of the asked passages some block's maxima let reach the threshold.

        Only blocks that a passage's words reach beyond the lightest of their
        items are summed up. Passages go in slices, so memory follows from SLICE
        alone (and from what a single passage reaches).
        """
        if not len(asked):
            return
        widest = int((end - begin)[asked].max())
        for own in np.split(asked, np.arange(0, len(asked), max(1, SLICE // widest))[1:]):
            size = end[own] - begin[own]
            at = np.arange(size.sum()) + np.repeat(begin[own] - (np.cumsum(size) - size), size)
            passage = np.repeat(np.arange(len(own)), size)[known[at]]
            passage, term = np.divmod(np.unique(passage * len(self.terms) + place[at[known[at]]]), len(self.terms))
            reached = np.diff(self.main_begin)[term]
            count = np.bincount(passage, minlength=len(own))
            starts = np.cumsum(count) - count
            # Whole passages, with about SLICE blocks, and that reach about as many, together.
            whole = np.maximum(np.cumsum(np.bincount(passage, reached, minlength=len(own))), np.arange(len(own)) * self.blocks) // SLICE
            for few in np.split(np.arange(len(own)), np.flatnonzero(np.diff(whole)) + 1):
                low, high = starts[few[0]], starts[few[-1]] + count[few[-1]]
                each = reached[low:high]
                rows = np.arange(each.sum()) + np.repeat(self.main_begin[term[low:high]] - (np.cumsum(each) - each), each)
                keys = np.repeat(passage[low:high] - few[0], each) * self.blocks + self.main_blocks[rows]
                sums = np.bincount(keys, self.main_most[rows], minlength=len(few) * self.blocks).reshape(len(few), -1)
                which, block = np.nonzero((sums > 0) & (sums + self.rest >= self.threshold - 1e-9))
                which += few[0]
                # What is left of passages and blocks: the block's maxima of all words of the passage.
                for k in range(0, len(which), max(1, SLICE // widest)):
                    w, n = which[k : k + max(1, SLICE // widest)], count[which[k : k + max(1, SLICE // widest)]]
                    words_of = np.arange(n.sum()) + np.repeat(starts[w] - (np.cumsum(n) - n), n)
                    wanted = term[words_of] * self.blocks + np.repeat(block[k : k + len(w)], n)
                    found = np.minimum(np.searchsorted(self.block_keys, wanted), len(self.block_keys) - 1)
                    gain = np.where(self.block_keys[found] == wanted, self.block_max[found], 0.0)
                    open_ones = np.bincount(np.repeat(np.arange(len(w)), n), gain, minlength=len(w)) >= self.threshold - 1e-9
                    yield from own[np.unique(w[open_ones])].tolist()

    def wand(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Every item whose score for the terms reaches the threshold, with the score."""
        limit = self.threshold - 1e-9
        most, at, end = self.most[terms], self.begin[terms], self.begin[terms + 1]
        hits = []
        while len(terms):
            item = self.items[at]
            order = np.argsort(item, kind="stable")
            pivot = int(np.searchsorted(np.cumsum(most[order]), limit))
            if pivot == len(terms):
                break  # what is left of all terms together stays below
            pivot_item = int(item[order[pivot]])
            up_to = item <= pivot_item
            block = pivot_item // BLOCK
            keys = terms[up_to] * self.blocks + block
            found = np.minimum(np.searchsorted(self.block_keys, keys), len(self.block_keys) - 1)
            if self.block_max[found][self.block_keys[found] == keys].sum() < limit:
                # Neither this item nor another of the block before the next term begins can reach it.
                after = item[~up_to]
                target = min((block + 1) * BLOCK, int(after.min())) if len(after) else (block + 1) * BLOCK
                self.skipped += 1
            elif item[order[0]] == pivot_item:
                score = float(self.weights[at[up_to]].sum())
                self.scored += 1
                if score >= limit:
                    hits.append((pivot_item, score))
                target = pivot_item + 1
            else:
                target = pivot_item
            # Cursors of the terms up to the pivot go to the first posting at or after target.
            moved = np.flatnonzero(up_to)
            at[moved] = np.searchsorted(self.keys, terms[moved] * self.n + min(target, self.n))
            live = at < end
            if not live.all():
                terms, most, at, end = terms[live], most[live], at[live], end[live]
        return hits

    def _verified(self, item: int, n: int, held: dict[int, np.ndarray]) -> tuple[int, float, float]:
        """Where in a passage of n words, and how much of, an item's question and answer stand together: in stretches of four times the item's words, stepped by half."""
        step = max(8, 2 * int(self.sizes[item]))
        best = (-1.0, 0, 0.0, 0.0)
        for at in range(0, max(1, n - step), step):
            own = {k: runs[at : max(at + 1, at + 2 * step - k + 1)] for k, runs in held.items()} if n > 2 * step else held
            question, answer = self._share(self.question[item], own), self._share(self.answer[item], own)
            if min(question, answer) > best[0]:
                best = (min(question, answer), at, question, answer)
        return best[1:]

    def _share(self, wanted: np.ndarray, held: dict[int, np.ndarray]) -> float:
        # Parts of fewer than RUN words are one run of all their words.
        return max((float(np.isin(wanted, runs).mean()) for runs in held.values()), default=0.0) if len(wanted) else 1.0


def item_indexes(items: DataFrame, threshold: float, index_items: int = INDEX_ITEMS) -> Iterator[ItemIndex]:
    """Indexes of at most index_items items each, one after another, so that only one is built at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).where(F.col("item_id").isNotNull())

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes, first = words(batch["text"].tolist(), separators=_NOT_WORD)
            own = [np.unique(hashes[first[k] : first[k + 1]]).view(np.int64) for k in range(len(batch))]
            yield batch.assign(size=np.diff(first), terms=own)

    made = written(rows.mapInPandas(told, "item_id long, text string, size long, terms array<long>"), "items")
    df = written(made.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "item-terms")
    about = made.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
    # Items that fit in the same power of four of words are asked by the same passages.
    made = made.where("size > 0").withColumn("step", F.greatest(F.lit(16), F.pow(F.lit(4), F.ceil(F.log2("size") / 2))).cast("int"))
    for c in made.groupBy("step").agg(F.count("*").alias("n"), F.sum("size").alias("words")).orderBy("step").collect():  # a row for each power of four
        parts = max(-(-c["n"] // index_items), -(-c["words"] // INDEX_WORDS))
        for part in range(parts):
            own = made.where((F.col("step") == c["step"]) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part))
            listed = own.orderBy("item_id", "text").select("item_id", "text").collect()
            if listed:
                counts = df.join(own.select(F.explode("terms").alias("term")).distinct(), "term").toPandas()
                yield ItemIndex([r["item_id"] for r in listed], [r["text"] for r in listed], threshold, c["step"], about["n"], about["mean"], counts["term"].to_numpy(np.int64).view(_U), counts["df"].to_numpy())


def retrieve(docs: DataFrame, items: DataFrame, threshold: float = 0.6, index_items: int = INDEX_ITEMS) -> DataFrame:
    """Every item of which some passage of a document scores at least threshold: doc_id, row (names the text), item_id, first_word, score, question, answer (shares of their word runs that the passage holds).

    Documents are read and told into words once for INDEXES indexes, of which a
    task holds one at a time; only more items than that make another pass.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    found = spark.createDataFrame([], FOUND)
    sent: list = []

    def asked(sent: list) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            only = pickle.loads(sent[0].value) if len(sent) == 1 else None
            for batch in batches:
                sizes = np.cumsum(batch["text"].str.len().to_numpy(np.int64))
                splits = [x for x in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(sizes // (1 << 20))) + 1) if len(x)]
                told = [words(batch["text"].iloc[own].tolist(), separators=_NOT_WORD) for own in splits]
                ids, of, out = batch["doc_id"].to_numpy(), batch["row"].to_numpy(), []
                for one in sent:
                    index = only or pickle.loads(one.value)
                    for own, (hashes, first) in zip(splits, told, strict=True):
                        out += [(ids[own[t]], of[own[t]], int(index.ids[i]), at, score, q, a) for t, i, at, score, q, a in index.search(hashes, first)]
                yield pd.DataFrame(out, columns=["doc_id", "row", "item_id", "first_word", "score", "question", "answer"])

        return rows.mapInPandas(run, FOUND)

    for index in item_indexes(items, threshold, index_items):
        sent.append(spark.sparkContext.broadcast(pickle.dumps(index)))  # INDEX_ITEMS items and INDEX_WORDS words at most
        if len(sent) == INDEXES:
            found, sent = found.unionByName(asked(sent)), []
    found = found.unionByName(asked(sent)) if sent else found
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.6, index_items: int = INDEX_ITEMS) -> DataFrame:
    """What retrieve finds whose question and answer are both held to at least overlap."""
    return retrieve(docs, items, threshold, index_items).where((F.col("question") >= overlap) & (F.col("answer") >= overlap))


def decontaminated(docs: DataFrame, items: DataFrame, **options: float) -> DataFrame:
    """docs without the rows that hold an item."""
    gone = contaminated(docs, items, **options).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(text_or_empty()) == F.col("_row")), "left_anti")
