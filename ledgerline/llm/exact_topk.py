"""Exact top-k by inner product over an impact-ordered index, score at a time.

Every dimension's values are quantised to levels; a posting segment is the
vectors of one level of one dimension, with their values. A query processes
segments by descending quantised impact, the most that a vector of the segment
can gain, and adds what each of its vectors gains to its accumulator. Where an
unprocessed segment's impact is at most i, a vector with u dimensions to come
can gain u * i at most, which is negative in the end. The search stops where
that proves that no vector outside a small set of possible members can be among
the k best; those are scored exactly.

The candidates lie in blocks, each with an index of its own; all queries visit
every block, in blocks too, and a block's k best meet the other blocks' by query.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; a query meets vectors of its own dimension only, and vectors of
none score 0; ties go to the smaller id; repeated rows of one id are ranked
each; ids must not be null (such rows take no part); scores are exact, and one
beyond 64 bits is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERY_BLOCK, LEVELS = 8192, 4096, 16
FOUND = "query_id long, vec_id long, score long"


class ImpactIndex:
    """Postings of one block of integer vectors, in segments by dimension and quantised level."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        #: How many segments the last search processed, of how many.
        self.processed = 0
        self.rows, self.values, dims = [], [], []
        for d in range(vectors.shape[1]):
            own = self.vectors[:, d]
            by_value = np.argsort(own, kind="stable")
            low, high = int(own[by_value[0]]), int(own[by_value[-1]])
            level = (own[by_value] - low) // ((high - low) // levels + 1)
            for rows in np.split(by_value, np.flatnonzero(np.diff(level)) + 1):
                dims.append(d)
                self.rows.append(rows)
                self.values.append(own[rows])
        self.dims = np.array(dims, np.int64)
        self.least, self.most = (np.array([v[k] for v in self.values], np.int64) for k in (0, -1))
        self.largest = int(max(abs(int(self.vectors.min(initial=0))), abs(int(self.vectors.max(initial=0)))))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, exact scores) but for the query's own id, ties to the smaller id."""
        other = self.ids != own
        k = min(k, int(other.sum()))
        if not k:
            return self.ids[:0], self.ids[:0]
        if self.largest * max(abs(int(query.min(initial=0))), abs(int(query.max(initial=0)))) * (len(query) + 1) >= 2**62:
            return self._best(np.flatnonzero(other), query.astype(object), k)
        weight = query[self.dims]
        impact = np.maximum(weight * self.least, weight * self.most)  # no vector of the segment gains more
        order = np.argsort(-impact, kind="stable")
        gained, left = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(query), np.int64)
        checks = set(np.linspace(0, len(order), 33).astype(int)[8:].tolist())
        nothing = np.iinfo(np.int64).min
        possible = np.flatnonzero(other)
        for done, segment in enumerate(order.tolist(), 1):
            rows = self.rows[segment]
            gained[rows] += weight[segment] * self.values[segment]
            left[rows] -= 1
            self.processed = done
            if done not in checks or done == len(order):
                continue
            most = gained + left * impact[order[done]]
            # A lower limit for the k-th best score: exact scores of those that lead now.
            take = min(4 * k, len(most))
            leading = np.argpartition(-np.where(other, most, nothing), take - 1)[:take]
            leading = leading[other[leading]]
            exact = np.sort(self.vectors[leading] @ query)
            limit = exact[-k] if len(exact) >= k else nothing
            possible = np.flatnonzero(other & (most >= limit))
            if len(possible) <= max(8 * k, len(most) // 16):
                break
        return self._best(possible, query, k)

    def _best(self, possible: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        scores = self.vectors[possible] @ query
        first = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][first], scores[first].astype(np.int64)


def quantised(vectors: DataFrame, id_column: str, vector: str, scale: int = 1024) -> DataFrame:
    """vec_id, v (integers), dims; rows that take no part are gone."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    whole = lambda c: F.when(F.abs(c * scale) >= 2.0**63, F.raise_error("a component is beyond 64 bits").cast("long")).otherwise(F.floor(c * scale))
    fine = F.col(id_column).isNotNull() & F.col(vector).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, whole).alias("v"), F.size(vector).alias("dims"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """For every row of vectors (see quantised) where is_query holds: query_id, rank (from 1), vec_id, score."""
    sizes = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, query_blocks = -(-max(1, sizes["n"]) // BLOCK), -(-max(1, sizes["q"]) // QUERY_BLOCK)

    def search(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        index = ImpactIndex(rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy()).astype(np.int64))  # once for QUERY_BLOCK queries
        out = []
        for own, v in zip(queries["vec_id"].tolist(), queries["v"], strict=True):
            ids, scores = index.search(np.asarray(v, np.int64), own, k)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out)

    # Every block of queries meets every block of vectors once.
    asked = vectors.where(is_query).withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    held = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
    keys = ["dims", "block", "query_block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
