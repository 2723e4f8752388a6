"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors are quantised to integers and packed into blocks.  In each block the postings (vector, dimension, value) are
cut into segments by the size of the value, their impact.  Queries process the segments of a block from the highest
impact down; after each, what is left can add at most the product of the norms.  A query stops when that bound proves
that only few vectors can be among its best; those are scored exactly.  Otherwise it goes through all segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a packed block of the index and of the queries; what a task works on at a time.
INDEX_BLOCK, QUERY_BLOCK = 8192, 2048
SLICE, QUERY_SLICE = 2048, 512
LEVELS = 6
#: A query stops once at most so many vectors of a slice can be among its best.
FEW = 128
EXACT = 2.0**53


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    inf = float("inf")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x != inf) & (x != -inf))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


class Slice:
    """Some vectors with their segments: for each impact level the values of that level, and the norms of the rest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        size = np.abs(self.vectors)
        top = max(float(size.max(initial=0)), 1.0)
        level = np.clip(np.floor(np.log2(top / np.maximum(size, 1e-9))), 0, LEVELS - 1).astype(np.int8)
        self.planes, self.rest = [], []
        for k in range(LEVELS):
            self.planes.append(np.where(level == k, self.vectors, 0))
            later = np.where(level > k, self.vectors, 0).astype(np.float64)
            self.rest.append(np.sqrt((later**2).sum(1)))

    def possible(self, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its row, the rows here that can still be among its best, and their exact scores.

        ``floor`` is the score that a query's k-th best already has, minus infinity if there are fewer.
        """
        n = len(self.ids)
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        peak = norms.max(initial=0) * np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1)).max(initial=0)
        if peak >= EXACT:
            whole = queries.astype(object) @ self.vectors.T.astype(object)
            bound = 2**63 - 1
            for row in range(len(queries)):
                yield row, np.arange(n), np.array([max(-bound, min(bound, int(x))) for x in whole[row]], dtype=np.int64)
            return
        kind = np.float32 if peak * 2 < 2**24 else np.float64
        alive = np.arange(len(queries))
        score = np.zeros((len(queries), n), dtype=kind)
        for level, (plane, rest) in enumerate(zip(self.planes, self.rest)):
            score[alive] += queries[alive].astype(kind) @ plane.T.astype(kind)
            if level == LEVELS - 1:
                break
            part = score[alive]
            slack = norms[alive, None] * rest[None] * (1 + 1e-6) + 1e-3
            least = floor[alive]
            if n > k:
                least = np.maximum(least, np.partition(part - slack, n - k - 1, axis=1)[:, n - k - 1])
            open_ = part + slack >= least[:, None]
            done = open_.sum(1) <= FEW
            for at in np.flatnonzero(done).tolist():
                rows = np.flatnonzero(open_[at])
                yield alive[at], rows, np.rint(self.vectors[rows].astype(np.float64) @ queries[alive[at]].astype(np.float64)).astype(np.int64)
            alive = alive[~done]
            if not len(alive):
                return
        for row in alive.tolist():
            exact = np.rint(score[row]).astype(np.int64)
            rows = np.flatnonzero(exact >= floor[row])
            if len(rows) > k + 1:
                rows = rows[exact[rows] >= np.partition(exact[rows], len(rows) - k - 1)[len(rows) - k - 1]]
            yield row, rows, exact[rows]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[np.ndarray]:
    """query, vector and score of each query's best k in the block; ties to the smaller vector id."""
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(query_ids)
    floor = np.full(len(query_ids), -np.inf)
    for a in range(0, len(ids), SLICE):
        part = Slice(ids[a : a + SLICE], vectors[a : a + SLICE])
        own_rows = int(np.unique(part.ids, return_counts=True)[1].max(initial=1))
        for b in range(0, len(query_ids), QUERY_SLICE):
            # As many more than k as rows of the query's own id may be among them.
            for row, rows, scores in part.possible(queries[b : b + QUERY_SLICE], floor[b : b + QUERY_SLICE], k + own_rows):
                q = b + row
                there = part.ids[rows]
                own = there != query_ids[q]
                i = np.concatenate([best[q][0], there[own]])
                s = np.concatenate([best[q][1], scores[own]])
                order = np.lexsort((i, -s))[:k]
                best[q] = (i[order], s[order])
                if len(order) == k:
                    floor[q] = s[order[-1]]
    return [
        np.repeat(query_ids, [len(i) for i, _ in best]),
        np.concatenate([i for i, _ in best] or [np.empty(0, np.int64)]),
        np.concatenate([s for _, s in best] or [np.empty(0, np.int64)]),
    ]


def packed(vectors: DataFrame, count: int, block: int) -> DataFrame:
    """Vectors dealt into blocks of about ``block`` by the hash of id and values: dim, block, ids and values as bytes."""
    blocks = max(1, -(-count // block))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.array(pdf["vector"].tolist(), dtype=np.int64)
        return pd.DataFrame(
            {"dim": [pdf["dim"].iloc[0]], "block": [pdf["block"].iloc[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [values.tobytes()]}
        )

    return dealt.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, ids binary, vectors binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """Each query's ``k`` highest inner products with the other vectors: query_id, rank from 1, vec_id, score.

    Components become floor(scale * x).  Vectors that are null or empty or hold a null or non-finite component, or
    have no id, take no part; vectors of another length than the query's are no candidates.  Every row counts:
    of repeated ids each row is a candidate for queries of other ids, and each is a query whose results are ranked
    together under the id.  A query has fewer results if there are fewer candidates, and an empty table
    gives an empty one.  Scores beyond a long are cut to its range.

    Every query block meets every index block in a task of its own; only the best k of each come back.
    """
    clean = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    # Equal rows have equal scores: of each no more than k can be among the best, as candidates or as queries.
    clean = clean.groupBy("vec_id", "embedding").agg(F.count("*").alias("n"))
    clean = clean.withColumn("n", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))))
    clean = clean.select("vec_id", quantised(F.col("embedding"), scale).alias("vector"), F.size("embedding").alias("dim"))
    total, asked = vectors.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    index = packed(clean, total, INDEX_BLOCK)
    queries = packed(clean.where(is_query), asked, QUERY_BLOCK)
    n_queries, n_index = max(1, -(-asked // QUERY_BLOCK)), max(1, -(-total // INDEX_BLOCK))
    left = index.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))).withColumnRenamed("block", "b")
    right = queries.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_index - 1)))).withColumnRenamed("block", "q")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = [np.empty(0, np.int64)] * 3
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            arrays = []
            for side in (right, left):
                arrays += [np.frombuffer(side["ids"].iloc[0], np.int64), np.frombuffer(side["vectors"].iloc[0], np.int64).reshape(-1, dim)]
            columns = search_block(*arrays, k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    on = ["dim", "b", "q"]
    best = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
