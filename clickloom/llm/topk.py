"""Exact top-k inner products by MaxScore.

Vectors are split into shards. A shard keeps, per dimension and sign, a posting list of the
vectors with a component of that sign, with its largest size: for a query, the most that
the dimension can add. Dimensions are ordered by that bound. While the bounds of the
smallest of them together stay below the k-th best score so far, these are non-essential: no
vector found in them alone can enter the result. Only the postings of essential dimensions
are traversed; the other dimensions are probed for the vectors found, largest bound first,
and a vector is given up once its score and the bounds still open cannot reach the k-th.
The best of all shards are merged per query.

Vectors and queries are dealt by the shard number and sorted so that a shard's vectors come
before the queries, which then stream through: a task holds one shard and at most
`QUERIES_AT_ONCE` queries, and neither side is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a shard, about.
SHARD_ROWS = 4096
#: Queries that a task holds, at most.
QUERIES_AT_ONCE = 1024
SCALE = 256
RESULT = "query_id long, vec_id long, score long"


class Shard:
    """Posting lists of integer vectors: per dimension, the rows by sign and the bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.columns = np.ascontiguousarray(self.vectors.T)
        self.probed = self.given_up = 0  # of all queries so far
        rows, dims = self.vectors.shape
        zero = np.zeros(dims, np.int64)
        self.high = self.vectors.max(axis=0) if rows else zero
        self.low = self.vectors.min(axis=0) if rows else zero
        self.postings = {
            (d, sign): np.flatnonzero(sign * self.columns[d] > 0) for d in range(dims) for sign in (1, -1)
        }

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but the query's own; ties to the smaller id."""
        own = self.ids != query_id
        if not own.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = np.maximum(np.maximum(query * self.high, query * self.low), 0)
        order = np.argsort(-bounds, kind="stable")
        open_after = np.cumsum(bounds[order][::-1])[::-1]  # bounds of a dimension and all later ones
        open_after = np.append(open_after, 0)
        least = self._first_threshold(query, order, own, k)
        # essential: as few of the largest bounds as leave less than the threshold to the rest
        essential = int(np.argmax(open_after < least)) if least > 0 else len(order)
        found = np.zeros(len(self.ids), bool)
        for d in order[:essential]:
            if query[d]:
                found[self.postings[d, 1 if query[d] > 0 else -1]] = True
        if least <= 0:
            found[:] = True  # a vector with no positive term may be among the best
        rows = np.flatnonzero(found & own)
        score = np.zeros(len(rows), np.int64)
        step, begun = 4, int(own.sum())
        for at in range(0, len(order), step):
            part = order[at : at + step]
            score += query[part] @ self.columns[np.ix_(part, rows)]
            stays = score + open_after[min(at + step, len(order))] >= least
            if not stays.all():
                rows, score = rows[stays], score[stays]
        self.probed += begun
        self.given_up += begun - len(rows)
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[best]], score[best]

    def _first_threshold(self, query: np.ndarray, order: np.ndarray, own: np.ndarray, k: int) -> int:
        """The k-th best score among the rows that lead in the dimension of the largest bound;
        the least possible one if the shard has fewer than k rows."""
        if own.sum() <= k:
            return -(1 << 62)
        d = order[0]
        lead = np.where(own, query[d] * self.columns[d], np.iinfo(np.int64).min)
        rows = np.argpartition(-lead, min(16 * k, len(lead) - 1))[: 16 * k]
        rows = rows[own[rows]]
        if len(rows) < k:
            return -(1 << 62)
        return int(np.sort(self.vectors[rows] @ query)[-k])


def quantised(vector: str, scale: int = SCALE) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def _usable(vector: str) -> Column:
    # infinite and missing components fail the comparison; NaN is larger than all numbers
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    )


class _Searcher:
    """One shard at a time: its vectors, then its queries."""

    def __init__(self, k: int):
        self.k, self.parts = k, []
        self.shards: dict[int, Shard] | None = None

    def add(self, ids: pa.Array, vectors: pa.Array) -> None:
        self.parts.append((ids.to_numpy(), vectors))

    def _build(self) -> dict[int, Shard]:
        shards = {}  # vectors of one length each: others have no inner product with a query
        if not self.parts:
            return shards
        ids = np.concatenate([part for part, _ in self.parts])
        vectors = pa.concat_arrays([part for _, part in self.parts])
        lengths = np.diff(vectors.offsets.to_numpy())
        for size in np.unique(lengths).tolist():
            some = np.flatnonzero(lengths == size)
            values = vectors.take(pa.array(some)).flatten().to_numpy()
            shards[size] = Shard(ids[some], values.reshape(len(some), size))
        self.parts = []
        return shards

    def search(self, ids: pa.Array, vectors: pa.Array) -> pa.RecordBatch:
        if self.shards is None:
            self.shards = self._build()
        queries, hits, scores = [], [], []
        for query_id, query in zip(ids.to_pylist(), vectors):
            if len(query) in self.shards:
                values = query.values.to_numpy(zero_copy_only=False)
                best, score = self.shards[len(query)].search(query_id, values, self.k)
                queries.append(np.full(len(best), query_id, np.int64))
                hits.append(best)
                scores.append(score)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (queries, hits, scores)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def _search_shards(k: int):
    """Reads rows sorted by shard, a shard's vectors before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, searcher = None, None
        for batch in batches:
            # one run of rows per shard and side; runs are cut to what may be held at once
            shard, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (side[1:] != side[:-1])][: len(shard)])
            for begin, end in zip(new.tolist(), [*new[1:].tolist(), len(shard)]):
                if shard[begin] != current:
                    current, searcher = shard[begin], _Searcher(k)
                for at in range(begin, end, QUERIES_AT_ONCE):
                    part = batch.slice(at, min(QUERIES_AT_ONCE, end - at))
                    if side[begin]:
                        yield searcher.search(part.column(2), part.column(3))
                    else:
                        searcher.add(part.column(2), part.column(3))

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per query its k best vectors: query_id, rank (from 1), vec_id, score.

    Components are turned into floor(256 * x); the score is the inner product of integers.
    Queries are the rows for which `is_query` (over the column `vec_id`) holds; candidates
    are all rows but the query's own. Ties go to the smaller id. Vectors that are null, or
    hold a null, NaN or infinite component, and rows with a null id take no part; vectors of
    another length than the query are no candidates for it. Rows of the same id count as one,
    with the smallest of their vectors. Fewer candidates than k give as many ranks. An empty
    table gives no rows; other columns are not read.
    """
    usable = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    usable = usable.where(_usable("v") & F.col("vec_id").isNotNull())
    rows = usable.groupBy("vec_id").agg(F.min(quantised("v")).alias("vector"))
    count = usable.count()
    shards = max(1, -(-count // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("long").alias("shard")
    dealt = rows.select(shard, F.lit(0).alias("side"), "vec_id", "vector")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    queries = rows.where(is_query).select(numbers, F.lit(1).alias("side"), "vec_id", "vector")
    in_order = dealt.unionByName(queries).repartition(shards, "shard").sortWithinPartitions("shard", "side")
    found = in_order.mapInArrow(_search_shards(k), RESULT)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
