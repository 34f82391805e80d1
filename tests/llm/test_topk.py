"""Top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import topk


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        good[i] = min(good.get(i, q), q)
    out = []
    for i, q in good.items():
        if i % every == 0:
            scores = [(-int(np.dot(q, c)), j) for j, c in good.items() if j != i and len(c) == len(q)]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, rows, k=5, every=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    return sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % every == 0, k).collect())


@pytest.mark.parametrize("spread", ["normal", "ties", "positive", "negative", "copies"])
def test_same_as_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    random = np.random.RandomState(4)
    vectors = random.normal(size=(300, 12))
    if spread == "ties":
        vectors = random.randint(-1, 2, (300, 12)) / 4
    elif spread == "positive":
        vectors = np.abs(vectors) * (random.uniform(size=vectors.shape) < 0.2)
    elif spread == "negative":
        vectors = -np.abs(vectors) * np.where(np.arange(300) % 5 == 0, -1, 1)[:, None]
    elif spread == "copies":
        vectors[50:200] = vectors[50]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert found(spark, rows) == brute(rows, 5, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [1.0, 2.0]), (None, [1.0, 1.0])]
    rows += [(5, [1.0, 2.0]), (6, [0.5, 0.5]), (7, [1.0, 2.0, 3.0]), (8, []), (10, [0.0, 0.0]), (10, [9.0, 9.0])]
    assert found(spark, rows) == brute(rows, 5, 5)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_most_vectors_are_given_up_early():
    """Vectors whose open dimensions cannot lift them to the threshold are not probed on."""
    random = np.random.RandomState(0)
    vectors = random.randint(0, 3, (2000, 16))
    vectors[:, 0] = random.randint(0, 1000, 2000)
    shard = topk.Shard(np.arange(2000), vectors)
    query = np.r_[100, np.ones(15, int)]
    best, score = shard.search(-1, query, 5)
    everything = vectors @ query
    order = np.lexsort((np.arange(2000), -everything))[:5]
    assert best.tolist() == order.tolist() and score.tolist() == everything[order].tolist()
    assert shard.probed == 2000 and shard.given_up > 1500


def test_queries_stream_through_a_shard(spark, monkeypatch):
    """No task holds more than a shard of vectors and a batch of queries."""
    import pyarrow as pa

    held = []

    class Counting(topk._Searcher):
        def add(self, ids, vectors):
            super().add(ids, vectors)
            held.append(("vectors", sum(len(part) for part, _ in self.parts)))

        def search(self, ids, vectors):
            held.append(("queries", len(ids)))
            return super().search(ids, vectors)

    monkeypatch.setattr(topk, "_Searcher", Counting)
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 50)
    random = np.random.RandomState(1)

    def batches():
        for shard in range(3):
            for side, n in ((0, 200), (1, 330)):
                ids, vectors = np.arange(n) + 1000 * side, random.randint(-9, 9, (n, 4)).tolist()
                for at in range(0, n, 70):
                    part = slice(at, at + 70)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard] * len(ids[part])),
                            pa.array([side] * len(ids[part])),
                            pa.array(ids[part]),
                            pa.array(vectors[part], pa.list_(pa.int64())),
                        ],
                        names=["shard", "side", "vec_id", "vector"],
                    )

    rows = sum(batch.num_rows for batch in topk._search_shards(5)(batches()))
    assert rows == 3 * 330 * 5
    assert max(n for kind, n in held if kind == "queries") == 50
    assert max(n for kind, n in held if kind == "vectors") == 200
