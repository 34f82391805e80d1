"""Quality scores: the arrays against a plain walk, the fit against held-out labels."""

import zlib

import numpy as np
import pytest

from clickloom.llm import quality
from clickloom.llm.queries import llm_queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    rows = llm_queries()["op11_quality"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return rows, labels


def test_contract(spark, scored):
    rows, _ = scored
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == docs
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    assert [type(v) for v in rows[0]] == [int, bool, float, int]


def test_held_out_documents_are_told_apart(scored):
    rows, labels = scored
    good = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    assert good and bad and np.mean(good) > 0.97 and np.mean(bad) < 0.25


def test_held_out_labels_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", quality.held_out().cast("int").bitwiseXOR(labels.quality))
    want = {r.doc_id: r.score for r in quality.scored_documents(docs, labels).collect()}
    assert want == {r.doc_id: r.score for r in quality.scored_documents(docs, turned).collect()}


def test_arrays_give_what_walking_each_tree_gives():
    random = np.random.RandomState(3)
    rows = random.normal(size=(500, 5))
    labels = (rows[:, 0] + rows[:, 1] * rows[:, 2] > 0).astype(float)
    edges = [np.unique(np.quantile(rows[:, i], np.linspace(0.02, 0.98, 40))) for i in range(5)]
    trees = quality.boost(rows, labels, edges)

    def walk(row):
        total = trees.start
        for tree in range(quality.TREES):
            node = 0
            while node < 2**quality.DEPTH - 1:
                right = row[trees.statistic[tree, node]] > trees.cut[tree, node]
                node = 2 * node + (2 if right else 1)
            total += trees.leaf[tree, node - (2**quality.DEPTH - 1)]
        return total

    assert np.allclose(trees.margins(rows), [walk(row) for row in rows])
    assert ((trees.scores(rows) > 0.5) == labels).mean() > 0.95


def test_first_cut_is_the_best_of_all():
    random = np.random.RandomState(4)
    rows = random.normal(size=(200, 3))
    labels = (rows[:, 1] > 0.3).astype(float)
    edges = [np.quantile(rows[:, i], np.linspace(0.1, 0.9, 9)) for i in range(3)]
    trees = quality.boost(rows, labels, edges)
    p = (labels.sum() + 1) / 202
    gains = {}
    for i in range(3):
        for edge in edges[i]:
            sides = rows[:, i] > edge
            parts = [(labels[s] - p).sum() ** 2 / (p * (1 - p) * s.sum() + quality.PENALTY) for s in (sides, ~sides)]
            gains[i, edge] = sum(parts)
    assert (trees.statistic[0, 0], trees.cut[0, 0]) == max(gains, key=gains.get)


def test_whole_texts_count():
    clean = "Some plain words in a line. " * 400
    a, b = quality.statistics_of(clean), quality.statistics_of(clean + "$$$ ### " * 4000)
    assert b[quality.STATISTICS.index("other_marks")] > 10 * a[quality.STATISTICS.index("other_marks")]
    assert quality.statistics_of("") == [0.0] * len(quality.STATISTICS)
    assert quality.statistics_of("a\nb\na\na")[quality.STATISTICS.index("repeated_lines")] == 0.5


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, 0), (12, None), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = quality.scored_documents(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    twice = [r.score for r in rows if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality.scored_documents(no_documents, labels).collect() == []
    unlabelled = quality.scored_documents(odd_documents, labels.where("false")).collect()
    assert {r.score for r in unlabelled} == {0.5}
