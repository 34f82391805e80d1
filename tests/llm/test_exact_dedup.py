"""Exact dedup against a dictionary of normalised texts."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from clickloom.llm import exact_dedup as E


def normal(text):
    return (text or "").translate(str.maketrans(E.UPPER, E.LOWER))


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[normal(text)].append(-1 if i is None else i)
    out = []
    for text, ids in groups.items():
        keep, digest = max(ids), hashlib.sha256(text.encode()).hexdigest()
        for n, i in enumerate(sorted(ids, reverse=True)):
            out.append((i, keep, len(ids), n == 0, digest))
    return sorted(out)


def found(frame):
    fill = lambda x: -1 if x is None else x
    return sorted((fill(r.doc_id), fill(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in frame.collect())


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert found(E.exact_groups(odd_documents)) == expected(rows)


def test_kept_rows_have_all_columns(odd_documents):
    kept = E.without_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    wanted = sorted(r[0] for r in expected(rows) if r[3])
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == wanted


def test_empty_table(no_documents):
    assert E.exact_groups(no_documents).count() == 0
    assert E.without_copies(no_documents).count() == 0


@pytest.mark.parametrize("slots", [E.BLOCK, 1])
def test_a_full_filter_changes_nothing(spark, monkeypatch, slots):
    """With far too few slots all rows are possibly repeated, and the result is the same."""
    monkeypatch.setattr(E, "filter_slots", lambda rows: slots)
    rows = [(i, f"text {i % 700}" if i % 3 else "hot") for i in range(3000)]
    assert found(E.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_only_possible_repeats_are_shuffled(spark):
    rows = spark.range(50_000).selectExpr("id", "xxhash64(CASE WHEN id < 10 THEN 0 ELSE id END) AS hash")
    marked = E.possibly_repeated(rows, "hash", 50_000).where("repeated")
    ids = {r.id for r in marked.collect()}
    assert set(range(10)) <= ids and len(ids) < 1000


def test_filter_size_is_bounded():
    assert E.filter_slots(10**15) == E.MAX_SLOTS
    assert E.probe_slots(np.arange(10, dtype=np.uint64), 1 << 20).max() < 1 << 20
