"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from clickloom.llm import near_dedup as N


def brute(rows, least=N.SIMILARITY):
    """Class of each row by all pairs; `rows` are (id, text)."""
    shingler = N.Shingler()
    words = [shingler.words(t or "") for _, t in rows]
    keys = [shingler.key(t or "", w) for (_, t), w in zip(rows, words)]
    shingles = [shingler.shingles(w) for w in words]
    counts = np.zeros(N.SLOTS, np.int64)
    for s in shingles:
        counts[np.unique(s % N.SLOTS)] += 1
    idf = N.idf_table(counts, len(rows)).astype(np.float32)
    vectors = [N.weighted(s, idf) for s in shingles]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if root(i) != root(j) and (
                keys[i] == keys[j]
                or (rows[i][0] is not None and rows[j][0] is not None and len(vectors[i][0]) and N.similarity(vectors[i], vectors[j]) >= least)
            ):
                parent[root(i)] = root(j)
    classes = {}
    for i, (doc_id, _) in enumerate(rows):
        classes.setdefault(root(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own = classes[root(i)]
        least_id = min((x for x in own if x is not None), default=None)
        out.append((doc_id, least_id, len(own), doc_id == least_id))
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(frame):
    rows = N.near_groups(frame).collect()
    return sorted(((r.doc_id, r.class_id, r.class_size, r.kept) for r in rows), key=lambda r: (r[0] is None, r))


def made(seed):
    """Texts, copies with more and more words changed, chains, and shared passages."""
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=random.randint(2, 6)))
    text = lambda n: [word() for _ in range(n)]
    rows, passage = [], text(60)
    for _ in range(12):
        base = text(random.randint(30, 200))
        rows.append(base)
        for _ in range(6):
            copy = list(base)
            for _ in range(random.randint(1, 6)):
                copy[random.randrange(len(copy))] = word()
            rows.append(copy)
            base = copy if random.random() < 0.4 else base
    rows += [[*text(60), *passage, *text(60)] for _ in range(20)]
    rows += [text(random.randint(1, 8)) for _ in range(10)]
    random.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_all_pairs(spark, seed):
    rows = made(seed)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_a_large_group_is_taken_apart_in_blocks(spark, monkeypatch):
    """A bucket with many texts and several classes is compared block by block."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 8)
    random.seed(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(random.choice([1, 2, 3, 3])):
            copy[random.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(500 + i, " ".join(f"y{i}_{k}" for k in range(50))) for i in range(20)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert found(odd_documents) == brute(rows)
    assert found(no_documents) == []
    kept = N.without_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    wanted = sorted(-1 if r[0] is None else r[0] for r in brute(rows) if r[3])
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == wanted


def test_samples_agree_as_often_as_texts_are_similar():
    random.seed(4)
    sampler, idf = N.Sampler(), np.ones(N.SLOTS, np.float32)
    idf[: N.SLOTS // 2] = 2.5
    for share in (0.5, 0.8, 0.95):
        agreed, want = [], []
        for _ in range(40):
            common = np.array([random.getrandbits(32) for _ in range(int(400 * share))], np.uint32)
            a, b = (np.r_[common, np.array([random.getrandbits(32) for _ in range(int(200 * (1 - share)))], np.uint32), common[:30]] for _ in range(2))
            x, y = N.weighted(a, idf), N.weighted(b[:-15], idf)
            agreed.append((sampler.samples(*x) == sampler.samples(*y)).mean())
            want.append(N.similarity(x, y))
        assert abs(np.mean(agreed) - np.mean(want)) < 0.03


def test_long_chains_join(spark):
    """A chain of 200 nodes in one component, a star, and a node of its own."""
    edges = [(bytes([1, i]), bytes([1, i + 1])) for i in range(200)] + [(bytes([2, 0]), bytes([2, i])) for i in range(1, 50)]
    random.Random(1).shuffle(edges)
    rows = N.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    labels = {bytes(r.key): bytes(r.label) for r in rows}
    assert all(labels[bytes([1, i])] == bytes([1, 0]) for i in range(1, 201))
    assert all(labels[bytes([2, i])] == bytes([2, 0]) for i in range(1, 50))


def test_small_tables_are_stored_in_few_files(spark, monkeypatch):
    """Few rows in many partitions: not one file of a few rows for each of them."""
    files, stored = {}, N.stored

    def counted(rows, purpose):
        read = stored(rows, purpose)
        files.setdefault(purpose, []).append(len(read.inputFiles()))
        return read

    monkeypatch.setattr(N, "stored", counted)
    many = 3 * spark.sparkContext.defaultParallelism + 20
    settings = {"spark.sql.shuffle.partitions": str(many), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    rows = made(5)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(many))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == brute(rows)
    # blocks of buckets stay apart, as comparing them is work
    most = {purpose: max(counts) for purpose, counts in files.items() if purpose != "near-sifted"}
    assert len(most) > 6 and max(most.values()) <= spark.sparkContext.defaultParallelism, most


def test_stored_tables_keep_their_partitions_where_rows_are_many(spark):
    rows = spark.range(0, 1000, 1, 100)
    cores = spark.sparkContext.defaultParallelism
    assert N.few(rows, 1000, 10).rdd.getNumPartitions() == 100
    assert N.few(rows, 1000, 1).rdd.getNumPartitions() == 100
    assert N.few(rows, 1000, 1000).rdd.getNumPartitions() == min(100, cores)
    assert N.few(rows, 0, 1000).rdd.getNumPartitions() == min(100, cores)
