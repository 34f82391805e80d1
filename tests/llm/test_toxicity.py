"""Toxicity: the neighbours against brute force, the scores on held-out labels."""

import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import toxicity as T
from clickloom.llm.queries import op8_toxicity

SF = "/root/testdata/sf0.1"


def test_nearest_are_exact():
    random = np.random.RandomState(1)
    words = [f"w{i}" for i in range(300)]
    vocabulary = {w: i for i, w in enumerate(words)}
    index = T.BlockMaxIndex(vocabulary, random.uniform(0.5, 5, 300), np.zeros(0), np.zeros(0), 0.1)
    draw = lambda: Counter(random.choice(words, random.randint(1, 60)))
    vectors = [index.vector(draw()) for _ in range(500)]
    vectors[100:120] = [vectors[100]] * 20  # ties
    index.labels, index.ids = random.randint(0, 2, 500), np.arange(500)
    index.build(vectors)
    dense = np.zeros((500, 300))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for q in [vectors[100], *(index.vector(draw()) for _ in range(50))]:
        one = np.zeros(300)
        one[q[0]] = q[1]
        cosine = dense @ one
        best, found = index.nearest(*q, 9)
        want = np.lexsort((np.arange(500), -np.round(cosine, 12)))[:9]
        assert np.allclose(np.sort(found), np.sort(cosine[want]))
        assert best.tolist() == want.tolist() or np.allclose(cosine[best], cosine[want])


@pytest.fixture(scope="module")
def scored(spark):
    rows = op8_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return rows, labels


def test_held_out_labels(scored):
    rows, labels = scored
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    wins = np.mean([(t > c) + (t == c) / 2 for t in toxic for c in clean])
    caught, wrong = np.mean(np.array(toxic) >= 0.7), np.mean(np.array(clean) >= 0.7)
    assert wins > 0.95 and caught > 0.8 and wrong < 0.01


def test_scores_are_calibrated(scored):
    rows, labels = scored
    held = np.array([(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels])
    assert abs(held[:, 0].mean() - held[:, 1].mean()) < 0.04


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 0), (4, 1), (None, 1), (99, 1)], "doc_id long, toxic int")
    rows = T.scored_documents(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count()
    by_text = {r.doc_id: r for r in rows}
    assert by_text[3].score == by_text[4].score and 0 <= by_text[3].score <= 1
    assert T.scored_documents(no_documents, labels).count() == 0
    assert {r.predicted for r in T.scored_documents(odd_documents, labels.where("false")).collect()} == {0}
    kept = T.without_toxic(odd_documents, labels.where("false"))
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()


def test_a_label_of_its_own_is_no_input(spark):
    """Changing a held-out label changes no score."""
    texts = [(i, " ".join(["idiotic" if i % 5 == 0 else "lovely", *(f"filler{i * j % 50:02d}" for j in range(20))])) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    label = lambda flip: spark.createDataFrame(
        [(i, int(i % 5 == 0) ^ int(flip and zlib.crc32(str(i).encode()) % 3 == 1)) for i in range(300)], "doc_id long, toxic int"
    )
    a, b = (sorted((r.doc_id, r.score) for r in T.scored_documents(docs, label(f)).collect()) for f in (False, True))
    assert a == b


def _scores(spark, texts, toxic):
    """Scores of texts without a label, learnt from every other one."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(toxic(i))) for i in range(0, len(texts), 2)], "doc_id long, toxic int")
    rows = T.scored_documents(docs, labels).collect()
    return [[r.score for r in rows if r.doc_id % 2 and toxic(r.doc_id) == side] for side in (True, False)]


def _filler(i, words=12):
    return " ".join(f"{n}th" for n in np.random.RandomState(i).choice(90, words, False))


def test_insults_count_however_common_or_rare(spark):
    third = [f"{'idiotic' if i // 2 % 3 == 0 else 'lovely'} {_filler(i)}" for i in range(300)]
    toxic, clean = _scores(spark, third, lambda i: i // 2 % 3 == 0)
    assert np.mean(np.array(toxic) >= 0.7) > 0.9 and max(clean) < 0.7
    rare = [f"{'idiotic idiotic' if i // 2 % 2000 == 0 else 'lovely lovely'} {_filler(i)}" for i in range(8000)]
    toxic, clean = _scores(spark, rare, lambda i: i // 2 % 2000 == 0)
    assert min(toxic) > max(clean)


@pytest.mark.parametrize("insult, praise", [("scum", "nice"), ("ass", "ok"), ("这个人是白痴", "这个人很可爱"), ("เขาโง่มาก", "เขาดีมาก")])
def test_short_and_unspaced_words_count(spark, insult, praise):
    texts = [f"{'we all say so ' * (i % 3)}{insult if i // 2 % 4 == 0 else praise}" for i in range(300)]
    toxic, clean = _scores(spark, texts, lambda i: i // 2 % 4 == 0)
    assert min(toxic) >= 0.7 > max(clean)


def test_examples_are_read_to_the_end(spark):
    long = [(i, "filler " * 40_000 + ("idiotic" if i % 2 else "lovely")) for i in range(4)]
    index = T.fit(spark.createDataFrame(long, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, toxic int"))
    assert set(index.vocabulary) == {"fill", "er", "idio", "tic", "love", "ly"}


def test_nearest_of_each_class_and_votes():
    """Both searches and the vote against dense arithmetic; an example left out leaves no trace."""
    random = np.random.RandomState(2)
    words = [f"w{i}" for i in range(200)]
    index = T.BlockMaxIndex({w: i for i, w in enumerate(words)}, random.uniform(0.5, 5, 200), np.zeros(0), np.zeros(0), 0.1)
    draw = lambda: Counter(random.choice(words, random.randint(1, 60)))
    vectors = [index.vector(draw()) for _ in range(300)]
    index.labels, index.ids = random.randint(0, 2, 300), np.arange(300)
    index.build(vectors)
    dense = np.zeros((300, 200))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for query in range(40):
        left = np.arange(300) != query
        found = index.of_each_class(*vectors[query], 5, query)
        cosine = dense @ dense[query]
        votes = []
        sides = [left & (index.labels == label) for label in (0, 1)]
        share = [(dense[side] > 0).sum(0) / side.sum() + 2 / min(s.sum() for s in sides) for side in sides]
        lean = np.maximum(0, np.log(share[1] / share[0]))
        for side, (best, got) in zip(sides, found):
            assert np.allclose(got, np.sort(cosine[side])[::-1][:5]) and side[best].all()
            votes.append((dense[best] * dense[query] * lean).sum() / 5)
        want = np.log((votes[1] + T.LEAST_VOTE) / (votes[0] + T.LEAST_VOTE))
        assert np.isclose(index.vote(*vectors[query], found, 5, query), want)


def test_what_each_term_leans_to_is_told_once(monkeypatch):
    """A text is scored by the leanings that the index was built with; only an example, which is
    left out of them, has its own."""
    index = T.BlockMaxIndex({"a": 0, "b": 1, "c": 2}, np.ones(3), np.zeros(0), np.zeros(0), 0.1)
    index.labels, index.ids = np.array([0, 0, 1]), np.arange(3)
    index.build([index.vector(Counter(text)) for text in ("ab", "bc", "ac")])
    assert np.array_equal(index.lean, index._leaning(np.arange(3)))
    vector = index.vector(Counter("aac"))
    found = index.of_each_class(*vector, 2)
    want = index.vote(*vector, found, 2)
    monkeypatch.setattr(T.BlockMaxIndex, "_leaning", lambda *_: 1 / 0)
    assert index.vote(*vector, found, 2) == want


@pytest.mark.parametrize("members", [0, 3, 5, 40])
def test_a_side_with_few_examples(members):
    """Fewer examples than are looked for, or none; those without a common term do not count."""
    random = np.random.RandomState(3)
    index = T.BlockMaxIndex({str(i): i for i in range(30)}, np.ones(30), np.zeros(0), np.zeros(0), 0.1)
    vectors = [index.vector(Counter(random.choice(30, 3).astype(str))) for _ in range(100)]
    index.labels, index.ids = (np.arange(100) < members).astype(int), np.arange(100)
    index.build(vectors)
    dense = np.zeros((100, 30))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for q in range(100):
        cosine = np.round(dense @ dense[q], 6)
        for label, (best, got) in enumerate(index.of_each_class(*vectors[q], 5)):
            side = np.flatnonzero((index.labels == label) & (cosine > 0))
            want = side[np.argsort(-cosine[side], kind="stable")][:5]
            assert len(best) == len(want) and np.allclose(got, cosine[want], atol=2e-6)


def test_features_of_all_scripts():
    assert T.stems_of("Hello_wor1d, I'm x") == ["hell", "o_wo", "r1d", "i", "m", "x"]
    assert T.stems_of("Éternel ½ªß") == ["éter", "nel", "½ªß"]
    assert T.stems_of("Ωmegatron 我们好 é") == ["ωmeg", "atro", "n", "é", "我们", "们好"]
    latin = "".join(map(chr, range(256)))
    assert T.stems_of(latin) == T._PIECE.findall(T._UNSPACED.sub(" ", latin.lower()))
    ascii_ = "".join(map(chr, range(128)))
    assert T.stems_of(ascii_) == T._PIECE.findall(ascii_.lower())


def test_document_frequencies_count_texts(spark):
    docs = spark.createDataFrame([("one two one",), ("two unknown",), ("",), ("nothing",)], "text string")
    counts, texts = T._document_frequencies(docs, {"one": 0, "two": 1, "thre": 2})
    assert counts.tolist() == [1, 2, 0] and texts == 4


def test_an_id_repeated_often_is_one_example(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(5000)] + [(2, "other")], "doc_id long, text string")
    index = T.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert sorted(index.ids.tolist()) == [1, 2] and "0" in index.vocabulary and "6" not in index.vocabulary
