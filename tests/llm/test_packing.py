"""Packing: every token once, all limits kept, little padding."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clickloom.llm import packing, tokens
from clickloom.llm.packing import Limits, Packer, Piece, pack
from clickloom.llm.queries import WORD_TOKENIZER
from clickloom.llm.tokens import WordTokenizer

PATH = public_tokenizers.path(WORD_TOKENIZER)


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts():
    random.seed(3)
    letters = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(" \n\t.,'") * 300 + ["😀"] * 20
    texts = ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(1500)]
    texts += ["", " ", "it's. don't! ΑΣ. Σ", "\x1cа\x1d b", "<|endoftext|>", "İ. İİ", "a" * 3000, "क़. xक़"]
    assert WordTokenizer(PATH).encode(texts) == plain_ids(texts)


def test_a_piece_is_kept_once_whatever_its_case_and_marks():
    """Rare words are looked up by what the tokenizer encodes apart, so most are known already."""
    tokenizer = WordTokenizer(PATH)
    texts = ["Word word, WORD! wOrd.", "Été? été; ÉTÉ", "don't Don't"]
    assert tokenizer.encode(texts) == plain_ids(texts)
    assert set(tokenizer.known) == {"word", "été", "don", "'t", *",!.?;"}


def test_lower_case_that_would_compose_stays_apart():
    """There is no single letter for a capital T with two dots, but there is one in lower case."""
    texts = ["T\u0308a", "H\u0331b. T\u0308a", "x T\u0308", "J\u030c\u0391\u03a3 a"]
    assert WordTokenizer(PATH).encode(texts) == plain_ids(texts)


def test_characters_unknown_to_python_stay_in_their_word():
    texts = ["\u1c8a", "\u268a\u1c8a\u00f9 a", "a\u1c8a b", "\u1c8a\u2600 \u0391\u03a3", "x\U00010d40.\U00010d40"]
    assert WordTokenizer(PATH).encode(texts * 2) == plain_ids(texts * 2)


def test_a_full_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 50)
    monkeypatch.setattr(tokens, "PASSING_PIECES", 30)
    random.seed(4)
    texts = [" ".join("".join(random.choices("abcdeéß'1.", k=random.randint(1, 90))) for _ in range(20)) for _ in range(60)]
    tokenizer = WordTokenizer(PATH)
    for text, ids in zip(texts, plain_ids(texts)):
        pieces = len(set(tokens._pieces(text)))
        assert tokenizer.encode([text]) == [ids]
        assert len(tokenizer.known) <= 50 + 30 + 2 * pieces
    assert max(map(len, tokenizer.known)) <= tokens.LONGEST_CACHED


def check(rows, documents, limits):
    """`documents`: by id, all ids with the end, and where loss begins; ids must be unique."""
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id].append(r)
        assert r.length == len(r.ids) // 4
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces])
        assert [r.offset for r in pieces] == [0, *ends[:-1]]
        assert ends[-1] <= limits.tokens and len(pieces) <= limits.segments
        assert sum(r.loss_tokens for r in pieces) <= limits.loss_tokens
    for doc_id, (ids, loss_from) in documents.items():
        pieces = sorted(by_document[doc_id], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == ids
        assert sum(r.loss_tokens for r in pieces) == len(ids) // 4 - loss_from
        assert {r.doc_tokens for r in pieces} == {len(ids) // 4}
    return by_sequence


def test_odd_rows(odd_documents):
    rows = pack(odd_documents.dropDuplicates(["doc_id"]), PATH).collect()
    texts = {r.doc_id: r.text or "" for r in odd_documents.collect()}
    end = np.array([1], "<u4").tobytes()
    check(rows, {i: (ids + end, 0) for i, ids in zip(texts, plain_ids(list(texts.values())))}, Limits())
    assert pack(odd_documents, PATH).where("doc_id = 5 and start = 0").count() == 2


def test_empty_table(no_documents):
    assert pack(no_documents, PATH).count() == 0


def test_prompts_bear_no_loss_and_all_limits_hold(spark):
    random.seed(1)
    word = lambda n: " ".join(random.choice("alpha beta gamma delta".split()) for _ in range(n))
    data = [(i, word(random.randint(0, 300)), word(random.randint(0, 200))) for i in range(400)] + [(400, word(3000), word(3000))]
    data += [(401, None, None), (402, "", "")]
    limits = Limits(tokens=512, segments=3, loss_tokens=200)
    frame = spark.createDataFrame(data, "doc_id long, ask string, text string").coalesce(2)
    rows = pack(frame, PATH, limits, prompt="ask").collect()
    asks, texts = plain_ids([a or "" for _, a, _ in data]), plain_ids([t or "" for _, _, t in data])
    end = np.array([1], "<u4").tobytes()
    check(rows, {d[0]: (a + t + end, len(a) // 4) for d, a, t in zip(data, asks, texts)}, limits)


@pytest.mark.parametrize("cut", [True, False])
def test_little_padding(cut):
    random.seed(5)
    packer = Packer(Limits(), 1024, cut)
    sequences = []
    for i in range(3000):
        n = random.choice([random.randint(1, 60), random.randint(100, 900), random.randint(900, 5000)])
        sequences += packer.add(Piece(i, 0, bytes(4 * n), 0, n))
    sequences += packer.finish()
    sizes = [sum(map(len, s)) for s in sequences]
    padding = sum(0 if size & (size - 1) == 0 else 2048 - size for size in sizes)
    assert padding < (0.002 if cut else 0.02) * sum(sizes)


def test_the_dot_product_chooses_what_fits_the_shape_of_the_room():
    """One of two equally long examples is taken by what else it needs: with loss scarce, a
    sequence is filled from examples that bear much and little loss together."""
    packer = Packer(Limits(tokens=100, segments=10, loss_tokens=60), 100, cut=False)
    for i in range(10):
        list(packer.add(Piece(("much", i), 0, bytes(4 * 50), 0, 50)))
        list(packer.add(Piece(("none", i), 0, bytes(4 * 50), 50, 50)))
    sequences = list(packer.finish())
    assert len(sequences) == 10
    assert all({p.doc_id[0] for p in s} == {"much", "none"} for s in sequences)


def test_what_leaves_a_task_at_once_is_bounded_by_bytes(spark, monkeypatch):
    """1,500 long pieces are fewer rows than a batch may have, and far more bytes."""
    docs = spark.createDataFrame([], "doc_id long, text string")
    runs = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run))
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": lambda: type("Own", (), {"partitionId": lambda self: 0})()}))
    pack(docs, PATH)
    texts = ["one two three four five " * 340] * 1500
    given = pa.table({"doc_id": pa.array(range(1500), pa.int64()), "text": texts, "prompt": [""] * 1500})
    out = list(runs[0](iter(given.to_batches())))
    assert max(batch.nbytes for batch in out) < packing.IDS_BYTES * 1.2
    ids = defaultdict(bytes)
    for row in sorted((row for batch in out for row in batch.to_pylist()), key=lambda row: (row["doc_id"], row["start"])):
        ids[row["doc_id"]] += row["ids"]
    whole = plain_ids(texts[:1])[0] + np.array([1], "<u4").tobytes()
    assert ids == {i: whole for i in range(1500)}
