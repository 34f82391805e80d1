"""Byte-level BPE against the library that the ranks come from."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from clickloom.llm import byte_bpe as B
from clickloom.llm.queries import BYTE_RANKS

PATH = public_tokenizers.path(BYTE_RANKS)


@pytest.fixture(scope="module")
def library():
    ranks = B.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return B.byte_bpe(PATH, public_tokenizers.PATTERN)


def bytes_of(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_random_texts(library, encoder):
    random.seed(2)
    letters = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list(" \n\t  \x1c\x1f\x85\xa0'sdt") * 200 + ["😀"] * 50
    texts = ["".join(random.choices(letters, k=random.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "  \n\n x", "\x1c\x1dx", "a" * 4000, "ab" * 2000, "don't  stop", "<|endoftext|>", "ß" * 65]
    assert encoder.encode(texts) == [bytes_of(library, t) for t in texts]
    assert [encoder.decode(ids) for ids in encoder.encode(texts)] == [t.encode() for t in texts]


def test_both_trees_agree(encoder):
    random.seed(6)
    pieces = [bytes(random.choices(b"abcdefgh the", k=random.randint(1, 64))) for _ in range(500)]
    assert encoder.merge_short(pieces) == [np.array(encoder.merge_long(p), "<u4").tobytes() for p in pieces]


def test_leftmost_of_equal_ranks_merges_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaaa": 257}
    encoder = B.ByteBpe(ranks, r"\w+|\W+")
    assert encoder.merge_long(b"aaa") == [256, 97]
    assert encoder.merge_short([b"aaa", b"aaaaa"]) == [np.array(x, "<u4").tobytes() for x in ([256, 97], [257, 97])]


def test_a_cache_that_is_full_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(B, "CACHED_PIECES", 5)
    encoder = B.ByteBpe(B.read_ranks(PATH), public_tokenizers.PATTERN)
    for text in ["some words here and more words there", "other text with several more words than five"]:
        assert encoder.encode([text, text]) == [bytes_of(library, text)] * 2


def test_odd_rows(odd_documents, library):
    encoded = B.encode(odd_documents, PATH, public_tokenizers.PATTERN)
    rows = B.decode(encoded, PATH, public_tokenizers.PATTERN).collect()
    key = lambda x: (x[0] is None, x)
    want = [(r.doc_id, bytes_of(library, r.text or ""), (r.text or "").encode()) for r in odd_documents.collect()]
    assert sorted([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows], key=key) == sorted(want, key=key)


def test_empty_table(no_documents):
    encoded = B.encode(no_documents, PATH, public_tokenizers.PATTERN)
    assert B.decode(encoded, PATH, public_tokenizers.PATTERN).count() == 0
