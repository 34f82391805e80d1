"""Token ids of whole texts by a word-level tokenizer, through a cache of pieces."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

#: Pieces kept per Python worker; later ones are kept until there are `PASSING_PIECES` of them,
#: longer ones for a text only. Some 40 MB in all.
CACHED_PIECES = 160_000
PASSING_PIECES = 60_000
LONGEST_CACHED = 64

# What the tokenizer encodes apart, in lower case. Python counts a few marks (\x1c to \x1f) as
# white space that the tokenizer does not.
_ASCII_PIECE = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9\t-\r ]+")
_PIECE = re.compile(r"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|[_\x1c-\x1f])+")
_ODD = re.compile("[\x1c-\x1f]")


# The public table of letters that stand for bytes.
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in own]
    return {byte: chr(byte) for byte in own} | {byte: chr(256 + i) for i, byte in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def _plain(text: str) -> bool:
    """Whether NFC leaves the text and its lower case as they are, and lower case changes each
    character by itself (that of a capital sigma depends on its place)."""
    if text.isascii():
        return True
    lower = text.lower()
    return (
        len(lower) == len(text)
        and "\u03a3" not in text
        and unicodedata.is_normalized("NFC", text)
        and unicodedata.is_normalized("NFC", lower)
    )


def _unassigned(piece: str) -> bool:
    """Whether it holds characters that are newer than Python's tables: the tokenizer may know
    them, and then tells what else belongs to their piece."""
    return not piece.isascii() and not piece.isalpha() and any(unicodedata.category(c) == "Cn" for c in piece)


def _pieces(text: str) -> list[str]:
    """The text in pieces, whose ids in turn are those of the text: what the tokenizer encodes
    apart, in lower case. Holds but for unassigned characters."""
    if text.isascii():
        return _ASCII_PIECE.findall(text.lower())
    return _PIECE.findall(text.lower()) if _plain(text) else _pieces_by_word(text)


def _pieces_by_word(text: str) -> list[str]:
    """The same for every text: words that are not plain stay whole."""
    if _ODD.search(text):
        return [text]
    pieces = []
    for word in text.split():
        pieces += _PIECE.findall(word.lower()) if _plain(word) and not _unassigned(word) else [word]
    return pieces


class WordTokenizer:
    """Ids of a byte-level BPE with lower case and NFC that drops white space and never joins what it separates.

    The ids of a text are then those of its pieces in turn, and each distinct piece need be
    encoded only once. `encode` returns exactly what the tokenizer gives for the whole text.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []

    def _encode_piece(self, piece: str) -> bytes:
        if piece.isalpha() and piece.lower() == piece and unicodedata.is_normalized("NFC", piece):
            # such letters alone are one piece to the tokenizer: its model is asked directly
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids = self.id_bytes
            return b"".join([ids[token.id] for token in self.model.tokenize(piece)])
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        known = self.known
        for text in texts:
            pieces = _pieces(text)
            # a full cache keeps the pieces it has: the frequent ones came early
            full = len(known) - len(self.passing) > CACHED_PIECES
            new = set(pieces).difference(known)
            if not text.isascii() and any(map(_unassigned, new)):
                pieces = _pieces_by_word(text)
                new = set(pieces).difference(known)
            once = []
            for piece in new:
                known[piece] = self._encode_piece(piece)
                if len(piece) > LONGEST_CACHED or _unassigned(piece):
                    once.append(piece)
                elif full:
                    self.passing.append(piece)
            out.append(b"".join(map(known.__getitem__, pieces)))
            for piece in once:
                del known[piece]
            if len(self.passing) > PASSING_PIECES:
                for piece in self.passing:
                    del known[piece]
                self.passing.clear()
        return out


_cached: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file, kept for the life of the Python worker."""
    if path not in _cached:
        _cached[path] = WordTokenizer(path)
    return _cached[path]
