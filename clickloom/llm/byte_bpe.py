"""Byte-level BPE, encoding and decoding.

The merges of a piece of text are found with a segment tree over its byte positions. A leaf
holds the rank of the pair that starts at its position, and every node the least of its
leaves with the leftmost position; the root is the next merge. A merge changes three leaves
(its own, its right neighbour's and its left live neighbour's) and the nodes above them.

Short pieces of one size class are merged side by side, a row of a matrix each. Pieces are
cached, since most of a text consists of pieces met before.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import text_or_empty

#: Pieces kept at most per Python worker, and the longest piece that is kept.
CACHED_PIECES = 600_000
CACHED_LENGTH = 64
#: Longest piece, in bytes, that is merged side by side with others.
SIDE_BY_SIDE = 64

_POSITION_BITS = 32
_NONE = np.iinfo(np.int64).max
_PAIR_BITS = 20

# A run of other than white space with one space before it, or white space: no match of a
# pattern of the usual kind reaches over the border of two such runs. \x1c-\x1f are no white
# space here, as for the pattern.
_RUN = re.compile(r" ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left << _PAIR_BITS | right] = rank
        self.pair_keys = np.array(sorted(self.pairs), np.int64)
        self.pair_ranks = np.array([self.pairs[key] for key in self.pair_keys.tolist()], np.int64)
        self.known: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    # -- one long piece ------------------------------------------------------------------

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece, by a segment tree in plain lists."""
        ids = [int(self.byte_ids[b]) for b in piece]
        n = len(ids)
        size = 1 << max(0, (n - 1).bit_length())
        none = int(_NONE)
        pairs = self.pairs
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << _PAIR_BITS | ids[i + 1])
            if rank is not None:
                tree[size + i] = rank << _POSITION_BITS | i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after = list(range(1, n + 1))
        before = list(range(-1, n))

        def put(i: int) -> None:
            j = after[i]
            rank = pairs.get(ids[i] << _PAIR_BITS | ids[j]) if j < n else None
            set_leaf(i, none if rank is None else rank << _POSITION_BITS | i)

        def set_leaf(i: int, value: int) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while tree[1] != none:
            i = tree[1] & ((1 << _POSITION_BITS) - 1)
            j = after[i]
            ids[i] = tree[1] >> _POSITION_BITS
            after[i] = after[j]
            before[after[j]] = i
            set_leaf(j, none)
            put(i)
            if before[i] >= 0:
                put(before[i])
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    # -- many short pieces ---------------------------------------------------------------

    def _pair_values(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, valid: np.ndarray) -> np.ndarray:
        keys = left << _PAIR_BITS | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = valid & (self.pair_keys[at] == keys)
        return np.where(hit, self.pair_ranks[at] << _POSITION_BITS | place, _NONE)

    def merge_short(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of at most `size` bytes, as bytes of unsigned 32-bit integers."""
        lengths = np.array([len(p) for p in pieces])
        size = 1 << max(1, int(lengths.max() - 1).bit_length())
        rows = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
        # one place more stands for the end
        ids = np.zeros((rows, size + 1), np.int64)
        ids[:, :size] = self.byte_ids[raw]
        after = np.tile(np.arange(1, size + 2), (rows, 1))
        before = np.tile(np.arange(-1, size), (rows, 1))
        tree = np.full((rows, 2 * size), _NONE)
        places = np.arange(size)
        tree[:, size:] = self._pair_values(ids[:, :-1], ids[:, 1:], places, places + 1 < lengths[:, None])
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def set_leaves(row: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
            node = size + place
            tree[row, node] = value
            while size > 1 and node[0] > 1:  # all leaves lie equally deep
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        live = np.flatnonzero(tree[:, 1] != _NONE)
        while len(live):
            root = tree[live, 1]
            i = root & ((1 << _POSITION_BITS) - 1)
            j = after[live, i]
            k = after[live, j]
            ids[live, i] = root >> _POSITION_BITS
            after[live, i] = k
            before[live, np.minimum(k, size)] = i
            set_leaves(live, j, np.full(len(live), _NONE))
            set_leaves(live, i, self._pair_values(ids[live, i], ids[live, np.minimum(k, size)], i, k < lengths[live]))
            h = before[live, i]
            inner = h >= 0
            if inner.any():
                r, h = live[inner], h[inner]
                set_leaves(r, h, self._pair_values(ids[r, h], ids[r, i[inner]], h, np.ones(len(r), bool)))
            live = live[tree[live, 1] != _NONE]

        alive = np.zeros((rows, size + 1), bool)
        place = np.zeros(rows, np.int64)
        live = np.flatnonzero(lengths > 0)
        while len(live):
            alive[live, place[live]] = True
            place[live] = after[live, place[live]]
            live = live[place[live] < lengths[live]]
        flat = ids[alive].astype("<u4").tobytes()
        ends = 4 * np.cumsum(alive.sum(axis=1))
        starts = np.r_[0, ends[:-1]]
        return [flat[s:e] for s, e in zip(starts.tolist(), ends.tolist())]

    # -- texts ---------------------------------------------------------------------------

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pieces not met before."""
        found: dict[str, bytes] = {}
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(raw)
            if rank is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(raw) > SIDE_BY_SIDE:
                found[piece] = np.array(self.merge_long(raw), "<u4").tobytes()
            else:
                classes.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in classes.values():
            for at in range(0, len(group), 20_000):
                part = group[at : at + 20_000]
                found.update(zip([p for p, _ in part], self.merge_short([raw for _, raw in part])))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        split = [_RUN.findall(text) for text in texts]
        fresh = {run for runs in split for run in runs if run not in self.runs}
        if len(self.runs) + len(fresh) > CACHED_PIECES:
            self.runs.clear()
            fresh = {run for runs in split for run in runs}
        pieces = {run: self.pattern.findall(run) for run in fresh}
        new = {piece for parts in pieces.values() for piece in parts if piece not in self.known}
        if len(self.known) + len(new) > CACHED_PIECES:
            self.known.clear()
            new = {piece for parts in pieces.values() for piece in parts}
        self.known.update(self._learn(new))
        self.runs.update((run, b"".join(map(self.known.__getitem__, parts))) for run, parts in pieces.items())
        out = [b"".join(map(self.runs.__getitem__, runs)) for runs in split]
        for run in fresh:
            if len(run) > CACHED_LENGTH:
                del self.runs[run]
        for piece in new:
            if len(piece) > CACHED_LENGTH:
                del self.known[piece]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_cached: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The encoder of a file of ranks, kept for the life of the Python worker."""
    if (path, pattern) not in _cached:
        _cached[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _cached[path, pattern]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id and ids (binary, little-endian unsigned 32-bit integers).

    No special tokens: their strings are ordinary text. Null counts as empty and has no ids.
    Rows with null or repeated ids are encoded like any other; an empty table gives no rows;
    other columns are not read. The pattern must keep white space and other characters
    apart but for one leading space, as those of the usual byte-level vocabularies do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = encoder.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return columns.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The rows of `encode` with a column `decoded`: the bytes of the ids. Null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [encoder.decode(ids or b"") for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
