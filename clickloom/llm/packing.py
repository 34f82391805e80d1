"""Vector bin packing of token sequences by the dot-product heuristic.

Examples are placed into sequences under three limits at once: tokens, segments (examples or
parts of one in a sequence) and loss-bearing tokens. A sequence is filled by taking, again
and again, the example that fits and has the largest dot product between what it needs and
what the sequence has left, each resource weighted by how scarce it is among the examples at
hand. An example over a limit is cut into full parts first; with `cut`, one that would fit
but for its length fills what is left.

Each task packs the examples it reads from a pool of bounded size; nothing is shuffled, and
at most the last sequence of a task is padded much.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import released, text_or_empty
from clickloom.llm.tokens import word_tokenizer

PIECES = (
    "doc_id long, start long, length long, loss_tokens long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)

#: Bytes of ids that leave a task at once, besides those of the last piece.
IDS_BYTES = 1 << 20


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 512
    loss_tokens: int = 2048

    def array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], float)


class Piece:
    """Part of an example: its ids, where they start, and from which place on they bear loss.
    The ids are bytes, or a view of those of a longer example."""

    __slots__ = ("doc_id", "start", "ids", "loss_from", "doc_tokens")

    def __init__(self, doc_id, start, ids, loss_from, doc_tokens):
        self.doc_id, self.start, self.ids, self.loss_from, self.doc_tokens = doc_id, start, ids, loss_from, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def loss(self, length: int | None = None) -> int:
        end = self.start + (len(self) if length is None else length)
        return max(0, end - max(self.start, self.loss_from))

    def head(self, length: int) -> Piece:
        return Piece(self.doc_id, self.start, self.ids[: 4 * length], self.loss_from, self.doc_tokens)

    def rest(self, length: int) -> Piece:
        return Piece(self.doc_id, self.start + length, self.ids[4 * length :], self.loss_from, self.doc_tokens)

    def fitting(self, tokens: int, loss_tokens: int) -> int:
        """Tokens from the start that keep both limits."""
        free = max(0, self.loss_from - self.start)
        return min(len(self), tokens, free + loss_tokens)


class Packer:
    """Packs pieces into sequences; `pool` pieces wait at most before sequences are filled."""

    def __init__(self, limits: Limits, pool: int, cut: bool, least_cut: int = 8, least_last: int = 64):
        self.limits, self.pool, self.cut = limits, pool, cut
        self.least_cut, self.least_last = least_cut, least_last
        self.waiting: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Sequences that are complete once the piece has come."""
        # full parts are views of the ids, so cutting a long example copies nothing
        piece = Piece(piece.doc_id, piece.start, memoryview(piece.ids), piece.loss_from, piece.doc_tokens)
        while True:
            part = piece.fitting(self.limits.tokens, self.limits.loss_tokens)
            full = part == self.limits.tokens or part < len(piece)
            if not full:
                break
            yield [piece.head(part)]
            if part == len(piece):
                return
            piece = piece.rest(part)
        piece.ids = bytes(piece.ids)
        self.waiting.append(piece)
        if len(self.waiting) >= self.pool:
            yield from self.fill(self.pool // 2)

    def fill(self, keep: int = 0) -> Iterator[list[Piece]]:
        """Sequences from the pool, until no more than `keep` pieces wait."""
        pieces = self.waiting
        limit = self.limits.array()
        need = np.array([[len(p), 1, p.loss()] for p in pieces], float).reshape(-1, 3) / limit
        columns = need.T.copy()  # side by side, which compares much faster
        live = np.ones(len(pieces), bool)
        left = len(pieces)
        while left > keep:
            scarce = need[live].sum(axis=0)
            room, chosen = np.ones(3), []
            while left:
                fits = live.copy()
                for column, most in zip(columns, room + 1e-9):
                    fits &= column <= most
                worth = np.where(fits, need @ (scarce * room), -1.0)
                best = int(np.argmax(worth))
                if not fits[best]:
                    break
                chosen.append(pieces[best])
                live[best] = False
                left -= 1
                room = room - need[best]
            if self.cut and left and room[1] * limit[1] > 0.5:
                tokens, loss = (int(round(x)) for x in (room * limit)[[0, 2]])
                best = int(np.argmax(np.where(live, need[:, 0], -1.0)))
                part = pieces[best].fitting(tokens, loss)
                if self.least_cut <= part < len(pieces[best]):
                    chosen.append(pieces[best].head(part))
                    pieces[best] = pieces[best].rest(part)
                    need[best] = np.array([len(pieces[best]), 1, pieces[best].loss()]) / limit
                    columns[:, best] = need[best]
            yield chosen
        self.waiting = [p for p, alive in zip(pieces, live) if alive]

    def finish(self) -> Iterator[list[Piece]]:
        """All that still waits. With `cut`, a last sequence that is not full is cut to
        lengths that are powers of two, which need no padding."""
        for sequence in self.fill():
            size = sum(map(len, sequence))
            if self.cut and not self.waiting and size < self.limits.tokens - self.least_last:
                yield from self._powers(sequence, size)
            else:
                yield sequence

    def _powers(self, sequence: list[Piece], size: int) -> Iterator[list[Piece]]:
        while size >= self.least_last:
            want = 1 << (size.bit_length() - 1)
            size -= want
            part = []
            while want:
                piece = sequence.pop(0)
                if len(piece) > want:
                    sequence.insert(0, piece.rest(want))
                    piece = piece.head(want)
                part.append(piece)
                want -= len(piece)
            yield part
        if sequence:
            yield sequence


def _rows(sequences: Iterator[list[Piece]], first: int) -> Iterator[tuple]:
    for number, sequence in enumerate(sequences, first):
        offset = 0
        for piece in sequence:
            yield piece.doc_id, piece.start, len(piece), piece.loss(), piece.doc_tokens, number, offset, bytes(piece.ids)
            offset += len(piece)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    limits: Limits = Limits(),
    id_column: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
    end_id: int = 1,
    pool: int = 2048,
    cut: bool = True,
) -> DataFrame:
    """Pieces of the tokenized rows with their places in sequences, one row per piece.

    An example is the ids of its prompt, if a prompt column is named, then those of its text,
    then `end_id`; only text and end bear loss. Columns: doc_id, start (the example's ids
    before the piece), length, loss_tokens, doc_tokens (of the whole example, with the end),
    sequence_id, offset (place in the sequence, without gaps) and ids (little-endian unsigned
    32-bit). Null texts and prompts are empty: such an example is its end alone. Rows with a
    null or repeated id are packed like any other. Long texts become many pieces; equal
    choices go to the row that came first; an empty table gives no rows; other columns are
    not read.
    """
    columns = [F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text")]
    columns.append((text_or_empty(prompt) if prompt else F.lit("")).alias("prompt"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(limits, pool, cut)

        def sequences() -> Iterator[list[Piece]]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256).to_pydict()
                    prompts = tokenizer.encode(part["prompt"]) if prompt else [b""] * len(part["text"])
                    for doc_id, before, ids in zip(part["doc_id"], prompts, tokenizer.encode(part["text"])):
                        whole = before + ids + end
                        yield from packer.add(Piece(doc_id, 0, whole, len(before) // 4, len(whole) // 4))
            yield from packer.finish()

        first = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [(name, pa.int64()) for name in ("doc_id", "start", "length", "loss_tokens", "doc_tokens", "sequence_id", "offset")]
            + [("ids", pa.binary())]
        )
        rows: list[tuple] = []
        size = 0
        for row in _rows(sequences(), first):
            rows.append(row)
            size += len(row[-1])
            if size >= IDS_BYTES or len(rows) == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return docs.select(*columns).mapInArrow(run, PIECES)
