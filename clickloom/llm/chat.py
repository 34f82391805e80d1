"""Chat formatting that can be read back: a template, its parser, and escapes.

A turn is rendered as `<|im_start|>role`, a newline, the text, `<|im_end|>` and a newline.
Control strings begin with `<|`. An escaped part has a backslash put between `<` and `|`,
and one more into `<\\|`, `<\\\\|` and so on; a role also has `\\` and newlines escaped. The
parser always takes one such backslash away, so a text needs escapes only where reading it
back plainly gives something else. That is how they are placed: a turn is rendered plainly,
parsed, compared with its source, and escaped if it differs.

A rendered turn holds exactly one turn, with no control string inside, so the parse of turns
joined together is the parses joined together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import text_or_empty

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(rendered: str) -> list[tuple[str, str, int, int]] | None:
    """Turns of a rendered text: role, text, and where the rendered text of the turn begins
    and ends. None if it does not follow the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        line = rendered.find("\n", at)
        if not rendered.startswith(START, at) or line < 0:
            return None
        head = rendered[at + len(START) : line]
        end = rendered.find("<|", line + 1)
        if "<|" in head or end < 0 or not rendered.startswith(END + "\n", end):
            return None
        turns.append((unescape_role(head), unescape(rendered[line + 1 : end]), line + 1, end))
        at = end + len(END) + 1
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn rendered so that it reads back as it is, and the place of its text."""
    heads, bodies = (role, escape_role(role)), (text, escape(text))
    for head, body in ((0, 0), (0, 1), (1, 0), (1, 1)):
        rendered = f"{START}{heads[head]}\n{bodies[body]}{END}\n"
        turns = parse(rendered)
        if turns is not None and [turn[:2] for turn in turns] == [(role, text)]:
            return rendered, turns[0][2], turns[0][3]
    raise AssertionError("an escaped turn always reads back")


def format_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn, in order inside its partition: conv_id, turn, formatted, loss_from
    and loss_to (the part of `formatted` under the loss mask; equal if there is none).

    Every turn is rendered where it is read; only then are turns dealt out by conversation.
    The formatted conversation is its turns joined without anything between. Turns are
    sorted by number, then role and formatted text; null numbers come first. Repeated turns stay. Null
    roles and texts are empty; rows with a null conversation form one conversation. Empty
    texts give an empty turn; an empty table gives no rows; other columns are not read.
    Turns stream through: a long conversation takes no more memory than its longest turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, starts, ends = [], [], []
            for who, said in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                rendered, start, end = render(who, said)
                formatted.append(rendered)
                starts.append(start if who == LOSS_ROLE else 0)
                ends.append(end if who == LOSS_ROLE else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(formatted, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "turn", "role", "formatted", "loss_from", "loss_to"],
            )

    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        text_or_empty(role).alias("role"),
        text_or_empty(text).alias("text"),
    )
    rendered = rows.mapInArrow(
        run, "conv_id long, turn long, role string, formatted string, loss_from long, loss_to long"
    )
    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.drop("role")


class _Digest:
    """Figures of one conversation, read back from its formatted turns as they come."""

    def __init__(self):
        self.turns = self.loss_chars = self.formatted_chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss_from: int, loss_to: int) -> None:
        for role, text, _, _ in parse(formatted):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
        loss = unescape(formatted[loss_from:loss_to])
        self.loss_chars += len(loss)
        self.loss_hash.update(loss.encode())
        self.formatted_chars += len(formatted)

    def row(self) -> tuple:
        return self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation of `format_conversations`: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, all taken from the formatted text.

    Must follow `format_conversations` directly, whose partitions hold whole conversations
    in order.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done = []
            for key, *turn in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if digest is None or key != current:
                    if digest is not None:
                        done.append((current, *digest.row()))
                    current, digest = key, _Digest()
                digest.add(*turn)
            columns = list(zip(*done)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        if digest is not None:
            columns = [[value] for value in (current, *digest.row())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
