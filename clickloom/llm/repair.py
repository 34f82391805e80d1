"""Cheapest repair of the turn structure of conversations.

A conversation is repaired by keeping, reroling, deleting and inserting turns until the
initials of its roles read `(s?(ua)+)?`. The edits in order give the audit, a string of the
letters D, I, K and R; of equally cheap repairs the one with the least audit is taken.

Every partial repair is one whole number. Its high digits are the cost. Its low digits, a
fixed number of them, are the letters of the audit from the left, 1 to 4 for D, I, K and R,
and 0 after the end, so that an audit is less than one it begins. A repair of the rows from
some row on, beginning in some state of the pattern, is an edge before a repair of the later
rows: the letter is put in front and the cost added. The rows and states form a directed graph
without cycles, and the least number at its beginning decides cost and audit at once. The
number of turns left fixes the role of each place, so the audit also fixes the outcome.

Conversations are sorted over all tasks by ranges, so that one with a great share of all rows
is spread. Those that lie inside a task, nearly all, are solved where they are read. Others are
cut into pieces of at most `PIECE_ROWS` rows. Inserts belong to the turn after them, so a piece
of n rows has n other letters and ends in one; two different audits of a piece then differ
inside the shorter one, and what follows can never change their order. It is enough to know of
each piece the 16 costs from state to state and the order of the 16 audits. One small row per
piece goes to a task per conversation that finds the states at all borders, and the pieces are
solved once more between these states. Only the hash over a repaired conversation has to read
its texts in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored

PIECE_ROWS = 256
PIECE_CHARS = 1 << 20

# Costs of the edits, faults and pattern of the contract.
RETOLD, DELETED, INSERTED, UNENDED = 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
LETTERS = "\0DIKR"
D, I, K, R = 1, 2, 3, 4
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after s, after u, after a. The first and the last may be the end.
STATES = range(4)
#: The state that keeping a turn leads to, by state and class of its initial (s, u, a, other).
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: The state after a turn of the only role that may be inserted: user, or assistant after u.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: Edits at the end of a conversation by state: how many turns are inserted.
MISSING = (0, 2, 1, 0)

DIGIT = 3  # bits of a letter
FINE, TRUNCATED, CONDEMNED = 0, 4, 8  # added to the class of a turn's initial


def solve(codes: bytes, ends: tuple[int | None, ...], width: int) -> list[int | None]:
    """Of each state the least number of a repair of all rows that begins there.

    A code is the class of a row's initial plus its fault; `ends` are the numbers after the
    last row by state, None where none may end; `width` is the number of letters that fit.
    """
    bits = DIGIT * width
    mask = (1 << bits) - 1

    def before(number: int | None, letter: int, cost: int) -> int | None:
        if number is None:
            return None
        low = number & mask
        return (number - low) + (cost << bits) + (letter << (bits - DIGIT)) + (low >> DIGIT)

    after = list(ends)
    for code in reversed(codes):
        own: list[int | None] = []
        for state in STATES:
            edges = [before(after[state], D, DELETED)]
            if code < CONDEMNED:
                unended = UNENDED if code >= TRUNCATED else 0
                to = KEPT[state][code & 3]
                if to is not None:
                    edges.append(before(after[to], K, unended))
                edges.append(before(after[NEXT[state]], R, RETOLD + unended))
            own.append(min((e for e in edges if e is not None), default=None))
        after = []
        for state in STATES:
            once = own[NEXT[state]]
            twice = before(own[NEXT[NEXT[state]]], I, INSERTED)
            edges = [own[state], before(once, I, INSERTED), before(twice, I, INSERTED)]
            after.append(min((e for e in edges if e is not None), default=None))
    return after


def width_of(rows: int) -> int:
    """Letters that a cheapest repair has at most: two inserts before each row and at the end."""
    return 3 * rows + 2


def unpack(number: int, width: int) -> tuple[int, str]:
    """Cost and audit of a number."""
    bits = DIGIT * width
    low = number & ((1 << bits) - 1)
    letters = []
    for at in range(bits - DIGIT, -1, -DIGIT):
        letter = (low >> at) & 7
        if not letter:
            break
        letters.append(LETTERS[letter])
    return number >> bits, "".join(letters)


def _pack(cost: int, audit: str, width: int) -> int:
    low = 0
    for letter in audit.ljust(width, "\0"):
        low = low << DIGIT | LETTERS.index(letter)
    return cost << (DIGIT * width) | low


def final_ends(width: int) -> tuple[int, ...]:
    return tuple(_pack(INSERTED * n, "I" * n, width) for n in MISSING)


@lru_cache(maxsize=20_000)
def solve_whole(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    width = width_of(len(codes))
    return unpack(solve(codes, final_ends(width), width)[0], width)


@lru_cache(maxsize=2_000)
def solve_between(codes: bytes) -> tuple[list[int], list[int], list[str]]:
    """Of a piece, from each state to each state (16 places): the cost (-1: no way), the rank
    of the audit among all of them, and the audit."""
    width = width_of(len(codes))
    costs, audits = [-1] * 16, [""] * 16
    for end in STATES:
        found = solve(codes, tuple(0 if state == end else None for state in STATES), width)
        for begin, number in enumerate(found):
            if number is not None:
                costs[4 * begin + end], audits[4 * begin + end] = unpack(number, width)
    order = sorted(set(audits))
    return costs, [order.index(audit) for audit in audits], audits


def join_pieces(pieces: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """Cost of a conversation and the states at the borders of its pieces, from their costs
    and ranks: begins with state 0 and ends with the state after the last row."""
    # per state: cost so far from there, rank of the audit from there
    after = [(INSERTED * n, n) for n in MISSING]
    ways = []
    for costs, ranks in reversed(pieces):
        best = []
        for begin in STATES:
            options = [
                (costs[4 * begin + end] + after[end][0], ranks[4 * begin + end], after[end][1], end)
                for end in STATES
                if costs[4 * begin + end] >= 0
            ]
            best.append(min(options))
        order = sorted({option[1:3] for option in best})
        after = [(option[0], order.index(option[1:3])) for option in best]
        ways.append([option[3] for option in best])
    states = [0]
    for way in reversed(ways):
        states.append(way[states[-1]])
    return after[0][0], states


def repaired_turns(rows: list[tuple[str, str]], audit: str, state: int = 0) -> list[str]:
    """`role:text` of each turn that an audit leaves, beginning in a state."""
    turns, at = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(at)
        if letter == "D":
            continue
        if letter == "K":
            state = KEPT[state][_class_of(role)]
        else:
            role, state = ROLE[state], NEXT[state]
        turns.append(f"{role}:{text}")
    return turns


def _class_of(role: str) -> int:
    return "sua".find(role[:1]) % 4 if role else 3


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, copies (0 for a dropped row, whose
    text is left out), key (of conversation, role and text).

    What happens to a row follows from crc32 of `conv_id:turn`. Null roles, texts, and in the
    crc ids and turns, stand for one space.
    """
    space = F.lit(" ")
    role, text = (F.coalesce(F.col(name).cast("string"), space) for name in ("role", "text"))
    conv, turn = (F.col(name).cast("long") for name in ("conv_id", "turn"))
    name = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 0, "").when(kind == 4, "user").otherwise(role)
    rows = conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("key", _key())


def _key() -> Column:
    """A hash of conversation, role and text."""
    parts = [F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.length("role").cast("string"), "role", "text"]
    return F.sha2(F.concat_ws(":", *parts), 256)


def _marked(rows: DataFrame) -> DataFrame:
    """The rows, and whether the same role and text stand in an earlier turn."""
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    said = rows.where("copies > 0").groupBy("key").agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
    again = said.where(~F.col("first").eqNullSafe(F.col("last"))).select("key", "first")
    marked = rows.join(again, "key", "left")
    return marked.select(*rows.columns, (F.col("first").isNotNull() & ~turn.eqNullSafe(F.col("first"))).alias("again"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PIECE = (
    "conv_id long, part int, piece int, whole boolean, rows int, min_turn long, max_turn long, turns int,"
    "blank long, duplicate long, truncated long, illegal long, first string, last string,"
    "cost long, audit string, repaired_sha256 string,"
    "codes binary, roles array<string>, texts array<string>, costs array<int>, ranks array<int>"
)
_PIECE_NAMES = [field.split()[0] for field in _PIECE.split(",")]
_PIECE_ARROW = [
    pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int32(),
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
    pa.int64(), pa.string(), pa.string(),
    pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()),
]


class _Piece:
    """Rows of one conversation that follow one another, and what is counted in them."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.rows, self.codes, self.chars = conv_id, [], bytearray(), 0
        self.min_turn = self.max_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        said = text.strip(WHITE)
        kind = _class_of(role)
        if not said:
            self.blank += 1
            kind += CONDEMNED
        elif again:
            self.duplicate += 1
            kind += CONDEMNED
        elif said[-1] not in ".!?":
            self.truncated += 1
            kind += TRUNCATED
        if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.max_turn:
            self.turns += 1
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        self.rows.append((role, text))
        self.codes.append(kind)
        self.chars += len(text)

    def row(self, part: int, piece: int, whole: bool) -> tuple:
        head = (self.conv_id, part, piece, whole, len(self.rows), self.min_turn, self.max_turn, self.turns)
        head += (self.blank, self.duplicate, self.truncated, self.illegal)
        head += (self.rows[0][0][:1], self.rows[-1][0][:1]) if self.rows else (None, None)
        codes = bytes(self.codes)
        if whole:
            cost, audit = solve_whole(codes)
            joined = "\n".join(repaired_turns(self.rows, audit))
            return *head, cost, audit, hashlib.sha256(joined.encode()).hexdigest(), None, None, None, None, None
        costs, ranks, _ = solve_between(codes)
        return *head, None, None, None, codes, [r for r, _ in self.rows], [t for _, t in self.rows], costs, ranks


def _cut(piece_rows: int):
    """Whole conversations solved, others as pieces; reads rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        piece, inside, last = None, False, None  # inside: the conversation begins in this task, in this piece
        done: list[tuple] = []

        def close(whole: bool) -> None:
            nonlocal number
            done.append(piece.row(part, number, whole))
            number += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(_PIECE_ARROW)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE_ARROW)], names=_PIECE_NAMES)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                columns = [c.to_pylist() for c in batch.slice(at, 1000).columns]
                for conv_id, turn, role, text, copies, key, again in zip(*columns):
                    if piece is None or conv_id != piece.conv_id:
                        if piece is not None:
                            close(inside)
                        inside, last, piece = piece is not None, None, _Piece(conv_id)
                    for _ in range(copies):
                        if len(piece.rows) >= piece_rows or piece.chars >= PIECE_CHARS:
                            close(False)
                            inside, piece = False, _Piece(conv_id)
                        piece.add(turn, role, text, again or last == (turn, key))
                        last = (turn, key)
                yield batch_of()
        if piece is not None:
            close(False)  # it may go on in the next task
            yield batch_of()

    return run


def _plan(key: tuple, table: pa.Table) -> pa.Table:
    """Counts of one conversation over its pieces, and the state before each piece."""
    pieces = sorted(table.to_pylist(), key=lambda p: (p["part"], p["piece"]))
    cost, states = join_pieces([(p["costs"], p["ranks"]) for p in pieces])
    total = {name: sum(p[name] for p in pieces) for name in _COUNTS}
    turns, least, most, last = 0, None, None, None
    for p in pieces:
        if p["rows"]:
            if last is not None and last + p["first"] not in LEGAL:
                total["illegal"] += 1
            last = p["last"]
        if p["turns"]:
            turns += p["turns"] - (p["min_turn"] == most)
            least, most = p["min_turn"] if least is None else least, p["max_turn"]
    n = len(pieces)
    columns = {
        "part": pa.array([p["part"] for p in pieces], pa.int32()),
        "piece": pa.array([p["piece"] for p in pieces], pa.int32()),
        "begin": pa.array(states[:-1], pa.int32()),
        "end": pa.array(states[1:], pa.int32()),
        "at_end": pa.array([i == n - 1 for i in range(n)], pa.bool_()),
        "min_turn": pa.array([least] * n, pa.int64()),
        "max_turn": pa.array([most] * n, pa.int64()),
        "turns": pa.array([turns] * n, pa.int64()),
        **{name: pa.array([total[name]] * n, pa.int64()) for name in _COUNTS},
        "cost": pa.array([cost] * n, pa.int64()),
    }
    return pa.table(columns)


_PLAN = (
    "part int, piece int, begin int, end int, at_end boolean, min_turn long, max_turn long, turns long,"
    "blank long, duplicate long, truncated long, illegal long, cost long"
)
_TOTALS = ("min_turn", "max_turn", "turns", *_COUNTS, "cost")


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece its part of the audit and its repaired turns."""
    for batch in batches:
        for at in range(0, batch.num_rows, 50):
            part = batch.slice(at, 50)
            audits, turns = [], []
            for row in part.select(["codes", "roles", "texts", "begin", "end", "at_end"]).to_pylist():
                audit = solve_between(row["codes"])[2][4 * row["begin"] + row["end"]]
                audit += "I" * MISSING[row["end"]] if row["at_end"] else ""
                audits.append(audit)
                turns.append(repaired_turns(list(zip(row["roles"], row["texts"])), audit, row["begin"]))
            kept = [part.column(name) for name in ("conv_id", "part", "piece", *_TOTALS)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(audits, pa.string()), pa.array(turns, pa.list_(pa.string()))],
                names=["conv_id", "part", "piece", *_TOTALS, "audit", "repaired"],
            )


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of conversations whose pieces come in order."""
    current, audits, digest, any_turn, totals = None, [], None, False, None
    names = ["conv_id", *_TOTALS, "audit", "repaired_sha256"]
    types = [pa.int64()] * (len(names) - 2) + [pa.string()] * 2

    def out() -> pa.RecordBatch:
        row = (current, *totals, "".join(audits), digest.hexdigest())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if digest is None or row["conv_id"] != current:
                if digest is not None:
                    yield out()
                current, audits, digest, any_turn = row["conv_id"], [], hashlib.sha256(), False
                totals = tuple(row[name] for name in _TOTALS)
            audits.append(row["audit"])
            for turn in row["repaired"]:
                digest.update((b"\n" if any_turn else b"") + turn.encode())
                any_turn = True
    if digest is not None:
        yield out()


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation of `rows`, which `damaged` gives: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, null turns first; rows of one turn by the hash of role and text.
    A row's first fault counts: blank, a copy of an earlier one, truncated. A role without
    first letter fits nowhere. Rows with a null conv_id are one conversation. A conversation
    without rows has counts and cost 0, an empty audit and the hash of an empty text; an empty
    table gives no rows; other columns are not read. Gaps beyond the largest long are that.
    """
    order = ["conv_id", "turn", "key"]
    marked = _marked(rows.select("conv_id", "turn", "role", "text", "copies", "key"))
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(ranged.mapInArrow(_cut(piece_rows), _PIECE), "repair-pieces")

    open_ = pieces.where("NOT whole")
    small = open_.drop("whole", "audit", "repaired_sha256", "cost", "codes", "roles", "texts")
    plan = small.groupBy("conv_id").applyInArrow(_plan, _PLAN)
    texts = open_.select("conv_id", "part", "piece", "codes", "roles", "texts")
    fields = "conv_id long, part int, piece int, " + ", ".join(f"{name} long" for name in _TOTALS)
    solved = texts.join(plan, ["part", "piece"]).mapInArrow(
        _solve_pieces, fields + ", audit string, repaired array<string>"
    )
    in_order = solved.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    hashed = in_order.mapInArrow(
        _hash_pieces, "conv_id long, " + ", ".join(f"{name} long" for name in _TOTALS) + ", audit string, repaired_sha256 string"
    )
    both = pieces.where("whole").select(*hashed.columns).unionByName(hashed)
    wide = [F.col(name).cast("decimal(38,0)") for name in ("max_turn", "min_turn", "turns")]
    gaps = F.least(wide[0] - wide[1] + 1 - wide[2], F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    return both.select(
        "conv_id",
        F.when(F.col("turns") > 0, gaps).otherwise(0).cast("long").alias("gaps"),
        *_COUNTS,
        "cost",
        "audit",
        "repaired_sha256",
    )
