"""Secret scans in column functions only.

Three kinds of secrets are found by pattern: assignments to telling names, access keys, and
long hexadecimal strings. Candidate strings, runs of the characters that keys are made of,
are then held against the Shannon entropy of a sliding window, per character class. The
window's character counts are updated as it moves: the sum of c * log2(c) over the counts c
changes by the character that comes and the one that goes. A candidate is reported from its
first to its last window at or above the threshold of its class, unless the allow-list
knows all of that span: lower-case words and small numbers with separators, or characters in
their order. Repeated characters and short words never reach a threshold. The allow-list
never touches what the patterns find.

Everything is an expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import text_or_empty

# The patterns of the kinds, and the length a match needs (of the second group
# for assignments).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "entropy")

_DIGITS, _LOWER, _UPPER = ("".join(f"{c}?" for c in cs) for cs in (string.digits, string.ascii_lowercase, string.ascii_uppercase))
#: Strings that are never secrets by entropy alone. Each pattern knows the whole string, and
#: with it every part of it. Possessive repeats are matched in a loop, not by recursion.
ALLOWED = (
    r"^[-_/.+=]*+(?:(?:[a-z]{1,20}+|[0-9]{1,4}+)[-_/.+=]++)*+(?:[a-z]{1,20}+|[0-9]{1,4}+)?$",
    rf"^{_DIGITS}{_UPPER}{_LOWER}{_DIGITS}\+?/?=?$",
    rf"^{_DIGITS}{_LOWER}{_UPPER}{_DIGITS}\+?/?=?$",
)


@dataclass(frozen=True)
class EntropyClass:
    """Characters of a class, the window over them, and the bits that make it suspicious."""

    name: str
    characters: str
    window: int
    bits: float


# Character classes, from the narrowest to the widest.
CLASSES = (
    EntropyClass("hex", "0123456789abcdefABCDEF", 32, 3.4),
    EntropyClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 24, 4.1),
)
#: Characters of the blocks that a text is cut into while it is masked.
BLOCK_CHARS = 4096
#: Sums of c * log2(c) are kept in whole units of this part of a bit, so they stay exact.
UNIT = 1 << 20


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """Per element the sum, or other join, of all up to it. Each round joins an element with
    the one twice as far before it as in the round before, so that few rounds do."""
    shifts = F.array(*[F.lit(1 << k) for k in range(31)])

    def rounds(own: Column) -> Column:
        def step(acc: Column, shift: Column) -> Column:
            return F.transform(acc, lambda x, i: F.when(i >= shift, joined(x, F.get(acc, i - shift))).otherwise(x))

        return F.aggregate(F.filter(shifts, lambda shift: shift < F.size(own)), own, step)

    return _let(values, rounds)


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """All matches in turn: kind, start, end and the match. Ends follow from the lengths of
    the matches and of what lies between them, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # the last part between matches has none after it
    lengths = F.zip_with(between, matches, lambda gap, match: F.length(gap) + F.length(match))
    ends = _running(F.filter(lengths, lambda n: n.isNotNull()), lambda x, y: x + y)
    spans = F.zip_with(
        ends,
        matches,
        lambda end, match: F.struct(
            (end - F.length(match)).alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            end.alias("end"),
            match.alias("match"),
        ),
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(empty)


def pattern_spans(text: Column, kind: str) -> Column:
    """The matches of a kind that are long enough. Short ones still take their place: no
    other match begins inside one. For access keys and hexadecimal strings a match is a whole
    run, so the length can stand in the pattern itself."""
    least = LEAST[kind]
    if kind == "assign":
        long_enough = lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= least
        return F.filter(_spans(text, ASSIGN, kind), long_enough)
    pattern = f"AKIA[A-Z0-9]{{{least - 4},}}" if kind == "access" else f"[0-9a-f]{{{least},}}"
    return _spans(text, pattern, kind)


def _bits_table(window: int) -> Column:
    """c * log2(c) for counts 0 .. window, in units."""
    return F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("long") for c in range(window + 1)])


def _entropy_span(candidate: Column, found: EntropyClass) -> Column:
    """First and last window of the candidate at or above the threshold (positions of their
    first characters, -1 if there is none).

    The state holds the count of each character of the class and the sum over them; a step
    takes one character in and, once the window is full, one out.
    """
    size = len(found.characters)
    table = _bits_table(found.window)
    # entropy = log2(window) - sum / window, so the sum must not exceed this
    most = math.floor((math.log2(found.window) - found.bits) * found.window * UNIT)
    codes = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.instr(F.lit(found.characters), c))

    def change(counts: Column, total: Column, code: Column, by: int) -> tuple[Column, Column]:
        old = F.element_at(counts, code)
        new = F.transform(counts, lambda c, i: F.when(i == code - 1, c + by).otherwise(c))
        return new, total + F.element_at(table, old + by + 1) - F.element_at(table, old + 1)

    def step(acc: Column, code: Column) -> Column:
        full = acc["at"] >= found.window
        gone = F.when(full, F.element_at(acc["codes"], F.greatest(acc["at"] - found.window + 1, F.lit(1))))
        out_counts, out_total = change(acc["counts"], acc["total"], gone, -1)
        counts = F.when(full, out_counts).otherwise(acc["counts"])
        total = F.when(full, out_total).otherwise(acc["total"])
        counts, total = change(counts, total, code, 1)
        start = acc["at"] + 1 - found.window
        hit = (start >= 0) & (total <= most)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            acc["codes"].alias("codes"),
            counts.alias("counts"),
            total.alias("total"),
            F.when(hit & (acc["first"] < 0), start).otherwise(acc["first"]).alias("first"),
            F.when(hit, start).otherwise(acc["last"]).alias("last"),
        )

    begin = F.struct(
        F.lit(0).alias("at"),
        codes.alias("codes"),
        F.array_repeat(F.lit(0), size).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    return F.aggregate(codes, begin, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _allowed(candidate: Column) -> Column:
    return F.rlike(candidate, F.lit("|".join(f"(?:{pattern})" for pattern in ALLOWED)))


def _class_spans(text: Column, one: EntropyClass, narrower: tuple[EntropyClass, ...]) -> Column:
    escaped = "".join("\\" + c if c in "+/=_-" else c for c in one.characters)
    runs = _spans(text, f"[{escaped}]{{{one.window},}}", "entropy")
    inner = [f"^[{n.characters}]+$" for n in narrower]

    def suspect(span: Column) -> Column:
        # where the whole run is allowed, so is any span of it: no need to measure
        kept = ~_allowed(span["match"])
        for pattern in inner:
            kept = kept & ~F.rlike(span["match"], F.lit(pattern))
        return kept

    measured = F.transform(
        F.filter(runs, suspect),
        lambda span: F.struct(span.alias("s"), _entropy_span(span["match"], one).alias("w")),
    )

    def cut(m: Column) -> Column:
        first, last = m["w"]["first"], m["w"]["last"]
        return F.struct(
            (m["s"]["start"] + first).alias("start"),
            m["s"]["kind"].alias("kind"),
            (m["s"]["start"] + last + one.window).alias("end"),
            F.substr(m["s"]["match"], first + 1, last - first + one.window).alias("match"),
        )

    reported = F.transform(F.filter(measured, lambda m: m["w"]["first"] >= 0), cut)
    return F.filter(reported, lambda span: ~_allowed(span["match"]))


def entropy_spans(text: Column, classes: tuple[EntropyClass, ...] = CLASSES) -> Column:
    """Spans of high entropy: per class, inside runs of its characters that no narrower
    class holds whole."""
    return F.concat(*[_class_spans(text, one, classes[:i]) for i, one in enumerate(classes)])


def _distinct(spans: Column) -> Column:
    """The spans in order, equal ones once."""
    unlike = lambda own: F.filter(own, lambda x, i: (i == 0) | (x != F.get(own, F.greatest(i - 1, F.lit(0)))))
    return _let(F.array_sort(spans), unlike)


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and the arrays assign, access, hex and entropy of found spans, each a
    struct of start, kind (its place in `KINDS`), end (exclusive) and match; positions count
    code points.

    Null counts as empty; an empty text has no spans. Whole texts are read. Rows with null or
    repeated ids are scanned like any other; an empty table gives no rows; other columns are
    not read. Two entropy classes may report overlapping spans; equal ones appear once.
    """
    columns = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("text"))
    spans = {kind: pattern_spans(F.col("text"), kind) for kind in KINDS[:3]}
    return columns.select("doc_id", *[span.alias(kind) for kind, span in spans.items()], _distinct(entropy_spans(F.col("text"))).alias("entropy"))


def _listed(*kinds: str) -> Column:
    """Spans as kind:start:end, by start and then kind, joined with commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    ordered = F.array_sort(F.concat(*[F.col(kind) for kind in kinds]))
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Per row of `scan`: counts of the patterns' spans, their hash, and all spans as text."""
    return scanned.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_listed(*KINDS[:3]), 256).alias("base_sha256"),
        _listed(*KINDS).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows of `docs` with each secret in `text` replaced by `mark`; overlapping spans
    become one. Rows, their order and all other columns, also ones named like this module's
    own, stay as they are; a null text stays null."""
    body = text_or_empty(f"`{text}`")
    spans = F.concat(*[pattern_spans(body, kind) for kind in KINDS[:3]], entropy_spans(body))
    bounds = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"))))

    def between(blocks: Column, begin: Column, end: Column) -> Column:
        """The text from a place to another, read from the blocks it lies in."""
        first = F.call_function("div", begin, F.lit(BLOCK_CHARS)).cast("int")
        count = F.call_function("div", end, F.lit(BLOCK_CHARS)).cast("int") - first + 1
        return F.substr(F.array_join(F.slice(blocks, first + 1, count), ""), begin - first * BLOCK_CHARS + 1, end - begin)

    def built(parts: Column) -> Column:
        blocks, own, reached = parts["blocks"], parts["bounds"], parts["reached"]
        before = lambda i: F.when(i > 0, F.get(reached, F.greatest(i - 1, F.lit(0)))).otherwise(0)
        pieces = F.transform(
            own,
            lambda b, i: F.when(b["s"] >= before(i), F.concat(between(blocks, before(i), b["s"]), F.lit(mark))).otherwise(""),
        )
        rest = between(blocks, F.element_at(reached, -1), F.length(body))
        return F.concat(F.array_join(pieces, ""), rest)

    def masked(own: Column) -> Column:
        # the text in blocks, so that a place in it is found without reading all before it
        blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
        reached = _running(F.transform(own, lambda b: b["e"]), lambda x, y: F.greatest(x, y))
        parts = F.struct(blocks.alias("blocks"), own.alias("bounds"), reached.alias("reached"))
        return F.when(F.size(own) > 0, _let(parts, built)).otherwise(F.col(f"`{text}`").cast("string"))

    return docs.withColumn(text, _let(bounds, masked))
