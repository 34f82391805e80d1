"""Quality of documents by histogram gradient-boosted trees over document statistics.

Each whole text gives a row of statistics: its size, the shares of kinds of characters, how
its words and lines repeat, how its lines end. The statistics are written once. From all of
them Spark takes the quantiles that cut each statistic into bins. Trees are boosted on binned
statistics of at most `TRAINING_ROWS` labelled documents, chosen by a hash: per node one
histogram of gradients over all statistics and bins tells the best cut. All trees have the
same depth, so that they lie in three arrays, in which node n has the children 2n+1 and 2n+2;
numpy walks all trees for all rows of a batch, a level at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored, text_or_empty

#: Labelled documents that trees are fitted on, at most.
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 64
SHRINKAGE, PENALTY, LEAST_WEIGHT = 0.15, 1.0, 0.5
KEEP_FROM = 0.3

STATISTICS = (
    "log_chars",
    "log_words",
    "word_length",
    "longest_word",
    "letters",
    "digits",
    "spaces",
    "sentence_marks",
    "other_marks",
    "bars",
    "beyond_ascii",
    "capitals",
    "entropy",
    "distinct_words",
    "commonest_word",
    "words_without_letter",
    "words_before_symbol",
    "log_lines",
    "line_length",
    "repeated_lines",
    "ended_lines",
)

_MARKS = ".,;:!?\"'()-"


def _class_table() -> np.ndarray:
    """Of each byte its kind: 0 letter, 1 digit, 2 space, 3 sentence mark, 4 other mark, 5 beyond ASCII."""
    table = np.full(256, 4, np.int64)
    for byte in range(128):
        letter = chr(byte)
        if letter.isalpha():
            table[byte] = 0
        elif letter.isdigit():
            table[byte] = 1
        elif letter.isspace():
            table[byte] = 2
        elif letter in _MARKS:
            table[byte] = 3
    table[128:] = 5
    return table


_CLASSES = _class_table()


def statistics_of(text: str) -> list[float]:
    """The statistics of a whole text, in the order of `STATISTICS`; all 0 if it is empty."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    per_byte = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASSES, per_byte, 6) / len(data)
    shares = per_byte[per_byte > 0] / len(data)
    capitals = per_byte[65:91].sum() / max(1, per_byte[65:91].sum() + per_byte[97:123].sum())
    words = text.split()
    counts = Counter(words)
    n_words = max(1, len(words))
    bare = sum(n for word, n in counts.items() if not any(map(str.isalpha, word)))
    symbol = sum(n for word, n in counts.items() if not word[-1].isalnum() and word[-1] not in _MARKS)
    lines = [line for line in text.split("\n") if line]
    n_lines = max(1, len(lines))
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        sum(len(word) * n for word, n in counts.items()) / n_words,
        math.log1p(max(map(len, counts), default=0)),
        float(kinds[0]),
        float(kinds[1]),
        float(kinds[2]),
        float(kinds[3]),
        float(kinds[4]),
        float(per_byte[ord("|")]) / len(data),
        float(kinds[5]),
        float(capitals),
        float(-(shares * np.log2(shares)).sum()),
        len(counts) / n_words,
        max(counts.values(), default=0) / n_words,
        bare / n_words,
        symbol / n_words,
        math.log1p(len(lines)),
        math.log1p(len(text) / n_lines),
        1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(line.rstrip()[-1:] in (".", "!", "?") for line in lines if line.rstrip()) / n_lines,
    ]


@dataclass
class Trees:
    """Boosted trees of one depth as arrays (tree, node); rows go right where their statistic
    is above the cut. A node that is not cut sends all rows left."""

    statistic: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of all rows (row, statistic), by one step per level for all trees at once."""
        trees = np.arange(len(self.leaf))
        at = np.zeros((len(rows), len(trees)), np.int64)
        of_row = np.arange(len(rows))[:, None]
        for _ in range(DEPTH):
            at = 2 * at + 1 + (rows[of_row, self.statistic[trees, at]] > self.cut[trees, at])
        return self.start + self.leaf[trees, at - (2**DEPTH - 1)].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(rows)))


def boost(rows: np.ndarray, labels: np.ndarray, edges: list[np.ndarray]) -> Trees:
    """Trees for labels 0 or 1 by Newton steps on the log-loss; cuts are taken from `edges`,
    per statistic in rising order. Equal gains go to the first statistic and edge."""
    width, nodes = rows.shape[1] if len(rows) else len(edges), 2**DEPTH - 1
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = math.log(share / (1 - share))
    statistic = np.zeros((TREES, nodes), np.int64)
    cut = np.full((TREES, nodes), np.inf)
    leaf = np.zeros((TREES, nodes + 1))
    if not len(rows) or not 0 < labels.sum() < len(labels):
        return Trees(statistic, cut, leaf, start)
    # bin b holds the values above edge b - 1 and up to edge b
    bins = np.stack([np.searchsorted(e, rows[:, i]) for i, e in enumerate(edges)], 1)
    n_bins = max(len(e) for e in edges) + 1
    places = np.arange(width) * n_bins + bins
    usable = np.zeros((width, n_bins), bool)
    for i, e in enumerate(edges):
        usable[i, : len(e)] = True
    margin = np.full(len(rows), start)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = labels - p, p * (1 - p)
        at = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            place = ((at - first)[:, None] * (width * n_bins) + places).ravel()
            shape = (count, width, n_bins)
            g = np.bincount(place, np.repeat(gradient, width), count * width * n_bins).reshape(shape)
            h = np.bincount(place, np.repeat(weight, width), count * width * n_bins).reshape(shape)
            left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - all_g**2 / (all_h + PENALTY)
            gain[~(usable & (left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT))] = 0
            flat = np.round(gain, 9).reshape(count, -1)
            best = flat.argmax(axis=1)
            for node in np.flatnonzero(flat[np.arange(count), best] > 0):
                i, b = divmod(int(best[node]), n_bins)
                statistic[tree, first + node], cut[tree, first + node] = i, edges[i][b]
            at = 2 * at + 1 + (rows[np.arange(len(rows)), statistic[tree, at]] > cut[tree, at])
        own = at - nodes
        leaf[tree] = SHRINKAGE * np.bincount(own, gradient, nodes + 1) / (np.bincount(own, weight, nodes + 1) + PENALTY)
        margin += leaf[tree, own]
    return Trees(statistic, cut, leaf, start)


def document_statistics(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id and the statistics of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics_of(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "statistics"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, statistics array<double>")


def bin_edges(statistics: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per statistic the distinct quantiles over all rows, at most `bins` - 1."""
    wanted = F.lit([i / bins for i in range(1, bins)])
    found = statistics.select(
        *[F.percentile_approx(F.col("statistics")[i], wanted, 10_000).alias(name) for i, name in enumerate(STATISTICS)]
    ).first()
    return [np.unique(np.array(found[name] or [0.0])) for name in STATISTICS]


def fit(statistics: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Trees:
    """Trees from `labels` (doc_id, quality) and the statistics of these documents."""
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality"))
    known = statistics.join(marks, "doc_id").groupBy("doc_id", "quality").agg(F.min("statistics").alias("statistics"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    values = np.array([row.statistics for row in chosen]).reshape(-1, len(STATISTICS))
    return boost(values, np.array([float(row.quality > 0) for row in chosen]), bin_edges(statistics))


def score(statistics: DataFrame, trees: Trees) -> DataFrame:
    """doc_id and score of each row of `document_statistics`."""
    sent = statistics.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sent.value.scores(rows), pa.float64())], names=["doc_id", "score"]
                )

    return statistics.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the labels of a document are kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored_documents(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted (1 from `keep_from` on).

    Learns from labels of documents that are not held out; only statistics of the text enter
    a score. Null texts count as empty; empty texts have statistics of 0 and are scored like
    others. A document labelled more than once is good if any label says so; of rows with one
    id the one with the least statistics teaches; null labels, labels without an id and labels
    of unknown documents teach nothing. Without labels, or with labels of one kind only, every
    score is their smoothed share. Repeated rows are scored alike, a null id is not held out,
    an empty table gives no rows. Other columns are not read.
    """
    statistics = stored(document_statistics(docs), "quality-statistics")
    trees = fit(statistics, labels.select("doc_id", "quality").where(~held_out()))
    return score(statistics, trees).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= keep_from).cast("int").alias("predicted"),
    )
