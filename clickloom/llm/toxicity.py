"""Toxicity by nearest labelled examples.

Labelled texts are kept in an inverted index over TF-IDF weights, ordered into blocks. Per
term and block the index holds the largest weight, so the sum of a text's weights times
these bounds its cosine with every example of the block. Blocks are visited from the highest
bound down until no bound reaches the k-th best cosine found: the k nearest are exact. The
k nearest toxic and the k nearest clean examples are looked up. Each votes with its cosine, or
rather with that part of it that comes from features which toxic examples hold more often than
clean ones. The votes are calibrated to a probability on the examples themselves; an example
then neither votes nor counts in what its features lean to. Labels enter the votes only, never
the vectors.

The index holds at most `PER_CLASS` labelled texts of each class, chosen by a hash, and so
has a bounded size and can be sent to every task. Whole examples are indexed; tasks count
their features. Document frequencies are counted over all texts. Features are the pieces of
all words, each word cut into runs of four characters, since insults come with many endings;
scripts that write without spaces give pairs of characters. Every feature that an example
holds is kept, however common or rare it is: frequent ones weigh less by their inverse
document frequency.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import released, text_or_empty

#: Labelled texts of each class in the index, at most.
PER_CLASS = 1000
NEIGHBOURS = 5
BLOCK = 32
FIRST_BLOCKS = 6
REJECT_FROM = 0.7
#: Added to the votes of both classes, so that faint ones say little.
LEAST_VOTE = 0.1

_PIECE = re.compile(r"\w{1,4}")
_ASCII_PIECE = re.compile(r"[a-z0-9_]{1,4}")
#: Runs of scripts without spaces: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile(
    "[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]+"
)


def _is_latin(text: str) -> bool:
    """Whether all characters are below 256, told much faster than by a pattern."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def stems_of(text: str) -> list[str]:
    """Every word in pieces of four characters, and the character pairs of unspaced runs."""
    text = text.lower()
    if text.isascii():
        return _ASCII_PIECE.findall(text)
    if _is_latin(text):
        return _PIECE.findall(text)
    pairs = [run[i : i + 2] for run in _UNSPACED.findall(text) for i in range(max(1, len(run) - 1))]
    return _PIECE.findall(_UNSPACED.sub(" ", text)) + pairs


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges in turn, and the length of each range."""
    lengths = ends - starts
    after = np.cumsum(lengths)
    total = int(after[-1]) if len(after) else 0
    return np.arange(total) + np.repeat(starts - after + lengths, lengths), lengths


@dataclass
class BlockMaxIndex:
    """Inverted index of unit vectors, with the largest weight per term and block.

    A list with a sixteenth of all examples or more is kept as a row of all of them, block by
    block, which takes at most 64 bytes a posting; the others as entries of postings.
    """

    vocabulary: dict[str, int]
    idf: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    base_rate: float
    row_of: np.ndarray = field(default=None)  # of each term its row, -1 if it has none
    rows: np.ndarray = field(default=None)  # weights by block, place and row
    row_max: np.ndarray = field(default=None)
    term_entries: np.ndarray = field(default=None)  # where each term's entries begin
    entry_block: np.ndarray = field(default=None)
    entry_max: np.ndarray = field(default=None)
    entry_postings: np.ndarray = field(default=None)  # where each entry's postings begin
    posting_doc: np.ndarray = field(default=None)
    posting_weight: np.ndarray = field(default=None)
    examples: list = field(default_factory=list)  # terms and weights of each example
    held: np.ndarray = field(default=None)  # per class (clean, toxic) and term the examples with it
    lean: np.ndarray = field(default=None)  # of each term
    classes: list = field(default_factory=list)  # sides of the clean and the toxic examples
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text, of length one."""
        terms = np.fromiter(map(self.vocabulary.get, counts, repeat(-1)), np.int64, len(counts))
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        terms, tf = terms[terms >= 0], tf[terms >= 0]
        weights = (1 + np.log(tf)) * self.idf[terms]
        norm = np.sqrt((weights * weights).sum())
        return (terms, weights / norm) if norm > 0 else (np.zeros(0, np.int64), np.zeros(0))

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        docs = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        terms = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weights = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        n, size = len(vectors), len(self.vocabulary)
        toxic = self.labels[docs] == 1
        self.held = np.stack([np.bincount(terms[toxic == side], minlength=size) for side in (False, True)])
        long = self.held.sum(axis=0) * 16 >= max(n, 32)
        self.row_of = np.where(long, np.cumsum(long) - 1, -1)
        n_blocks = -(-n // BLOCK)
        rows = np.zeros((n_blocks * BLOCK, long.sum()), np.float32)
        inside = long[terms]
        rows[docs[inside], self.row_of[terms[inside]]] = weights[inside]
        self.rows = rows.reshape(n_blocks, BLOCK, rows.shape[1])
        self.row_max = np.ascontiguousarray(self.rows.max(axis=1, initial=0.0).T)
        docs, terms, weights = docs[~inside], terms[~inside], weights[~inside]
        order = np.lexsort((docs, terms))
        docs, terms, weights = docs[order], terms[order], weights[order]
        blocks = docs // BLOCK
        new = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])][: len(terms)])
        self.posting_doc, self.posting_weight = docs, weights
        self.entry_postings = np.r_[new, len(docs)]
        self.entry_block = blocks[new]
        self.entry_max = np.maximum.reduceat(weights, new) if len(new) else np.zeros(0)
        self.term_entries = np.searchsorted(terms[new], np.arange(size + 1))
        self.examples = vectors
        self.lean = self._leaning(np.arange(size))
        self.classes = [self._side(self.labels != 1), self._side(self.labels == 1)]

    def _side(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The examples of a side, and whether each block has one."""
        padded = np.zeros(len(self.rows) * BLOCK, bool)
        padded[: len(marks)] = marks
        return np.flatnonzero(marks), padded.reshape(-1, BLOCK).any(axis=1)

    def _leads(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
        """A text's weights by row, entries of its other terms with the block and weight of
        each, and the bound of each block."""
        row = self.row_of[terms]
        long = row >= 0
        rows, row_weight = row[long], weights[long].astype(np.float32)
        terms, weights = terms[~long], weights[~long]
        entries, lengths = _ranges(self.term_entries[terms], self.term_entries[terms + 1])
        of_block, term_weight = self.entry_block[entries], np.repeat(weights, lengths)
        bound = np.bincount(of_block, self.entry_max[entries] * term_weight, len(self.rows))
        bound = bound + row_weight @ self.row_max[rows]
        of_rows = np.zeros(self.rows.shape[2], np.float32)
        of_rows[rows] = row_weight
        return of_rows, entries, of_block, term_weight, bound

    def _search(
        self, leads: tuple[np.ndarray, ...], k: int, sides: list[tuple[np.ndarray, np.ndarray]], without: int = -1
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k nearest of each side."""
        of_rows, entries, of_block, term_weight, bound = leads
        blocks = len(bound)
        # per side the bound of each block that has examples of it and a term of the text
        bounds = np.where(np.stack([has for _, has in sides]), bound, 0.0)
        # a side's cosines are taken out of all before they are compared
        found, least = [np.zeros(len(members)) for members, _ in sides], np.zeros(len(sides))
        cosine, step = np.zeros(blocks * BLOCK), FIRST_BLOCKS
        while bounds.any():
            # of each side the blocks with the highest bounds that are left
            top = np.argpartition(-bounds, min(step, blocks) - 1, axis=1)[:, :step]
            chosen = np.zeros(blocks, bool)
            chosen[top] = True
            chosen &= (bounds > 0).any(axis=0)
            use = np.flatnonzero(chosen[of_block])
            some = entries[use]
            postings, lengths = _ranges(self.entry_postings[some], self.entry_postings[some + 1])
            weights = self.posting_weight[postings] * np.repeat(term_weight[use], lengths)
            cosine += np.bincount(self.posting_doc[postings], weights, len(cosine))
            whole = np.zeros((blocks, BLOCK), np.float32)
            for block in np.flatnonzero(chosen).tolist():
                np.dot(self.rows[block], of_rows, out=whole[block])
            cosine += whole.ravel()
            if without >= 0:
                cosine[without] = 0.0
            for side, (members, _) in enumerate(sides):
                # to six digits, so that equal texts tie
                found[side] = own = np.round(cosine[members], 6)
                high = own[own >= max(least[side], 1e-7)]  # never fewer than before
                if len(high) >= k:
                    high.partition(len(high) - k)
                    least[side] = high[len(high) - k]
            bounds[:, chosen] = 0.0
            # a bound as high as the k-th cosine may hide a tie
            bounds[bounds < least[:, None] - 1e-5] = 0.0
            step = 4 * FIRST_BLOCKS
        results = []
        for own, (members, _), kth in zip(found, sides, least.tolist()):
            # of equal cosines the earlier example
            best = np.flatnonzero(own >= max(kth, 1e-7))
            best = best[np.argsort(-own[best], kind="stable")][:k]
            results.append((members[best], own[best]))
        return results

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine above 0 and the cosines, largest first;
        ties to the earlier example."""
        return self._search(self._leads(terms, weights), k, [self._side(np.ones(len(self.labels), bool))])[0]

    def of_each_class(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k nearest clean and the k nearest toxic examples; `without` leaves one out."""
        return self._search(self._leads(terms, weights), k, self.classes, without)

    def _leaning(self, terms: np.ndarray, without: int = -1) -> np.ndarray:
        """How much more often toxic examples hold each term than clean ones, as a log-ratio, 0
        where they do not; two examples more on both sides, so that one alone says little."""
        sizes = np.array([(self.labels != 1).sum(), (self.labels == 1).sum()], float)
        held = self.held[:, terms].astype(float)
        if without >= 0:
            own = int(self.labels[without] == 1)
            sizes[own] -= 1
            held[own] -= 1
        sizes = np.maximum(1, sizes)
        clean, toxic = held / sizes[:, None] + 2 / sizes.min()
        return np.maximum(0, np.log(toxic / clean))

    def vote(self, terms: np.ndarray, weights: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], k: int, without: int = -1) -> float:
        """Log-odds of the mean votes of the nearest toxic and the nearest clean examples."""
        told = np.zeros(len(self.vocabulary))
        told[terms] = weights * (self.lean[terms] if without < 0 else self._leaning(terms, without))
        votes = []
        for best, _ in found:
            own = [self.examples[i] for i in best]
            votes.append(sum(float(told[t] @ w) for t, w in own) / k)
        return float(np.log((votes[1] + LEAST_VOTE) / (votes[0] + LEAST_VOTE)))

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
        """Logistic fit of label on vote over the examples, weighted to the base rate."""
        x = np.array([self.vote(*v, self.of_each_class(*v, k, i), k, i) if len(v[0]) else 0.0 for i, v in enumerate(vectors)])
        y = self.labels.astype(float)
        share = y.mean() if len(y) else 0.0
        if not 0 < share < 1:
            return
        weight = np.where(y == 1, self.base_rate / share, (1 - self.base_rate) / (1 - share))
        design = np.stack([np.ones_like(x), x], 1)
        beta = np.zeros(2)
        for _ in range(50):  # Newton steps with a slight pull to 0
            p = 1 / (1 + np.exp(-design @ beta))
            gradient = design.T @ (weight * (y - p)) - 1e-2 * beta
            curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
            step = np.linalg.solve(curvature, gradient)
            beta += step
            if np.abs(step).max() < 1e-9:
                break
        self.shift, self.slope = float(beta[0]), float(max(beta[1], 1e-3))

    def score(self, text: str, k: int = NEIGHBOURS) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability of being toxic, and the evidence: nearest examples and cosines."""
        terms, weights = self.vector(Counter(stems_of(text)))
        if not len(terms):
            return self.base_rate, np.zeros(0, np.int64), np.zeros(0)
        found = self.of_each_class(terms, weights, k)
        best, cosine = (np.concatenate(parts) for parts in zip(*found))
        order = np.lexsort((best, -cosine))
        value = self.shift + self.slope * self.vote(terms, weights, found, k)
        return float(1 / (1 + np.exp(-value))), best[order], cosine[order]


def _document_frequencies(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many of all texts each entry of the vocabulary occurs, and the number of texts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        counts, texts = np.zeros(len(known) + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                features = set(stems_of(text.as_py()))
                # the last place takes what is not known, and is set in the end
                counts[np.fromiter(map(known.get, features, repeat(-1)), np.int64, len(features))] += 1
                texts += 1
        counts[-1] = texts
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["term", "n"])

    frequencies = np.zeros(len(vocabulary) + 1, np.int64)
    counted = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in counted.toLocalIterator():
        frequencies[row.term] = row.n
    sent.destroy()
    return frequencies[:-1], int(frequencies[-1])


def _counted(texts: DataFrame) -> DataFrame:
    """doc_id and toxic as they are, and the features of `text` with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(stems_of(text.as_py())) for text in batch.column(2)]
            arrays = [pa.array([list(c) for c in counts], pa.list_(pa.string()))]
            arrays.append(pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["doc_id", "toxic", "stems", "counts"])

    schema = T.StructType([texts.schema["doc_id"], texts.schema["toxic"]])
    schema = schema.add("stems", T.ArrayType(T.StringType())).add("counts", T.ArrayType(T.LongType()))
    return texts.select("doc_id", "toxic", "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> BlockMaxIndex:
    """An index from `labels` (doc_id, toxic) and their texts in `docs` (doc_id, text)."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {int(row.toxic): row["count"] for row in marks.groupBy("toxic").count().collect()}
    base_rate = (totals.get(1, 0) + 1) / (sum(totals.values()) + 10)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [marks.where(F.col("toxic") == label).orderBy(*order).limit(per_class) for label in (1, 0)]
    chosen = picked[0].unionByName(picked[1])  # at most 2 * per_class rows
    # one text per id, the least, however often the id is repeated
    texts_of = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = _counted(texts_of).collect()
    examples = sorted((row.doc_id, row.toxic, sorted(zip(row.stems, row.counts))) for row in rows)
    counts = [Counter(dict(found)) for _, _, found in examples]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*counts)))} if counts else {}
    frequencies, texts = _document_frequencies(docs, vocabulary)
    idf = np.log1p(texts / np.maximum(1, frequencies))
    index = BlockMaxIndex(vocabulary, idf, np.zeros(0), np.zeros(0), base_rate)
    vectors = [index.vector(c) for c in counts]
    # examples of one label that lean on the same frequent word lie together: tight bounds
    frequent = idf < np.sort(idf)[min(len(idf) - 1, 100)] if len(idf) else np.zeros(0, bool)
    lead = [int(t[np.argmax(np.where(frequent[t], w, 0.0))]) if len(t) else -1 for t, w in vectors]
    order = sorted(range(len(examples)), key=lambda i: (examples[i][1], lead[i], i))
    vectors = [vectors[i] for i in order]
    index.labels = np.array([examples[i][1] for i in order], np.int64)
    index.ids = np.array([examples[i][0] for i in order], np.int64)
    index.build(vectors)
    index.calibrate(vectors, k)
    return index


def score(
    docs: DataFrame, index: BlockMaxIndex, k: int = NEIGHBOURS, evidence: int = 3, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Per row of `docs` its columns `keep`, the score, and the nearest examples as evidence
    (`evidence_ids`, `evidence_cosines`)."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    added = T.StructType(
        [
            T.StructField("score", T.DoubleType()),
            T.StructField("evidence_ids", T.ArrayType(T.LongType())),
            T.StructField("evidence_cosines", T.ArrayType(T.DoubleType())),
        ]
    )

    given = "text" in keep
    at = keep.index("text") if given else len(keep)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            scores, ids, cosines = [], [], []
            for text in batch.column(at):
                value, best, cosine = own.score(text.as_py() or "", k)
                scores.append(value)
                ids.append(own.ids[best[:evidence]].tolist())
                cosines.append(cosine[:evidence].tolist())
            arrays = [
                pa.array(scores, pa.float64()),
                pa.array(ids, pa.list_(pa.int64())),
                pa.array(cosines, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], names=[*keep, *added.names])

    rows = docs.select(*keep) if given else docs.select(*keep, text_or_empty("text").alias("__text"))
    return rows.mapInArrow(run, T.StructType([docs.schema[name] for name in keep] + added.fields))


def held_out(doc_id: str = "doc_id"):
    """Whether the labels of a document are kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored_documents(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted, evidence_ids, evidence_cosines.

    Learns from labels of documents that are not held out. Texts without a known stem, null
    and empty ones among them, get the base rate of toxic labels. A document labelled more
    than once is toxic if any label says so; of texts with one id the least is the example;
    null labels and labels of unknown documents teach nothing; without labels every score is the same. Repeated rows are scored alike,
    a null id is not held out, an empty table gives no rows. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id"), text_or_empty("text").alias("text"))
    learnt = labels.select("doc_id", "toxic").where(~held_out())
    index = fit(texts, learnt)
    return score(docs, index, keep=keep).withColumns(
        {"held_out": held_out(), "predicted": (F.col("score") >= REJECT_FROM).cast("int")}
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not rejected, with all their columns, whatever their names.

    A text goes to Python and back once, beside the other columns of its row.
    """
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"])
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), others.alias("row"))
    kept = scored_documents(rows, labels, keep=("doc_id", "row", "text")).where(F.col("predicted") == 0)
    named = {name: F.col("row")[name] for name in docs.columns} | {"text": F.col("text").cast(docs.schema["text"].dataType)}
    return kept.select(*[named[name].alias(name) for name in docs.columns])
