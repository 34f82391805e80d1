"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is its multiset of five-word shingles. A shingle weighs its count times its inverse
document frequency, log(1 + texts / frequency), which is cut off where it is in less than a
fifth of all texts: very common passages count less, all others alike. Frequencies are
counted over all texts by hash slot; `SLOTS` slots make a slot's frequency exceed its
shingle's by about a five-hundredth of the number of texts, far below the cut.

Each of 64 samples picks one shingle of a text, so that two texts agree on a sample with the
probability of their weighted Jaccard similarity. Sixteen bands of four samples make
candidates: a pair of similarity 0.8 shares a band with probability 0.9998. Candidates are
verified by their exact weighted Jaccard similarity, and the links found join texts to
classes (connected components).

No bucket is expanded into pairs. First each text is held against the first text of its
buckets only, which joins nearly all of a group of copies. Then buckets that still hold more
than one class are taken apart: the largest class of a bucket is dealt in blocks over tasks,
the other texts meet it block by block and one another in blocks. Blocks are compared by their
samples first, 64 bytes a text: only texts of which half the samples agree with those of
another class go on (a pair of similarity 0.8 does with all but 1e-7 probability), and only
they are given their shingles. Pairs are then verified in one of their common buckets only,
and skipped once joined. Equal word sequences are one text from the start.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import discard, few, free_name, released, stored, text_or_empty

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SAMPLES, BANDS = 64, 16
LEAST_AGREEING = SAMPLES // 2
SLOTS = 1 << 18
CUT_SHARE = 0.2
#: Rows of a bucket that one task compares with as many others.
BLOCK_ROWS = 512
#: Texts whose rows are stored together at least, a few kilobytes a text; and links.
TEXTS_A_FILE, LINKS_A_FILE = 4000, 100_000

_SLOT_BLOCK = 4096
_WORD = re.compile(r"\w+")
_PARAMETERS = 1 << 16


def _mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input reaches every bit of the output."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Shingler:
    """Shingle hashes of texts; hashes of words are cached."""

    CACHED, LONGEST_CACHED = 100_000, 64

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        return _WORD.findall(text.lower())

    def key(self, text: str, words: list[str]) -> bytes:
        """Equal for equal word sequences; of a text without words, for equal texts."""
        data = " ".join(words) if words else "\0" + text
        return hashlib.blake2b(data.encode(), digest_size=16).digest()

    def shingles(self, words: list[str]) -> np.ndarray:
        """32-bit hashes of all shingles in turn; fewer than five words make one shingle."""
        if not words:
            return np.zeros(0, np.uint32)
        if len(self.known) > self.CACHED:
            self.known.clear()
        known = self.known
        new = set(words).difference(known)
        for word in new:
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        for word in new:
            if len(word) > self.LONGEST_CACHED:
                del known[word]
        width = min(SHINGLE_WORDS, len(hashes))
        total = np.zeros(len(hashes) - width + 1, np.uint64)
        for i in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(total)]
        return (_mix(total) >> np.uint64(32)).astype(np.uint32)


class Sampler:
    """Consistent weighted samples of weighted shingles.

    Per sample and shingle, r and c follow Gamma(2, 1) and beta is uniform. They come from a
    table that the shingle's hash, spread by a multiplier of the sample, points into.
    """

    def __init__(self, seed: int = 7):
        random = np.random.RandomState(seed)
        r = random.gamma(2, 1, _PARAMETERS)
        c = random.gamma(2, 1, _PARAMETERS)
        beta = random.uniform(0, 1, _PARAMETERS)
        # with t = floor(log w / r + beta), the sample is the shingle with the least
        # log c - r * (t - beta + 1)
        self.inverse, self.beta = (1 / r).astype(np.float32), beta.astype(np.float32)
        self.r, self.rest = r.astype(np.float32), (np.log(c) + r * beta - r).astype(np.float32)
        self.spread = (random.randint(0, 1 << 31, SAMPLES) * 2 + 1).astype(np.uint32)
        # nearly all shingles occur once and weigh the most that one can: of each place in the
        # table, their step and value
        self.usual = np.float32(np.log1p(1 / CUT_SHARE))
        self.usual_step = np.floor(np.log(self.usual) * self.inverse + self.beta)
        self.usual_value = self.rest - self.r * self.usual_step

    def _least(self, own: np.ndarray, log_weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each sample the least value, and the hash and step it belongs to."""
        place = ((own[:, None] * self.spread) >> np.uint32(16)).astype(np.intp)
        columns = np.arange(SAMPLES)
        if log_weight is None:
            value = self.usual_value.take(place)
            least = np.argmin(value, axis=0)
            return value[least, columns], own[least], self.usual_step[place[least, columns]]
        step = np.floor(log_weight[:, None] * self.inverse.take(place) + self.beta.take(place))
        value = self.rest.take(place) - self.r.take(place) * step
        least = np.argmin(value, axis=0)
        return value[least, columns], own[least], step[least, columns]

    def samples(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value per sample, of the shingle and step chosen."""
        hashes = (_mix(shingles.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        usual = weights == self.usual
        parts = [(hashes[usual], None), (hashes[~usual], np.log(weights[~usual]).astype(np.float32))]
        best = np.full(SAMPLES, np.inf, np.float32)
        chosen = np.zeros(SAMPLES, np.uint64)
        for own, log_weight in parts:
            for at in range(0, len(own), 1024):
                part = slice(at, at + 1024)
                found, hash_, step = self._least(own[part], None if log_weight is None else log_weight[part])
                # of equal values the smaller hash, whatever the order
                better = (found < best) | ((found == best) & (hash_ < (chosen >> np.uint64(32))))
                picked = hash_.astype(np.uint64) << np.uint64(32) | step.astype(np.int32).view(np.uint32)
                best, chosen = np.where(better, found, best), np.where(better, picked, chosen)
        return _mix(chosen)


def bands_of(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of samples."""
    rows = samples.reshape(BANDS, -1)
    keys = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(rows.shape[1]):
        keys = _mix(keys + rows[:, i])
    return keys.view(np.int64)


def weighted(shingles: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their weights."""
    distinct, counts = np.unique(shingles, return_counts=True)
    return distinct, counts * idf[distinct % SLOTS]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of smaller over the sum of larger weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - shared
    return float(shared / union) if union > 0 else 0.0


_shingler = Shingler()
_samplers: dict[int, Sampler] = {}


def _sampler() -> Sampler:
    if not _samplers:
        _samplers[0] = Sampler()
    return _samplers[0]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Of each hash slot, the number of all texts with a shingle there; and of all texts."""

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                words = _shingler.words(text.as_py())
                counts[np.unique(_shingler.shingles(words) % SLOTS)] += 1
                rows += 1
        blocks = counts.reshape(-1, _SLOT_BLOCK)
        met = np.flatnonzero(blocks.any(axis=1))
        data = [blocks[i].astype("<u4").tobytes() for i in met]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *met.tolist()], pa.int64()), pa.array([np.array([rows], "<u4").tobytes(), *data], pa.binary())],
            names=["block", "counts"],
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for counts in batch.column("counts"):
                total = total + np.frombuffer(counts.as_py(), "<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([total.astype("<i8").tobytes()], pa.binary())],
            names=["block", "counts"],
        )

    schema = "block long, counts binary"
    summed = texts.select("text").mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema)
    counts, rows = np.zeros(SLOTS, np.int64), 0
    for row in summed.toLocalIterator():  # SLOTS numbers in all
        values = np.frombuffer(row.counts, "<i8")
        if row.block < 0:
            rows = int(values[0])
        else:
            counts[row.block * _SLOT_BLOCK : (row.block + 1) * _SLOT_BLOCK] = values
    return counts, rows


def idf_table(counts: np.ndarray, rows: int) -> np.ndarray:
    idf = np.log1p(rows / np.maximum(counts, 1))
    return np.minimum(idf, np.log1p(1 / CUT_SHARE))


def signatures(texts: DataFrame, idf) -> DataFrame:
    """Per row of (doc_id, text, text_hash): doc_id, text_hash, key (of its word sequence),
    weight in all, one byte per sample, bands, and its shingles, sorted, as 32-bit numbers.
    Texts without words have no bands."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys, weights, samples, bands, shingles = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    words = _shingler.words(text)
                    keys.append(_shingler.key(text, words))
                    all_own = _shingler.shingles(words)
                    own, weight = weighted(all_own, idf.value)
                    weights.append(float(weight.sum()))
                    chosen = sampler.samples(own, weight)
                    samples.append((chosen >> np.uint64(56)).astype(np.uint8).tobytes())
                    bands.append(bands_of(chosen).tolist() if len(own) else [])
                    shingles.append(np.sort(all_own).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(keys, pa.binary()),
                        pa.array(weights, pa.float64()),
                        pa.array(samples, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(shingles, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "key", "weight", "samples", "bands", "shingles"],
                )
        _shingler.known.clear()

    return texts.mapInArrow(
        run,
        "doc_id long, text_hash binary, key binary, weight double, samples binary, bands array<bigint>, shingles binary",
    )


def _verified(pairs: DataFrame, shingles: DataFrame, idf, least: float) -> DataFrame:
    """Of pairs (a, b) of keys, those of enough similarity."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            near = [
                similarity(
                    weighted(np.frombuffer(x, "<u4"), idf.value), weighted(np.frombuffer(y, "<u4"), idf.value)
                ) >= least
                for x, y in zip(left, right)
            ]
            kept = batch.filter(pa.array(near, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    first = shingles.select(F.col("key").alias("a"), F.col("shingles").alias("of_a"))
    second = shingles.select(F.col("key").alias("b"), F.col("shingles").alias("of_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "of_a", "of_b")
    return joined.mapInArrow(run, "a binary, b binary")


def _candidates(table: pa.Table, cross: bool, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Of each row of a group in turn the later ones of another class that may be similar
    enough by weight and samples, those that agree most first."""
    weights = table.column("weight").to_numpy()
    samples = np.frombuffer(b"".join(table.column("samples").to_pylist()), np.uint8).reshape(-1, SAMPLES)
    side = table.column("side").to_numpy()
    classes = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)[1]
    for i in range(len(classes)):
        others = np.arange(i + 1, len(classes))
        ok = classes[others] != classes[i]
        if cross:
            ok &= side[others] != side[i]
        others = others[ok]
        small, large = np.minimum(weights[others], weights[i]), np.maximum(weights[others], weights[i])
        others = others[small >= (least - 1e-9) * large]
        agree = (samples[others] == samples[i]).sum(axis=1)
        order = np.argsort(-agree, kind="stable")
        yield i, others[order][agree[order] >= LEAST_AGREEING]


def _sift_groups(least: float):
    """The rows of a block, or of two, that have a candidate there; reads no shingles."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        met = np.zeros(table.num_rows, bool)
        for i, others in _candidates(table, key[1].as_py() != key[2].as_py(), least):
            met[others] = True
            met[i] |= bool(len(others))
        return table.filter(pa.array(met))

    return run


def _compare_groups(idf, least: float):
    """Links inside one block, or between two, of a bucket."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, labels = table.column("key").to_pylist(), table.column("label").to_pylist()
        shingles = table.column("shingles")
        bands = [set(own) for own in table.column("bands").to_pylist()]
        band = table.column("band")[0].as_py()
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while x in parent:
                x = parent[x]
            return x

        vectors: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def vector(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in vectors:
                vectors[i] = weighted(np.frombuffer(shingles[i].as_py(), "<u4"), idf.value)
            return vectors[i]

        found_a, found_b = [], []
        for i, others in _candidates(table, key[1].as_py() != key[2].as_py(), least):
            for j in others.tolist():
                # a pair with several common buckets is looked at in the first of them
                if min(bands[i] & bands[j]) != band or root(labels[i]) == root(labels[j]):
                    continue
                if similarity(vector(i), vector(j)) >= least:
                    found_a.append(keys[i])
                    found_b.append(keys[j])
                    parent[root(labels[i])] = root(labels[j])
        return pa.table([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], names=["a", "b"])

    return run


def components(edges: DataFrame, nodes: int | None = None) -> DataFrame:
    """Of edges (a, b), each node with the least node it is connected to: key, label.

    Edges are turned towards the least neighbour, from larger and from smaller nodes in turn,
    until every node points at the least of its component. The number of rounds grows with
    the logarithm of the longest chain; each round is written before the next. `nodes`: about
    how many there may be, if known; the first edges are then stored together.
    """

    def state(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    turned = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = stored(turned if nodes is None else few(turned, nodes, TEXTS_A_FILE), "near-edges")
    before = state(current)
    while True:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.hex("u").alias("h"), F.least("u", "m").alias("m"))
        # joined by another form of the key, so that a node with many edges can be split
        large = both.where("v > u").withColumn("h", F.hex("u")).join(least, "h").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m")).select(F.hex("u").alias("h"), "m")
        joined = large.withColumn("h", F.hex("u")).join(lower, "h")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(joined.select("u", F.col("m").alias("v"))).distinct()
        current = stored(few(small, before[0], LINKS_A_FILE), "near-edges")
        same, before = before, state(current)
        if same == before:
            return current.select(F.col("u").alias("key"), F.col("v").alias("label"))


def _classes(docs: DataFrame, id_column: str, text: str, least: float) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, class_id, class_size, kept."""
    body = text_or_empty(f"`{text}`")
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), body.alias("text"), _text_hash(body).alias("text_hash"))
    context = docs.sparkSession.sparkContext
    counts, n_texts = document_frequencies(texts)
    idf = context.broadcast(idf_table(counts, n_texts).astype(np.float32))

    def kept_together(rows: DataFrame, purpose: str) -> DataFrame:
        return stored(few(rows, n_texts, TEXTS_A_FILE), purpose)

    # put together before texts go to Python, where a task then needs one worker
    signed = stored(signatures(few(texts, n_texts, TEXTS_A_FILE), idf), "near-signatures")
    keys = kept_together(signed.select("doc_id", "text_hash", "key"), "near-keys")
    distinct = signed.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min_by(F.struct("weight", "samples", "bands"), F.lit(0)).alias("s")
    )
    distinct = kept_together(distinct.where("doc_id is not null").select("key", "doc_id", "s.*"), "near-distinct")
    banded = distinct.select("key", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("hub")).where("n > 1")
    shared = shared.select(F.hex("band").alias("bucket"), "hub")
    rows = kept_together(banded.withColumn("bucket", F.hex("band")).join(shared, "bucket"), "near-buckets")
    members = rows.groupBy("key").agg(F.min("hub").alias("hub"), F.collect_list("band").alias("bands"))
    # with at most BANDS bands each
    members = kept_together(members.join(distinct.select("key", "doc_id", "weight", "samples"), "key"), "near-members")
    # of equal texts the row with the least id; rows repeated with it hold the same shingles
    texts_of = signed.groupBy("key", "doc_id").agg(F.min("shingles").alias("shingles"))
    shingles = texts_of.join(members.select("key", "doc_id", "bands"), ["key", "doc_id"]).select("key", "shingles", "bands")
    shingles = kept_together(shingles, "near-shingles")
    discard(signed, distinct)

    # each text against the first one of its buckets
    stars = members.where("key != hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    labels = components(_verified(stars, shingles, idf, least), n_texts)

    # buckets that hold more than one class yet
    labelled = rows.drop("hub").join(labels, "key", "left")
    labelled = kept_together(labelled.withColumn("label", F.coalesce("label", "key")), "near-labelled")
    sizes = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"), F.max("n").alias("n_main"), F.max_by("label", F.struct("n", "label")).alias("main")
    )
    mixed = mixed.where("classes > 1").select(
        F.unhex("bucket").alias("bucket_bytes"),
        "main",
        F.ceil(F.col("n_main") / BLOCK_ROWS).cast("int").alias("main_blocks"),
        F.ceil((F.col("n") - F.col("n_main")) / BLOCK_ROWS).cast("int").alias("other_blocks"),
    )
    opened = labelled.withColumn("bucket_bytes", F.unhex("bucket")).join(mixed, "bucket_bytes").drop("bucket_bytes")
    opened = opened.join(members.select("key", "weight", "samples"), "key")
    is_main = F.col("label") == F.col("main")
    number = F.abs(F.xxhash64("key"))
    own = F.when(is_main, number % F.col("main_blocks")).otherwise(number % F.col("other_blocks")).cast("int")
    to_main = F.transform(
        F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda i: F.struct(F.lit(-1).alias("i"), i.alias("j"))
    )
    to_others = F.transform(
        F.sequence(F.lit(0), F.col("other_blocks") - 1),
        lambda i: F.struct(F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")),
    )
    places = F.when(is_main, F.array(F.struct(F.lit(-1).alias("i"), F.col("own").alias("j")))).otherwise(
        F.concat(to_main, to_others)
    )
    dealt = opened.withColumn("own", own).withColumn("place", F.explode(places)).select(
        "bucket",
        "place.i",
        "place.j",
        "key",
        "label",
        "weight",
        "samples",
        "band",
        # the side of a pair of blocks: the main class against the others, or block against block
        F.when(is_main, -1).otherwise(F.when(F.col("place.i") < 0, 0).otherwise(F.col("own"))).alias("side"),
    )
    dealt = dealt.withColumns({name: F.col(name).cast("int") for name in ("i", "j", "side")})
    sifted = dealt.groupBy("bucket", "i", "j").applyInArrow(_sift_groups(least), dealt.schema)
    # only texts with a candidate are given their shingles
    sifted = stored(sifted, "near-sifted")
    more = (
        sifted.join(shingles, "key")
        .groupBy("bucket", "i", "j")
        .applyInArrow(_compare_groups(idf, least), "a binary, b binary")
    )
    # the labels so far stand for the links behind them
    joined = components(labels.select(F.col("key").alias("a"), F.col("label").alias("b")).union(more), n_texts)
    classes = keys.join(joined, "key", "left").select(
        "doc_id", "text_hash", F.coalesce("label", "key").alias("label")
    )
    classes = kept_together(classes, "near-classes")
    discard(keys, rows, members, shingles, labelled, sifted)
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    named = classes.groupBy("label").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("class_size"))
    named = named.select(F.hex("label").alias("h"), "first", "class_size")
    return classes.withColumn("h", F.hex("label")).join(named, "h").select(
        "doc_id",
        "text_hash",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        own.eqNullSafe(F.col("first")).alias("kept"),
    )


def _text_hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id (the least id of its class), class_size,
    kept (whether it is the one of its class that stays).

    Texts are compared by lower-cased words. Null counts as empty; texts without words are
    alike only if equal. Rows repeated with the same id and text are one document and stay or
    go together; of different texts with the least id of a class, the one with the least
    SHA-256 stays. Rows with a null id join a class by an equal word sequence only, and go
    unless all of it have none. An empty table gives no rows; other columns are not read.
    """
    return _classes(docs, id_column, text, least).drop("text_hash")


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns, whatever their names: one document
    of each class, told by id and text (null ids and texts too)."""
    id_name, hash_name = free_name(docs, "gone_id"), free_name(docs, "gone_text")
    gone = _classes(docs, id_column, text, SIMILARITY).where("not kept")
    gone = gone.select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name)).distinct()
    same_id = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col(id_name))
    return docs.join(gone, same_id & (_text_hash(text_or_empty(f"`{text}`")) == F.col(hash_name)), "left_anti")
